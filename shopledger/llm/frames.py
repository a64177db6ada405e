"""Texts as independent zstandard frames with cumulative counts, so that any place in a text can be found by one frame.

A unit is a run of blanks with the run of other characters after it, or the blanks that end a text; blanks are
`[\\x20\\x09-\\x0D]`. A frame ends behind a unit, at the first one that fills `FRAME_BYTES`, or with the text. `units` and `chars`
count from the text's begin to the end of each frame. Whoever needs a place decompresses the frame that holds it; whoever
needs a whole text takes one frame after the other, so no more than one frame is open at a time.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard

FRAME_BYTES = 1 << 16
LEVEL = 1

_UNIT = re.compile(rb"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
_UNIT_END = re.compile(rb"[^\x20\x09-\x0D](?=[\x20\x09-\x0D])")

COLUMNS = "frames array<binary>, units array<long>, chars array<long>"


def characters(data: bytes) -> int:
    return len(data.decode("utf-8", "replace"))


@dataclass
class Place:
    """A position in a text: a frame, the byte in it, and the characters of the whole text before it."""

    frame: int
    byte: int
    chars: int


@dataclass
class Frames:
    frames: list[bytes] = field(default_factory=list)
    units: list[int] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)

    @property
    def n(self) -> int:
        return self.units[-1] if self.units else 0

    def opened(self, i: int) -> bytes:
        return zstandard.ZstdDecompressor().decompress(self.frames[i])

    def place(self, unit: int) -> Place:
        """Where `unit` units of the text end; only the frame that holds this place is decompressed."""
        if unit <= 0 or not self.frames:
            return Place(0, 0, 0)
        i = bisect_left(self.units, min(unit, self.n))
        data, byte = self.opened(i), 0
        skipped = unit - (self.units[i - 1] if i else 0)
        for nth, found in enumerate(_UNIT.finditer(data), 1):
            byte = found.end()
            if nth == skipped:
                break
        return Place(i, byte, (self.chars[i - 1] if i else 0) + characters(data[:byte]))

    @property
    def end(self) -> Place:
        return Place(len(self.frames), 0, self.chars[-1] if self.chars else 0)

    def stream(self, start: Place | None = None, end: Place | None = None) -> Iterator[bytes]:
        """The text between two places, frame by frame."""
        start, end = start or Place(0, 0, 0), end or self.end
        for i in range(start.frame, min(end.frame + 1, len(self.frames))):
            if i == end.frame and not end.byte:
                return
            data = self.opened(i)
            yield data[start.byte if i == start.frame else 0 : end.byte if i == end.frame else None]


def framed(pieces: Iterable[bytes], limit: int = FRAME_BYTES) -> Frames:
    """Pieces of one text, one behind the other, as frames; at most a frame and a unit wait at a time."""
    out, waiting, searched = Frames(), bytearray(), 0
    press = zstandard.ZstdCompressor(level=LEVEL)

    def close(size: int) -> None:
        data = bytes(waiting[:size])
        del waiting[:size]
        out.frames.append(press.compress(data))
        out.units.append(out.n + len(_UNIT.findall(data)))
        out.chars.append((out.chars[-1] if out.chars else 0) + characters(data))

    for piece in pieces:
        for at in range(0, len(piece), limit):
            waiting += piece[at : at + limit]
            while len(waiting) > limit:
                found = _UNIT_END.search(waiting, max(limit - 1, searched))
                if not found:
                    searched = len(waiting) - 1  # its last byte may yet end a unit
                    break
                end, searched = found.end(), 0
                del found  # lets go of `waiting`, which shrinks now
                close(end)
    if waiting:
        close(len(waiting))
    return out


def arrays(found: list[Frames]) -> list[pa.Array]:
    """The columns `COLUMNS` of some texts."""
    return [
        pa.array([f.frames for f in found], pa.list_(pa.binary())),
        pa.array([f.units for f in found], pa.list_(pa.int64())),
        pa.array([f.chars for f in found], pa.list_(pa.int64())),
    ]


def rows(batch: pa.RecordBatch) -> Iterator[Frames]:
    """The texts of a batch with the columns `COLUMNS`, one at a time."""
    columns = [batch.column(batch.schema.get_field_index(c)) for c in ("frames", "units", "chars")]
    for frames, units, chars in zip(*columns):
        yield Frames(frames.as_py() or [], units.as_py() or [], chars.as_py() or [])

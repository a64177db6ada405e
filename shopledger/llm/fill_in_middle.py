"""Fill-in-middle over texts that lie in seekable compressed frames.

A text of n units (see `frames`) is cut at two places drawn by a hash of its id, which gives prefix, middle and suffix. The form
`psm` is the first mark, prefix, second mark, suffix, third mark, middle; `spm` is the second mark, suffix, first mark,
prefix, third mark, middle; a `plain` text stays as it is. Marks hold no blank, so no frame splits one. The cuts are looked
up by the cumulative counts and one frame each; outputs are streamed into frames of their own, and read back from these.

Defined cases: null and empty texts have no unit and are plain; so is a text that holds a mark; a null id is hashed as the
seed alone; equal rows each get their result, the same one; cuts may leave any part empty; a unit longer than a frame
makes a frame of its own, and other texts of any length are held compressed, besides the row that Spark hands over; other
columns of the input are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm import frames as S
from shopledger.llm.frames import Frames, Place

MARKS = ("<P>", "<S>", "<M>")
BATCH_BYTES = 8 << 20


def store(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", marks: Sequence[str] = MARKS) -> DataFrame:
    """doc_id, marked (does the text hold a mark?), n (units), frames, units, chars; texts don't move between tasks."""
    _checked(marks)
    held = F.lit(False)
    for mark in marks:
        held = held | F.coalesce(F.contains(F.col(text_column), F.lit(mark)), F.lit(False))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), held.alias("marked"),
                        F.col(text_column).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = ((i, S.framed([text.as_py() or b""])) for i, text in enumerate(batch.column(2)))
            for first, some in _portions(found):
                same = batch.slice(first, len(some))
                yield pa.RecordBatch.from_arrays(
                    [same.column(0), same.column(1), pa.array([f.n for f in some], pa.int64()), *S.arrays(some)],
                    ["doc_id", "marked", "n", "frames", "units", "chars"],
                )

    return texts.mapInArrow(run, f"doc_id long, marked boolean, n long, {S.COLUMNS}")


def _checked(marks: Sequence[str]) -> None:
    if len(set(marks)) != 3 or any(not m or any(c in " \t\n\x0b\f\r" for c in m) for m in marks):
        raise ValueError("three different marks without blanks are needed")
    if any(a != b and a in b for a in marks for b in marks):
        raise ValueError("no mark may hold another one")
    if any(a[-k:] == b[:k] for a in marks for b in marks for k in range(1, min(len(a), len(b)))):
        raise ValueError("no mark may end as a mark begins")


def _portions(found: Iterable[tuple[int, Frames]]) -> Iterator[tuple[int, list[Frames]]]:
    """Neighbouring texts whose frames together hold about `BATCH_BYTES`, with the number of the first."""
    first, some, size = 0, [], 0
    for i, f in found:
        some.append(f)
        size += sum(map(len, f.frames))
        if size >= BATCH_BYTES:
            yield first, some
            first, some, size = i + 1, [], 0
    if some:
        yield first, some


def output(text: Frames, form: str, first: Place, second: Place, marks: Sequence[str] = MARKS) -> Iterator[bytes]:
    """The output of a text in a form, in pieces of a frame at most."""
    p, s, m = (mark.encode() for mark in marks)
    if form == "plain":
        yield from text.stream()
        return
    parts = {p: (Place(0, 0, 0), first), s: (second, text.end), m: (first, second)}
    for mark in (p, s, m) if form == "psm" else (s, p, m):
        yield mark
        yield from text.stream(*parts[mark])


def restored(made: Frames, form: str, marks: Sequence[str] = MARKS) -> Iterator[bytes]:
    """The text behind an output, from the output and its form alone."""
    if form == "plain":
        yield from made.stream()
        return
    p, s, m = (mark.encode() for mark in marks)
    order, at = ((p, s, m) if form == "psm" else (s, p, m)), 0
    begins, ends = {}, {}
    for i in range(len(made.frames)):
        data, byte = made.opened(i), 0
        while at < 3 and (byte := data.find(order[at], byte)) >= 0:
            if at:
                ends[order[at - 1]] = Place(i, byte, 0)
            byte += len(order[at])
            begins[order[at]] = Place(i, byte, 0)
            at += 1
    ends[m] = made.end
    for mark in (p, m, s):
        yield from made.stream(begins[mark], ends[mark])


def transform(stored: DataFrame, *, seed: int = 42, percent: int = 50, spm_percent: int = 80,
              marks: Sequence[str] = MARKS) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the output as frames, units, chars, of texts that `store` gave.

    `percent` of the texts are rearranged, `spm_percent` of these as spm.
    """
    _checked(marks)
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)

    def group(i: int) -> Column:
        return F.conv(F.substring("digest", 8 * i + 1, 8), 16, 10).cast("long")

    a, b = group(0) % (F.col("n") + 1), group(1) % (F.col("n") + 1)
    plain = (F.col("n") == 0) | F.col("marked") | (group(2) % 100 >= percent)
    drawn = stored.withColumn("digest", digest).select(
        "doc_id", "n", F.when(plain, "plain").when(group(3) % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
        F.least(a, b).alias("first"), F.greatest(a, b).alias("second"), "frames", "units", "chars",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, firsts, seconds = (batch.column(i).to_pylist() for i in (2, 3, 4))
            sizes: list[tuple[int | None, int | None]] = []

            def made() -> Iterator[tuple[int, Frames]]:
                for i, text in enumerate(S.rows(batch)):
                    if forms[i] == "plain":
                        sizes.append((None, None))
                        yield i, text
                    else:
                        first, second = text.place(firsts[i]), text.place(seconds[i])
                        sizes.append((first.chars, second.chars - first.chars))
                        yield i, S.framed(output(text, forms[i], first, second, marks))

            for first, some in _portions(made()):
                same, known = batch.slice(first, len(some)), sizes[first : first + len(some)]
                yield pa.RecordBatch.from_arrays(
                    [same.column(0), same.column(1), same.column(2), pa.array([x for x, _ in known], pa.int64()),
                     pa.array([x for _, x in known], pa.int64()), *S.arrays(some)],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "frames", "units", "chars"],
                )

    return drawn.mapInArrow(run, f"doc_id long, n long, form string, prefix_chars long, middle_chars long, {S.COLUMNS}")


def texts(made: DataFrame, column: str = "output") -> DataFrame:
    """The columns of `made` with one of whole texts instead of frames."""
    others = [c for c in made.columns if c not in ("frames", "units", "chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [b"".join(f.stream()) for f in S.rows(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in others]
                + [pa.array(whole, pa.binary()).cast(pa.string())], [*others, column],
            )

    return made.mapInArrow(run, made.select(*others).schema.add(column, "string"))


def digests(made: DataFrame, *, marks: Sequence[str] = MARKS) -> DataFrame:
    """`made` without its frames, with output_sha256 and with restored_sha256 of the text that is rebuilt from the output."""
    others = [c for c in made.columns if c not in ("frames", "units", "chars")]

    def digest(pieces: Iterable[bytes]) -> str:
        out = hashlib.sha256()
        for piece in pieces:
            out.update(piece)
        return out.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = batch.column(batch.schema.get_field_index("form")).to_pylist()
            found = [(digest(f.stream()), digest(restored(f, form, marks))) for f, form in zip(S.rows(batch), forms)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in others]
                + [pa.array([x[i] for x in found], pa.string()) for i in (0, 1)],
                [*others, "output_sha256", "restored_sha256"],
            )

    schema = made.select(*others).schema.add("output_sha256", "string").add("restored_sha256", "string")
    return made.mapInArrow(run, schema)

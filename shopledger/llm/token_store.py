"""Token ids of documents in raw shard files, with a minimal perfect hash index from document key to place.

Files of a store, all in one shared folder:

  ids-P-K.bin    16 bytes of header ("TIDS", a byte for the version, one for the bytes per id, 2 unused, 8 for the number
                 of ids), then the ids in little-endian order: 2 bytes each if the vocabulary allows it, else 4
  index-B.npz    one bucket of the index: bits and ranks of a minimal perfect hash, and by slot the key's fingerprint,
                 shard, offset (ids before it in the shard) and number of ids

Documents lie in ascending order of their ids; each ends with the end id. A look-up hashes the key, takes its bucket's file,
walks a few bit arrays to a slot, compares the fingerprint and reads one range of one shard. Tasks write under a name of
their own and rename, so a repeated task replaces a file by an equal one.

Defined cases: null and empty texts have the end id only; a null id comes first; rows that share an id are stored one after
the other in the order of a hash of their texts and are told apart by a number from 1; an empty table gives a store without
files; other columns are ignored.
"""

from __future__ import annotations

import io
import json
import os
import re
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shopledger.llm import text as T
from shopledger.llm.language_id import code_points
from shopledger.llm.scratch import saved, shared_folder

SHARD_IDS = 1 << 24
BUCKET_KEYS = 50_000
_HEADER, _HEADER_BYTES = "<4sBBxxQ", 16
_LETTER, _DIGIT, _SIGN, _SPACE, _UNSURE = range(5)
# White_Space of the Unicode standard
_SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]


def _open(folder: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    if "://" in folder:
        return pyarrow.fs.FileSystem.from_uri(folder)
    return pyarrow.fs.LocalFileSystem(), folder


def _put(folder: str, name: str, *parts: bytes) -> None:
    files, path = _open(folder)
    files.create_dir(path, recursive=True)
    own = f"{path}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(own) as out:
        for part in parts:
            out.write(part)
    files.move(own, f"{path}/{name}")


# --- encoding ---------------------------------------------------------------------------------------------------------


def _kinds() -> np.ndarray:
    """Letter, digit, white space or another sign by code point; unsure where Unicode's versions differ."""
    def kind(category: str) -> int:
        return {"L": _LETTER, "N": _DIGIT}.get(category[0], _SIGN)

    out = np.full(0x110000, _UNSURE, np.uint8)
    old = unicodedata.ucd_3_2_0
    for point in range(0x110000):
        now = unicodedata.category(chr(point))
        if now != "Cn" and kind(now) == kind(old.category(chr(point))):
            out[point] = kind(now)
    out[_SPACES] = _SPACE
    out[0x180E] = _UNSURE
    return out


def pieces(points: np.ndarray, kinds: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First code points of the pieces into which byte-level BPE cuts texts before it merges.

    These are runs of letters, of digits or of other signs, each with one blank before it; the endings 's 't 're 've 'm 'll
    'd after an apostrophe that stands alone; and white space, whose last character goes with what follows if it's a blank
    and is a piece of its own if not.
    """
    n = len(points)
    first = np.zeros(n + 1, bool)
    first[bounds] = True  # first[n]: the end
    run = first.copy()
    run[1:n] |= kinds[1:] != kinds[:-1]
    space = kinds == _SPACE
    start = run[:n].copy()
    joined = np.zeros(n, bool)  # a blank before it in the same text goes with it
    joined[1:] = ~space[1:] & (points[:-1] == 32) & ~first[1:n]
    start &= ~joined
    # last white space before something else
    start[:-1] |= space[:-1] & ~space[1:] & ~first[1:n]
    quote = np.flatnonzero((points == 39) & run[:n] & ~joined)
    quote = quote[quote + 1 < n]
    quote = quote[run[quote + 1] & ~first[quote + 1] & (kinds[quote + 1] == _LETTER)]
    if len(quote):
        one = points[quote + 1]
        more = np.zeros(len(quote), bool)
        inside = quote + 2 < n
        more[inside] = ~first[quote[inside] + 2]
        two = np.where(more, points[np.minimum(quote + 2, n - 1)], 0)
        size = np.zeros(len(quote), np.int64)
        for letters in ("re", "ve", "ll"):
            size[(one == ord(letters[0])) & (two == ord(letters[1]))] = 2
        size[np.isin(one, [ord(c) for c in "stmd"])] = 1
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        after = quote + 1 + size
        after = after[after < n]
        start[after] |= ~joined[after]
    return np.flatnonzero(start)


class Encoder:
    """Ids of many texts at once: every different piece goes through the tokenizer once and is remembered.

    A text whose cutting depends on Unicode's version or that holds an added token of the tokenizer, such as <|endoftext|>,
    takes the library's plain way, and so does every text with a tokenizer of another kind.
    """

    KEEP = 1_000_000  # remembered pieces; beyond this the memory starts anew

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self.added = re.compile(b"|".join(re.escape(t) for t in added)) if added else None
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        cut = settings.get("pre_tokenizer") or {}
        self.by_piece = (
            settings["model"]["type"] == "BPE" and not settings.get("normalizer") and not settings.get("truncation")
            and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space", True)
        )
        self.kinds = _kinds() if self.by_piece else None
        self._forget()

    def _forget(self) -> None:
        self.place: dict[int, int] = {}
        self.ids = np.zeros(1 << 20, np.uint32)
        self.ends = np.zeros(1 << 18, np.int64)

    def _learn(self, hashes: list[int], strings: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)]
        known = len(self.place)
        while len(self.ends) < known + len(found) + 1:
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        used = int(self.ends[known])
        ends = used + np.cumsum([len(x) for x in found])
        while len(self.ids) < ends[-1]:
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[used : ends[-1]] = np.concatenate([np.asarray(x, np.uint32) for x in found])
        self.ends[known + 1 : known + 1 + len(found)] = ends
        self.place.update(zip(hashes, range(known, known + len(found))))

    def _plain(self, part: T.Slice) -> tuple[np.ndarray, np.ndarray]:
        data = part.data.tobytes()
        texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(part.bounds, part.bounds[1:])]
        found = [np.asarray(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(found), np.array([len(x) for x in found], np.int64)

    def _with_added(self, part: T.Slice) -> np.ndarray:
        """Rows that hold a byte of an added token's text; a match over two rows counts for both."""
        out = np.zeros(part.rows, bool)
        if self.added is not None:
            for match in self.added.finditer(part.data):
                first, last = np.searchsorted(part.bounds, [match.start(), match.end() - 1], "right") - 1
                out[first : last + 1] = True
        return out

    def encode(self, part: T.Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice and their number by row."""
        if not self.by_piece:
            return self._plain(part)
        points, bounds = code_points(part)
        kinds = self.kinds[points]
        unsure = kinds == _UNSURE
        odd = self._with_added(part)
        if unsure.any():
            odd |= np.diff(np.concatenate([[0], np.cumsum(unsure)])[bounds]) > 0
        if odd.any():
            return self._mixed(part, odd)
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(part.rows, np.int64)
        starts = pieces(points, kinds, bounds)
        ends = np.append(starts[1:], len(points))
        different, at, which = np.unique(T.span_hashes(points, starts, ends), return_index=True, return_inverse=True)
        if len(self.place) > self.KEEP:
            self._forget()
        keys = different.tolist()
        new = [i for i, key in enumerate(keys) if key not in self.place]
        if new:
            text = points.astype("<u4").tobytes().decode("utf-32-le")
            first = at[new]
            self._learn([keys[i] for i in new], [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())])
        place = np.array([self.place[key] for key in keys], np.int64)[which]
        sizes = self.ends[place + 1] - self.ends[place]
        total = np.concatenate([[0], np.cumsum(sizes)])
        return self.ids[T.flat(sizes, self.ends[place])], np.diff(total[np.searchsorted(starts, bounds)])

    def _mixed(self, part: T.Slice, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        found, counts = [], []
        for i in range(part.rows):
            a, b = part.bounds[i], part.bounds[i + 1]
            own = T.Slice(i, part.data[a:b], np.array([0, b - a]))
            ids, n = self._plain(own) if odd[i] else self.encode(own)
            found.append(ids)
            counts.append(n)
        return np.concatenate(found), np.concatenate(counts)


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder for a tokenizer file, so that what it remembers serves later tasks too."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# --- minimal perfect hash ---------------------------------------------------------------------------------------------


def key_hashes(keys: list) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each (id as text or None, number) for its place, and an independent 32-bit fingerprint."""
    raw = [b"%d" % n if k is None else b"%d:%s" % (n, str(k).encode()) for k, n in keys]
    place = np.array([xxhash.xxh64_intdigest(r, 1) for r in raw], np.uint64)
    return place, np.array([xxhash.xxh64_intdigest(r, 2) & 0xFFFFFFFF for r in raw], np.uint32)


@dataclass
class PerfectHash:
    """Different 64-bit hashes to 0 ... n - 1 without gaps, in about 3 bits a key.

    At each level a key sets one bit; keys that meet go to the next level. A key's slot is the number of set bits before its
    own. The few that still meet after the last level are listed.
    """

    sizes: np.ndarray
    words: np.ndarray
    ranks: np.ndarray
    listed: np.ndarray

    LEVELS = 32

    @staticmethod
    def _at(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (T.mixed(hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        left, sizes, bits = hashes, [], []
        while len(left) and len(sizes) < cls.LEVELS:
            size = -(-len(left) * 3 // 2 // 64) * 64 + 64
            at = cls._at(left, len(sizes), size)
            count = np.bincount(at, minlength=size)
            bits.append(count == 1)
            sizes.append(size)
            left = left[count[at] > 1]
        flat = np.concatenate(bits) if bits else np.zeros(0, bool)
        words = np.packbits(flat, bitorder="little").view(np.uint64)
        ranks = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])
        return cls(np.array(sizes, np.int64), words, ranks, left)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """The slot of each hash, -1 for one that certainly has none."""
        out = np.full(len(hashes), -1, np.int64)
        open_rows, base = np.arange(len(hashes)), 0
        for level, size in enumerate(self.sizes.tolist()):
            at = base + self._at(hashes[open_rows], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            found = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[open_rows[found]] = (self.ranks[word] + np.bitwise_count(below))[found]
            open_rows, base = open_rows[~found], base + size
        for i, value in enumerate(self.listed.tolist()):
            out[open_rows[hashes[open_rows] == np.uint64(value)]] = self.ranks[-1] + i
        return out


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (T.mixed(hashes ^ np.uint64(0xB0C5E7)) % np.uint64(buckets)).astype(np.int64)


@dataclass
class Bucket:
    """One index file."""

    hash: PerfectHash
    fingerprint: np.ndarray
    shard: np.ndarray
    offset: np.ndarray
    length: np.ndarray

    FIELDS = ("fingerprint", "shard", "offset", "length")

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self.hash), **{f: getattr(self, f) for f in self.FIELDS})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Bucket:
        file = np.load(io.BytesIO(data))
        hash_fields = ("sizes", "words", "ranks", "listed")
        return cls(PerfectHash(*(file[f] for f in hash_fields)), *(file[f] for f in cls.FIELDS))

    def find(self, hashes: np.ndarray, fingerprints: np.ndarray) -> np.ndarray:
        """Slots of keys, -1 where the stored fingerprint says that the key isn't there."""
        slot = self.hash.slots(hashes)
        known = slot >= 0
        known[known] = self.fingerprint[slot[known]] == fingerprints[known]
        return np.where(known, slot, -1)


# --- store ------------------------------------------------------------------------------------------------------------


@dataclass
class Store:
    """A written store. `shards`: shard, name, base (ids in all shards before it), n_ids. `keys`: doc_id, number."""

    folder: str
    buckets: int
    shards: DataFrame
    keys: DataFrame

    def find(self, keys: DataFrame) -> DataFrame:
        """Places of `keys` (doc_id, number): doc_id, number, shard, offset, length; keys not stored are left out."""
        folder, buckets = self.folder, self.buckets
        id_type = keys.schema["doc_id"].dataType.simpleString()

        def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes, prints = key_hashes(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(hashes.view(np.int64)), pa.array(prints.astype(np.int64)),
                     pa.array(_bucket(hashes, buckets))],
                    ["doc_id", "number", "hash", "fingerprint", "bucket"],
                )

        def found(table: pa.Table) -> pa.Table:
            files, path = _open(folder)
            with files.open_input_file(f"{path}/index-{table['bucket'][0].as_py():06d}.npz") as file:
                index = Bucket.from_bytes(file.read())
            slot = index.find(
                table["hash"].to_numpy().view(np.uint64), table["fingerprint"].to_numpy().astype(np.uint32)
            )
            kept = np.flatnonzero(slot >= 0)
            out, slot = table.select(["doc_id", "number"]).take(pa.array(kept)), slot[kept]
            for name in ("shard", "offset", "length"):
                out = out.append_column(name, pa.array(getattr(index, name)[slot].astype(np.int64)))
            return out

        # a bucket has about BUCKET_KEYS keys, whatever the ids are, since a hash of the key chooses it
        return (
            keys.select("doc_id", "number")
            .mapInArrow(dealt, f"doc_id {id_type}, number long, hash long, fingerprint long, bucket long")
            .groupBy("bucket")
            .applyInArrow(found, f"doc_id {id_type}, number long, shard long, offset long, length long")
        )

    def read(self, keys: DataFrame) -> DataFrame:
        """`keys` with start (ids of all documents before), n_tokens and ids (4-byte little-endian numbers)."""
        return self._each(keys, lambda ids: ids.tobytes(), pa.binary(), "ids binary")

    def checksums(self, keys: DataFrame) -> DataFrame:
        """As `read`, with the unsigned crc32 of the ids in place of the ids."""
        return self._each(keys, lambda ids: zlib.crc32(ids.tobytes()), pa.int64(), "ids_crc32 long")

    def _each(self, keys: DataFrame, value, kind: pa.DataType, column: str) -> DataFrame:
        folder = self.folder
        places = self.find(keys).join(self.shards.select("shard", "name", "base"), "shard")
        id_type = keys.schema["doc_id"].dataType.simpleString()
        name = column.split()[0]

        def read(table: pa.Table) -> pa.Table:
            files, path = _open(folder)
            values, starts = [], []
            with files.open_input_file(f"{path}/{table['name'][0].as_py()}") as file:
                _, _, width, _ = struct.unpack(_HEADER, file.read(_HEADER_BYTES))
                for offset, length in zip(table["offset"].to_pylist(), table["length"].to_pylist()):
                    file.seek(_HEADER_BYTES + offset * width)
                    values.append(value(np.frombuffer(file.read(length * width), f"<u{width}").astype("<u4")))
            starts = pa.array(table["base"].to_numpy() + table["offset"].to_numpy())
            return pa.table({
                "doc_id": table["doc_id"], "number": table["number"], "start": starts,
                "n_tokens": table["length"], name: pa.array(values, kind),
            })

        # a shard has about SHARD_IDS ids, so its documents fit into a task
        return places.groupBy("shard").applyInArrow(
            read, f"doc_id {id_type}, number long, start long, n_tokens long, {column}"
        )


def _writer(folder: str, tokenizer: str, end_id: int, shard_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        width = 2 if max(own.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        partition, shard, held, waiting = TaskContext.get().partitionId(), 0, 0, []
        last, number = object(), 0

        def flush() -> None:
            nonlocal shard, held, waiting
            _put(folder, f"ids-{partition:06d}-{shard:06d}.bin", struct.pack(_HEADER, b"TIDS", 1, width, held),
                 *(x.tobytes() for x in waiting))
            shard, held, waiting = shard + 1, 0, []

        for batch in batches:
            for part in T.slices(batch.column(1)):
                ids, counts = own.encode(part)
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(f"<u{width}")
                counts = counts + 1
                keys = batch.column(0).slice(part.first, part.rows)
                numbers = []
                for key in keys.to_pylist():
                    number = number + 1 if key == last else 1
                    last = key
                    numbers.append(number)
                offsets = held + np.cumsum(counts) - counts
                waiting.append(ids)
                held += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [keys, pa.array(numbers, pa.int64()), pa.array(np.full(len(counts), partition), pa.int64()),
                     pa.array(np.full(len(counts), shard), pa.int64()), pa.array(offsets, pa.int64()),
                     pa.array(counts, pa.int64())],
                    ["doc_id", "number", "part", "piece", "offset", "length"],
                )
                if held >= shard_ids:
                    flush()
        if held:
            flush()

    return run


def write(documents: DataFrame, tokenizer: str, *, folder: str | None = None, end_id: int = 2,
          id_column: str = "doc_id", text_column: str = "text", shard_ids: int = SHARD_IDS) -> Store:
    """Encode every whole text, write shards in ascending order of the ids, and index them.

    The texts are dealt out once by ranges of ids; rows of one id stay together. All else moves keys and numbers only.
    """
    spark: SparkSession = documents.sparkSession
    folder = folder or shared_folder(spark)
    ids = documents.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    id_type = ids.schema["doc_id"].dataType.simpleString()
    ordered = ids.repartitionByRange("doc_id").sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.length("text"))
    placed = saved(ordered.mapInArrow(
        _writer(folder, tokenizer, end_id, shard_ids),
        f"doc_id {id_type}, number long, part long, piece long, offset long, length long",
    ))
    in_order = Window.orderBy("part", "piece")  # one row per shard
    shards = saved(
        placed.groupBy("part", "piece").agg(F.sum("length").alias("n_ids"))
        .select(
            "part", "piece", "n_ids", (F.row_number().over(in_order) - 1).cast("long").alias("shard"),
            (F.sum("n_ids").over(in_order) - F.col("n_ids")).alias("base"),
            F.format_string("ids-%06d-%06d.bin", "part", "piece").alias("name"),
        )
    )
    buckets = max(1, -(-placed.count() // BUCKET_KEYS))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, prints = key_hashes(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), pa.array(prints.astype(np.int64)), pa.array(_bucket(hashes, buckets)),
                 *(batch.column(i) for i in (2, 3, 4))],
                ["hash", "fingerprint", "bucket", "shard", "offset", "length"],
            )

    def built(table: pa.Table) -> pa.Table:
        bucket = table["bucket"][0].as_py()
        hashes = table["hash"].to_numpy().view(np.uint64)
        perfect = PerfectHash.build(hashes)
        at = perfect.slots(hashes)
        columns = {}
        for name, kind in (("fingerprint", np.uint32), ("shard", np.uint32), ("offset", np.uint64), ("length", np.uint64)):
            columns[name] = np.zeros(len(at), kind)
            columns[name][at] = table[name].to_numpy()
        _put(folder, f"index-{bucket:06d}.npz", Bucket(perfect, **columns).to_bytes())
        return pa.table({"bucket": [bucket], "n": pa.array([len(at)], pa.int64())})

    rows = placed.join(shards.select("part", "piece", "shard"), ["part", "piece"])
    saved(
        rows.select("doc_id", "number", "shard", "offset", "length")
        .mapInArrow(hashed, "hash long, fingerprint long, bucket long, shard long, offset long, length long")
        .groupBy("bucket").applyInArrow(built, "bucket long, n long")
    )
    return Store(folder, buckets, shards, placed.select("doc_id", "number"))

"""Bits of a set of keys, sent to where another table is read, so that only likely matches are shuffled.

Every key sets two bits of a map of at least 16 bits a key, kept as rows of
4 KB. A row whose bits aren't both set has none of the keys; of the others about
one in seventy has none either, so an exact join follows. The map is broadcast, its
size follows from the number of keys and is bounded by ``MOST_KEYS``; for more keys all rows pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MOST_KEYS = 1 << 24  # 32 MB of bits
_ROW_BITS = 1 << 15
_SEEDS = (1, 2)


def _places(columns: Sequence[str], bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(bits)) for seed in _SEEDS]


def key_bits(keys: DataFrame, columns: Sequence[str], bits: int) -> DataFrame:
    """``(piece, bits)``: the map of all keys."""
    places = keys.select(F.explode(F.array(*_places(columns, bits))).alias("place"))
    return places.groupBy(F.bitmap_bucket_number("place").alias("piece")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))


def _is_set(bits: Column, position: Column) -> Column:
    byte = F.substring(bits, F.shiftright(position, 3).cast("int") + 1, F.lit(1))
    return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (position % 8).cast("int")) == 1


def maybe_among(
    rows: DataFrame, keys: DataFrame, columns: Sequence[str], count: int
) -> DataFrame:
    """Rows that may have one of the ``count`` keys, and all that do. Null keys match nothing."""
    if count > MOST_KEYS:
        return rows
    bits = max(_ROW_BITS, 1 << (BITS_PER_KEY * max(count, 1) - 1).bit_length())
    known = F.broadcast(key_bits(keys, columns, bits))
    kept = rows
    for number, place in enumerate(_places(columns, bits)):
        piece, found = f"_piece_{number}", f"_bits_{number}"
        named = known.select(F.col("piece").alias(piece), F.col("bits").alias(found))
        kept = kept.join(named, F.bitmap_bucket_number(place) == F.col(piece)).filter(
            _is_set(F.col(found), F.bitmap_bit_position(place))).drop(piece, found)
    return kept

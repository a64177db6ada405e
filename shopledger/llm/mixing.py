"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions only.

Every source gets a target number of words: its weight's part of `share` times all words, at most `limit` times its own
words, what is cut off being given to the others by weight. A document of a source wants target / source words copies. The
whole part is certain; the fractional parts are rounded together: two documents of a source meet, words move from one to
the other until one of them is whole, and chance decides the direction so that each keeps its expected number of copies.
Because words are moved, the words of a source stay what they were. Documents meet in chunks of about `CHUNK`; the one left
over from a chunk goes on to the next level, so a source of any size is a tree of a few levels. Its last document is
rounded to the nearer side: a source misses its target by at most half of one document.

Chance comes from hashes of keys, so reruns agree, however the input is partitioned. Defined cases: null and blank texts
have size 0 and take nothing; a null source is a source of its own and comes last; rows equal in id, source and size share
one decision and count as one document of their joint size; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.scratch import saved

CHUNK = 96


def word_count(text: str | Column) -> Column:
    """Runs of characters other than space and \\t to \\r; null has none."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, limit: float) -> DataFrame:
    """One row per source: source, source_no (in code point order, null last), source_size, target."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source, not per document
    numbered = by_source.withColumn("source_no", F.row_number().over(in_order) - 1)
    weight = F.element_at(
        F.array(*map(F.lit, map(float, weights))), (F.pmod("source_no", F.lit(len(weights))) + 1).cast("int")
    )
    most = F.lit(float(limit)) * F.col("source_size")
    weighed = numbered.withColumn("weight", weight).withColumn("most", most).withColumn("ratio", F.col("most") / F.col("weight"))
    up = Window.orderBy("ratio", "source_no")
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.sum("most").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    words = F.sum("source_size").over(whole)
    # words per weight if all sources with a smaller ratio are full: the first source that this doesn't fill decides
    level = F.greatest((F.lit(float(share)) * words - before) / rest, F.lit(0.0))
    levelled = weighed.withColumn("level", level)
    chosen = F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "source_no", "level"))).over(whole)["level"]
    # all full: share is as large as limit
    target = F.least("most", F.coalesce(F.col("weight") * chosen, F.col("most")))
    return levelled.select("source", "source_no", "source_size", target.alias("target"))


def _met(units: Column, level: int) -> Column:
    """The sequence of meetings of a chunk: struct of those that became whole and the one that is left."""
    unit_type = "struct<unit:bigint,size:bigint,words:double,up:boolean>"
    none = F.struct(
        F.lit(None).cast("bigint").alias("unit"), F.lit(0).cast("bigint").alias("size"),
        F.lit(0.0).alias("words"), F.lit(False).alias("up"),
    )

    def meet(state: Column, new: Column) -> Column:
        old = state["left"]
        to_old = F.least(old["size"] - old["words"], new["words"])
        to_new = F.least(old["words"], new["size"] - new["words"])
        chance = F.shiftrightunsigned(F.xxhash64(F.lit(level), old["unit"], new["unit"]), 11).cast("double") / F.lit(2.0**53)
        old_gains = chance * (to_old + to_new) < to_new
        # the smaller of the two amounts is moved whole, so that side ends at 0 or at its size
        old_words = F.when(old_gains, F.when(to_old < new["words"], old["size"].cast("double")).otherwise(old["words"] + to_old)) \
            .otherwise(F.when(to_new < old["words"], old["words"] - to_new).otherwise(F.lit(0.0)))
        new_words = F.when(old_gains, F.when(to_old < new["words"], new["words"] - to_old).otherwise(F.lit(0.0))) \
            .otherwise(F.when(to_new < old["words"], new["size"].cast("double")).otherwise(new["words"] + to_new))
        return _after(state, old, new, old_words, new_words)

    def _after(state: Column, old: Column, new: Column, old_words: Column, new_words: Column) -> Column:
        both = F.transform(
            F.array(F.struct(old_words.alias("a"), new_words.alias("b"))),
            lambda w: F.when(
                old["unit"].isNull(), F.struct(state["whole"].alias("whole"), _unit(new, new["words"]).alias("left"))
            ).when(
                (w["a"] <= 0) | (w["a"] >= old["size"]),
                F.struct(F.concat(state["whole"], F.array(_unit(old, w["a"]))).alias("whole"), _unit(new, w["b"]).alias("left")),
            ).otherwise(
                F.struct(F.concat(state["whole"], F.array(_unit(new, w["b"]))).alias("whole"), _unit(old, w["a"]).alias("left"))
            ),
        )
        return both[0]

    def _unit(x: Column, words: Column) -> Column:
        return F.struct(
            x["unit"].alias("unit"), x["size"].alias("size"), words.alias("words"), (words >= x["size"]).alias("up")
        ).cast(unit_type)

    start = F.struct(F.array().cast(f"array<{unit_type}>").alias("whole"), none.cast(unit_type).alias("left"))
    return F.aggregate(units, start, meet)


def _level(units: DataFrame, level: int) -> DataFrame:
    """Chunks of a source: column `met` with those that became whole and the one left over."""
    counts = units.groupBy("source_no").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    dealt = units.join(counts, "source_no").withColumn(
        "chunk", F.pmod(F.xxhash64(F.lit(level), F.col("unit")), F.col("chunks"))
    )
    member = F.struct(
        F.xxhash64(F.lit(-1 - level), F.col("unit")).alias("order"), "unit", "size", "words"
    )
    return (
        dealt.groupBy("source_no", "chunk").agg(F.sort_array(F.collect_list(member)).alias("units"))
        .select("source_no", _met(F.col("units"), level).alias("met"))
    )


def mix(documents: DataFrame, *, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, limit: float = 2,
        id_column: str = "doc_id", text_column: str = "text", source_column: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies (whole ones), taken = copies * size.

    The input is read once, for its sizes; what follows works on ids and numbers.
    """
    if not weights or min(weights) <= 0 or share < 0 or limit < 0:
        raise ValueError("weights must be positive, share and limit not negative")
    sizes = saved(documents.select(
        F.col(id_column).alias("doc_id"), F.col(source_column).alias("source"), word_count(text_column).alias("size")
    ))
    targets = saved(source_targets(sizes, weights, share, limit))
    wanted = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    same = sizes.groupBy("doc_id", "source", "size").agg(F.count("*").alias("n"))
    units = saved(
        same.join(targets, same["source"].eqNullSafe(targets["source"])).select(
            "doc_id", targets["source_no"], same["size"].alias("each"), (F.col("n") * same["size"]).alias("size"),
            F.floor(wanted).alias("certain"), (wanted - F.floor(wanted)).alias("part"),
            F.xxhash64("doc_id", "source_no", "each").alias("unit"),
        )
    )
    open_units = units.where((F.col("part") > 0) & (F.col("size") > 0)).select(
        "source_no", "unit", "size", (F.col("part") * F.col("size")).alias("words")
    )
    decided, level = [], 0
    while True:
        met = saved(_level(open_units, level))
        decided.append(met.select("source_no", F.inline("met.whole")).select("source_no", "unit", "up"))
        left = met.select("source_no", "met.left.*")
        most = left.groupBy("source_no").count().agg(F.max("count")).first()[0]
        if most is None or most <= 1:
            decided.append(left.select("source_no", "unit", (F.col("words") * 2 >= F.col("size")).alias("up")))
            break
        whole = (F.col("words") <= 0) | F.col("up")
        decided.append(left.where(whole).select("source_no", "unit", "up"))
        open_units = left.where(~whole).select("source_no", "unit", "size", "words")
        level += 1
    ups = decided[0]
    for more in decided[1:]:
        ups = ups.unionByName(more)
    copies = units.join(ups, ["source_no", "unit"], "left").select(
        "doc_id", "source_no", "each", (F.col("certain") + F.coalesce(F.col("up"), F.lit(False)).cast("long")).alias("copies")
    )
    rows = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).select(
        sizes["doc_id"], sizes["source"], "source_no", "size", "source_size", "target"
    )
    return rows.join(
        copies,
        rows["doc_id"].eqNullSafe(copies["doc_id"]) & (rows["source_no"] == copies["source_no"]) & (rows["size"] == copies["each"]),
        "left",
    ).select(
        rows["doc_id"], "source", "size", "source_size", "target", F.coalesce("copies", F.lit(0)).alias("copies"),
        (F.coalesce("copies", F.lit(0)) * F.col("size")).alias("taken"),
    )

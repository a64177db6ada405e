"""Pick up newly landed files and merge them as the batch run would.

Structured Streaming only keeps track of which files were seen. Each batch goes
to several places: its rows to raw, unusable ones to the rejects if asked for, the
rest through the same cleaning and keyed merge to core. A batch is known by a load id
made of its number, its query's progress folder and its files' time: folders of raw
and rejects bear it, and the ledger of loads names it once all is done. A
batch that the ledger names is skipped, one that died half-way is written over. Facts
whose store or product isn't known yet wait in a pending table and are
merged with the first later batch that finds their parents.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cleaning, integrity, quality
from ..operators.cleaning import LANDING_ORDER, OVERFLOWED
from ..operators.integrity import WITH_PARENTS
from ..operators.merge import merge_by_key
from ..schemas import ENTITIES
from ..sources.landing import CSV_OPTIONS, append_raw, position
from ..sources.rates import RAW_COLUMNS, history_rates, rates_history_stream
from ..sources.warehouse import Warehouse


def landed_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Files of one table as they land; headers must match the declared columns."""
    return tagged(spark.readStream.schema(ENTITIES[name].landed).options(**CSV_OPTIONS).csv(folder))


def tagged(rows: DataFrame) -> DataFrame:
    """Rows of files with what is known of each file."""
    return rows.withColumns({
        "arrived": F.col("_metadata.file_modification_time"),
        "source_file": F.col("_metadata.file_path"),
        "source_block": F.col("_metadata.file_block_start"),
        "source_length": F.col("_metadata.file_size"),
    })


def _load_id(batch: DataFrame, progress: str, number: int) -> str | None:
    """The same however often a batch is run; None for a batch without rows."""
    latest = batch.agg(F.date_format(F.max("arrived"), "yyyy-MM-dd'T'HH-mm-ss")).first()[0]
    mark = zlib.crc32(progress.encode())
    return None if latest is None else f"{latest}-{mark:08x}-{number:09d}"


def _finish(warehouse: Warehouse, name: str, batch: DataFrame, load_id: str) -> None:
    files = batch.select(
        F.regexp_replace("source_file", "^(\\w+):/+", "$1:/").alias("path"),
        F.col("source_length").alias("length"), F.col("arrived").alias("modified"),
    ).distinct().collect()
    warehouse.ledger.commit(name, files, load_id)


def _merge_batch(
    warehouse: Warehouse, name: str, batch: DataFrame, number: int, progress: str,
    keep_rejects: bool, dates: str,
) -> None:
    load_id = _load_id(batch, progress, number)
    if load_id is None or warehouse.ledger.holds(name, load_id):
        return
    staged = ENTITIES[name].staged.names
    append_raw(batch.select(*staged, "source_file"), warehouse.raw_path(name), load_id)
    # each file is cleaned by itself, then the latest file with a usable row wins
    load = ["arrived", "source_file"]
    placed = batch.withColumn(LANDING_ORDER, position("source_file", "source_block"))
    per_file = cleaning.clean(name, placed, per=load, dates=dates, overflow=True)
    key = list(ENTITIES[name].key)
    rows = cleaning.one_per_key(per_file, key, load, keep="last").drop(*load)
    if keep_rejects:
        rows, rejects = quality.split_rejects(name, rows)
        warehouse.set_aside_load(name, rejects, load_id)
    _merge_rows(warehouse, name, rows)
    _finish(warehouse, name, batch, load_id)


def _merge_rows(warehouse: Warehouse, name: str, rows: DataFrame) -> None:
    key = list(ENTITIES[name].key)
    if name not in WITH_PARENTS:
        rows, seen = quality.watched(name, rows)
        warehouse.stage(name, rows.drop(OVERFLOWED))
        quality.enforce(name, warehouse.staged(name), seen)
        warehouse.publish(warehouse.merge(name, warehouse.staged(name)))
        return
    broken = quality.violations(name, rows).filter("rule = 'precision'").first()
    if broken is not None:
        raise quality.QualityError(f"{name}: precision({broken['columns']}): {broken.bad_rows} rows")
    rows = rows.drop(OVERFLOWED)
    # facts that came too early are tried again; a newer row of their key replaces them
    earlier = warehouse.pending(name)
    waiting = merge_by_key(earlier, rows, key)
    warehouse.stage(f"{name}_and_pending", waiting)
    together = warehouse.staged(f"{name}_and_pending", ENTITIES[name].staged)
    known = integrity.related(name, together, warehouse.core)
    warehouse.stage(name, known)
    quality.enforce(name, warehouse.staged(name))
    changes = warehouse.merge(name, warehouse.staged(name))
    left = together.join(warehouse.staged(name).select(*key), key, "left_anti").select(*earlier.columns)
    warehouse.publish(changes + warehouse.keep_pending(name, left))


def _merge_rates(
    warehouse: Warehouse, batch: DataFrame, number: int, progress: str, currencies: DataFrame
) -> None:
    name = "currency_rates"
    load_id = _load_id(batch, progress, number)
    if load_id is None or warehouse.ledger.holds(name, load_id):
        return
    rates = history_rates(batch, currencies, keep=["arrived"])
    append_raw(rates.select(*RAW_COLUMNS), warehouse.raw_path(name), load_id)
    # the latest file of a day wins
    order = ["arrived", "source_url", "nominal", "rate_to_rub", "currency_name"]
    _merge_rows(warehouse, name, cleaning.clean(name, rates, order, overflow=True))
    _finish(warehouse, name, batch, load_id)


def ingest_available(
    spark: SparkSession, folder: str, root: str, name: str, progress: str,
    keep_rejects: bool = False, dates: str = "each",
) -> StreamingQuery:
    """Merge everything landed since the last call; ``progress`` keeps the offsets.

    ``keep_rejects`` and ``dates`` as for the batch run; rejects go to
    ``<root>/rejects/<name>``, by load.
    """
    warehouse = Warehouse(spark, root)
    return (
        landed_stream(spark, folder, name)
        .writeStream.option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, number: _merge_batch(
            warehouse, name, batch, number, progress, keep_rejects, dates))
        .start()
    )


def ingest_rates_available(
    spark: SparkSession, folder: str, root: str, currencies: DataFrame, progress: str,
    encoding: str = "windows-1251",
) -> StreamingQuery:
    """Merge the rates of history files landed since the last call.

    ``currencies`` gives ids, codes and names, as ``read_currency_dim`` does.
    """
    warehouse = Warehouse(spark, root)
    records = tagged(rates_history_stream(spark, folder, encoding))
    return (
        records.writeStream.option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, number: _merge_rates(
            warehouse, batch, number, progress, currencies))
        .start()
    )

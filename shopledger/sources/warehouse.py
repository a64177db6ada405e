"""Core tables on plain Parquet folders, with an atomic switch of versions.

A merge never touches files a reader may hold open. It writes the partitions
it changes below ``<table>/version=<n>`` and then adds one small file to the
publication log saying which version of which partitions is current. Until
that file appears readers see the old state of all tables; a run that dies
half-way leaves unreferenced files and is simply run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.key_filter import maybe_among
from ..operators.merge import merge_by_key, stamped
from ..schemas import ENTITIES, Entity
from .ledger import Ledger

_LOG = (
    "table_name string, part string, version bigint, live boolean, base bigint,"
    " low string, high string"
)
_WHOLE = "all"


class PublicationConflict(RuntimeError):
    """Another run has published a partition since it was read for merging."""


class Warehouse:
    """Raw, staging and core tables below one folder of shared storage.

    Each instance stages in a folder of its own, so runs don't meet there.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.run = uuid.uuid4().hex

    # ---- raw and staging ----

    def raw_path(self, name: str) -> str:
        return f"{self.root}/raw/{name}_raw"

    def staging_path(self, name: str) -> str:
        return f"{self.root}/stg/{self.run}/{name}_clean"

    def rejects_path(self, name: str) -> str:
        return f"{self.root}/stg/{self.run}/{name}_rejects"

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, self.root)

    def raw(self, name: str, since: str | None = None) -> DataFrame:
        """Rows of finished loads; ``since`` (a day or a load) prunes the folders of earlier ones."""
        rows = self.spark.read.parquet(self.raw_path(name))
        rows = rows.withColumns({c: F.col(c).cast("string") for c in ("load_day", "load_id")})
        if since is not None:
            rows = rows.filter((F.col("load_day") >= since[:10]) & (F.col("load_id") >= since))
        return rows.join(self.ledger.loads(name, since), "load_id", "left_semi")

    def stage(self, name: str, rows: DataFrame) -> None:
        """Replace a staging table."""
        rows.write.mode("overwrite").parquet(self.staging_path(name))

    def staged(self, name: str, layout: T.StructType | None = None) -> DataFrame:
        layout = layout or ENTITIES[name].staged
        return self.spark.read.schema(layout).parquet(self.staging_path(name))

    def set_aside(self, name: str, rejects: DataFrame) -> None:
        rejects.write.mode("overwrite").parquet(self.rejects_path(name))

    def set_aside_load(self, name: str, rejects: DataFrame, load_id: str) -> None:
        """Rejects of one load of an incremental run, in a folder that a repeated load replaces."""
        rejects.withColumn("load_id", F.lit(load_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("load_id").parquet(
            f"{self.root}/rejects/{name}")

    # ---- facts that came before their store or product ----

    def pending(self, name: str) -> DataFrame:
        """Facts of earlier batches that still lack a parent."""
        current = self._current(f"{name}_pending")
        layout = ENTITIES[name].staged
        if not current:
            return self.spark.createDataFrame([], layout)
        path = f"{self._table(f'{name}_pending')}/version={current[_WHOLE]}"
        return self.spark.read.schema(layout).parquet(path)

    def keep_pending(self, name: str, rows: DataFrame) -> list[tuple]:
        """Replace the pending facts; returns what to publish."""
        table = f"{name}_pending"
        base = self._current(table).get(_WHOLE)
        version = self._next_version()
        rows.write.parquet(f"{self._table(table)}/version={version}")
        return [(table, _WHOLE, version, True, base, None, None)]

    # ---- core ----

    def core(self, name: str, months: Iterable[str] | None = None) -> DataFrame:
        """The current rows of a table; ``months`` prunes partitions."""
        entity = ENTITIES[name]
        current = self._current(name)
        if months is not None and entity.partition:
            current = {part: v for part, v in current.items() if part in set(months)}
        return self._read(entity, current)

    def tables(self, months: Iterable[str] | None = None) -> dict[str, DataFrame]:
        return {name: self.core(name, months) for name in ENTITIES}

    def merge(self, name: str, rows: DataFrame) -> list[tuple]:
        """Write the partitions changed by ``rows``; returns what to publish.

        ``rows`` must hold each key once and read the same every time: pass
        a staged table. Only partitions named by the new rows, or holding an
        older version of one of them, are rewritten. Where a row's partition
        follows from its key, older versions can't be anywhere else. Otherwise
        key columns are read to find them: those of partitions whose least and
        greatest key leave room for one of the new keys, and of their rows only
        those go into a join that bits of the new keys let through.
        """
        entity = ENTITIES[name]
        incoming = stamped(rows.select(*entity.core.names))
        current = self._current(name)
        touched: set[str] = set()
        if entity.partition is None:
            merged = merge_by_key(self._read(entity, current), incoming, entity.key)
            touched = {_WHOLE}
        else:
            keyed = self._with_partition(entity, incoming)
            parts = keyed.select(entity.partition)
            if not entity.partition_follows_key:
                moved = self._older_versions(entity, current, keyed.select(*entity.key))
                parts = parts.union(moved.select(entity.partition))
            touched = {row[0] for row in parts.distinct().collect()}
            affected = {part: v for part, v in current.items() if part in touched}
            merged = merge_by_key(self._read(entity, affected), keyed, entity.key)

        version = self._next_version()
        path = f"{self._table(name)}/version={version}"
        if entity.partition is None:
            merged.write.parquet(path)
            written = {_WHOLE: (None, None)}
        else:
            # balanced by size, so one large month is written by many tasks
            merged.hint("rebalance", entity.partition).write.partitionBy(
                entity.partition).parquet(path)
            written = {}
            if touched:
                found = self.spark.read.schema(self._layout(entity)).parquet(path)
                written = self._key_ranges(entity, found)
        return [
            (name, part, version, part in written, current.get(part),
             *written.get(part, (None, None)))
            for part in sorted(touched)
        ]

    def _key_ranges(self, entity: Entity, rows: DataFrame) -> dict[str, tuple]:
        """Partitions with the least and greatest key, where these help to find older versions."""
        by_part = rows.groupBy(entity.partition)
        if entity.partition_follows_key:
            # values come from folder names; no data column is read
            return {r[0]: (None, None) for r in by_part.count().collect()}
        key = entity.key[0]
        found = by_part.agg(F.min(key).alias("low"), F.max(key).alias("high")).collect()
        return {r[0]: (r.low, r.high) for r in found}

    def _older_versions(
        self, entity: Entity, current: dict[str, int], keys: DataFrame
    ) -> DataFrame:
        """Stored rows that have one of the keys."""
        first = entity.key[0]
        span = keys.agg(
            F.min(first).alias("low"), F.max(first).alias("high"), F.count(F.lit(1)).alias("n")
        ).first()
        ranges = self._stored_ranges(entity.name)
        reachable = {
            part: version for part, version in current.items()
            if span.n and not self._apart(ranges.get(part), (span.low, span.high))
        }
        stored = self._read(entity, reachable).select(*entity.key, entity.partition)
        likely = maybe_among(stored, keys, entity.key, span.n)
        return likely.join(keys, list(entity.key), "left_semi")

    @staticmethod
    def _apart(known: tuple | None, asked: tuple) -> bool:
        """Whether two ranges of keys can't meet; unknown ranges may."""
        if known is None or None in known or None in asked:
            return False
        return known[1] < asked[0] or asked[1] < known[0]

    def publish(self, changes: list[tuple]) -> None:
        """Switch readers to the given partitions, all at once.

        Fails if one of them is no longer what the merge read, so that nobody's
        rows are lost; merge again then. The check and the switch are two steps:
        let one run publish at a time.
        """
        for name in {change[0] for change in changes}:
            current = self._current(name)
            moved = [c[1] for c in changes if c[0] == name and current.get(c[1]) != c[4]]
            if moved:
                raise PublicationConflict(f"{name}: {', '.join(moved)} changed since the merge")
        if changes:
            frame = self.spark.createDataFrame(changes, _LOG)
            frame.coalesce(1).write.mode("append").json(self._log())

    # ---- internals ----

    def _table(self, name: str) -> str:
        return f"{self.root}/dm/{name}"

    def _log(self) -> str:
        return f"{self.root}/dm/publications"

    def _published(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_LOG).json(self._log())
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def _current(self, name: str) -> dict[str, int]:
        """Current version of every live partition (one entry per month)."""
        log = self._published()
        if log is None:
            return {}
        newest = (
            log.filter(F.col("table_name") == name).groupBy("part")
            .agg(F.max_by(F.struct("version", "live"), "version").alias("newest"))
            .select("part", "newest.*").filter("live")
        )
        return {row.part: row.version for row in newest.collect()}

    def _stored_ranges(self, name: str) -> dict[str, tuple]:
        log = self._published()
        if log is None:
            return {}
        newest = log.filter(F.col("table_name") == name).groupBy("part").agg(
            F.max_by(F.struct("low", "high"), "version").alias("range"))
        return {row.part: (row.range.low, row.range.high) for row in newest.collect()}

    def _next_version(self) -> int:
        """Later than anything published; time keeps retries apart."""
        clock = self.spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
        log = self._published()
        last = log.agg(F.max("version")).first()[0] if log is not None else None
        return max(clock, (last or 0) + 1)

    def _layout(self, entity: Entity) -> T.StructType:
        fields = list(entity.core) + [T.StructField("updated_at", T.TimestampType())]
        if entity.partition and entity.partition_expr:
            fields.append(T.StructField(entity.partition, T.StringType()))
        return T.StructType(fields)

    def _with_partition(self, entity: Entity, rows: DataFrame) -> DataFrame:
        if entity.partition_expr is None:
            return rows
        return rows.withColumn(entity.partition, F.expr(entity.partition_expr))

    def _read(self, entity: Entity, current: dict[str, int]) -> DataFrame:
        layout = self._layout(entity)
        if not current:
            return self.spark.createDataFrame([], layout)
        versions = sorted(set(current.values()))
        rows = (
            self.spark.read.schema(T.StructType([*layout, T.StructField("version", T.LongType())]))
            .option("basePath", self._table(entity.name))
            .parquet(*(f"{self._table(entity.name)}/version={v}" for v in versions))
        )
        if entity.partition:
            wanted = [
                (F.col("version") == v)
                & F.col(entity.partition).isin([p for p, pv in current.items() if pv == v])
                for v in versions
            ]
            rows = rows.filter(reduce(lambda a, b: a | b, wanted))
        return rows.select(*layout.names)

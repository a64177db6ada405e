"""Keyed merge: incoming rows replace stored rows of the same key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ENTITIES


def merge_by_key(stored: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """Stored rows without a newer version, plus all incoming rows.

    ``incoming`` must hold each key once. Nothing is ever deleted.
    """
    kept = stored.join(incoming.select(*key), list(key), "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def stamped(rows: DataFrame) -> DataFrame:
    return rows.withColumn("updated_at", F.current_timestamp())


def upsert(name: str, stored: DataFrame, staged: DataFrame, stamp: bool = True) -> DataFrame:
    """Merge a staged table into its core table on the table's own key."""
    entity = ENTITIES[name]
    incoming = staged.select(*entity.core.names)
    return merge_by_key(stored, stamped(incoming) if stamp else incoming, entity.key)


def upsert_sales(stored: DataFrame, staged: DataFrame, stamp: bool = True) -> DataFrame:
    return upsert("sales", stored, staged, stamp)


def upsert_stores(stored: DataFrame, staged: DataFrame, stamp: bool = True) -> DataFrame:
    return upsert("stores", stored, staged, stamp)


def upsert_products(stored: DataFrame, staged: DataFrame, stamp: bool = True) -> DataFrame:
    return upsert("products", stored, staged, stamp)


def upsert_inventory(stored: DataFrame, staged: DataFrame, stamp: bool = True) -> DataFrame:
    return upsert("inventory", stored, staged, stamp)


def upsert_plan(stored: DataFrame, staged: DataFrame, stamp: bool = True) -> DataFrame:
    return upsert("plan_sales", stored, staged, stamp)


def upsert_rates(stored: DataFrame, staged: DataFrame, stamp: bool = True) -> DataFrame:
    return upsert("currency_rates", stored, staged, stamp)

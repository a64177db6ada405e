"""Referential integrity as left-semi joins.

No side is hinted: Spark broadcasts a dimension it measures as small and sorts
and merges it otherwise, splitting hot keys of the fact side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame


WITH_PARENTS = ("sales", "inventory", "plan_sales")


def having_parent(rows: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    return rows.join(parent.select(key), key, "left_semi")


def ri_sales(sales: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    return having_parent(having_parent(sales, stores, "store_id"), products, "product_id")


def ri_inventory(inventory: DataFrame, stores: DataFrame, products: DataFrame) -> DataFrame:
    return having_parent(having_parent(inventory, stores, "store_id"), products, "product_id")


def ri_plan(plan: DataFrame, stores: DataFrame) -> DataFrame:
    """Plans answer to stores only; their category is free text."""
    return having_parent(plan, stores, "store_id")


def related(name: str, rows: DataFrame, dimension: Callable[[str], DataFrame]) -> DataFrame:
    """Facts with known parents; dimensions pass unchanged."""
    if name == "sales":
        return ri_sales(rows, dimension("stores"), dimension("products"))
    if name == "inventory":
        return ri_inventory(rows, dimension("stores"), dimension("products"))
    if name == "plan_sales":
        return ri_plan(rows, dimension("stores"))
    return rows

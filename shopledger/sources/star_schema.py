"""The retail model derived from an order-line star schema.

Order lines become sales, suppliers stores and parts products; plans are last
year's sales raised by five percent, stock positions are what a store sold of a
product, counted at a month's end. Every definition is a lazy DataFrame over
the whole source table, so a mart that needs three columns reads three columns.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator, Mapping
from decimal import Decimal
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import month_of
from ..functions.numbers import TOTAL, scaled, unscaled
from ..schemas import MONEY, PRICE, RATE

_RAISED = Decimal("1.05")


def store_id(key: str) -> Column:
    return F.concat(F.lit("S"), F.lpad(F.col(key).cast("string"), 6, "0"))


def product_id(key: str) -> Column:
    return F.concat(F.lit("P"), F.lpad(F.col(key).cast("string"), 7, "0"))


class StarSchemaTables(Mapping[str, DataFrame]):
    """Mapping of retail table name to DataFrame over one data directory."""

    _names = ("stores", "products", "sales", "plan_sales", "inventory", "currency_rates")

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory
        self._built: dict[str, DataFrame] = {}
        self._sources: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = getattr(self, name)()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            path = os.path.join(self.directory, f"{name}.parquet")
            self._sources[name] = self.spark.read.parquet(path)
        return self._sources[name]

    def stores(self) -> DataFrame:
        # The few places come as a lookup, repeats included. Spark multiplies the sizes of joined
        # tables, so a join would hide from it that the stores can be broadcast.
        places = (
            self.source("nation")
            .join(self.source("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .filter(F.col("n_nationkey").isNotNull())
            .groupBy("n_nationkey").agg(F.collect_list(F.struct("n_name", "r_name")).alias("at"))
            .agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "at"))))
        )
        key = F.col("s_suppkey")
        return (
            self.source("supplier")
            .select("s_suppkey", "s_name", F.inline(places.scalar()[F.col("s_nationkey")]))
            .select(
                store_id("s_suppkey").alias("store_id"),
                F.col("s_name").alias("store_name"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("region"),
                F.when(key % 3 == 0, "Convenience").when(key % 3 == 1, "Supermarket")
                .otherwise("Hypermarket").alias("format"),
                F.date_add(F.lit("2010-01-01").cast("date"), (key % 3650).cast("int"))
                .alias("opening_date"),
                # zeros exercise the division guards
                F.when(key % 17 == 0, 0).otherwise(400 + (key % 8) * 200).cast("int")
                .alias("store_area_sqm"),
                F.when(key % 13 == 0, 0).otherwise(20 + key % 60).cast("int")
                .alias("employees_count"),
            )
        )

    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        price = F.col("p_retailprice").cast(PRICE)
        return self.source("part").select(
            product_id("p_partkey").alias("product_id"),
            (10000 + key).cast("string").alias("stock_code"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)).alias("subcategory"),
            F.col("p_brand").alias("brand"),
            F.concat(F.lit("V"), (key % 8).cast("string")).alias("supplier"),
            F.round(price * F.lit("0.72").cast("decimal(3,2)"), 2).cast(PRICE).alias("unit_cost"),
            price.alias("unit_price"),
            F.lit("pcs").alias("uom"),
            F.lit(1).cast("smallint").alias("is_active"),
        )

    def lines(self) -> DataFrame:
        """Order lines with one row per (order, line number).

        The source repeats that key. Taking the smallest row as an aggregate
        keeps map-side combining, so even a key holding a third of the table
        reaches its reducer as one row per map task. The whole row is in the
        aggregate whatever is read later, hence all uses of the lines within
        one query share a single scan and shuffle.
        """
        row = F.struct(
            "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity", "l_discount"
        )
        return (
            self.source("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(F.min(row).alias("line"))
            .select("l_orderkey", "l_linenumber", "line.*")
        )

    def _priced(self, lines: DataFrame) -> DataFrame:
        gross = F.col("l_extendedprice").cast(MONEY)
        kept = F.lit(1) - F.col("l_discount").cast("decimal(5,2)")
        cost_rate = F.lit("0.72").cast("decimal(3,2)")
        parts = self.source("part").select("p_partkey", F.col("p_type").alias("category"))
        return (
            lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
            .withColumn("sale_date", F.col("l_shipdate").cast("date"))
            .withColumn("revenue", F.round(gross * kept, 2).cast(MONEY))
            .withColumn("total_cost", F.round(gross * cost_rate, 2).cast(MONEY))
            .withColumn("profit", (F.col("revenue") - F.col("total_cost")).cast(MONEY))
            .withColumn("quantity", F.col("l_quantity").cast("int"))
        )

    def sales(self) -> DataFrame:
        # Grouped by its key, so that a query not reading the channel has the
        # whole join removed by the optimizer. Lines meet it as they lie: what is
        # derived from them, and their category, would be shuffled along.
        channels = (
            self.source("orders")
            .groupBy("o_orderkey")
            .agg(F.min(F.substr("o_orderpriority", F.lit(3))).alias("sales_channel"))
        )
        return (
            self._priced(
                self.lines().join(channels, F.col("l_orderkey") == F.col("o_orderkey"), "left"))
            .select(
                F.concat_ws("-", F.col("l_orderkey").cast("string"),
                            F.col("l_linenumber").cast("string")).alias("sale_id"),
                "sale_date",
                month_of("sale_date").alias("sale_month"),
                store_id("l_suppkey").alias("store_id"),
                product_id("l_partkey").alias("product_id"),
                "category", "quantity", "revenue", "total_cost", "profit", "sales_channel",
            )
        )

    def plan_sales(self) -> DataFrame:
        return (
            self["sales"]
            .withColumn("plan_month", month_of(F.add_months("sale_date", 12)))
            .groupBy("plan_month", "store_id", "category")
            .agg(
                F.round(F.sum("revenue") * F.lit(_RAISED), 2).cast(TOTAL).alias("plan_revenue"),
                F.round(F.sum("profit") * F.lit(_RAISED), 2).cast(TOTAL).alias("plan_profit"),
                F.sum("quantity").alias("plan_qty"),
            )
        )

    def plan_fact_cells(self, months: Iterable[str] | None = None) -> DataFrame:
        """Plans and sales by month, store and category, as ``plan_fact.cells`` aligns them.

        A plan is the sales of a year before, so one sum by cell, on keys as they lie,
        gives both. It is moved once more, to its store: there a cell and what follows
        from it a year later meet, and sums by store find their rows in one place. A
        store sends one row per month and category, however many lines it holds.
        """
        month, planned = F.trunc("sale_date", "month"), F.col("planned")
        amounts = scaled("revenue", 2, "revenue") | scaled("profit", 2, "profit") | {
            "quantity": F.col("quantity"), "rows": F.lit(1).cast("bigint"),
        }
        lines = self._priced(self.lines())
        if months is not None:
            chosen = list(months)
            lines = lines.filter(
                month_of(month).isin(chosen) | month_of(F.add_months(month, 12)).isin(chosen))
        summed = (
            lines.groupBy(month.alias("month"), "l_suppkey", "category")
            .agg(*(F.sum(e).alias(a) for a, e in amounts.items()))
            .withColumn("store_id", store_id("l_suppkey")).drop("l_suppkey")
            .repartition("store_id")
        )
        uses = F.array(
            F.struct(F.col("month").alias("cell_month"), F.lit(False).alias("planned")),
            F.struct(F.add_months("month", 12).alias("cell_month"), F.lit(True).alias("planned")),
        )
        # as in a join, a null key equals nothing: such sales and plans stay apart
        keys = ("cell_month", "store_id", "category")
        apart = F.when(reduce(or_, (F.col(k).isNull() for k in keys)), planned)
        aligned = (
            summed.select("store_id", "category", *amounts, F.inline(uses))
            .groupBy(*keys, apart.alias("apart"))
            .agg(
                *(F.sum(F.when(~planned, F.col(a))).alias(f"fact_{a}") for a in amounts),
                *(F.sum(F.when(planned, F.col(a))).alias(f"plan_{a}") for a in amounts),
            )
        )

        def money(name: str) -> Column:
            return unscaled(F.col(f"{name}_high"), F.col(f"{name}_low"), 2)

        cells = aligned.select(
            month_of("cell_month").alias("plan_month"), "store_id", "category",
            money("fact_revenue").alias("fact_revenue"), money("fact_profit").alias("fact_profit"),
            F.col("fact_quantity").alias("fact_qty"),
            *(F.round(money(f"plan_{c}") * F.lit(_RAISED), 2).cast(TOTAL).alias(f"plan_{c}")
              for c in ("revenue", "profit")),
            F.col("plan_quantity").alias("plan_qty"),
            F.coalesce("fact_rows", F.lit(0)).alias("sales_rows"),
            F.when(F.col("plan_rows") > 0, 1).otherwise(0).cast("bigint").alias("plan_rows"),
        )
        return cells if months is None else cells.filter(F.col("plan_month").isin(chosen))

    def inventory(self) -> DataFrame:
        # Counts of odd-numbered products are dated a month late, so that both
        # sales without stock and stock without sales occur.
        late = (F.col("l_partkey") % 2).cast("int")
        qty = F.col("stock_qty")
        return (
            self.lines()
            .select(
                F.last_day(F.date_add(F.col("l_shipdate").cast("date"), late * 31))
                .alias("inventory_date"),
                store_id("l_suppkey").alias("store_id"),
                product_id("l_partkey").alias("product_id"),
                F.col("l_quantity").cast("int").alias("quantity"),
            )
            .groupBy("inventory_date", "store_id", "product_id")
            .agg((F.sum(F.col("quantity") * 7) % 61).cast("int").alias("stock_qty"))
            .select(
                "inventory_date", "store_id", "product_id", "stock_qty",
                (qty * F.lit("10.5").cast("decimal(3,1)")).cast(MONEY).alias("stock_value"),
                F.lit(15).alias("reorder_point"),
                (qty * F.lit("1.25").cast("decimal(3,2)")).cast("decimal(10,2)")
                .alias("days_of_cover"),
                F.when(qty < 15, "LOW").when(qty > 45, "OVERSTOCK").otherwise("OK")
                .alias("stock_status"),
            )
        )

    def currency_rates(self) -> DataFrame:
        code = F.substr("o_orderpriority", F.lit(3))
        return (
            self.source("orders")
            .groupBy(F.col("o_orderdate").cast("date").alias("rate_date"),
                     code.alias("currency_code"))
            .agg(F.max("o_totalprice").cast(RATE).alias("rate_to_rub"))
            .select(
                "rate_date", "currency_code",
                F.concat(F.lit("Currency "), F.col("currency_code")).alias("currency_name"),
                F.lit(1).alias("nominal"),
                "rate_to_rub",
                F.lit(None).cast("string").alias("source_url"),
            )
        )

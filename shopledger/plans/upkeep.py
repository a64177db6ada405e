"""Table upkeep over the star schema: cleaning, integrity, quality, merges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import cleaning, integrity, merge, quality
from ..schemas import MONEY, PRICE, RATE
from ..sources.star_landing import FROM_LINES, LANDED, sales_lines, sales_text
from ..sources.star_schema import StarSchemaTables


def cleaned(name: str, tables: StarSchemaTables) -> DataFrame:
    rows, text = FROM_LINES.get(name, (LANDED[name], None))
    return cleaning.clean(name, rows(tables), [cleaning.LANDING_ORDER], text=text)


def clean_sales_of_mixed_dates(tables: StarSchemaTables) -> DataFrame:
    """Sales whose days are mostly written day first with slashes, a tenth of them otherwise.

    What doesn't fit the format of its column is unreadable, so these rows go.
    """
    slashed = F.date_format(F.to_date("sale_date"), "dd/MM/yyyy")
    dotted = F.date_format(F.to_date("sale_date"), "MM.dd.yyyy")
    def text(lines: DataFrame) -> DataFrame:
        return sales_text(lines).withColumns({
            "sale_datetime": F.concat(dotted, F.lit(" 12:30")),
            "sale_date": F.when(F.col("invoice_no").endswith("7"), F.col("sale_date"))
            .otherwise(slashed),
        })

    return cleaning.clean(
        "sales", sales_lines(tables), [cleaning.LANDING_ORDER], dates="column", text=text)


def date_formats(tables: StarSchemaTables) -> DataFrame:
    """The format found for columns of landed sales and rates written in several ways."""
    sales = LANDED["sales"](tables).withColumns({
        "sale_datetime": F.concat(
            F.date_format(F.to_date("sale_date"), "d.M.yyyy"), F.lit(" 12:30")),
        "sale_date": F.date_format(F.to_date("sale_date"), "MM-dd-yyyy"),
    })
    rates = LANDED["currency_rates"](tables).withColumn(
        "rate_date", F.date_format(F.to_date("rate_date"), "yyyyMMdd"))
    rows = [
        cleaning.date_styles(name, landed).select(
            F.lit(name).alias("table_name"), F.posexplode(F.array(*(
                F.struct(F.lit(c).alias("column_name"), F.col("date_styles")[c].alias("style"))
                for c in columns))))
        for name, landed, columns in (
            ("sales", sales, ("sale_datetime", "sale_date")),
            ("currency_rates", rates, ("rate_date",)))
    ]
    return rows[0].unionByName(rows[1]).select("table_name", "col.column_name", "col.style")


def _known_stores(tables: StarSchemaTables) -> DataFrame:
    return tables["stores"].filter("employees_count > 0")


def _known_products(tables: StarSchemaTables) -> DataFrame:
    return tables["products"].filter("unit_price >= 910")


def ri_sales(tables: StarSchemaTables) -> DataFrame:
    return integrity.ri_sales(tables["sales"], _known_stores(tables), _known_products(tables))


def ri_inventory(tables: StarSchemaTables) -> DataFrame:
    return integrity.ri_inventory(
        tables["inventory"], _known_stores(tables), _known_products(tables)
    )


def ri_plan(tables: StarSchemaTables) -> DataFrame:
    return integrity.ri_plan(tables["plan_sales"], _known_stores(tables))


def quality_check(tables: StarSchemaTables) -> DataFrame:
    """Broken constraints of the landed sales read without removing repeats."""
    landed = LANDED["sales"](tables).drop(cleaning.LANDING_ORDER)
    gaps = landed.withColumns({
        "discount_rate": F.nullif("discount_rate", F.lit("")),
        "quantity": F.when(F.col("quantity").cast("int") > 0, F.col("quantity")),
    })
    return quality.violations("sales", gaps)


def quality_check_of_numbers(tables: StarSchemaTables) -> DataFrame:
    """Broken constraints of cleaned sales, some of whose numbers are too large for their columns."""
    huge = F.lit("0" * 9)
    def text(lines: DataFrame) -> DataFrame:
        return sales_text(lines).withColumns({
            "revenue": F.when(F.col("sales_channel") == "A",
                              F.concat(F.split_part("revenue", F.lit("."), F.lit(1)), huge))
            .otherwise(F.col("revenue")),
            "discount_rate": F.when(F.col("quantity").endswith("7"), F.lit("1000.00"))
            .otherwise(F.col("discount_rate")),
            "invoice_type": F.when(F.col("quantity").endswith("1"), F.lit("NA"))
            .otherwise(F.col("invoice_type")),
        })

    cleaned_rows = cleaning.clean(
        "sales", sales_lines(tables), [cleaning.LANDING_ORDER], overflow=True, text=text)
    return quality.violations("sales", cleaned_rows)


# ---- merges: an older load, then a newer one that overlaps it ----

def upsert_sales(tables: StarSchemaTables) -> DataFrame:
    rows = tables["sales"]
    raised = (F.col("revenue") + 1).cast(MONEY)
    return merge.upsert_sales(
        rows.filter("sale_date < DATE '2000-01-01'"),
        rows.filter("sale_date >= DATE '1999-01-01'").withColumn("revenue", raised),
        stamp=False,
    )


def upsert_stores(tables: StarSchemaTables) -> DataFrame:
    rows = tables["stores"]
    return merge.upsert_stores(
        rows.filter("store_area_sqm < 1200"),
        rows.filter("store_area_sqm >= 800").withColumn(
            "employees_count", F.col("employees_count") + 5),
        stamp=False,
    )


def upsert_products(tables: StarSchemaTables) -> DataFrame:
    rows = tables["products"]
    return merge.upsert_products(
        rows.filter("unit_price < 1000"),
        rows.filter("unit_price >= 950").withColumn(
            "unit_price", (F.col("unit_price") + 1).cast(PRICE)),
        stamp=False,
    )


def upsert_inventory(tables: StarSchemaTables) -> DataFrame:
    rows = tables["inventory"]
    return merge.upsert_inventory(
        rows.filter("inventory_date < DATE '2000-01-01'"),
        rows.filter("inventory_date >= DATE '1999-01-01'").withColumn(
            "stock_qty", F.col("stock_qty") + 1),
        stamp=False,
    )


def upsert_plan(tables: StarSchemaTables) -> DataFrame:
    rows = tables["plan_sales"]
    return merge.upsert_plan(
        rows.filter("plan_month < '2001-01'"),
        rows.filter("plan_month >= '2000-01'").withColumn("plan_qty", F.col("plan_qty") + 1),
        stamp=False,
    )


def upsert_rates(tables: StarSchemaTables) -> DataFrame:
    rows = tables["currency_rates"].drop("source_url").withColumn("source_url", F.lit("feed"))
    return merge.upsert_rates(
        rows.filter("rate_date < DATE '2000-01-01'"),
        rows.filter("rate_date >= DATE '1999-01-01'").withColumn(
            "rate_to_rub", (F.col("rate_to_rub") + 1).cast(RATE)),
        stamp=False,
    )

"""Exchange-rate XML files, read after they have landed on shared storage."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.parsing import comma_number, number
from ..operators.cleaning import one_per_key
from ..schemas import CURRENCIES

_DAILY = (
    "_Date string, Valute array<struct<_ID string, CharCode string, Nominal string,"
    " Name string, Value string, VunitRate string>>"
)
_RECORD = "_Date string, _Id string, Nominal string, Value string, VunitRate string"
RAW_COLUMNS = (
    "rate_date", "currency_code", "currency_name", "nominal", "rate_to_rub", "source_url",
)


def currency_codes(text: str) -> tuple[str, ...]:
    """Codes from a comma-separated setting."""
    return tuple(c.strip().upper() for c in text.split(",") if c.strip())


def _xml(spark: SparkSession, path: str | list[str], row: str, schema: str, encoding: str) -> DataFrame:
    return (
        spark.read.format("xml").option("rowTag", row).option("encoding", encoding)
        .schema(schema).load(path)
        .withColumn("source_url", F.col("_metadata.file_path"))
    )


def _day(c: str) -> Column:
    return F.try_to_date(F.col(c), "dd.MM.yyyy")


def _nominal(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("1"))


def _per_unit(value: str, nominal: str) -> Column:
    units = F.nullif(number(_nominal(nominal)), F.lit(0))
    return comma_number(F.coalesce(F.col(value), F.lit("0"))) / units


def _four_decimals(rate: Column) -> Column:
    return F.round(rate, 4).cast("decimal(18,4)")


def _quotes(spark: SparkSession, path: str, codes: Sequence[str], encoding: str) -> DataFrame:
    daily = _xml(spark, path, "ValCurs", _DAILY, encoding)
    quotes = daily.select("_Date", "source_url", F.explode("Valute").alias("quote"))
    return quotes.select("_Date", "source_url", "quote.*").withColumn(
        "currency_code", F.upper("CharCode")
    ).filter(F.col("currency_code").isin(*codes))


def read_rates_daily_xml(
    spark: SparkSession, path: str, codes: Sequence[str] = CURRENCIES,
    encoding: str = "windows-1251",
) -> DataFrame:
    """One row per requested currency of every daily file."""
    return _quotes(spark, path, codes, encoding).select(
        _day("_Date").cast("string").alias("rate_date"),
        "currency_code",
        F.coalesce("Name", F.lit("")).alias("currency_name"),
        _nominal("Nominal").alias("nominal"),
        _four_decimals(_per_unit("Value", "Nominal")).cast("string").alias("rate_to_rub"),
        "source_url",
    )


def read_currency_dim(
    spark: SparkSession, path: str, codes: Sequence[str] = CURRENCIES,
    encoding: str = "windows-1251",
) -> DataFrame:
    """Id and name of each requested currency, from the latest daily file."""
    named = _quotes(spark, path, codes, encoding).select(
        F.col("_ID").alias("currency_id"), "currency_code",
        F.coalesce("Name", F.lit("")).alias("currency_name"), _day("_Date").alias("as_of"),
    )
    return one_per_key(named, ["currency_code"], ["as_of", "currency_id"], keep="last").drop("as_of")


def read_rates_history_xml(
    spark: SparkSession, path: str | list[str], currencies: DataFrame,
    start: date | None = None, end: date | None = None, encoding: str = "windows-1251",
) -> DataFrame:
    """Dated records of the known currencies.

    A record names its currency; where it does not, the file is named after
    the currency id. A stated rate per unit wins over value by nominal.
    """
    records = _xml(spark, path, "Record", _RECORD, encoding)
    return history_rates(records, currencies, start, end)


def rates_history_stream(
    spark: SparkSession, folder: str, encoding: str = "windows-1251"
) -> DataFrame:
    """Records of history files as they land, for ``history_rates``."""
    records = (
        spark.readStream.format("xml").option("rowTag", "Record").option("encoding", encoding)
        .schema(_RECORD).load(folder)
    )
    return records.withColumn("source_url", F.col("_metadata.file_path"))


def history_rates(
    records: DataFrame, currencies: DataFrame, start: date | None = None, end: date | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rates of the known currencies from the records of history files, with further columns to keep."""
    from_file = F.regexp_extract("source_url", r"([^/]+)\.xml$", 1)
    rate = F.coalesce(comma_number(F.nullif("VunitRate", F.lit(""))), _per_unit("Value", "Nominal"))
    dated = records.withColumns({
        "currency_id": F.coalesce("_Id", from_file), "day": _day("_Date"), "rate": rate,
    })
    if start is not None:
        dated = dated.filter(F.col("day") >= start)
    if end is not None:
        dated = dated.filter(F.col("day") <= end)
    return dated.join(currencies, "currency_id").select(
        F.col("day").cast("string").alias("rate_date"), "currency_code", "currency_name",
        _nominal("Nominal").alias("nominal"),
        _four_decimals(F.col("rate")).cast("string").alias("rate_to_rub"), "source_url", *keep,
    )


def require_rates(rates: DataFrame) -> DataFrame:
    """Fail when a feed brought no rate of any requested currency."""
    if rates.isEmpty():
        raise ValueError("no requested currency found in the rate files")
    return rates

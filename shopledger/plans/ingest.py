"""The daily run: landed files to raw, staging and core tables.

Dimensions are merged before facts, and all core tables switch to their new
versions in one publication at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning, integrity, quality
from ..schemas import CSV_ENTITIES, CURRENCIES, ENTITIES
from ..sources.landing import append_raw, read_landing
from ..sources.rates import (
    RAW_COLUMNS, currency_codes, read_currency_dim, read_rates_history_xml, require_rates,
)
from ..sources.warehouse import Warehouse
from . import published

MERGE_ORDER = ("stores", "products", "sales", "inventory", "plan_sales", "currency_rates")


@dataclass(frozen=True)
class RateFiles:
    """Where the rate feed landed, and which currencies and days of it to load.

    Daily files give the names, histories the rates. ``codes`` may be the text
    of a setting, separated by commas; an open ``start`` or ``end`` takes all.
    """

    daily: str
    history: str
    encoding: str = "windows-1251"
    codes: Sequence[str] | str = CURRENCIES
    start: date | None = None
    end: date | None = None


def _load(
    warehouse: Warehouse, name: str, paths: Sequence[str], only_new: bool,
    read: Callable[[list[str]], DataFrame],
) -> str | None:
    """Append landed files to a raw table; the load's id, or None where no file is new."""
    files = warehouse.ledger.files(name, *paths, only_new=only_new)
    if not files:
        return None
    load_id = warehouse.ledger.new_load()
    append_raw(read([file.path for file in files]), warehouse.raw_path(name), load_id)
    warehouse.ledger.commit(name, files, load_id)
    return load_id


def load_raw(
    spark: SparkSession, landing: str, warehouse: Warehouse, only_new: bool = False
) -> dict[str, str | None]:
    """Append landed tables to raw; the id of each load.

    The established flow appends every file on every run; with ``only_new``
    files that an earlier load has brought are left out.
    """
    return {
        name: _load(
            warehouse, name, [f"{landing}/{name}.csv"], only_new,
            lambda files, name=name: read_landing(spark, landing, name, files=files))
        for name in CSV_ENTITIES
    }


def load_raw_rates(
    spark: SparkSession, files: RateFiles, warehouse: Warehouse, only_new: bool = False
) -> str | None:
    codes = currency_codes(files.codes) if isinstance(files.codes, str) else files.codes
    currencies = read_currency_dim(spark, files.daily, codes, files.encoding)

    def read(paths: list[str]) -> DataFrame:
        return require_rates(read_rates_history_xml(
            spark, paths, currencies, files.start, files.end, files.encoding))

    return _load(warehouse, "currency_rates", [files.history], only_new, read)


def _stage(warehouse: Warehouse, name: str, rows: DataFrame) -> None:
    """Write a staging table; its rules are counted on the way, only keys are read again."""
    rows, seen = quality.watched(name, rows)
    warehouse.stage(name, rows.drop(cleaning.OVERFLOWED))
    quality.enforce(name, warehouse.staged(name), seen)


def stage_csv(
    spark: SparkSession, landing: str, warehouse: Warehouse, keep_rejects: bool = False,
    dates: str = "each",
) -> None:
    """Clean the landed files themselves, not the ever-growing raw tables.

    Dimensions are staged first and facts are checked against the staged copy,
    so each dimension is cleaned once. Broken constraints stop the run, among
    them numbers too large for their column; with ``keep_rejects`` such rows and
    those that lack a required value are set aside instead, with the names of
    what they lack, and the rest is loaded. ``dates="column"`` reads each date
    column in the one format that fits most of it.
    """
    for name in CSV_ENTITIES:
        landed = read_landing(spark, landing, name)
        rows = cleaning.clean(name, landed, dates=dates, overflow=True)
        rows = integrity.related(name, rows, warehouse.staged)
        if keep_rejects:
            rows, rejects = quality.split_rejects(name, rows)
            warehouse.set_aside(name, rejects)
        _stage(warehouse, name, rows)


def stage_rates(warehouse: Warehouse, since: str | None = None) -> None:
    """Rates are cleaned from raw, of all loads or of those from ``since`` on; the latest load
    of a day wins. Earlier loads are in the core table already, which the merge lets the new ones replace."""
    raw = warehouse.raw("currency_rates", since).select(*RAW_COLUMNS, "load_dttm")
    settled = ["load_dttm", "source_url", "nominal", "rate_to_rub", "currency_name"]
    _stage(warehouse, "currency_rates",
           cleaning.clean("currency_rates", raw, settled, overflow=True))


def merge_core(warehouse: Warehouse, names=MERGE_ORDER) -> list[tuple]:
    """Merge what is staged and publish it; returns what was published."""
    changes: list[tuple] = []
    for name in names:
        changes += warehouse.merge(name, warehouse.staged(name))
    warehouse.publish(changes)
    return changes


def dimensions_changed(warehouse: Warehouse) -> bool:
    """Whether staged stores or products differ from those in core; ask before merging them."""
    for name in ("stores", "products"):
        columns = ENTITIES[name].core.names
        new = warehouse.staged(name).select(*columns)
        if not new.exceptAll(warehouse.core(name).select(*columns)).isEmpty():
            return True
    return False


def run(
    spark: SparkSession, landing: str, root: str, rates: RateFiles | None = None,
    keep_rejects: bool = False, dates: str = "each", only_new: bool = False,
    marts: str | None = None,
) -> Warehouse:
    """One complete load; safe to repeat.

    With ``marts``, a folder, the stored marts and reports of the months that
    this load has touched are computed anew, or all if a dimension has changed.

    With ``only_new`` a run appends and reads new files' loads only: rates of
    earlier loads aren't read again, and nothing is staged or merged where no
    file is new. If one CSV file is, all are staged, since a new store may let
    sales of an older file in.
    """
    warehouse = Warehouse(spark, root)
    loads = load_raw(spark, landing, warehouse, only_new)
    names = []
    if any(loads.values()):
        stage_csv(spark, landing, warehouse, keep_rejects, dates)
        names = [n for n in MERGE_ORDER if n in CSV_ENTITIES]
    if rates is not None:
        load_id = load_raw_rates(spark, rates, warehouse, only_new)
        if load_id is not None:
            stage_rates(warehouse, load_id if only_new else None)
            names.append("currency_rates")
    everywhere = marts is not None and "stores" in names and dimensions_changed(warehouse)
    changes = merge_core(warehouse, names)
    if marts is not None and changes:
        staged = warehouse.staged("currency_rates") if "currency_rates" in names else None
        months = None if everywhere else published.touched_months(changes, staged)
        published.refresh(warehouse.tables(), marts, months)
    return warehouse


def marts_to_tables(warehouse: Warehouse, target: str, months=None) -> None:
    """Store every mart as Parquet, for readers outside Spark."""
    from .registry import MARTS

    tables = warehouse.tables()
    for name, mart in MARTS.items():
        mart(tables, months).write.mode("overwrite").parquet(f"{target}/{name}")

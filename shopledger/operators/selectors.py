"""Filters a caller chooses: dashboard selectors and report periods."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from datetime import date
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_MONTH = re.compile(r"\d{4}-\d{2}")


def apply_selectors(df: DataFrame, chosen: Mapping[str, Iterable]) -> DataFrame:
    """Keep rows whose columns hold one of the chosen values; empty means all."""
    for name, values in chosen.items():
        values = checked_values(values)
        if values:
            df = df.filter(F.col(name).isin(list(values)))
    return df


def checked_values(values: Iterable) -> tuple:
    """Chosen values as a tuple that can be read again; a single text or date is one value."""
    return (values,) if isinstance(values, (str, date)) else tuple(values)


def check_month(month: str) -> str:
    if not isinstance(month, str) or not _MONTH.fullmatch(month):
        raise ValueError("month must be written YYYY-MM")
    return month


def check_date(day: str | date) -> date:
    try:
        return day if isinstance(day, date) else date.fromisoformat(day)
    except (TypeError, ValueError) as error:
        raise ValueError("report date must be written YYYY-MM-DD") from error


def checked_months(months: Iterable[str] | None) -> tuple[str, ...] | None:
    """Months as a tuple that can be read again and again; a single text is one month."""
    if months is None:
        return None
    return tuple(check_month(m) for m in ([months] if isinstance(months, str) else months))


def over_months(mart: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A mart whose ``months`` may be any iterable: it is read once, here."""

    @wraps(mart)
    def run(tables, months=None, *args, **kwargs):
        return mart(tables, checked_months(months), *args, **kwargs)

    return run


def in_months(df: DataFrame, column: str, months: tuple[str, ...] | None) -> DataFrame:
    """Keep the given months of a month-key column (reaches the scan)."""
    return df if months is None else df.filter(F.col(column).isin(list(months)))


def _bounds(month: str) -> tuple[date, date]:
    year, number = map(int, month.split("-"))
    return date(year, number, 1), date(year + number // 12, number % 12 + 1, 1)


def dated_in_months(df: DataFrame, column: str, months: tuple[str, ...] | None) -> DataFrame:
    """Keep the given months of a date column, as ranges the scan can use."""
    if months is None:
        return df
    keep: Column = F.lit(False)
    for start, end in map(_bounds, months):
        keep = keep | ((F.col(column) >= start) & (F.col(column) < end))
    return df.filter(keep)


def up_to_months(df: DataFrame, column: str, months: tuple[str, ...] | None) -> DataFrame:
    """Keep everything up to the last of the months, for comparisons that look back."""
    if months is None:
        return df
    return df.filter(F.col(column) <= max(months)) if months else df.filter(F.lit(False))


def dated_up_to_months(df: DataFrame, column: str, months: tuple[str, ...] | None) -> DataFrame:
    if months is None:
        return df
    return df.filter(F.col(column) < _bounds(max(months))[1]) if months else df.filter(F.lit(False))

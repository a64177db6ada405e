"""Numbers, names and periods as text for reports.

Numbers are printed from their double value, halves to even, which is what the
readers of these reports have always seen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col, or_zero

NO_DATA = "no data"
NOT_STATED = "not stated"

_MONTHS = (
    "January", "February", "March", "April", "May", "June", "July", "August", "September",
    "October", "November", "December",
)


def money_text(value: Column | str) -> Column:
    """Whole units with spaces between thousands; missing prints as 0."""
    return F.translate(F.format_number(or_zero(value).cast("double"), 0), ",", " ")


def pct_text(value: Column | str) -> Column:
    """One decimal, dropped when zero.

    Values up to 1 in size are taken for fractions and multiplied by 100, so a
    true percentage below one prints a hundredfold; numeric columns keep the
    plain figure.
    """
    number = or_zero(value).cast("double")
    number = F.when(F.abs(number) <= 1, number * 100).otherwise(number)
    digits = F.translate(F.format_number(number, 1), ",", "")
    return F.regexp_replace(F.concat(digits, F.lit("%")), r"\.0%$", "%")


def names(rows: Column | str, field: str) -> Column:
    """Names in a list of structs, comma separated."""
    found = F.filter(F.transform(col(rows), lambda r: r[field]), lambda n: n.isNotNull())
    return F.when(F.size(found) > 0, F.array_join(found, ", ")).otherwise(NO_DATA)


def first_name(rows: Column | str, field: str) -> Column:
    return F.coalesce(F.get(col(rows), F.lit(0))[field], F.lit(NO_DATA))


def month_label(month: Column | str) -> Column:
    """``YYYY-MM`` as "Month YYYY"; an unknown month number is shown as it is."""
    month = col(month)
    number = F.substring_index(month, "-", -1)
    pairs = [F.lit(p) for i, n in enumerate(_MONTHS, 1) for p in (f"{i:02d}", n)]
    name = F.coalesce(F.create_map(*pairs)[number], number)
    return (
        F.when(month.isNull() | (month == ""), NOT_STATED)
        .when(~month.contains("-"), month)
        .otherwise(F.concat_ws(" ", name, F.substring_index(month, "-", 1)))
    )


def fact(name: str, value: Column) -> Column:
    return F.struct(F.lit(name).alias("name"), value.alias("value"))

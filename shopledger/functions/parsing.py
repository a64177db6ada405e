"""Lenient parsing of landed text: whatever cannot be read becomes null."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import col

# The texts a CSV reader of the pandas family takes as missing.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

_WIDE = "decimal(38,12)"

# Ways of writing a day; a slashed day that doesn't begin with the year has the month first.
DAY_FORMATS = {
    r"\d{4}-\d{1,2}-\d{1,2}": "yyyy-M-d",
    r"\d{4}/\d{1,2}/\d{1,2}": "yyyy/M/d",
    r"\d{8}": "yyyyMMdd",
    r"\d{1,2}\.\d{1,2}\.\d{4}": "d.M.yyyy",
    r"\d{1,2}/\d{1,2}/\d{4}": "M/d/yyyy",
}
# the usual way, which Spark reads by itself
_ISO = r"^\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?$"
# One format for a whole column; of equally good ones the first here wins.
COLUMN_STYLES = (
    "yyyy-M-d", "yyyy/M/d", "yyyyMMdd", "d.M.yyyy", "M.d.yyyy", "M/d/yyyy", "d/M/yyyy", "d-M-yyyy",
    "M-d-yyyy",
)
_CLOCK = r"[ T]+(\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)"


def known(c: Column | str) -> Column:
    c = col(c)
    return F.when(~c.isin(NA_TOKENS), c)


def number(c: Column | str) -> Column:
    return F.trim(col(c)).try_cast(_WIDE)


def comma_number(c: Column | str) -> Column:
    """A number written with a decimal comma."""
    return number(F.translate(col(c), ",", "."))


def day(c: Column | str) -> Column:
    """The day of a date or a date with a time; anything else around it makes it null."""
    text = F.trim(col(c))
    return F.when(F.rlike(text, F.lit(_ISO)), text.try_cast("date")).otherwise(
        _rarely(text, _other_day))


def _rarely(text: Column, read: Callable[[Column], Column]) -> Column:
    """A rare reading as a lambda: generated methods stay short, long ones are never compiled."""
    return F.get(F.transform(F.array(text), read), F.lit(0))


def _other_day(text: Column) -> Column:
    return F.coalesce(*(
        F.when(
            F.rlike(text, F.lit(f"^{pattern}(?:{_CLOCK})?$")),
            F.try_to_date(F.regexp_extract(text, f"^({pattern})", 1), style),
        )
        for pattern, style in DAY_FORMATS.items()
    ))


def day_text(c: Column | str) -> Column:
    """A day without the time written behind it, empty if it is none."""
    return F.regexp_extract(F.trim(col(c)), rf"^(\d+(?:[-./]\d+)*)(?:{_CLOCK})?$", 1)


def _read_day(written: Column, style: str) -> Column:
    """A day text in a style; texts with other marks between numbers aren't tried at all,
    since a failed try costs many times a good one."""
    mark = next((c for c in style if not c.isalpha()), "")
    shape = r"^\d+$" if not mark else rf"^\d+[{mark}]\d+[{mark}]\d+$"
    return F.when(F.rlike(written, F.lit(shape)), F.try_to_date(written, style))


def _reader(style: str) -> tuple[str, str]:
    """Pattern of a whole text with a day in a style, and the replacement that puts it in the usual
    way, with the time behind it; any other text keeps nothing but marks, which are no day."""
    mark = next((c for c in style if not c.isalpha()), "")
    # a formatter takes up to 19 digits for a month or a day, but four for a year
    digits = {"yyyy": r"(\d{4})", "M": r"0{0,17}(\d{1,2})", "d": r"0{0,17}(\d{1,2})"}
    if mark:
        fields = style.split(mark)
        written = f"[{mark}]".join(digits[f] for f in fields)
    else:
        fields, written = ["yyyy", "M", "d"], r"(\d{4})(\d{2})(\d{2})"
    year, month, day_of_month = (fields.index(f) + 1 for f in ("yyyy", "M", "d"))
    return f"(?s)^{written}(?:{_CLOCK})?$|^.*$", f"${year}-${month}-${day_of_month} $4"


def style_reader(chosen: Column) -> Column:
    """What ``read_day`` and ``read_moment`` need of a format, computed once for a column."""
    readers = [
        F.struct(F.lit(pattern).alias("pattern"), F.lit(usual).alias("usual"))
        for pattern, usual in map(_reader, COLUMN_STYLES)
    ]
    read = F.when(chosen == COLUMN_STYLES[0], readers[0])
    for style, reader in zip(COLUMN_STYLES[1:], readers[1:]):
        read = read.when(chosen == style, reader)
    return read


def column_style(c: Column | str, times: Column | str | None = None) -> Column:
    """Aggregate: the format that reads most of a column's values, null if none reads any.

    A day that fits two formats votes for both, so ``05.12.2024`` is settled by
    the other days of its column. ``times`` says how often a value occurs.
    """
    written = day_text(c)
    number = F.lit(1).cast("bigint") if times is None else col(times)

    def readable(style: str) -> Column:
        votes = F.sum(F.when(_read_day(written, style).isNotNull(), number))
        return F.coalesce(votes, F.lit(0).cast("bigint"))

    votes = F.array(*(
        F.struct(
            readable(style).alias("readable"),
            F.lit(-place).alias("preference"), F.lit(style).alias("style"),
        )
        for place, style in enumerate(COLUMN_STYLES)
    ))
    winner = F.array_max(votes)
    return F.when(winner["readable"] > 0, winner["style"])


def styled_day(c: Column | str, chosen: Column) -> Column:
    """The day as the chosen format of its column reads it; what it can't read is null."""
    written = day_text(c)
    ways = [(chosen == style, _read_day(written, style)) for style in COLUMN_STYLES]
    read = F.when(*ways[0])
    for way in ways[1:]:
        read = read.when(*way)
    return read


def styled_moment(c: Column | str, chosen: Column) -> Column:
    return _timed(F.trim(col(c)), styled_day(c, chosen))


def _usual(c: Column | str, reader: Column) -> Column:
    return F.regexp_replace(F.trim(col(c)), reader["pattern"], reader["usual"])


def read_day(c: Column | str, reader: Column) -> Column:
    """As ``styled_day``, in one step that is the same for all formats."""
    return _usual(c, reader).try_cast("date")


def read_moment(c: Column | str, reader: Column) -> Column:
    """As ``styled_moment``, from what ``style_reader`` made of the format."""
    return _usual(c, reader).try_cast("timestamp_ntz")


def moment(c: Column | str) -> Column:
    """A day with its time, midnight where none is written."""
    text = F.trim(col(c))
    return F.when(F.rlike(text, F.lit(_ISO)), text.try_cast("timestamp_ntz")).otherwise(
        _rarely(text, lambda t: _timed(t, _other_day(t)))
    )


def _timed(text: Column, read: Column) -> Column:
    clock = F.nullif(F.regexp_extract(text, f"{_CLOCK}$", 1), F.lit(""))
    return F.concat(
        read.cast("string"), F.lit(" "), F.coalesce(clock, F.lit("00:00"))
    ).try_cast("timestamp_ntz")


def parse(c: Column, target: T.DataType, style: Column | None = None) -> Column:
    """Read text as ``target``; numbers stay wide until ``narrow`` is applied.

    With a ``style``, of ``style_reader``, days are read in this one format of their column.
    """
    if isinstance(target, T.StringType):
        return c
    if isinstance(target, T.DateType):
        return day(c) if style is None else read_day(c, style)
    if isinstance(target, T.TimestampNTZType):
        return moment(c) if style is None else read_moment(c, style)
    return number(c)


def fits(c: Column, target: T.DataType) -> Column:
    """Whether a wide number has room in its column type; null fits."""
    return c.isNull() | narrow(c, target).isNotNull()


def narrow(c: Column, target: T.DataType) -> Column:
    """Round (or, for integers, cut) a wide number to its column type.

    A value too large for the column turns null; ``fits`` tells such values
    from missing ones.
    """
    if isinstance(target, T.DecimalType):
        return F.round(c, target.scale).try_cast(target)
    if isinstance(target, T.IntegralType):
        return c.try_cast(target)
    return c

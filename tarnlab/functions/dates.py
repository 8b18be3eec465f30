"""Dates: laboratory formats, civil days and retention buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .binding import let

ZONE = "Australia/Sydney"

MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()

#: Formats by name, each a pattern whose groups are the parts named.
FORMATS = {
    "esdat": (
        (r"^(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4})\s+(\d{1,2}):(\d{1,2})", "dbYHM"),
        (r"^(\d{1,2})\s+([A-Za-z]{3})[a-z]*\s+(\d{4})", "dbY"),
        (r"^(\d{1,2})-([A-Za-z]{3})[a-z]*-(\d{2})\s+(\d{1,2}):(\d{1,2})", "dbyHM"),
        (r"^(\d{1,2})-([A-Za-z]{3})[a-z]*-(\d{2})", "dby"),
    ),
    "crosstab": ((r"^(\d{1,2})/(\d{1,2})/(\d{4})", "dmY"),),
    "iso": (
        (r"^(\d{4})-(\d{1,2})-(\d{1,2})\s+(\d{1,2}):(\d{1,2})", "YmdHM"),
        (r"^(\d{4})-(\d{1,2})-(\d{1,2})", "Ymd"),
    ),
}


def _month(name: Column) -> Column:
    """Number of a month's name by its first three letters; null if it is none."""
    numbers = F.create_map(*[F.lit(x) for k, m in enumerate(MONTHS) for x in (m, k + 1)])
    return F.try_element_at(numbers, F.initcap(F.substring(name, 1, 3)))


def _read(text: Column, pattern: str, parts: str) -> Column:
    """The naive timestamp that a pattern reads; null if the text or a field doesn't fit."""
    part = {p: F.regexp_extract(text, pattern, i + 1) for i, p in enumerate(parts)}
    number = lambda p: part[p].try_cast("int")  # noqa: E731  (null without a match)
    year = number("Y") if "Y" in part else F.when(number("y") < 69, number("y") + 2000).otherwise(number("y") + 1900)
    month = _month(part["b"]) if "b" in part else number("m")
    hour, minute = (number(p) if p in part else F.lit(0) for p in "HM")
    return F.try_make_timestamp_ntz(year, month, number("d"), hour, minute, F.lit(0))


def exists_in_zone(naive: Column, zone: str = ZONE) -> Column:
    """Whether a wall-clock time happens in a zone: not in the gap when clocks go forward."""
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), naive)
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc) == naive


def parse_local(text: Column, formats: str, zone: str = ZONE) -> Column:
    """The wall-clock time of a date string; null if no format fits.

    The first format that reads the text decides, even if its time falls into a gap
    and so is null: a later format would silently drop the clock.
    """
    t = F.trim(text)
    read = F.coalesce(*[_read(t, pattern, parts) for pattern, parts in FORMATS[formats]])
    return let(read, lambda x: F.when(exists_in_zone(x, zone), x))


def parse_lab_datetime(text: Column, formats: str, zone: str = ZONE) -> Column:
    """The naive UTC time of a laboratory's local date string."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), parse_local(text, formats, zone))


def has_clock_time(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\d{1,2}:\d{2}"), F.lit(False))


def sampled(text: Column) -> Column:
    """struct(date, datetime) of a row's date string under any laboratory's formats, both null if none fits.

    The local day is always known, the UTC instant only where the string has a clock time.
    """
    instant = lambda local: F.convert_timezone(F.lit(ZONE), F.lit("UTC"), local)
    both = lambda local: F.struct(F.to_date(local).alias("date"), F.when(has_clock_time(text), instant(local)).alias("datetime"))
    return let(F.coalesce(*[parse_local(text, k) for k in FORMATS]), both)


def excel_date(serial: Column) -> Column:
    return F.date_add(F.lit("1899-12-30").cast("date"), F.floor(serial).cast("int"))


def civil_date(utc: Column, zone: str = ZONE) -> Column:
    """The calendar day in a zone of a naive UTC time."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc.cast("timestamp_ntz")))


def month_of(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def date_bound(text: Column) -> Column:
    """An ISO date; null if it isn't one."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(text, "yyyy-MM-dd"))


def require_dates(df: DataFrame, *columns: str) -> DataFrame:
    """df, if these of its columns are dates; TypeError if one is not: instants would make a bound depend on a zone."""
    for c in columns:
        if not isinstance(df.schema[c].dataType, T.DateType):
            raise TypeError(f"{c} must be a date, not {df.schema[c].dataType.simpleString()}")
    return df

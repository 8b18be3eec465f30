"""Reported values: parsing, censoring, equality and plausibility."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
GROUPED = r"^[+-]?[0-9]{1,3}(,[0-9]{3})+(\.[0-9]+)?$"
COMMAS = r"^[+-]?[0-9]{1,3}(,[0-9]{1,3})+(\.[0-9]+)?$"

# Methods of field readings.
FIELD_METHODS = ("field", "EN67 - Client Supplied Data")


def parse_value(raw: Column) -> Column:
    """struct(value_num, value_chr, quantified, rl_low, rl_high, skip_reason, parse_error) of a reported value.

    `<x` and `>x` are censored, BDL is censored without a value, words are text.
    Empty, NS and dashes are skipped; a comma that may be a decimal point and a limit
    that is no number are errors. Hex, infinities and embedded units are never numbers.
    """
    t = F.trim(F.replace(F.replace(raw, F.lit("\u00a0"), F.lit(" ")), F.lit("−"), F.lit("-")))
    return let(F.coalesce(F.regexp_replace(t, r"^\s+|\s+$", ""), F.lit("")), _parsed)


def _parsed(t: Column) -> Column:
    limit = t.startswith("<") | t.startswith(">")
    body = F.regexp_replace(F.when(limit, F.substring(t, 2, 1_000_000)).otherwise(t), r"^\s+|\s+$", "")
    return let(body, lambda b: let(_number(b), lambda n: _classified(t, n, b.rlike(COMMAS) & ~b.rlike(GROUPED))))


def _number(body: Column) -> Column:
    """The finite number that a text is, thousands separators allowed; null if it is none or ambiguous."""
    plain = F.replace(body, F.lit(","), F.lit(""))
    ambiguous = body.rlike(COMMAS) & ~body.rlike(GROUPED)
    number = F.when(~ambiguous & plain.rlike(NUMBER), plain.try_cast("double"))
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def _classified(t: Column, number: Column, ambiguous: Column) -> Column:
    below, above = t.startswith("<"), t.startswith(">")
    skip = F.when(t == "", "empty").when(t == "NS", "no_sample").when(t.rlike("^-+$"), "not_computable")
    usable = skip.isNull()
    limit = usable & (below | above)
    bdl = usable & (t == "BDL")
    error = F.when(usable & ambiguous, "ambiguous_number_format").when(limit & number.isNull(), "unparseable_limit_value")
    quantified = F.when(bdl | (limit & number.isNotNull()), False).when(usable & number.isNotNull(), True)
    return F.struct(
        F.when(usable & ~bdl, number).alias("value_num"),
        F.when(usable & ~bdl & ~limit & number.isNull() & error.isNull(), t).alias("value_chr"),
        quantified.alias("quantified"),
        F.when(usable & below, number).alias("rl_low"),
        F.when(usable & above, number).alias("rl_high"),
        skip.alias("skip_reason"),
        error.alias("parse_error"),
    )


def values_equal(v1: Column, t1: Column, q1: Column, v2: Column, t2: Column, q2: Column) -> Column:
    """Equal as measurements: the same tri-state, and numbers within 1e-9 or the same text."""
    near = F.abs(v1 - v2) <= 1e-9 * F.greatest(F.lit(1.0), F.abs(v1), F.abs(v2))
    same = (
        F.when(v1.isNotNull() & v2.isNotNull(), near)
        .when(v1.isNull() & v2.isNull(), t1.eqNullSafe(t2))
        .otherwise(F.lit(False))
    )
    return q1.eqNullSafe(q2) & same


def is_true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def provably_distinct(a: Column, b: Column) -> Column:
    """Both instants are known and differ."""
    return F.coalesce(a.isNotNull() & b.isNotNull() & (a != b), F.lit(False))


def live(start: Column, end: Column, on: Column) -> Column:
    """Whether a validity interval, inclusive and open where null, holds the date; a null date is in all."""
    return on.isNull() | ((start.isNull() | (start <= on)) & (end.isNull() | (end >= on)))


def implausible(value: Column, n: Column, low: Column, high: Column) -> Column:
    """A positive value ten times outside the range of at least 30 known ones."""
    return F.coalesce((value > 0) & (n >= 30) & ((value < low / 10) | (value > high * 10)), F.lit(False))


def is_field(method: Column) -> Column:
    return F.coalesce(method.isin(*FIELD_METHODS), F.lit(False))


def lab_kind(known: Column, method: Column, organisation: Column) -> Column:
    """field, acirl_transcription, acirl_own_lab, als_lab or other_lab; null if the method isn't known."""
    return (
        F.when(~known, F.lit(None).cast("string"))
        .when(is_field(method), "field")
        .when((organisation == "ACIRL") & method.isNull(), "acirl_transcription")
        .when(organisation == "ACIRL", "acirl_own_lab")
        .when(organisation == "ALS", "als_lab")
        .otherwise("other_lab")
    )


def corrected_flag(value: Column, rl_low: Column, rl_high: Column) -> Column:
    """Whether a corrected value counts as quantified: not at or beyond a reporting limit."""
    return ~F.coalesce((value <= rl_low) | (value >= rl_high), F.lit(False))


def residual_class(quantified: Column, value: Column, rl_low: Column) -> Column:
    """Classes of rows by how value, limit and flag agree."""
    return (
        F.when(quantified.isNull() & value.isNotNull(), "B_NA")
        .when(~quantified & value.isNull(), "BDL_EQ")
        .when(~quantified & (value == rl_low), "A1")
        .when(~quantified & (value < rl_low), "A2")
        .when(~quantified, "LEGIT_RAISED")
        .otherwise("DET_OK")
    )


def changelog_text(c: Column, kind: str) -> Column:
    """Canonical text of a value in the change log."""
    if kind == "timestamp":
        return F.regexp_replace(F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0+$", "")
    return c.cast("string")

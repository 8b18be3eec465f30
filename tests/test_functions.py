"""Pinned values of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from tarnlab.functions import dates, text, units, values


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("2.3", (2.3, None, True, None, None, None, None)),
        ("<0.01", (0.01, None, False, 0.01, None, None, None)),
        ("< 0.01", (0.01, None, False, 0.01, None, None, None)),
        (">2000", (2000.0, None, False, None, 2000.0, None, None)),
        ("BDL", (None, None, False, None, None, None, None)),
        ("NS", (None, None, None, None, None, "no_sample", None)),
        ("----", (None, None, None, None, None, "not_computable", None)),
        ("Clear, low flow", (None, "Clear, low flow", None, None, None, None, None)),
        ("", (None, None, None, None, None, "empty", None)),
        (None, (None, None, None, None, None, "empty", None)),
        ("<0.01 mg/L", (None, None, None, None, None, None, "unparseable_limit_value")),
        ("<", (None, None, None, None, None, None, "unparseable_limit_value")),
        ("1,5", (None, None, None, None, None, None, "ambiguous_number_format")),
        ("1,23,456", (None, None, None, None, None, None, "ambiguous_number_format")),
        ("1,234", (1234.0, None, True, None, None, None, None)),
        ("0x10", (None, "0x10", None, None, None, None, None)),
        ("Inf", (None, "Inf", None, None, None, None, None)),
        ("1d", (None, "1d", None, None, None, None, None)),
        ("−3", (-3.0, None, True, None, None, None, None)),
        (" 7 ", (7.0, None, True, None, None, None, None)),
    ],
)
def test_parse_value(spark, raw, expected):
    assert tuple(one(spark, values.parse_value(F.lit(raw).cast("string")))) == expected


@pytest.mark.parametrize(
    "said, formats, utc",
    [
        ("05/01/2026", "crosstab", "2026-01-04 13:00:00"),
        ("13/13/2025", "crosstab", None),
        ("07-May-24 11:30", "esdat", "2024-05-07 01:30:00"),
        ("07 May 2024", "esdat", "2024-05-06 14:00:00"),
        ("05 Oct 2025 02:30", "esdat", None),
        ("2024-01-05 10:00", "iso", "2024-01-04 23:00:00"),
        ("yesterday", "iso", None),
        (None, "iso", None),
    ],
)
def test_dates(spark, said, formats, utc):
    assert one(spark, dates.parse_lab_datetime(F.lit(said).cast("string"), formats).cast("string")) == utc


def test_excel_serial(spark):
    assert str(one(spark, dates.excel_date(F.lit(45802.7)))) == "2025-05-25"


@pytest.mark.parametrize(
    "value, a, b, expected, error",
    [
        (1.0, "mg/L", "ug/L", 1000.0, None),
        (1.0, "mg/L", "g/m3", 1.0, None),
        (185.0, "µS/cm", "mS/cm", 0.185, None),
        (7.0, "pH", "pH Unit", 7.0, None),
        (20.0, "degC", "K", 293.15, None),
        (1.0, "mg/L", "degC", None, "unknown_unit"),
        (5.0, None, "mg/L", 5.0, None),
        (5.0, "mg/L", None, None, "missing_target"),
        (5.0, "furlong", "mg/L", None, "unknown_unit"),
    ],
)
def test_units(spark, value, a, b, expected, error):
    got = one(spark, units.convert(F.lit(value), F.lit(a).cast("string"), F.lit(b).cast("string")))
    assert got.error == error
    assert got.value == (pytest.approx(expected) if expected is not None else None)


@pytest.mark.parametrize("raw, key", [(" T.S01 ", "t.s01"), ("--", None), (None, None)])
def test_feature_key(spark, raw, key):
    assert one(spark, text.feature_key(F.lit(raw).cast("string"))) == key


def test_text_repairs(spark):
    assert one(spark, text.normalise_lab_text(F.lit("25Â°C <c2><b5>g �S/cm ¡"))) == "25°C µg µS/cm °"
    assert one(spark, text.is_irrecoverable(F.lit("a�b")))
    assert one(spark, text.method_key(F.lit("Nitrate + Nitrite as N"))) == "nitratenitriteasn"
    assert one(spark, text.canonical_point(F.lit("s007b010"))) == "S7B10"


@pytest.mark.parametrize(
    "said, stage, looks",
    [("Clear, low flow", "Low flow", "Clear"), ("high evel", "High level", None), ("no discharge, pooled", "No discharge", None), (None, None, None)],
)
def test_observation(spark, said, stage, looks):
    got = one(spark, text.observation(F.lit(said).cast("string")))
    assert (got.stage, got.appearance) == (stage, looks)


def test_values_equal(spark):
    n, d, b = (F.lit(None).cast(t) for t in ("string", "double", "boolean"))
    yes = F.lit(True)
    assert one(spark, values.values_equal(F.lit(1.0), n, yes, F.lit(1.0 + 1e-10), n, yes))
    assert not one(spark, values.values_equal(F.lit(1.0), n, yes, F.lit(1.0), n, b))
    assert one(spark, values.values_equal(d, F.lit("Dry"), b, d, F.lit("Dry"), b))
    assert not one(spark, values.values_equal(F.lit(1.0), n, yes, d, n, yes))


def test_units_for_several_values(spark):
    units_of = lambda *u: F.array(*map(F.lit, u))
    assert one(spark, units.recycled(units_of("mg/L"), 3)) == ["mg/L"] * 3
    assert one(spark, units.recycled(units_of("mg/L", "m"), F.size(F.array(F.lit(1), F.lit(2))))) == ["mg/L", "m"]
    for bad in (units.recycled(units_of("a", "b"), 3), units.recycled(F.lit(None).cast("array<string>"), 1)):
        with pytest.raises(Exception, match="must have length 1 or"):
            one(spark, bad)


def test_date_bounds_are_dates(spark):
    df = spark.sql("SELECT DATE '2024-05-07' AS a, TIMESTAMP '2024-05-07 10:00' AS b")
    assert dates.require_dates(df, "a") is df
    with pytest.raises(TypeError, match="b must be a date"):
        dates.require_dates(df, "a", "b")

"""Text: encoding repairs, key folding, codes and free-text observations."""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# Encoding repairs, applied in this order as literal replacements.
MOJIBAKE_FIXES = (
    ("<c2><b0>", "°"),
    ("<c2><b1>", "±"),
    ("<c2><b2>", "²"),
    ("<c2><b5>", "µ"),
    ("<c2><a1>", "°"),
    ("<e2><80><94>", "—"),
    ("<e2><81><bb>", "⁻"),
    ("¡", "°"),
    ("�S/cm", "µS/cm"),
    ("�g/L", "µg/L"),
    ("�C", "°C"),
    ("Â°", "°"),
    ("Âµ", "µ"),
)

# Spellings of the replacement character that no repair can undo.
IRRECOVERABLE = ("�", "<ef><bf><bd>", "ï¿½")

# Long names of unit symbols in reports.
UNIT_LONG_FORM = {
    "mg/L": "milligrams per litre",
    "µg/L": "micrograms per litre",
    "ug/L": "micrograms per litre",
    "mg/kg": "milligrams per kilogram",
    "µS/cm": "microsiemens per centimetre",
    "uS/cm": "microsiemens per centimetre",
    "ppmv": "parts per million by volume",
    "ppm": "parts per million",
    "%": "per cent",
    "%v/v": "per cent by volume",
    "pH": "pH units",
    "pH Unit": "pH units",
    "pH_Units": "pH units",
    "NTU": "nephelometric turbidity units",
    "g/m2/month": "grams per square metre per month",
    "m": "metres",
    "L/L": "litres per litre",
    "L/s": "litres per second",
    "mm": "millimetres",
    "degC": "degrees Celsius",
    "°C": "degrees Celsius",
}

# Patterns of codes.
WORK_ORDER = r"[A-Z]{2}\d{7}"
NCP_CODE = r"^[A-Z]{2}\d{7}\d*_[A-Z]{2}\d{7}$"
CAS_NUMBER = r"^\d{2,7}-\d{2}-\d$"
REPORT_NUMBER = r"ES[0-9]{7}"


def lookup(pairs: dict[str, str], key: Column) -> Column:
    """Literal dictionary; null where the key isn't in it."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv]), key)


def normalise_lab_text(c: Column) -> Column:
    return functools.reduce(lambda x, fix: F.replace(x, F.lit(fix[0]), F.lit(fix[1])), MOJIBAKE_FIXES, c)


def is_irrecoverable(c: Column) -> Column:
    """Whether a replacement character is left after the repairs."""
    fixed = normalise_lab_text(c)
    return functools.reduce(lambda a, b: a | b, [fixed.contains(x) for x in IRRECOVERABLE])


def method_key(c: Column) -> Column:
    """Fold of method and analyte names: letters and digits only, lower case; null if none."""
    return F.nullif(F.lower(F.regexp_replace(normalise_lab_text(c), r"(?U)[^\p{Alnum}]", "")), F.lit(""))


def unicode_trim(c: Column) -> Column:
    return F.regexp_replace(c, r"^[\h\v]+|[\h\v]+$", "")


def feature_key(c: Column) -> Column:
    """Fold of sampling-point names: lower case, trimmed, punctuation kept; null without a letter or digit."""
    key = unicode_trim(F.lower(normalise_lab_text(c)))
    return F.when(key.rlike(r"(?U)\p{Alnum}"), key)


def canonical_point(c: Column) -> Column:
    """Upper case; leading zeros of each run of digits dropped."""
    return F.regexp_replace(F.upper(c), r"(?<![0-9])0+(?=[0-9])", "")


def squish(c: Column) -> Column:
    """Without outer blanks, inner runs of them single."""
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def squish_key(c: Column) -> Column:
    return F.lower(squish(c))


def guess_work_order(c: Column) -> Column:
    return F.nullif(F.regexp_extract(c, f"({WORK_ORDER})", 1), F.lit(""))


def guess_revision(c: Column) -> Column:
    """The number that follows the first work order as `_n_` or `_n.`; null if there is none."""
    return F.nullif(F.regexp_extract(c, rf"^.*?{WORK_ORDER}(?:_(\d+)[_.])?", 1), F.lit("")).cast("int")


def adapter_id(c: Column) -> Column:
    return F.substring_index(c, "/", 1)


def strip_bom(c: Column) -> Column:
    return F.regexp_replace(c, "^(﻿|ï»¿)", "")


def sample_type(raw: Column) -> Column:
    """Sample types of crosstabs: empty is unknown, REG is Normal, others stay."""
    return F.when(raw.isNull() | (F.trim(raw) == ""), "unknown").when(F.trim(raw) == "REG", "Normal").otherwise(F.trim(raw))


def repair_units(analyte: Column, units: Column) -> Column:
    """Units cells of workbooks that carry a label or a stray prefix."""
    return (
        F.when(analyte.rlike("(?i)^temperature"), "°C")
        .when(units.rlike(r"(?i)^pH\s*units?$"), "pH")
        .otherwise(F.regexp_replace(units, "^.+µ", "µ"))
    )


def is_comment_label(c: Column) -> Column:
    return F.coalesce(c.rlike(r"(?i)^\s*(comments?|observations?|remarks?)\b"), F.lit(False))


def report_numbers(c: Column) -> Column:
    """All report numbers in a text, each once, in order."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(f"({REPORT_NUMBER})"), F.lit(1)))


def tokens(c: Column) -> Column:
    """Items of a comma list: trimmed, not empty."""
    return F.filter(F.transform(F.split(c, ",", -1), lambda x: F.trim(x)), lambda x: x != "")


def reported_as(c: Column) -> Column:
    """The word after a closing `as`, such as in `Nitrate as N`."""
    return F.nullif(F.regexp_extract(c, r"(?i)\sas\s+(\w+)$", 1), F.lit(""))


def unit_long_form(c: Column) -> Column:
    """Long name of a unit symbol; others pass as they are."""
    return F.coalesce(lookup(UNIT_LONG_FORM, c), c)


def observation(text: Column) -> Column:
    """Free text of a field observation as struct(stage, appearance); null where nothing is said.

    A magnitude with a noun (`low flow`) wins over standing phrases, of which the earliest counts.
    """
    x = F.regexp_replace(F.lower(text), r"\bevel\b", "level")
    pair = r"\b(very\s*low|low|mod(?:erate)?|high)\s*[-/,;]?\s*(flows?|levels?|dis(?:charge)?s?)"
    size = F.regexp_replace(F.regexp_extract(x, pair, 1), r"\s+", "")
    noun = F.regexp_extract(x, pair, 2)
    size = F.when(size == "verylow", "Very low").when(size.isin("mod", "moderate"), "Mod").otherwise(F.initcap(size))
    noun = F.when(noun.startswith("flow"), "flow").when(noun.startswith("level"), "level").otherwise("discharge")
    # Standing phrases and their spellings.
    standing = {
        "No discharge": r"no\s*discharge|non\s*discharge|no\s*dis\b|not\s*running|no\s*flows?\b|not\s*flowing",
        "Pooled": r"pooled|polled",
        "Dry": r"\bdry\b",
    }
    found = [
        F.struct(F.regexp_instr(x, F.lit(f"({p})")).alias("at"), F.lit(k).alias("rank"), F.lit(name).alias("name"))
        for k, (name, p) in enumerate(standing.items())
    ]
    first = F.array_min(F.filter(F.array(*found), lambda s: s["at"] > 0))["name"]
    stage = F.when(x.rlike(pair), F.concat_ws(" ", size, noun)).otherwise(first)
    looks = (
        F.when(x.rlike(r"sli\w*ly[ ,/-]*clou\w*dy"), "Slightly cloudy")
        .when(x.rlike(r"clou\w*dy"), "Cloudy")
        .when(x.rlike(r"turbid"), "Turbid")
        .when(x.rlike(r"\bcl(?:ea|ae)r\b"), "Clear")
    )
    return F.struct(stage.alias("stage"), looks.alias("appearance"))

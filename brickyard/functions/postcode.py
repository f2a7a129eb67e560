"""Postcode and code-list expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The London outcode prefixes (inner then outer London).
LONDON_OUTCODE_PREFIXES = ["E", "EC", "N", "NW", "SE", "SW", "W", "WC",
                           "BR", "CR", "DA", "EN", "HA", "IG", "KT", "RM", "SM", "TW", "UB", "WD"]

# UK postcode validity pattern (case-insensitive).
POSTCODE_PATTERN = r"(?i)^[A-Z]{1,2}[0-9R][0-9A-Z]? ?[0-9][A-Z]{2}$"

# Price-paid code lists.
PROPERTY_TYPE_CODES = {"D": "DETACHED", "S": "SEMI_DETACHED", "T": "TERRACED", "F": "FLAT", "O": "OTHER"}
TENURE_CODES = {"F": "FREEHOLD", "L": "LEASEHOLD"}
CATEGORY_CODES = {"A": "STANDARD_SALE", "B": "NEW_BUILD"}

# Month abbreviations for month parsing.
MONTH_ABBREVIATIONS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Approximate OSGB grid → WGS84 constants.
LAT0, LNG0, METRES_PER_DEGREE, REF_LAT_DEG = 49.766, -7.557, 111320.0, 51.5


def norm_key(col: Column) -> Column:
    """upper(trim(x)) with blank → NULL (P25)."""
    t = F.upper(F.trim(col))
    return F.when(F.length(t) > 0, t)


def outcode(col: Column) -> Column:
    """Outcode of a full postcode: drop whitespace, drop the last 3 chars, upper."""
    s = F.regexp_replace(col, r"\s", "")
    return F.upper(F.when(F.length(s) > 3, s.substr(F.lit(1), F.length(s) - 3)).otherwise(F.lit("")))


def outcode_split(col: Column) -> Column:
    """Outcode at ingest: what is before the first white space, NULL without any.

    Without patterns, as a filter and each column that uses it evaluate it anew.
    """
    t = F.translate(F.trim(col), "\t\n\x0b\f\r", "     ")
    return F.when(t.contains(" "), F.upper(F.substring_index(t, " ", 1)))


def area(col: Column) -> Column:
    """Leading letters of an outcode, else the whole string."""
    a = F.regexp_extract(col, r"^[A-Z]+", 0)
    return F.when(F.length(a) > 0, a).otherwise(col)


def sector_label(col: Column) -> Column:
    """First ≤ 4 characters when the outcode has ≥ 3, else itself."""
    return F.when(F.length(col) >= 3, F.substring(col, 1, 4)).otherwise(col)


def london_regex() -> str:
    one = [p for p in LONDON_OUTCODE_PREFIXES if len(p) == 1]
    two = [p for p in LONDON_OUTCODE_PREFIXES if len(p) == 2]
    return "^((" + "|".join(one + two) + r")[0-9]|(" + "|".join(two) + ")$)"


def is_london(out: Column) -> Column:
    """A prefix counts only when a digit follows; a 2-letter prefix may be the whole outcode (P5)."""
    return F.coalesce(out.rlike(london_regex()), F.lit(False))


def like_prefix(col: Column, prefix: str) -> Column:
    """``col LIKE 'prefix%'`` (P11); note 'E%' also matches EC*/EN* as in the reference (Q-7)."""
    return col.startswith(prefix)


def valid_postcode(col: Column) -> Column:
    return F.coalesce(col.rlike(POSTCODE_PATTERN), F.lit(False))


def decode(col: Column, mapping: dict[str, str]) -> Column:
    """Code → label, unknown → NULL."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return m[F.trim(col)]


def address_line(saon: Column, paon: Column, street: Column) -> Column:
    """``saon ? "saon, paon street" : "paon street"``, trimmed."""
    s, p, st = F.trim(F.coalesce(saon, F.lit(""))), F.trim(F.coalesce(paon, F.lit(""))), F.trim(F.coalesce(street, F.lit("")))
    return F.when(F.length(s) > 0, F.trim(F.concat(s, F.lit(", "), p, F.lit(" "), st))) \
            .otherwise(F.trim(F.concat(p, F.lit(" "), st)))


def js_parse_float(col: Column) -> Column:
    """JavaScript parseFloat: longest numeric prefix after leading blanks, else NULL (the cast of '', so that the pattern runs once)."""
    return F.regexp_extract(col, r"^\s*([+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?)", 1).try_cast("double")


def grid_to_latlng(easting: Column, northing: Column) -> tuple[Column, Column]:
    """Approximate OSGB easting/northing → lat/lng; NULL unless both > 0."""
    ok = (easting > 0) & (northing > 0)
    lat = F.lit(LAT0) + northing / METRES_PER_DEGREE
    lng = F.lit(LNG0) + easting / (METRES_PER_DEGREE * math.cos(REF_LAT_DEG * math.pi / 180))
    return F.when(ok, F.round(lat, 6)), F.when(ok, F.round(lng, 6))


def parse_month(col: Column) -> Column:
    """``YYYY Mon`` | ``Mon YYYY`` | ``YYYY-MM`` → first of month; unknown month name → 01."""
    names = F.create_map(*[F.lit(x) for i, m in enumerate(MONTH_ABBREVIATIONS) for x in (m, f"{i + 1:02d}")])
    y1, n1 = F.regexp_extract(col, r"^(\d{4})\s+([A-Za-z]{3})", 1), F.regexp_extract(col, r"^(\d{4})\s+([A-Za-z]{3})", 2)
    n2, y2 = F.regexp_extract(col, r"^([A-Za-z]{3})\s+(\d{4})", 1), F.regexp_extract(col, r"^([A-Za-z]{3})\s+(\d{4})", 2)
    y3, m3 = F.regexp_extract(col, r"^(\d{4})-(\d{2})", 1), F.regexp_extract(col, r"^(\d{4})-(\d{2})", 2)
    f1 = F.when(F.length(y1) > 0, F.concat(y1, F.lit("-"), F.coalesce(names[F.lower(n1)], F.lit("01")), F.lit("-01")))
    f2 = F.when(F.length(y2) > 0, F.concat(y2, F.lit("-"), F.coalesce(names[F.lower(n2)], F.lit("01")), F.lit("-01")))
    f3 = F.when(F.length(y3) > 0, F.concat(y3, F.lit("-"), m3, F.lit("-01")))
    return F.coalesce(f1, f2, f3).try_cast("date") if hasattr(F.Column, "try_cast") else F.try_to_date(F.coalesce(f1, f2, f3))

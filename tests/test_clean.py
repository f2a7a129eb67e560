"""Cleaning rules: the reference's validator cases plus parsing helpers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from brickyard.functions import postcode as P
from brickyard.operators import clean as C

AS_OF = dt.date(2025, 6, 30)
LONDON = ["SE16 7PB", "E1 6AN", "SW1A 1AA"]


@pytest.mark.parametrize("postcode,price,date,reason", [
    ("SE16 7PB", "350000", "2024-01-15", None),
    ("SE16 7PB", "0", "2024-01-15", "invalid_price"),
    ("SE16 7PB", "200000000", "2024-01-15", "invalid_price"),
    ("SE16 7PB", "350000", "2026-06-30", "future_date"),
    ("", "350000", "2024-01-15", "null_postcode"),
    ("M1 1AA", "350000", "2024-01-15", "not_london"),
    ("  se16 7pb ", "350000", "2024-01-15", None),
    ("SE16 7PB", "12abc", "2024-01-15", None),
    ("SE16 7PB", "abc", "2024-01-15", "invalid_price"),
    ("SE16 7PB", "350000", "bad", "invalid_date"),
    ("SE16 7PB", "350000", "2010-01-01", "too_old"),
])
def test_validator_cases(spark, postcode, price, date, reason):
    raw = spark.createDataFrame([(1, postcode, price, date)], "sale_id long, postcode string, sale_price string, sale_date string")
    london = spark.createDataFrame([(p,) for p in LONDON], "postcode string")
    r = C.validate_sales(raw, london, AS_OF).first()
    assert r["reason"] == reason
    assert r["valid"] == (reason is None)


def test_reasons_cover_every_row(spark):
    from brickyard.sources import bindings as b
    d = "/root/testdata/sf0.001"
    raw = b.raw_sale(spark, d)
    v = C.validate_sales(raw, C.clean_postcodes(b.raw_postcode(spark, d)), b.sale_as_of(spark, d))
    counts = {r["reason"]: r["n"] for r in C.skip_counts(v).collect()}
    assert sum(counts.values()) == raw.count()
    assert {"valid", "null_postcode", "invalid_price", "not_london"} <= set(counts)


def test_postcode_parts(spark):
    df = spark.createDataFrame([("SE16 7PB",), ("ec1a  1bb",), ("W1",)], "pc string")
    rows = df.select(P.outcode(F.col("pc")).alias("o"), P.outcode_split(F.col("pc")).alias("s")).collect()
    assert [r["o"] for r in rows] == ["SE16", "EC1A", ""]
    assert [r["s"] for r in rows] == ["SE16", "EC1A", None]
    oc = spark.createDataFrame([("SE16",), ("EC",), ("E",), ("E1W",), ("M1",), ("EN5",), ("ECX",), ("B1",)], "o string")
    got = [r[0] for r in oc.select(P.is_london(F.col("o"))).collect()]
    assert got == [True, True, False, True, False, True, False, False]
    a = spark.createDataFrame([("SE16",), ("123",)], "o string").select(P.area(F.col("o")), P.sector_label(F.col("o")))
    assert [tuple(r) for r in a.collect()] == [("SE", "SE16"), ("123", "123")]


def test_valid_postcode_pattern(spark):
    df = spark.createDataFrame([("SE16 7PB",), ("sw1a1aa",), ("INVALID",), ("E1 6AN",)], "pc string")
    assert [r[0] for r in df.select(P.valid_postcode(F.col("pc"))).collect()] == [True, True, False, True]


def test_parse_month_and_parse_float(spark):
    df = spark.createDataFrame([("2024 Mar",), ("Mar 2024",), ("2024-03",), ("2024 Foo",), ("n/a",)], "s string")
    got = [r[0] for r in df.select(P.parse_month(F.col("s"))).collect()]
    assert got == [dt.date(2024, 3, 1)] * 3 + [dt.date(2024, 1, 1), None]
    f = spark.createDataFrame([("12abc",), (" -3.5e2x",), ("abc",), ("",)], "s string")
    assert [r[0] for r in f.select(P.js_parse_float(F.col("s"))).collect()] == [12.0, -350.0, None, None]


def test_grid_to_latlng_requires_positive(spark):
    df = spark.createDataFrame([(530000.0, 180000.0), (0.0, 180000.0)], "e double, n double")
    lat, lng = P.grid_to_latlng(F.col("e"), F.col("n"))
    rows = df.select(lat, lng).collect()
    assert rows[0][0] == pytest.approx(49.766 + 180000 / 111320, abs=1e-6)
    assert rows[1][0] is None and rows[1][1] is None


def test_dedupe_keeps_earliest(spark):
    raw = spark.createDataFrame([
        (1, "E1 6AN", "1", "", "A ST", "2020-01-02", "100"),
        (2, "e1 6an ", "1", "", "A ST", "2020-01-01", "300"),
        (3, "E1 6AN", "2", "", "A ST", "2020-01-05", "100")],
        "sale_id long, postcode string, paon string, saon string, street string, sale_date string, sale_price string")
    got = {r["address_key"]: r["sale_id"] for r in C.dedupe_properties(raw).collect()}
    assert got == {"E1 6AN|1||A ST": 2, "E1 6AN|2||A ST": 3}


def test_assign_ids_dense_and_ordered(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "k string")
    got = {r["k"]: r["id"] for r in C.assign_ids(df, "k").collect()}
    assert got == {"a": 1, "b": 2, "c": 3}

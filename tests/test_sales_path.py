"""The sales feed: real ids, sales sent again, series without overflow, stale state, plan shapes."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from brickyard.functions.exact import cents  # noqa: F401  (the module must import alone)
from brickyard.operators import clean as C
from brickyard.operators import metrics as M
from brickyard.operators import series
from brickyard.sources import bindings as b
from brickyard.sources.readers import PPD_COLUMNS, to_csv_line
from brickyard.streaming import intake as S

SF = "/root/testdata/sf0.001"
GUID = "{5A8B2C1D-0E3F-4A5B-8C7D-9E0F1A2B3C4D}"


def feed(spark, rows):
    """(txn_uid, price, date, postcode) rows with all columns of the feed."""
    df = spark.createDataFrame(rows, "txn_uid string, sale_price string, sale_date string, postcode string")
    return df.select(*[F.col(c) if c in df.columns else F.lit("").alias(c) for c in PPD_COLUMNS])


def land(df, path):
    df.select(to_csv_line(df, PPD_COLUMNS).alias("value")).coalesce(1).write.mode("append").text(path)


def test_stream_takes_guid_ids_and_ignores_sales_sent_again(spark):
    london = spark.createDataFrame([("SE16 7PB",)], "postcode string")
    root, as_of = S.work_dir(spark, "test-sales"), dt.date(2024, 6, 30)
    land(feed(spark, [(GUID, "250000", "2024-03-01", "se16 7pb"), ("", "1", "2024-03-01", "SE16 7PB"), ("{X-1}", "0", "2024-03-01", "SE16 7PB"),
                      ("{A-1}", "9", "2024-03-01", "SE16 7PB"), ("{B-1}", "8", "2024-03-01", "SE16 7PB")]), f"{root}/in")
    first = S.stream_sales(spark, f"{root}/in", london, as_of, f"{root}/store", f"{root}/ck")
    assert sorted(r["txn_uid"] for r in first.collect()) == ["{5A8B2C1D-0E3F-4A5B-8C7D-9E0F1A2B3C4D}", "{A-1}", "{B-1}"]
    land(feed(spark, [(GUID, "1", "2023-01-01", "SE16 7PB"), ("{C-2}", "5", "2024-05-01", "SE16 7PB"), ("{C-2}", "4", "2024-05-02", "SE16 7PB")]), f"{root}/in")
    after = {r["txn_uid"]: (float(r["sale_price"]), r["sale_date"]) for r in S.stream_sales(spark, f"{root}/in", london, as_of, f"{root}/store", f"{root}/ck").collect()}
    assert after[GUID] == (250000.0, dt.date(2024, 3, 1)) and after["{C-2}"] == (5.0, dt.date(2024, 5, 1)) and len(after) == 4


def test_a_backlog_of_many_files_takes_few_batches_and_the_first_file_wins(spark):
    london = spark.createDataFrame([("SE16 7PB",)], "postcode string")
    root, as_of = S.work_dir(spark, "test-backlog"), dt.date(2024, 6, 30)
    land(feed(spark, [(GUID, "250000", "2024-03-01", "SE16 7PB")]), f"{root}/in")
    land(feed(spark, [(GUID, "1", "2023-01-01", "SE16 7PB")]), f"{root}/in")
    rows = feed(spark, [(f"{{F-{i}}}", "5", "2024-05-01", "SE16 7PB") for i in range(22)])
    rows.select(to_csv_line(rows, PPD_COLUMNS).alias("value")).repartition(22).write.mode("append").text(f"{root}/in")
    got = {r["txn_uid"]: r["sale_date"] for r in S.stream_sales(spark, f"{root}/in", london, as_of, f"{root}/store", f"{root}/ck").collect()}
    assert got[GUID] == dt.date(2024, 3, 1) and len(got) == 23
    assert len([f for f in os.listdir(f"{root.removeprefix('file:')}/ck/commits") if f.isdigit()]) <= S.SALE_BATCHES


def test_two_months_of_events_are_all_counted(spark):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), "view") for i in range(60)]
    root = S.work_dir(spark, "test-crime")
    ev = spark.createDataFrame([(u % 7, t, k) for u, t, k in rows], "user_id long, ts timestamp_ntz, event_type string")
    for lo in range(0, 60, 12):
        ev.where((F.col("ts") >= F.lit(rows[lo][1])) & (F.col("ts") <= F.lit(rows[lo + 11][1]))).write.mode("append").parquet(f"{root}/in")
    got = S.stream_crime_counts(spark, f"{root}/in", "user_id long, ts timestamp_ntz, event_type string", f"{root}/store", f"{root}/ck", watermark="13 days")
    assert got.agg(F.sum("count")).first()[0] == 60


def test_series_of_any_size_do_not_overflow(spark):
    one = 9 * 10 ** 17
    s = spark.createDataFrame([("a", dt.date(2024, 1, 5), one + i) for i in range(30)], "outcode string, sale_date date, price_cents long")
    r = series.month_sums(s, ["outcode"]).collect()[0]
    assert int(r["_s"]) == sum(one + i for i in range(30)) and r["n"] == 30
    t = s.withColumn("price_cents", F.lit(5 * 10 ** 13)).withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(50))))
    assert series.monthly_totals(t, ["outcode"]).collect()[0]["avg_micro"] == 5 * 10 ** 17


def test_drilldown_of_one_outcode_has_four_levels(spark):
    s = b.sale(spark, SF)
    got = series.drilldown(s, b.sale_as_of(spark, SF), outcode="nation_3")
    levels = {r["geo_level"]: r["n"] for r in got.groupBy("geo_level").agg(F.countDistinct("geo_value").alias("n")).collect()}
    assert set(levels) == {"postcode_sector", "outcode", "area", "region"} and levels["outcode"] == levels["area"] == 1


def test_ids_are_dense_for_keys_with_a_common_prefix(spark):
    keys = spark.range(5000).select(F.concat(F.lit("SAME PREFIX "), F.lpad(F.col("id").cast("string"), 6, "0")).alias("k"))
    got = C.assign_ids(keys, "k").orderBy("k").collect()
    assert [r["id"] for r in got] == list(range(1, 5001))


def test_new_data_are_seen(spark, tmp_path):
    d = str(tmp_path)
    o = spark.createDataFrame([(1, dt.datetime(2024, 1, 5))], "o_orderkey long, o_orderdate timestamp")
    o.write.parquet(f"{d}/orders.parquet")
    assert b.sale_as_of(spark, d) == dt.date(2024, 1, 5)
    spark.createDataFrame([(2, dt.datetime(2024, 2, 9))], "o_orderkey long, o_orderdate timestamp").write.mode("append").parquet(f"{d}/orders.parquet")
    assert b.sale_as_of(spark, d) == dt.date(2024, 2, 9)


def test_five_outcodes_and_bad_postcodes_are_refused(spark):
    with pytest.raises(ValueError, match="between 1 and 4"):
        M.compare(spark.createDataFrame([], "outcode string"), ["SE16", "E1", "SW1", "N1", "W1"])
    ok = ("SE16 7PB", 2, 70, 400000, 180000, 25, 1, "FLAT")
    req = spark.createDataFrame([(1, *ok), (2, "INVALID", *ok[1:]), (3, *ok[:-1], "CASTLE"), (4, None, *ok[1:])],
                                "request_id long, postcode string, bedrooms int, floor_area_sqm int, asking_price int, rent_cents int, deposit_pct int, mortgage_product_id int, property_type string")
    assert {r["request_id"]: r["failed_rules"] for r in C.validate_requests(req).collect()} == {1: "", 2: "postcode", 3: "property_type", 4: "postcode"}


@pytest.mark.parametrize("name", ["load_sales", "dq_checks"])
def test_the_feed_is_scanned_once_or_reused(spark, name):
    import __spark_entry__ as E
    plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    limit = {"load_sales": 2, "dq_checks": 3}[name]  # with the feed of the index and, where ids are given, of the property rows
    assert plan.count("o_orderkey") and sum("o_totalprice" in line and "Relation" in line for line in plan.splitlines()) <= limit

"""What a load must not do twice or in one task, and that the cheaper forms give the same values."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from brickyard.functions.exact import cents
from brickyard.functions.postcode import js_parse_float, outcode_split
from brickyard.operators import clean as C
from brickyard.operators.ranking import percentile_cont
from brickyard.plans import catalog  # noqa: F401  (registers the queries used by the load)
from brickyard.plans import load as L
from brickyard.sources import bindings as b

DAY = dt.datetime(2001, 1, 1)


@pytest.fixture(scope="module")
def feeds(spark):
    """A folder with orders and customers only."""
    d = tempfile.mkdtemp(prefix="brickyard-feeds-")
    orders = [(k, k % 50, 1000.0 + k, DAY + dt.timedelta(days=k)) for k in range(400)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp").write.parquet(f"{d}/orders.parquet")
    spark.range(50).withColumnRenamed("id", "c_custkey").coalesce(1).write.parquet(f"{d}/customer.parquet")
    return d


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize(("text", "want"), [("E1 1AA", "E1"), ("  ec2a   4bx ", "EC2A"), ("E11AA", None), ("", None), ("   ", None), (None, None), ("n1\t9gu", "N1"),
                                           ("\tN1 9GU", ""), ("SW1A\n", "SW1A"), ("w1\r\n1aa", "W1"), ("a\x0bb", "A"), ("a\fb", "A"), ("E1 1 AA", "E1"), ("E1 1AA", None)])
def test_outcode_at_ingest(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(outcode_split(F.col("t")).alias("o")).first().o == want


@pytest.mark.parametrize(("text", "want"), [("12", 12.0), (" 12.50abc", 12.5), (".5", 0.5), ("5.", 5.0), ("-3e2x", -300.0), ("+7", 7.0), ("1.2.3", 1.2), ("abc", None),
                                           ("", None), (" ", None), (None, None), ("e5", None), (".", None), ("Infinity", None), ("NaN", None), ("1e", 1.0)])
def test_leading_number(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(js_parse_float(F.col("t")).alias("x")).first().x == want


def test_a_number_is_searched_once(spark):
    df = spark.range(1).select(F.col("id").cast("string").alias("t"))
    assert plan(df.select(js_parse_float(F.col("t")).alias("x"))).count("regexp_extract") == 1


def test_postcodes_are_cleaned_with_one_pattern_and_in_many_tasks(spark, feeds):
    raw = spark.createDataFrame([(1, "E1 1AA", "", "", "", "x"), (2, "E11AA", "", "", "", "x"), (3, "E1 1AA", "202001", "", "", "x"), (4, "M1 1AA", None, "", "", "x"),
                                 (5, None, "", "", "", "x"), (6, "ec1 2bb", None, "", "", "x")], "pc_id int, pcds string, doterm string, oseast1m string, osnrth1m string, lsoa11 string")
    clean = C.clean_postcodes(raw)
    assert {(r.pc_id, r.postcode, r.outcode) for r in clean.collect()} == {(1, "E1 1AA", "E1"), (6, "EC1 2BB", "EC1")}
    assert "regexp_replace" not in plan(clean) and "split(" not in plan(clean)
    made = b.raw_postcode(spark, feeds)
    assert "RepartitionByExpression" in plan(made) and made.count() == 50


def test_id_of_a_sale_has_the_digits_of_its_hash_in_groups(spark, feeds):
    import hashlib
    got = {r.sale_id: r.txn_uid for r in b.raw_sale(spark, feeds).collect()}
    for k, uid in got.items():
        h = hashlib.md5(str(k).encode()).hexdigest().upper()
        assert uid == f"{{{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}}}"


def test_index_of_a_load_reads_the_written_sales(spark, feeds):
    out = f"{tempfile.mkdtemp(prefix='brickyard-sale-')}/sale"
    sales = [("E1", (DAY + dt.timedelta(days=k)).date(), 100 * k) for k in range(400)]
    spark.createDataFrame(sales, "outcode string, sale_date date, price_cents long").write.parquet(out)
    step = next(s for s in L.STEPS if s.name == "hpi_index")
    made = step.make(spark, feeds, {"sale": spark.read.parquet(out)})
    assert made.inputFiles() and all(out in f for f in made.inputFiles())
    first = made.orderBy("reference_month").first()
    assert (first.outcode, first.reference_month, first.avg_cents) == ("E1", DAY.date(), 1500)


def test_properties_come_from_one_pass_over_the_checked_sales(spark, feeds):
    out = f"{tempfile.mkdtemp(prefix='brickyard-checked-')}/checked_sale"
    b.raw_sale(spark, feeds).withColumn("reason", F.when(F.col("sale_id") % 2 == 0, "too_old")).write.parquet(out)
    step = next(s for s in L.STEPS if s.name == "property")
    made = step.make(spark, feeds, {"checked_sale": spark.read.parquet(out)})
    assert not [f for f in made.inputFiles() if out in f]
    rows = made.collect()
    assert sorted(r.property_id for r in rows) == list(range(1, len(rows) + 1))
    assert [r.address_key for r in sorted(rows, key=lambda r: r.property_id)] == sorted(r.address_key for r in rows)
    valid = spark.read.parquet(out).where("reason is null")
    assert {r.address_key for r in rows} == {r.k for r in valid.select(C.address_key(valid).alias("k")).collect()}


def test_only_buckets_with_an_asked_rank_are_sorted(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 2999).cast("decimal(12,2)").alias("v"))
    got = percentile_cont(df, ["k"], "v", {"lo": "0.25", "mid": "0.5"}, count_as="n")
    tree = plan(got)
    assert tree.index("AS _lc") < tree.index("size(filter(")  # a parent comes before its children
    for r in got.collect():
        vs = sorted(i * 7 % 2999 for i in range(3000) if i % 3 == r.k)
        at = lambda p: vs[int(999 * p)] + (999 * p - int(999 * p)) * (vs[int(999 * p) + 1] - vs[int(999 * p)])
        assert (r.n, r.lo, r.mid) == (1000, at(0.25), at(0.5))


@pytest.mark.parametrize(("x", "want"), [(1.005, 101), (0.1 + 0.2, 30), (-2.345, -235), (99999999.99, 9999999999), (None, None)])
def test_cents_round_half_up_once(spark, x, want):
    assert spark.createDataFrame([(x,)], "x double").select(cents(F.col("x")).alias("c")).first().c == want

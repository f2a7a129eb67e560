"""Logical relations of the property model, built from the landed tables.

The driver's test tables stand in for the property feeds (see FIXTURES.md B):

* ``sale``        orders ⋈ customer ⋈ nation ⋈ region
* ``asset_sale``  lineitem ⋈ part ⋈ supplier ⋈ nation (comparables)
* ``hpi_index``   monthly mean of ``sale`` per outcode, complete months only
  (the newest one too, if the feed reaches its last day)
* ``rental_index`` weighted unit price per region and month
* ``location``    event users × nation, 1–3 postcodes per user (many-to-many)
* ``crime_stat``  event counts per (user, day, type)
* ``mortgage_product`` / ``request`` from supplier / customer

All money is also carried as integer cents (``*_cents``) for exact sums.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exact import cents, half_up_int
from ..functions.postcode import LONDON_OUTCODE_PREFIXES
from .tables import per_session, read, remember, scalar

# The property-type domain used for requests (the p_type values of
# the part table, alphabetical) and the mortgage types of the reference schema.
REQUEST_PROPERTY_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
MORTGAGE_TYPES = ["REPAYMENT", "INTEREST_ONLY"]


def nation_region(spark: SparkSession, d: str) -> DataFrame:
    n = read(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    r = read(spark, d, "region", ["r_regionkey", "r_name"])
    return n.join(r, n.n_regionkey == r.r_regionkey).drop("r_regionkey")


@per_session
def sale(spark: SparkSession, d: str) -> DataFrame:
    o = read(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])
    c = read(spark, d, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    nr = nation_region(spark, d)
    j = o.join(c, o.o_custkey == c.c_custkey).join(nr, F.col("c_nationkey") == F.col("n_nationkey"))
    price = F.col("o_totalprice").cast("decimal(14,2)")  # of both columns, as most of a row's time goes into it
    return j.select(
        F.col("o_orderkey").alias("sale_id"),
        F.concat_ws("/", "n_name", "c_mktsegment").alias("sector"),
        F.col("n_name").alias("outcode"),
        F.col("r_name").alias("area"),
        F.lit("ALL").alias("region"),
        price.cast("decimal(12,2)").alias("sale_price"),
        cents(price).alias("price_cents"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        F.col("o_orderpriority").alias("category"),
    )


@per_session
def asset_sale(spark: SparkSession, d: str) -> DataFrame:
    li = read(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                                     "l_extendedprice", "l_shipdate"])
    p = read(spark, d, "part", ["p_partkey", "p_type", "p_size"])
    s = read(spark, d, "supplier", ["s_suppkey", "s_name", "s_nationkey"])
    n = read(spark, d, "nation", ["n_nationkey", "n_name"])
    j = (li.join(p, li.l_partkey == p.p_partkey)
           .join(s, li.l_suppkey == s.s_suppkey)
           .join(n, F.col("s_nationkey") == F.col("n_nationkey")))
    return j.select(
        "l_orderkey", "l_linenumber",
        F.col("p_partkey").alias("property_id"),
        F.col("p_type").alias("property_type"),
        (F.col("p_size") % 5 + 1).cast("long").alias("bedrooms"),
        F.when(F.col("p_partkey") % 10 == 0, F.lit(None).cast("long"))
         .otherwise(10 + 2 * F.col("p_size")).cast("long").alias("floor_area_sqm"),
        F.col("n_name").alias("outcode"),
        F.col("s_name").alias("postcode"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("sale_price"),
        cents(F.col("l_extendedprice")).alias("price_cents"),
        F.col("l_shipdate").cast("date").alias("sale_date"),
    )


@per_session
def hpi_index(spark: SparkSession, d: str) -> DataFrame:
    """outcode, reference_month, average_price, index_value, annual_pct_change.

    ``avg_cents`` / ``apc_centi`` carry the exact integer forms.
    """
    return hpi_of(sale(spark, d), sale_as_of(spark, d))


def hpi_of(sales: DataFrame, as_of: dt.date | None) -> DataFrame:
    """The index of ``sales`` (outcode, sale_date, price_cents), whose latest date is ``as_of``."""
    s = sales.select("outcode", F.trunc("sale_date", "MM").alias("reference_month"), "price_cents")
    monthly = s.groupBy("outcode", "reference_month").agg(
        F.sum("price_cents").alias("_s"), F.count(F.lit(1)).alias("_n"))
    # the newest month counts only once the feed has reached its last day
    last = as_of + dt.timedelta(days=1) if as_of else None
    complete = monthly.where(F.col("reference_month") < F.trunc(F.lit(last).cast("date"), "MM"))
    w = Window.partitionBy("outcode").orderBy("reference_month")
    x = (complete.withColumn("avg_cents", half_up_int(F.col("_s"), F.col("_n")))
         .withColumn("_first", F.first("avg_cents").over(w.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("_lag", F.lag("avg_cents", 12).over(w)))
    apc = F.when(F.col("_lag") > 0, half_up_int((F.col("avg_cents") - F.col("_lag")) * 10000, F.col("_lag")))
    return x.select(
        "outcode", "reference_month",
        (F.col("avg_cents").cast("double") / 100.0).alias("average_price"),
        (half_up_int(F.col("avg_cents") * 10000, F.col("_first")).cast("double") / 100.0).alias("index_value"),
        (apc.cast("double") / 100.0).alias("annual_pct_change"),
        "avg_cents", apc.alias("apc_centi"),
    )


@per_session
def rental_index(spark: SparkSession, d: str) -> DataFrame:
    """region, reference_month, index_value (= Σprice / Σquantity / 10)."""
    li = read(spark, d, "lineitem", ["l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"])
    s = read(spark, d, "supplier", ["s_suppkey", "s_nationkey"])
    nr = nation_region(spark, d)
    j = li.join(s, li.l_suppkey == s.s_suppkey).join(nr, F.col("s_nationkey") == F.col("n_nationkey"))
    g = j.groupBy(F.col("r_name").alias("region"), F.trunc(F.col("l_shipdate").cast("date"), "MM").alias("reference_month")).agg(
        F.sum(cents(F.col("l_extendedprice"))).alias("_c"), F.sum(F.col("l_quantity").cast("long")).alias("_q"))
    centi = half_up_int(F.col("_c"), F.col("_q") * 10)
    return g.select("region", "reference_month", (centi.cast("double") / 100.0).alias("index_value"),
                    centi.alias("index_centi"))


@per_session
def location(spark: SparkSession, d: str) -> DataFrame:
    """postcode, outcode, borough, region, lsoa_code (1..3 postcodes per lsoa)."""
    users = read(spark, d, "events", ["user_id"]).distinct()
    nr = nation_region(spark, d)
    x = users.select("user_id", F.explode(F.sequence(F.lit(0), (F.col("user_id") % 3).cast("int"))).alias("k"))
    x = x.join(nr, (F.col("user_id") % 25) == F.col("n_nationkey"))
    return x.select(
        F.concat_ws("-", F.col("user_id").cast("string"), F.col("k").cast("string")).alias("postcode"),
        F.col("n_name").alias("outcode"),
        F.col("r_name").alias("borough"),
        F.lit("London").alias("region"),
        F.col("user_id").alias("lsoa_code"),
    )


@per_session
def crime_stat(spark: SparkSession, d: str) -> DataFrame:
    """lsoa_code, reference_period (day), category, count."""
    e = read(spark, d, "events", ["user_id", "ts", "event_type"])
    return e.groupBy(F.col("user_id").alias("lsoa_code"), F.col("ts").cast("date").alias("reference_period"),
                     F.col("event_type").alias("category")).agg(F.count(F.lit(1)).alias("count"))


@per_session
def mortgage_product(spark: SparkSession, d: str) -> DataFrame:
    s = read(spark, d, "supplier", ["s_suppkey", "s_name"])
    k = F.col("s_suppkey")
    tenths = F.when(k % 50 == 0, F.lit(0)).otherwise(30 + k % 40).cast("long")
    return s.select(
        k.alias("mortgage_product_id"),
        F.col("s_name").alias("lender"),
        F.concat(F.lit("Product "), k.cast("string")).alias("product_name"),
        F.when(k % 2 == 0, F.lit(MORTGAGE_TYPES[0])).otherwise(F.lit(MORTGAGE_TYPES[1])).alias("mortgage_type"),
        (60 + 5 * (k % 5)).cast("long").alias("max_ltv_pct"),
        (tenths.cast("decimal(5,3)") / 10).cast("decimal(5,3)").alias("initial_rate_pct"),
        tenths.alias("rate_tenths"),
        ((k % 4) * 500).cast("long").alias("product_fee_gbp"),
        (24 + 12 * (k % 4)).cast("long").alias("initial_period_months"),
        ((70 + k % 30).cast("decimal(5,3)") / 10).cast("decimal(5,3)").alias("follow_on_rate_pct"),
        F.date_add(F.lit("2024-01-01").cast("date"), (k % 365).cast("int")).alias("captured_at"),
        F.when(k % 7 != 0, F.concat(F.lit("https://lender.example/"), k.cast("string"))).alias("source_url"),
    )


@per_session
def request(spark: SparkSession, d: str) -> DataFrame:
    """One investor request per customer (composite score / comparables)."""
    c = read(spark, d, "customer", ["c_custkey", "c_nationkey"])
    n = read(spark, d, "nation", ["n_nationkey", "n_name"])
    nsup = scalar(read(spark, d, "supplier", ["s_suppkey"]).agg(F.count(F.lit(1)).alias("n")), "n")
    k = F.col("c_custkey")
    asking = (50000 + 100 * k).cast("long")
    types = F.array(*[F.lit(t) for t in REQUEST_PROPERTY_TYPES])
    x = c.join(n, c.c_nationkey == n.n_nationkey)
    return x.select(
        k.alias("request_id"),
        F.col("n_name").alias("outcode"),
        asking.alias("asking_price"),
        half_up_int(asking * (4 + k % 5) * 100, F.lit(1200)).alias("rent_cents"),
        (5 + k % 46).cast("long").alias("deposit_pct"),
        (k % F.lit(nsup)).alias("mortgage_product_id"),
        (k % 5 + 1).cast("long").alias("bedrooms"),
        F.element_at(types, (k % len(REQUEST_PROPERTY_TYPES) + 1).cast("int")).alias("property_type"),
        (12 + 2 * (k % 50)).cast("long").alias("floor_area_sqm"),
        # what a form would send: a postcode (every ninth malformed) and one of the stored types (every eleventh unknown)
        F.when(k % 9 == 0, F.lit("INVALID")).otherwise(_raw_postcode_expr(k)).alias("postcode"),
        F.when(k % 11 == 0, F.lit("CASTLE")).otherwise(
            F.element_at(F.array(*[F.lit(t) for t in ("DETACHED", "SEMI_DETACHED", "TERRACED", "FLAT", "OTHER")]), (k % 5 + 1).cast("int"))).alias("form_type"),
    )


def _latest(spark: SparkSession, d: str, table: str, col: str) -> dt.date:
    """MAX(date) of one column: a single-column scan, repeated when the folder's data change."""
    return remember(spark, d, ("latest", table, col),
                    lambda: read(spark, d, table, [col]).agg(F.max(F.col(col).cast("date")).alias("m")).first()["m"])


def sale_as_of(spark: SparkSession, d: str) -> dt.date:
    """Latest sale date of the feed (the ``as_of`` of sale-based queries)."""
    return _latest(spark, d, "orders", "o_orderdate")


def asset_as_of(spark: SparkSession, d: str) -> dt.date:
    return _latest(spark, d, "lineitem", "l_shipdate")


def crime_as_of(spark: SparkSession, d: str) -> dt.date:
    return _latest(spark, d, "events", "ts")


# Generated postcodes: the London prefixes, followed by three from elsewhere.
RAW_PREFIXES = [*LONDON_OUTCODE_PREFIXES, "M", "B", "LS"]


def _raw_postcode_expr(k: F.Column) -> F.Column:
    prefixes = F.array(*[F.lit(p) for p in RAW_PREFIXES])
    pre = F.element_at(prefixes, (k % len(RAW_PREFIXES) + 1).cast("int"))
    letters = F.concat(F.substring(F.lit("ABCDEFGHJKLMNPQRSTUWXYZ"), (k % 23 + 1).cast("int"), 1),
                       F.substring(F.lit("ABDEFGHJLNPQRSTUWXYZ"), ((k / 23).cast("long") % 20 + 1).cast("int"), 1))
    return F.concat(pre, (k % 10).cast("string"), F.lit(" "), ((k / 10).cast("long") % 10).cast("string"), letters)


@per_session
def raw_postcode(spark: SparkSession, d: str) -> DataFrame:
    """Postcode-directory rows as text: pcds, doterm, oseast1m, osnrth1m, lsoa11."""
    # a few bytes a row in the file, so that one task would make and clean the text of millions
    c = read(spark, d, "customer", ["c_custkey"]).repartition("c_custkey")
    k = F.col("c_custkey")
    return c.select(
        k.alias("pc_id"),
        _raw_postcode_expr(k).alias("pcds"),
        F.when(k % 11 == 0, F.lit("202001")).otherwise(F.lit("")).alias("doterm"),
        F.when(k % 13 == 0, F.lit("")).otherwise((500000 + (k % 1000) * 10).cast("string")).alias("oseast1m"),
        F.when(k % 13 == 0, F.lit("")).otherwise((170000 + (k % 997) * 10).cast("string")).alias("osnrth1m"),
        F.concat(F.lit("E0100"), F.lpad((k % 500).cast("string"), 4, "0")).alias("lsoa11"),
    )


@per_session
def raw_sale(spark: SparkSession, d: str) -> DataFrame:
    """Price-paid rows as untyped text with injected faults (see FIXTURES B)."""
    o = read(spark, d, "orders", ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"])
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    pc = _raw_postcode_expr(ck)
    postcode = (F.when(k % 83 == 0, F.lit("  "))
                 .when(k % 7 == 0, F.concat(F.lit("ZZ"), (k % 10).cast("string"), F.lit(" 1AA")))
                 .when(k % 5 == 0, F.concat(F.lit(" "), F.lower(pc), F.lit(" ")))
                 .otherwise(pc))
    digits = F.upper(F.md5(k.cast("string").cast("binary")))
    groups = [x for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)) for x in (F.lit("-"), F.substring(digits, at, n))]
    return o.select(
        k.alias("sale_id"),
        # ids as the feed has them: braced GUIDs
        F.concat(F.lit("{"), *groups[1:], F.lit("}")).alias("txn_uid"),
        F.when(k % 97 == 0, F.lit("0")).when(k % 89 == 0, F.lit("abc"))
         .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string")).alias("sale_price"),
        F.when(k % 79 == 0, F.lit("2999-01-01")).when(k % 73 == 0, F.lit("bad"))
         .otherwise(F.date_format(F.col("o_orderdate"), "yyyy-MM-dd")).alias("sale_date"),
        postcode.alias("postcode"),
        F.substring(F.lit("DSTFOX"), (k % 6 + 1).cast("int"), 1).alias("property_type"),
        F.when(k % 3 == 0, F.lit("F")).when(k % 3 == 1, F.lit("L")).otherwise(F.lit("U")).alias("tenure"),
        (ck % 50 + 1).cast("string").alias("paon"),
        F.when(k % 4 == 0, F.concat(F.lit("FLAT "), (k % 9 + 1).cast("string"))).otherwise(F.lit("")).alias("saon"),
        F.concat(F.lit("STREET "), (ck % 7).cast("string")).alias("street"),
        F.lit("LONDON").alias("town"),
        F.when(k % 2 == 0, F.lit("A")).otherwise(F.lit("B")).alias("ppd_category"),
    )

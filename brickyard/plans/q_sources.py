"""Registered queries: feed readers over text/JSON staged from the given tables (step 5, S*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.report import gap_fill
from ..sources import bindings as b
from ..sources import readers as RD
from ..sources.tables import read
from ..streaming.intake import work_dir
from .oracle_bindings import register, with_
from .registry import query

_PC_COLS = ["pc_id", "pcds", "doterm", "oseast1m", "osnrth1m", "lsoa11"]


@query("src_postcodes", with_("raw_postcode") + "SELECT * FROM raw_postcode")
def q_src_postcodes(spark, d):
    r = b.raw_postcode(spark, d).withColumn("pc_id", F.col("pc_id").cast("string"))
    header_line = ",".join(f'"{c.upper()}"' for c in _PC_COLS)
    root = work_dir(spark, "postcodes")
    r.select(RD.to_csv_line(r, _PC_COLS).alias("line")).write.text(f"{root}/data")
    spark.createDataFrame([(header_line,)], "line string").coalesce(1).write.text(f"{root}/header")
    out = RD.read_csv_with_header_file(spark, f"{root}/data", f"{root}/header")
    return out.select(F.col("PC_ID").cast("long").alias("pc_id"), *[F.col(c.upper()).alias(c) for c in _PC_COLS[1:]])


_PPD_KEEP = ["txn_uid", "sale_price", "sale_date", "postcode", "property_type", "tenure", "paon", "saon", "street",
             "town", "ppd_category"]


@query("src_ppd", with_("raw_sale") + "SELECT " + ", ".join(_PPD_KEEP) + " FROM raw_sale")
def q_src_ppd(spark, d):
    r = b.raw_sale(spark, d).select(*_PPD_KEEP, F.lit("N").alias("new_build"), F.lit("").alias("locality"),
                                    F.lit("").alias("district"), F.lit("GREATER LONDON").alias("county"),
                                    F.lit("A").alias("record_status"))
    path = work_dir(spark, "price-paid")
    r.select(RD.to_csv_line(r, RD.PPD_COLUMNS).alias("line")).write.text(path)
    return RD.read_ppd(spark, path).select(*_PPD_KEEP)


def hpi_docs(spark, d):
    """One JSON document per (outcode, year), months alternating string / {"@value"} forms."""
    h = b.hpi_index(spark, d)
    ym = F.date_format("reference_month", "yyyy-MM")
    month_json = F.when(F.month("reference_month") % 2 == 0, F.to_json(F.struct(ym.alias("@value")))) \
                  .otherwise(F.concat(F.lit('"'), ym, F.lit('"')))
    nums = F.to_json(F.struct(F.col("average_price").alias("ukhpi:averagePrice"),
                              F.col("index_value").alias("ukhpi:housePriceIndex"),
                              F.col("annual_pct_change").alias("ukhpi:percentageAnnualChange")))
    item = F.concat(F.lit('{"ukhpi:refMonth":'), month_json, F.lit(","), F.substring(nums, F.lit(2), F.length(nums)))
    it = h.select("outcode", F.year("reference_month").alias("y"), item.alias("item"))
    junk = it.select("outcode", "y", F.lit('{"ukhpi:averagePrice": 1}').alias("item")).distinct()
    docs = it.unionByName(junk).groupBy("outcode", "y").agg(
        F.concat(F.lit('{"result":{"items":['), F.concat_ws(",", F.collect_list("item")), F.lit("]}}")).alias("doc"))
    return docs


@query("src_hpi_json", with_("hpi_index") +
       "SELECT outcode, reference_month, average_price, index_value, annual_pct_change FROM hpi_index")
def q_src_hpi_json(spark, d):
    return RD.read_hpi_json(hpi_docs(spark, d), "doc", "outcode")


def _epc_docs(spark, d):
    p = read(spark, d, "part", ["p_partkey", "p_size"])
    k = F.col("p_partkey")
    row = F.to_json(F.struct(
        F.when(k % 7 != 0, k.cast("string")).alias("uprn"),
        F.concat((F.col("p_size") % 5 + 1).cast("string"), F.when(k % 2 == 0, F.lit(" rooms")).otherwise(F.lit("")))
         .alias("number-habitable-rooms"),
        F.concat((10 + 2 * F.col("p_size")).cast("string"), F.when(k % 3 == 0, F.lit(".5 sqm")).otherwise(F.lit("")))
         .alias("total-floor-area"),
        F.substring(F.lit("ABCDEFG"), (k % 7 + 1).cast("int"), 1).alias("current-energy-rating"),
        F.when(k % 11 == 0, F.lit("n/a")).otherwise((F.col("p_size") * 2).cast("string")).alias("current-energy-efficiency"),
        F.lit("1900-1929").alias("construction-age-band")))
    return p.groupBy((k / 20).cast("long").alias("doc_id")).agg(
        F.concat(F.lit('{"rows":['), F.concat_ws(",", F.collect_list(row)), F.lit("]}")).alias("doc"))


@query("src_epc", """
SELECT p_partkey AS uprn, CAST(p_size % 5 + 1 AS BIGINT) AS bedrooms,
       CAST(10 + 2 * p_size AS DOUBLE) + CASE WHEN p_partkey % 3 = 0 THEN 0.5 ELSE 0.0 END AS floor_area_sqm,
       substring('ABCDEFG', CAST(p_partkey % 7 + 1 AS INTEGER), 1) AS epc_rating,
       CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(p_size * 2 AS BIGINT) END AS epc_score,
       '1900-1929' AS construction_age_band
FROM part WHERE p_partkey % 7 <> 0""")
def q_src_epc(spark, d):
    return RD.read_epc(_epc_docs(spark, d), "doc")


@query("incident_counts", """
SELECT CAST(ts AS DATE) AS reference_period, CASE WHEN value < 1 THEN 'other' ELSE event_type END AS category, COUNT(*) AS n
FROM events GROUP BY ALL""")
def q_incident_counts(spark, d):
    e = read(spark, d, "events", ["ts", "user_id", "event_type", "value"])
    inc = F.to_json(F.struct(F.when(F.col("value") < 1, F.lit("")).otherwise(F.col("event_type")).alias("category")))
    # one answer of the service per user, minute and day: documents of a few incidents, whatever the volume
    docs = e.groupBy(F.col("ts").cast("date").alias("reference_period"), "user_id", F.date_trunc("minute", F.col("ts").cast("timestamp_ltz")).alias("m")).agg(
        F.concat(F.lit("["), F.concat_ws(",", F.collect_list(inc)), F.lit("]")).alias("doc"))
    return RD.count_incidents(docs, "doc", ["reference_period"])


@query("geo_features", """
SELECT n.n_regionkey AS region_key, n.n_name AS name,
       CASE WHEN n.n_regionkey = 0 THEN 'Point' ELSE 'Polygon' END AS geometry_type,
       CASE WHEN n.n_regionkey = 0 THEN 'centroid' ELSE 'geojson' END AS source
FROM nation n""")
def q_geo_features(spark, d):
    n = read(spark, d, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    k = F.col("n_nationkey").cast("double")
    ring = F.array(*[F.array(k + dx, F.lit(51.0) + dy) for dx, dy in ((0, 0), (0.5, 0), (0.5, 0.5), (0, 0.5), (0, 0))])
    feat = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.col("n_name").alias("name")).alias("properties"),
                              F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry")))
    docs = n.groupBy(F.col("n_regionkey").alias("region_key")).agg(
        F.concat(F.lit('{"type":"'), F.when(F.col("region_key") == 0, F.lit("Feature")).otherwise(F.lit("FeatureCollection")),
                 F.lit('","features":['), F.concat_ws(",", F.collect_list(feat)), F.lit("]}")).alias("doc"))
    cent = n.select(F.col("n_regionkey").alias("region_key"), F.col("n_name").alias("name"))
    return RD.read_features(docs, "doc", "region_key", cent, min_features=5)


# The region names of the region table (a fixed TPC-H domain), in order.
WIDE_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
WIDE_KEEP = "europe|asia|america"


def wide_lines(spark, d):
    r = b.rental_index(spark, d)
    p = r.groupBy("reference_month").pivot("region", WIDE_REGIONS).agg(F.first("index_value"))
    mi = F.year("reference_month") * 12 + F.month("reference_month")
    y, mon = F.date_format("reference_month", "yyyy"), F.date_format("reference_month", "MMM")
    label = F.when(mi % 3 == 0, F.concat(y, F.lit(" "), mon)).when(mi % 3 == 1, F.concat(mon, F.lit(" "), y)) \
             .otherwise(F.date_format("reference_month", "yyyy-MM"))
    vals = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in WIDE_REGIONS]
    data = p.select((F.lit(10) + mi).cast("long").alias("line_no"), F.concat_ws(",", label, *vals).alias("line"))
    pre = spark.createDataFrame([(0, "Index of private rents (generated)"), (1, "Source: lineitem"),
                                 (2, "Month," + ",".join(f'"{c}"' for c in WIDE_REGIONS))], "line_no long, line string")
    return pre.unionByName(data)


@query("unpivot_index", with_("rental_index") + f"""
SELECT region, reference_month, index_value FROM rental_index WHERE regexp_matches(lower(region), '{WIDE_KEEP}')
  AND (year(reference_month) * 12 + month(reference_month)) % 3 <> 1""")
def q_unpivot_index(spark, d):
    return RD.read_wide_index(wide_lines(spark, d), "europe", WIDE_KEEP)


@query("unpivot_skips", with_("rental_index") + f"""
SELECT CASE WHEN NOT regexp_matches(lower(region), '{WIDE_KEEP}') THEN 'region' WHEN (year(reference_month) * 12 + month(reference_month)) % 3 = 1
            THEN 'no_leading_year' ELSE 'kept' END AS reason, COUNT(*) AS n
FROM rental_index GROUP BY ALL""")
def q_unpivot_skips(spark, d):
    """What the wide reader leaves out, and why: the reasons add up to all cells that have a value."""
    return RD.wide_index_skips(wide_lines(spark, d), "europe", WIDE_KEEP)


# outcodes of the two regional sources, and the rows that each of three loads asks for
_SOURCES = {"EUROPE": "NATION_7", "ASIA": "NATION_12"}
_ASKED = {"one": 30, "both": 100, "supplemented": 100_000}

register("hpi_sources", ["hpi_index"], """
SELECT 1 AS rank, 'EUROPE' AS source, outcode, reference_month, average_price, index_value FROM hpi_index
WHERE outcode = 'NATION_7' AND month(reference_month) <> 5
UNION ALL SELECT 2, 'ASIA', outcode, reference_month, average_price, index_value FROM hpi_index WHERE outcode = 'NATION_12' AND month(reference_month) <> 7
UNION ALL SELECT 2, 'ASIA', outcode, reference_month, average_price + 1, index_value FROM hpi_index
WHERE outcode = 'NATION_7' AND month(reference_month) IN (2, 5)""")


@query("source_fallback", with_("hpi_sources") + """
, asked AS (SELECT unnest(['one', 'both', 'supplemented']) AS load, unnest([30, 100, 100000]) AS min_rows),
n AS (SELECT rank, count(*) AS n, sum(count(*)) OVER (ORDER BY rank) AS upto FROM hpi_sources GROUP BY rank),
taken AS (SELECT a.load, s.* FROM asked a JOIN n ON n.upto - n.n < a.min_rows JOIN hpi_sources s ON s.rank = n.rank),
kept AS (SELECT * FROM taken QUALIFY row_number() OVER (PARTITION BY load, outcode, reference_month ORDER BY rank DESC) = 1),
few AS (SELECT load FROM asked WHERE min_rows > (SELECT max(upto) FROM n)),
base AS (SELECT load, outcode, arg_max(average_price, reference_month) AS b FROM kept WHERE load IN (FROM few) GROUP BY ALL),
top AS (SELECT load, max(reference_month) AS m0 FROM kept GROUP BY load),
grid AS (SELECT load, outcode, b, m, CAST(m0 - to_months(CAST(m AS INTEGER)) AS DATE) AS reference_month FROM base JOIN top USING (load), (SELECT unnest(range(0, 36)) AS m))
SELECT load, outcode, reference_month, average_price, index_value, source FROM kept
UNION ALL
SELECT load, outcode, reference_month, CAST(floor(b * pow(1 - 0.03 / 12, CAST(m AS DOUBLE)) + 0.5) AS DOUBLE), CAST(100.0 + (36 - m) * 0.25 AS DOUBLE), 'generated'
FROM grid g ANTI JOIN kept k ON k.load = g.load AND k.outcode = g.outcode AND k.reference_month = g.reference_month""")
def q_source_fallback(spark, d):
    """Three loads of an index: the first source is enough, both are, and neither is."""
    h = b.hpi_index(spark, d).select("outcode", "reference_month", "average_price", "index_value")
    month = F.month("reference_month")
    first = h.where((F.col("outcode") == _SOURCES["EUROPE"]) & (month != 5))
    second = h.where((F.col("outcode") == _SOURCES["ASIA"]) & (month != 7)).unionByName(
        h.where((F.col("outcode") == _SOURCES["EUROPE"]) & month.isin(2, 5)).withColumn("average_price", F.col("average_price") + 1))
    out = None
    for load, asked in _ASKED.items():
        made = RD.accumulate([("EUROPE", first), ("ASIA", second)], ["outcode", "reference_month"], asked,
                             lambda have: gap_fill(have).where("is_generated").drop("is_generated"))
        own = made.select(F.lit(load).alias("load"), "outcode", "reference_month", "average_price", "index_value", "source")
        out = own if out is None else out.unionByName(own)
    return out

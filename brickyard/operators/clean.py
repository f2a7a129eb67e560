"""Cleaning and conforming of raw feeds.

Validation keeps every input row and attaches the *first* failing reason, so
reason counts always add up to the input (nothing is silently dropped).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import months_back
from ..functions.postcode import (CATEGORY_CODES, POSTCODE_PATTERN, PROPERTY_TYPE_CODES, TENURE_CODES, address_line, decode,
                                  grid_to_latlng, is_london, js_parse_float, norm_key, outcode_split)
from ..session import ensure_checkpoint_dir

REASONS = ("null_postcode", "invalid_price", "invalid_date", "future_date", "not_london", "too_old")
MAX_PRICE = 100_000_000
HISTORY_YEARS = 6


def clean_postcodes(raw: DataFrame) -> DataFrame:
    """Keep London, non-terminated postcodes; derive outcode, lat/lng, lsoa."""
    pc = F.trim(F.coalesce(F.col("pcds"), F.lit("")))
    oc = outcode_split(pc)
    lat, lng = grid_to_latlng(F.col("oseast1m").try_cast("double"), F.col("osnrth1m").try_cast("double"))
    # an empty postcode has no outcode and a missing outcode isn't in London
    keep = (F.length(F.trim(F.coalesce("doterm", F.lit("")))) == 0) & is_london(oc)
    return raw.where(keep).select(
        "pc_id", F.upper(pc).alias("postcode"), oc.alias("outcode"), F.lit(None).cast("string").alias("borough"),
        F.lit("London").alias("region"), norm_key(F.col("lsoa11")).alias("lsoa_code"),
        lat.alias("lat"), lng.alias("lng"))


def validate_sales(raw: DataFrame, london: DataFrame, as_of: dt.date) -> DataFrame:
    """sale_id, valid, reason of every row (P7; Q-13, Q-14 split out)."""
    return with_reason(raw, london, as_of).select("sale_id", F.col("reason").isNull().alias("valid"), "reason")


def with_reason(raw: DataFrame, london: DataFrame, as_of: dt.date) -> DataFrame:
    """The raw rows, each with its first failure of null_postcode → invalid_price → invalid_date →
    future_date → not_london → too_old as ``reason`` (NULL: valid), so that validating is one pass."""
    pc = norm_key(F.col("postcode"))
    price = js_parse_float(F.col("sale_price"))
    date = F.col("sale_date").try_cast("date") if hasattr(F.Column, "try_cast") else F.try_to_date("sale_date")
    members = london.select(F.col("postcode").alias("_pc")).distinct().withColumn("_in", F.lit(True))
    x = raw.withColumns({"_pc": pc, "_price": price, "_date": date}).join(members, "_pc", "left")
    reason = (F.when(F.col("_pc").isNull(), F.lit(REASONS[0]))
               .when(F.col("_price").isNull() | F.isnan("_price") | (F.col("_price") <= 0)
                     | (F.col("_price") >= MAX_PRICE), F.lit(REASONS[1]))
               .when(F.col("_date").isNull(), F.lit(REASONS[2]))
               .when(F.col("_date") > F.lit(as_of), F.lit(REASONS[3]))
               .when(F.col("_in").isNull(), F.lit(REASONS[4]))
               .when(F.col("_date") < F.lit(months_back(as_of, 12 * HISTORY_YEARS)), F.lit(REASONS[5])))
    return x.withColumn("reason", reason).select(*raw.columns, "reason")


def skip_counts(validated: DataFrame) -> DataFrame:
    """reason, n (valid rows under 'valid'); sums to the input row count."""
    return validated.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def semi_join_london(raw: DataFrame, london: DataFrame) -> DataFrame:
    """Sales whose normalised postcode is a known London postcode."""
    m = london.select(F.col("postcode").alias("_pc")).distinct()
    return raw.select("sale_id", norm_key(F.col("postcode")).alias("_pc")).join(m, "_pc", "left_semi").select("sale_id")


def decode_codes(raw: DataFrame) -> DataFrame:
    return raw.select("sale_id", decode(F.col("property_type"), PROPERTY_TYPE_CODES).alias("property_type"),
                      decode(F.col("tenure"), TENURE_CODES).alias("tenure"),
                      decode(F.col("ppd_category"), CATEGORY_CODES).alias("category"))


def address_key(df: DataFrame) -> F.Column:
    t = [F.trim(F.coalesce(F.col(c), F.lit(""))) for c in ("paon", "saon", "street")]
    return F.concat_ws("|", norm_key(F.col("postcode")), *t)


def with_address(raw: DataFrame) -> DataFrame:
    return raw.select("sale_id", address_line(F.col("saon"), F.col("paon"), F.col("street")).alias("address_line_1"))


def dedupe_properties(raw: DataFrame) -> DataFrame:
    """One whole row per address key, the earliest (date, price, id) winning.

    ``min(struct)`` aggregates map-side, so even an address key holding a
    third of all rows is reduced before the shuffle, and carries the winner's
    other columns along.
    """
    d = F.col("sale_date").try_cast("date") if hasattr(F.Column, "try_cast") else F.try_to_date("sale_date")
    x = raw.select(address_key(raw).alias("address_key"),
                   F.struct(d.alias("d"), js_parse_float(F.col("sale_price")).alias("p"), F.col("sale_id").alias("id"),
                            F.struct(*[c for c in raw.columns if c != "sale_id"]).alias("row")).alias("s"))
    g = x.groupBy("address_key").agg(F.min("s").alias("s"))
    return g.select("address_key", F.col("s.id").alias("sale_id"), "s.row.*")


def property_rows(sales: DataFrame) -> DataFrame:
    """Valid raw sales → the stored property columns, one row per address key."""
    return dedupe_properties(sales).select(
        "address_key", norm_key(F.col("postcode")).alias("postcode"),
        address_line(F.col("saon"), F.col("paon"), F.col("street")).alias("address_line_1"), F.trim("town").alias("city"),
        decode(F.col("property_type"), PROPERTY_TYPE_CODES).alias("property_type"), decode(F.col("tenure"), TENURE_CODES).alias("tenure"))


def assign_ids(df: DataFrame, key: str, name: str = "id", method: str = "dense") -> DataFrame:
    """Surrogate keys for the distinct values of ``key``.

    ``dense``: 1..N in key order.  The distinct keys are range-partitioned,
    which balances any distribution of keys (a common prefix too), and the
    partition number is written with them, so that recomputing after a lost
    executor yields the same ids; an id is the number of keys in the
    partitions before plus the rank inside.
    ``hash``: xxhash64 of the key (stable, no shuffle).
    """
    if method == "hash":
        return df.withColumn(name, F.xxhash64(key))
    ensure_checkpoint_dir(df.sparkSession)
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    dealt = keys.repartitionByRange(F.col(key)).withColumn("_part", F.spark_partition_id()).checkpoint()
    # one row per partition
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("_part").orderBy(key)))
    ids = inside.join(before, "_part").select(key, (F.col("_before") + F.col("_rank")).alias(name))
    return df.join(ids, key, "left")


def coerce_defaults(raw: DataFrame) -> DataFrame:
    """Numbers that do not parse become 0, blank strings '' (P20)."""
    return raw.select("sale_id", F.coalesce(F.col("sale_price").try_cast("double"), F.lit(0.0)).alias("value"),
                      F.coalesce(F.trim(F.col("town")), F.lit("")).alias("town"))


REQUEST_RULES = [  # fixed values: (rule, predicate) of the request validators
    ("postcode", f"postcode RLIKE '{POSTCODE_PATTERN}'"),
    ("bedrooms", "bedrooms BETWEEN 1 AND 10"),
    ("floor_area_sqm", "floor_area_sqm BETWEEN 10 AND 1000"),
    ("asking_price", "asking_price BETWEEN 50000 AND 10000000"),
    ("expected_monthly_rent", "rent_cents BETWEEN 10000 AND 2000000"),
    ("deposit_pct", "deposit_pct BETWEEN 5 AND 50"),
    ("mortgage_product_id", "mortgage_product_id > 0"),
    ("property_type", "property_type IN ('DETACHED','SEMI_DETACHED','TERRACED','FLAT','OTHER')"),
]


def validate_requests(req: DataFrame) -> DataFrame:
    """request_id, failed_rules: comma-joined names of failed rules ('' when valid)."""
    fails = [F.when(~F.coalesce(F.expr(pred), F.lit(False)), F.lit(rule)) for rule, pred in REQUEST_RULES]
    return req.select("request_id", F.concat_ws(",", *fails).alias("failed_rules"))

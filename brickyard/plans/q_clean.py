"""Registered queries: cleaning and conforming (step 5)."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import postcode as P
from ..functions.dates import trailing
from ..operators import clean as C
from ..sources import bindings as b
from .oracle_bindings import AS_OF_SALE, register, with_
from ..sources.tables import per_session
from .registry import query
from .sqlfrag import PCDS

register("raw_postcode", [], f"""
SELECT c_custkey AS pc_id, {PCDS('c_custkey')} AS pcds,
       CASE WHEN c_custkey % 11 = 0 THEN '202001' ELSE '' END AS doterm,
       CASE WHEN c_custkey % 13 = 0 THEN '' ELSE CAST(500000 + (c_custkey % 1000) * 10 AS VARCHAR) END AS oseast1m,
       CASE WHEN c_custkey % 13 = 0 THEN '' ELSE CAST(170000 + (c_custkey % 997) * 10 AS VARCHAR) END AS osnrth1m,
       'E0100' || lpad(CAST(c_custkey % 500 AS VARCHAR), 4, '0') AS lsoa11
FROM customer""")

register("raw_sale", [], f"""
SELECT o_orderkey AS sale_id, '{{' || upper(regexp_replace(md5(CAST(o_orderkey AS VARCHAR)), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '\\1-\\2-\\3-\\4-')) || '}}' AS txn_uid,
       CASE WHEN o_orderkey % 97 = 0 THEN '0' WHEN o_orderkey % 89 = 0 THEN 'abc'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS sale_price,
       CASE WHEN o_orderkey % 79 = 0 THEN '2999-01-01' WHEN o_orderkey % 73 = 0 THEN 'bad'
            ELSE strftime(o_orderdate, '%Y-%m-%d') END AS sale_date,
       CASE WHEN o_orderkey % 83 = 0 THEN '  '
            WHEN o_orderkey % 7 = 0 THEN 'ZZ' || CAST(o_orderkey % 10 AS VARCHAR) || ' 1AA'
            WHEN o_orderkey % 5 = 0 THEN ' ' || lower({PCDS('o_custkey')}) || ' '
            ELSE {PCDS('o_custkey')} END AS postcode,
       substring('DSTFOX', CAST(o_orderkey % 6 + 1 AS INTEGER), 1) AS property_type,
       CASE o_orderkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'L' ELSE 'U' END AS tenure,
       CAST(o_custkey % 50 + 1 AS VARCHAR) AS paon,
       CASE WHEN o_orderkey % 4 = 0 THEN 'FLAT ' || CAST(o_orderkey % 9 + 1 AS VARCHAR) ELSE '' END AS saon,
       'STREET ' || CAST(o_custkey % 7 AS VARCHAR) AS street, 'LONDON' AS town,
       CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'B' END AS ppd_category
FROM orders""")

# written out here, so that a wrong constant of the library shows
_LONDON_RE = ("^((E|N|W|EC|NW|SE|SW|WC|BR|CR|DA|EN|HA|IG|KT|RM|SM|TW|UB|WD)[0-9]"
              "|(EC|NW|SE|SW|WC|BR|CR|DA|EN|HA|IG|KT|RM|SM|TW|UB|WD)$)")
SQL_TYPES = {"D": "DETACHED", "S": "SEMI_DETACHED", "T": "TERRACED", "F": "FLAT", "O": "OTHER"}
SQL_TENURES = {"F": "FREEHOLD", "L": "LEASEHOLD"}
SQL_CATEGORIES = {"A": "STANDARD_SALE", "B": "NEW_BUILD"}
_OC_SPLIT = ("CASE WHEN len(string_split(regexp_replace(trim(pcds), '\\s+', ' ', 'g'), ' ')) >= 2 "
             "THEN upper(string_split(regexp_replace(trim(pcds), '\\s+', ' ', 'g'), ' ')[1]) END")
_LNG_DEN = repr(P.METRES_PER_DEGREE * math.cos(P.REF_LAT_DEG * math.pi / 180))

register("pc_clean", ["raw_postcode"], f"""
SELECT pc_id, upper(trim(pcds)) AS postcode, {_OC_SPLIT} AS outcode, CAST(NULL AS VARCHAR) AS borough, 'London' AS region,
       CASE WHEN length(upper(trim(lsoa11))) > 0 THEN upper(trim(lsoa11)) END AS lsoa_code,
       CASE WHEN TRY_CAST(oseast1m AS DOUBLE) > 0 AND TRY_CAST(osnrth1m AS DOUBLE) > 0
            THEN round(CAST({P.LAT0!r} AS DOUBLE) + TRY_CAST(osnrth1m AS DOUBLE) / {P.METRES_PER_DEGREE!r}, 6) END AS lat,
       CASE WHEN TRY_CAST(oseast1m AS DOUBLE) > 0 AND TRY_CAST(osnrth1m AS DOUBLE) > 0
            THEN round(CAST({P.LNG0!r} AS DOUBLE) + TRY_CAST(oseast1m AS DOUBLE) / {_LNG_DEN}, 6) END AS lng
FROM raw_postcode
WHERE length(trim(COALESCE(pcds, ''))) > 0 AND {_OC_SPLIT} IS NOT NULL
  AND COALESCE(regexp_matches({_OC_SPLIT}, '{_LONDON_RE}'), false) AND length(trim(COALESCE(doterm, ''))) = 0""")

_PRICE = "TRY_CAST(NULLIF(regexp_extract(sale_price, '^\\s*([+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?)', 1), '') AS DOUBLE)"
_NPC = "CASE WHEN length(upper(trim(postcode))) > 0 THEN upper(trim(postcode)) END"

register("validated", ["raw_sale", "pc_clean"], f"""
SELECT sale_id, reason IS NULL AS valid, reason FROM (
  SELECT s.sale_id,
         CASE WHEN s._pc IS NULL THEN 'null_postcode'
              WHEN s._price IS NULL OR s._price <= 0 OR s._price >= 100000000 THEN 'invalid_price'
              WHEN s._date IS NULL THEN 'invalid_date'
              WHEN s._date > {AS_OF_SALE} THEN 'future_date'
              WHEN m.postcode IS NULL THEN 'not_london'
              WHEN s._date < {AS_OF_SALE} - INTERVAL 72 MONTH THEN 'too_old' END AS reason
  FROM (SELECT sale_id, {_NPC} AS _pc, {_PRICE} AS _price, TRY_CAST(sale_date AS DATE) AS _date FROM raw_sale) s
  LEFT JOIN (SELECT DISTINCT postcode FROM pc_clean) m ON m.postcode = s._pc)""")


@per_session
def _london(spark, d):
    return C.clean_postcodes(b.raw_postcode(spark, d))


@query("postcode_parts", with_("raw_postcode") + f"""
SELECT pc_id, upper(trim(pcds)) AS postcode,
       upper(CASE WHEN length(regexp_replace(pcds, '\\s', '', 'g')) > 3
                  THEN substring(regexp_replace(pcds, '\\s', '', 'g'), 1, length(regexp_replace(pcds, '\\s', '', 'g')) - 3)
                  ELSE '' END) AS outcode,
       {_OC_SPLIT} AS outcode_split,
       CASE WHEN length(regexp_extract({_OC_SPLIT}, '^[A-Z]+', 0)) > 0 THEN regexp_extract({_OC_SPLIT}, '^[A-Z]+', 0)
            ELSE {_OC_SPLIT} END AS area,
       CASE WHEN length({_OC_SPLIT}) >= 3 THEN substring({_OC_SPLIT}, 1, 4) ELSE {_OC_SPLIT} END AS sector_label
FROM raw_postcode""")
def q_postcode_parts(spark, d):
    r = b.raw_postcode(spark, d)
    oc = P.outcode_split(F.col("pcds"))
    return r.select("pc_id", F.upper(F.trim("pcds")).alias("postcode"), P.outcode(F.col("pcds")).alias("outcode"),
                    oc.alias("outcode_split"), P.area(oc).alias("area"), P.sector_label(oc).alias("sector_label"))


@query("london_filter", with_("raw_postcode") + f"""
SELECT pc_id, upper(trim(pcds)) AS postcode, COALESCE(regexp_matches({_OC_SPLIT}, '{_LONDON_RE}'), false) AS flag
FROM raw_postcode""")
def q_london_filter(spark, d):
    r = b.raw_postcode(spark, d)
    return r.select("pc_id", F.upper(F.trim("pcds")).alias("postcode"), P.is_london(P.outcode_split(F.col("pcds"))).alias("flag"))


@query("prefix_filter", with_("raw_postcode") + """
SELECT pc_id, upper(trim(pcds)) LIKE 'E%' AS flag FROM raw_postcode""")
def q_prefix_filter(spark, d):
    """Postcodes below a typed prefix, as the location search does it."""
    return b.raw_postcode(spark, d).select("pc_id", P.like_prefix(F.upper(F.trim("pcds")), "E").alias("flag"))


@query("valid_postcode", with_("raw_postcode", "raw_sale") + f"""
SELECT sale_id AS pc_id, postcode, COALESCE(regexp_matches(postcode, '(?i)^[A-Z]{{1,2}}[0-9R][0-9A-Z]? ?[0-9][A-Z]{{2}}$'), false) AS flag FROM raw_sale""")
def q_valid_postcode(spark, d):
    r = b.raw_sale(spark, d)
    return r.select(F.col("sale_id").alias("pc_id"), "postcode", P.valid_postcode(F.col("postcode")).alias("flag"))


@query("clean_postcodes", with_("pc_clean") + "SELECT * FROM pc_clean")
def q_clean_postcodes(spark, d):
    return _london(spark, d)


@query("validate_sales", with_("validated") + "SELECT * FROM validated")
def q_validate_sales(spark, d):
    return C.validate_sales(b.raw_sale(spark, d), _london(spark, d), b.sale_as_of(spark, d))


@query("skip_counts", with_("validated") + "SELECT COALESCE(reason, 'valid') AS reason, COUNT(*) AS n FROM validated GROUP BY 1")
def q_skip_counts(spark, d):
    return C.skip_counts(C.validate_sales(b.raw_sale(spark, d), _london(spark, d), b.sale_as_of(spark, d)))


@query("semi_join_london", with_("raw_sale", "pc_clean") + f"""
SELECT sale_id FROM raw_sale WHERE {_NPC} IN (SELECT postcode FROM pc_clean)""")
def q_semi_join_london(spark, d):
    return C.semi_join_london(b.raw_sale(spark, d), _london(spark, d))


@query("trailing_window", with_("sale") + f"""
SELECT outcode, COUNT(*) FILTER (WHERE sale_date >= {AS_OF_SALE} - INTERVAL 12 MONTH) AS n_12m,
       COUNT(*) FILTER (WHERE sale_date >= {AS_OF_SALE} - INTERVAL 24 MONTH AND sale_date < {AS_OF_SALE} - INTERVAL 12 MONTH) AS n_12_24m,
       COUNT(*) FILTER (WHERE sale_date >= {AS_OF_SALE} - INTERVAL 60 MONTH) AS n_5y
FROM sale WHERE sale_date >= {AS_OF_SALE} - INTERVAL 60 MONTH GROUP BY outcode""")
def q_trailing_window(spark, d):
    as_of = b.sale_as_of(spark, d)
    s = b.sale(spark, d).where(trailing(F.col("sale_date"), as_of, 60))
    return s.groupBy("outcode").agg(
        F.count(F.when(trailing(F.col("sale_date"), as_of, 12), 1)).alias("n_12m"),
        F.count(F.when(trailing(F.col("sale_date"), as_of, 24, skip_months=12), 1)).alias("n_12_24m"),
        F.count(F.lit(1)).alias("n_5y"))


def _map_sql(col: str, mapping: dict[str, str]) -> str:
    return "CASE trim(" + col + ") " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items()) + " END"


@query("decode_codes", with_("raw_sale") + f"""
SELECT sale_id, {_map_sql('property_type', SQL_TYPES)} AS property_type,
       {_map_sql('tenure', SQL_TENURES)} AS tenure, {_map_sql('ppd_category', SQL_CATEGORIES)} AS category
FROM raw_sale""")
def q_decode_codes(spark, d):
    return C.decode_codes(b.raw_sale(spark, d))


@query("address_line", with_("raw_sale") + """
SELECT sale_id, CASE WHEN length(trim(COALESCE(saon, ''))) > 0
                     THEN trim(trim(saon) || ', ' || trim(COALESCE(paon, '')) || ' ' || trim(COALESCE(street, '')))
                     ELSE trim(trim(COALESCE(paon, '')) || ' ' || trim(COALESCE(street, ''))) END AS address_line_1
FROM raw_sale""")
def q_address_line(spark, d):
    return C.with_address(b.raw_sale(spark, d))


@query("dedupe_properties", with_("raw_sale", "validated") + f"""
SELECT address_key, sale_id FROM (
  SELECT concat_ws('|', {_NPC}, trim(COALESCE(paon, '')), trim(COALESCE(saon, '')), trim(COALESCE(street, ''))) AS address_key,
         sale_id, ROW_NUMBER() OVER (PARTITION BY concat_ws('|', {_NPC}, trim(COALESCE(paon, '')), trim(COALESCE(saon, '')),
                                                            trim(COALESCE(street, '')))
                                     ORDER BY TRY_CAST(sale_date AS DATE), {_PRICE}, sale_id) AS rn
  FROM raw_sale WHERE sale_id IN (SELECT sale_id FROM validated WHERE valid)) WHERE rn = 1""")
def q_dedupe_properties(spark, d):
    raw = b.raw_sale(spark, d)
    ok = C.validate_sales(raw, _london(spark, d), b.sale_as_of(spark, d)).where("valid").select("sale_id")
    return C.dedupe_properties(raw.join(ok, "sale_id", "left_semi")).select("address_key", "sale_id")


@query("assign_ids", with_("pc_clean") + """
SELECT postcode, ROW_NUMBER() OVER (ORDER BY postcode) AS id FROM (SELECT DISTINCT postcode FROM pc_clean)""")
def q_assign_ids(spark, d):
    return C.assign_ids(_london(spark, d).select("postcode").distinct(), "postcode", "id")


@query("grid_to_latlng", with_("raw_postcode") + f"""
SELECT pc_id,
       CASE WHEN TRY_CAST(oseast1m AS DOUBLE) > 0 AND TRY_CAST(osnrth1m AS DOUBLE) > 0
            THEN round(CAST({P.LAT0!r} AS DOUBLE) + TRY_CAST(osnrth1m AS DOUBLE) / {P.METRES_PER_DEGREE!r}, 6) END AS lat,
       CASE WHEN TRY_CAST(oseast1m AS DOUBLE) > 0 AND TRY_CAST(osnrth1m AS DOUBLE) > 0
            THEN round(CAST({P.LNG0!r} AS DOUBLE) + TRY_CAST(oseast1m AS DOUBLE) / {_LNG_DEN}, 6) END AS lng
FROM raw_postcode""")
def q_grid_to_latlng(spark, d):
    r = b.raw_postcode(spark, d)
    lat, lng = P.grid_to_latlng(F.col("oseast1m").try_cast("double"), F.col("osnrth1m").try_cast("double"))
    return r.select("pc_id", lat.alias("lat"), lng.alias("lng"))


@query("coerce_defaults", with_("raw_sale") + """
SELECT sale_id, COALESCE(TRY_CAST(sale_price AS DOUBLE), 0.0) AS value, COALESCE(trim(town), '') AS town FROM raw_sale""")
def q_coerce_defaults(spark, d):
    return C.coerce_defaults(b.raw_sale(spark, d))


@query("validate_requests", with_("request") + """
SELECT request_id, concat_ws(',',
  CASE WHEN NOT COALESCE(regexp_full_match(postcode, '[A-Za-z]{1,2}[0-9Rr][0-9A-Za-z]? ?[0-9][A-Za-z]{2}'), false) THEN 'postcode' END,
  CASE WHEN NOT COALESCE(bedrooms BETWEEN 1 AND 10, false) THEN 'bedrooms' END,
  CASE WHEN NOT COALESCE(floor_area_sqm BETWEEN 10 AND 1000, false) THEN 'floor_area_sqm' END,
  CASE WHEN NOT COALESCE(asking_price BETWEEN 50000 AND 10000000, false) THEN 'asking_price' END,
  CASE WHEN NOT COALESCE(rent_cents BETWEEN 10000 AND 2000000, false) THEN 'expected_monthly_rent' END,
  CASE WHEN NOT COALESCE(deposit_pct BETWEEN 5 AND 50, false) THEN 'deposit_pct' END,
  CASE WHEN NOT COALESCE(mortgage_product_id > 0, false) THEN 'mortgage_product_id' END,
  CASE WHEN NOT COALESCE(form_type IN ('DETACHED', 'SEMI_DETACHED', 'TERRACED', 'FLAT', 'OTHER'), false) THEN 'property_type' END) AS failed_rules
FROM request""")
def q_validate_requests(spark, d):
    r = b.request(spark, d)
    return C.validate_requests(r.withColumn("property_type", F.col("form_type")))


_MONTH_RAW = """CASE o_orderkey % 8
    WHEN 0 THEN strftime(o_orderdate, '%Y') || ' ' || strftime(o_orderdate, '%b')
    WHEN 4 THEN strftime(o_orderdate, '%Y') || '  ' || lower(strftime(o_orderdate, '%b'))
    WHEN 1 THEN strftime(o_orderdate, '%b') || ' ' || strftime(o_orderdate, '%Y')
    WHEN 5 THEN upper(strftime(o_orderdate, '%b')) || ' ' || strftime(o_orderdate, '%Y')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m') WHEN 6 THEN strftime(o_orderdate, '%Y-%m') || '-17'
    WHEN 3 THEN strftime(o_orderdate, '%Y') || ' Xyz' ELSE 'n/a' END"""


def _month_raw_spark():
    k, d = F.col("o_orderkey") % 8, F.col("o_orderdate")
    y, mon = F.date_format(d, "yyyy"), F.date_format(d, "MMM")
    return (F.when(k == 0, F.concat(y, F.lit(" "), mon)).when(k == 4, F.concat(y, F.lit("  "), F.lower(mon)))
             .when(k == 1, F.concat(mon, F.lit(" "), y)).when(k == 5, F.concat(F.upper(mon), F.lit(" "), y))
             .when(k == 2, F.date_format(d, "yyyy-MM")).when(k == 6, F.concat(F.date_format(d, "yyyy-MM"), F.lit("-17")))
             .when(k == 3, F.concat(y, F.lit(" Xyz"))).otherwise(F.lit("n/a")))


_MN = "CASE lower({n}) " + " ".join(f"WHEN '{m}' THEN '{i + 1:02d}'" for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split())) + " ELSE '01' END"


@query("parse_month", f"""
SELECT sale_id, raw, TRY_CAST(COALESCE(
    CASE WHEN regexp_matches(raw, '^(\\d{{4}})\\s+([A-Za-z]{{3}})') THEN regexp_extract(raw, '^(\\d{{4}})\\s+([A-Za-z]{{3}})', 1) || '-' ||
         {_MN.format(n="regexp_extract(raw, '^(\\d{4})\\s+([A-Za-z]{3})', 2)")} || '-01' END,
    CASE WHEN regexp_matches(raw, '^([A-Za-z]{{3}})\\s+(\\d{{4}})') THEN regexp_extract(raw, '^([A-Za-z]{{3}})\\s+(\\d{{4}})', 2) || '-' ||
         {_MN.format(n="regexp_extract(raw, '^([A-Za-z]{3})\\s+(\\d{4})', 1)")} || '-01' END,
    CASE WHEN regexp_matches(raw, '^(\\d{{4}})-(\\d{{2}})') THEN regexp_extract(raw, '^(\\d{{4}})-(\\d{{2}})', 1) || '-' ||
         regexp_extract(raw, '^(\\d{{4}})-(\\d{{2}})', 2) || '-01' END) AS DATE) AS month
FROM (SELECT o_orderkey AS sale_id, {_MONTH_RAW} AS raw FROM orders)""")
def q_parse_month(spark, d):
    from ..sources.tables import read
    o = read(spark, d, "orders", ["o_orderkey", "o_orderdate"])
    x = o.select(F.col("o_orderkey").alias("sale_id"), _month_raw_spark().alias("raw"))
    return x.select("sale_id", "raw", P.parse_month(F.col("raw")).alias("month"))

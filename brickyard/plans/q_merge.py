"""Registered queries: upserts, enrichment, sales load, migrations, contracts, quality (step 6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.postcode import CATEGORY_CODES, PROPERTY_TYPE_CODES, TENURE_CODES, decode, norm_key
from ..operators import clean as C
from ..operators import contracts as K
from ..operators import merge as G
from ..sources import bindings as b
from ..sources.tables import per_session, read
from .oracle_bindings import AS_OF_CRIME, AS_OF_SALE, register, with_
from .q_clean import _NPC, _PRICE, SQL_CATEGORIES, _map_sql
from .registry import query


STAMP_BASE = "2020-01-01"  # stamp of the pre-existing location rows


def _loc_parts(spark, d):
    loc = b.location(spark, d)
    base = loc.where(F.col("lsoa_code") % 3 != 0).withColumn("created_at", F.lit(STAMP_BASE).cast("date")) \
              .withColumn("updated_at", F.lit(STAMP_BASE).cast("date"))
    upd = loc.where((F.col("lsoa_code") % 2 == 0) | (F.col("lsoa_code") % 3 == 0)).select(
        "postcode", F.lower("outcode").alias("outcode"),
        F.when(F.col("lsoa_code") % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat("borough", F.lit("*"))).alias("borough"),
        F.lit("Greater London").alias("region"), "lsoa_code")
    return base, upd


@query("upsert_location", with_("location") + f"""
SELECT COALESCE(b.postcode, u.postcode) AS postcode,
       CASE WHEN u.postcode IS NOT NULL THEN u.outcode ELSE b.outcode END AS outcode,
       CASE WHEN u.postcode IS NOT NULL THEN COALESCE(u.borough, b.borough) ELSE b.borough END AS borough,
       CASE WHEN u.postcode IS NOT NULL THEN u.region ELSE b.region END AS region,
       CASE WHEN u.postcode IS NOT NULL THEN COALESCE(u.lsoa_code, b.lsoa_code) ELSE b.lsoa_code END AS lsoa_code,
       COALESCE(b.created_at, {AS_OF_CRIME}) AS created_at,
       CASE WHEN u.postcode IS NOT NULL THEN {AS_OF_CRIME} ELSE b.updated_at END AS updated_at,
       u.postcode IS NOT NULL AS changed
FROM (SELECT *, DATE '2020-01-01' AS created_at, DATE '2020-01-01' AS updated_at FROM location WHERE lsoa_code % 3 <> 0) b
FULL OUTER JOIN (SELECT postcode, lower(outcode) AS outcode,
                        CASE WHEN lsoa_code % 4 = 0 THEN NULL ELSE borough || '*' END AS borough,
                        'Greater London' AS region, lsoa_code FROM location WHERE lsoa_code % 2 = 0 OR lsoa_code % 3 = 0) u
ON b.postcode = u.postcode""")
def q_upsert_location(spark, d):
    base, upd = _loc_parts(spark, d)
    return G.upsert(base, upd, ["postcode"], {"borough": G.KEEP_IF_NULL, "lsoa_code": G.KEEP_IF_NULL},
                    stamp=b.crime_as_of(spark, d))


_HPI_COLS = ["average_price", "index_value", "annual_pct_change"]


@query("upsert_hpi", with_("hpi_index") + """
SELECT COALESCE(b.outcode, u.outcode) AS outcode, COALESCE(b.reference_month, u.reference_month) AS reference_month,
       CASE WHEN u.outcode IS NOT NULL THEN u.average_price ELSE b.average_price END AS average_price,
       CASE WHEN u.outcode IS NOT NULL THEN u.index_value ELSE b.index_value END AS index_value,
       CASE WHEN u.outcode IS NOT NULL THEN u.annual_pct_change ELSE b.annual_pct_change END AS annual_pct_change,
       u.outcode IS NOT NULL AS changed
FROM (SELECT outcode, reference_month, average_price, index_value, annual_pct_change FROM hpi_index
      WHERE month(reference_month) % 2 = 0) b
FULL OUTER JOIN (SELECT outcode, reference_month, average_price + 1 AS average_price,
                        CASE WHEN outcode = 'NATION_0' THEN NULL ELSE index_value END AS index_value, annual_pct_change
                 FROM hpi_index WHERE reference_month >= DATE '1998-01-01' OR month(reference_month) % 2 = 1) u
ON b.outcode = u.outcode AND b.reference_month = u.reference_month""")
def q_upsert_hpi(spark, d):
    h = b.hpi_index(spark, d).select("outcode", "reference_month", *_HPI_COLS)
    base = h.where(F.month("reference_month") % 2 == 0)
    upd = h.where((F.col("reference_month") >= F.lit("1998-01-01").cast("date")) | (F.month("reference_month") % 2 == 1)).select(
        "outcode", "reference_month", (F.col("average_price") + 1).alias("average_price"),
        F.when(F.col("outcode") == "NATION_0", F.lit(None).cast("double")).otherwise(F.col("index_value")).alias("index_value"),
        "annual_pct_change")
    return G.upsert(base, upd, ["outcode", "reference_month"])


@query("upsert_rental", with_("rental_index") + """
SELECT COALESCE(b.region, u.region) AS region, COALESCE(b.reference_month, u.reference_month) AS reference_month,
       CASE WHEN u.region IS NOT NULL THEN u.index_value ELSE b.index_value END AS index_value,
       u.region IS NOT NULL AS changed
FROM (SELECT region, reference_month, index_value FROM rental_index WHERE region <> 'ASIA') b
FULL OUTER JOIN (SELECT region, reference_month, index_value + 0.5 AS index_value FROM rental_index
                 WHERE reference_month >= DATE '2000-01-01' OR region = 'ASIA') u
ON b.region = u.region AND b.reference_month = u.reference_month""")
def q_upsert_rental(spark, d):
    r = b.rental_index(spark, d).select("region", "reference_month", "index_value")
    base = r.where(F.col("region") != "ASIA")
    upd = r.where((F.col("reference_month") >= F.lit("2000-01-01").cast("date")) | (F.col("region") == "ASIA")).withColumn(
        "index_value", F.col("index_value") + 0.5)
    return G.upsert(base, upd, ["region", "reference_month"])


@query("upsert_crime", with_("crime_stat") + """
SELECT COALESCE(b.lsoa_code, u.lsoa_code) AS lsoa_code, COALESCE(b.reference_period, u.reference_period) AS reference_period,
       COALESCE(b.category, u.category) AS category,
       CASE WHEN u.lsoa_code IS NOT NULL THEN u.count ELSE b.count END AS count, u.lsoa_code IS NOT NULL AS changed
FROM (SELECT * FROM crime_stat WHERE lsoa_code % 4 <> 0) b
FULL OUTER JOIN (SELECT lsoa_code, reference_period, category, arg_max(count, seq) AS count FROM (
                   SELECT *, 1 AS seq FROM crime_stat WHERE lsoa_code % 5 = 0 OR lsoa_code % 4 = 0
                   UNION ALL SELECT lsoa_code, reference_period, category, count + 1, 2 FROM crime_stat WHERE lsoa_code % 5 = 0 OR lsoa_code % 4 = 0)
                 GROUP BY ALL) u
ON b.lsoa_code = u.lsoa_code AND b.reference_period = u.reference_period AND b.category = u.category""")
def q_upsert_crime(spark, d):
    c = b.crime_stat(spark, d)
    base = c.where(F.col("lsoa_code") % 4 != 0)
    u = c.where((F.col("lsoa_code") % 5 == 0) | (F.col("lsoa_code") % 4 == 0))
    upd = u.withColumn("seq", F.lit(1)).unionByName(u.withColumn("count", F.col("count") + 1).withColumn("seq", F.lit(2)))
    return G.upsert(base, upd, ["lsoa_code", "reference_period", "category"], order_col="seq")


@query("insert_ignore", with_("mortgage_product") + """
SELECT mortgage_product_id, lender, product_name, mortgage_type, false AS inserted FROM mortgage_product
WHERE mortgage_product_id % 3 <> 0
UNION ALL
SELECT mortgage_product_id, lower(lender), product_name, mortgage_type, true FROM mortgage_product
WHERE mortgage_product_id % 3 = 0""")
def q_insert_ignore(spark, d):
    p = b.mortgage_product(spark, d).select("mortgage_product_id", "lender", "product_name", "mortgage_type")
    base = p.where(F.col("mortgage_product_id") % 3 != 0)
    # every key comes twice; the first one goes in
    new = p.withColumn("lender", F.lower("lender")).withColumn("seq", F.lit(1)).unionByName(
        p.withColumn("lender", F.upper("lender")).withColumn("seq", F.lit(2)))
    return G.insert_missing(base, new, ["mortgage_product_id"], order_col="seq")


# --- sparse enrichment ----------------------------------------------------------------

EPC_COLUMNS = ["bedrooms", "floor_area_sqm", "epc_rating", "epc_score", "construction_age_band"]


def asset_property(spark, d):
    p = read(spark, d, "part", ["p_partkey", "p_size"])
    return p.select(F.col("p_partkey").alias("property_id"), (F.col("p_size") % 5 + 1).cast("long").alias("bedrooms"),
                    F.when(F.col("p_partkey") % 10 == 0, F.lit(None).cast("long"))
                     .otherwise(10 + 2 * F.col("p_size")).cast("long").alias("floor_area_sqm"),
                    F.lit(None).cast("string").alias("epc_rating"), F.lit(None).cast("long").alias("epc_score"),
                    F.lit(None).cast("string").alias("construction_age_band"), F.lit(STAMP_BASE).cast("date").alias("updated_at"))


def epc_update(spark, d):
    p = read(spark, d, "part", ["p_partkey", "p_size", "p_retailprice"]).where(F.col("p_partkey") % 3 == 0)
    k = F.col("p_partkey")
    nul = k % 5 == 0
    rows = p.select(
        k.alias("property_id"),
        F.when(nul, F.lit(None).cast("long")).otherwise((F.col("p_size") % 4 + 1).cast("long")).alias("bedrooms"),
        F.when(nul, F.lit(None).cast("long")).otherwise((F.col("p_size") * 3).cast("long")).alias("floor_area_sqm"),
        F.substring(F.lit("ABCDEFG"), (k % 7 + 1).cast("int"), 1).alias("epc_rating"),
        (F.floor("p_retailprice").cast("long") % 100).alias("epc_score"),
        F.when(k % 2 == 0, F.concat(F.lit("England and Wales: "), (1900 + k % 100).cast("string"))).alias("construction_age_band"),
        F.lit(1).alias("seq"))
    ghosts = rows.where(k % 9 == 0).withColumn("property_id", F.col("property_id") + 1_000_000_000)
    # a second update of the same key, with a new score and nothing else for some of them
    later = rows.where(k % 4 == 0).withColumn("epc_score", F.col("epc_score") + 1).withColumn("seq", F.lit(2))
    later = later.withColumns({c: F.when(F.col("property_id") % 8 != 0, F.col(c)) for c in ("floor_area_sqm", "epc_rating")})
    return rows.unionByName(ghosts).unionByName(later)


register("asset_property", [], """
SELECT p_partkey AS property_id, CAST(p_size % 5 + 1 AS BIGINT) AS bedrooms,
       CAST(CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE 10 + 2 * p_size END AS BIGINT) AS floor_area_sqm
FROM part""")

register("epc_update", [], """
WITH r AS (SELECT p_partkey AS property_id,
                  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size % 4 + 1 AS BIGINT) END AS bedrooms,
                  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(p_size * 3 AS BIGINT) END AS floor_area_sqm,
                  substring('ABCDEFG', CAST(p_partkey % 7 + 1 AS INTEGER), 1) AS epc_rating,
                  CAST(floor(p_retailprice) AS BIGINT) % 100 AS epc_score,
                  CASE WHEN p_partkey % 2 = 0 THEN 'England and Wales: ' || CAST(1900 + p_partkey % 100 AS VARCHAR) END AS construction_age_band,
                  1 AS seq
           FROM part WHERE p_partkey % 3 = 0)
SELECT * FROM r
UNION ALL SELECT property_id + 1000000000, bedrooms, floor_area_sqm, epc_rating, epc_score, construction_age_band, seq FROM r WHERE property_id % 9 = 0
UNION ALL SELECT property_id, bedrooms, CASE WHEN property_id % 8 <> 0 THEN floor_area_sqm END, CASE WHEN property_id % 8 <> 0 THEN epc_rating END,
                 epc_score + 1, construction_age_band, 2 FROM r WHERE property_id % 4 = 0""")


@query("enrich_sparse", with_("asset_property", "epc_update") + """
SELECT a.property_id, COALESCE(u.bedrooms, a.bedrooms) AS bedrooms, COALESCE(u.floor_area_sqm, a.floor_area_sqm) AS floor_area_sqm,
       u.epc_rating, u.epc_score, u.construction_age_band,
       CASE WHEN u.property_id IS NULL THEN DATE '2020-01-01' ELSE """ + AS_OF_SALE + """ END AS updated_at
FROM asset_property a LEFT JOIN (
  SELECT property_id, max(bedrooms) FILTER (WHERE seq = b_seq) AS bedrooms, max(floor_area_sqm) FILTER (WHERE seq = f_seq) AS floor_area_sqm,
         max(epc_rating) FILTER (WHERE seq = r_seq) AS epc_rating, max(epc_score) FILTER (WHERE seq = s_seq) AS epc_score,
         max(construction_age_band) FILTER (WHERE seq = a_seq) AS construction_age_band
  FROM (SELECT *, max(CASE WHEN bedrooms IS NOT NULL THEN seq END) OVER w AS b_seq, max(CASE WHEN floor_area_sqm IS NOT NULL THEN seq END) OVER w AS f_seq,
               max(CASE WHEN epc_rating IS NOT NULL THEN seq END) OVER w AS r_seq, max(CASE WHEN epc_score IS NOT NULL THEN seq END) OVER w AS s_seq,
               max(CASE WHEN construction_age_band IS NOT NULL THEN seq END) OVER w AS a_seq
        FROM epc_update WINDOW w AS (PARTITION BY property_id))
  GROUP BY property_id) u ON a.property_id = u.property_id""")
def q_enrich_sparse(spark, d):
    return G.enrich(asset_property(spark, d), epc_update(spark, d), "property_id",
                    EPC_COLUMNS, order_col="seq",
                    stamp=b.sale_as_of(spark, d))


# --- sales load (J10, K6, T2) --------------------------------------------------------------

@per_session
def valid_raw(spark, d):
    """Valid sales with all their raw columns, and the postcodes they were held against."""
    lon = C.clean_postcodes(b.raw_postcode(spark, d))
    return C.with_reason(b.raw_sale(spark, d), lon, b.sale_as_of(spark, d)).where("reason is null").drop("reason"), lon


@per_session
def properties(spark, d):
    """Property table with dense ids; its keys are written once for each version of the folder's data."""
    return C.assign_ids(C.property_rows(valid_raw(spark, d)[0]), "address_key", "property_id")


def transactions(spark, d, mode: str = "address"):
    vr, _ = valid_raw(spark, d)
    t = vr.select("sale_id", C.address_key(vr).alias("address_key"), norm_key(F.col("postcode")).alias("postcode"),
                  F.trim("sale_price").try_cast("decimal(12,2)").alias("sale_price"),
                  F.col("sale_date").try_cast("date").alias("sale_date"),
                  decode(F.col("ppd_category"), CATEGORY_CODES).alias("category"))
    p = properties(spark, d)
    on = "address_key" if mode == "address" else "postcode"
    j = t.join(p.select(on, "property_id"), on)
    return j.select("sale_id", "property_id", "sale_price", "sale_date", "category")


_AK = "concat_ws('|', " + _NPC + ", trim(COALESCE(paon, '')), trim(COALESCE(saon, '')), trim(COALESCE(street, '')))"

register("props", ["raw_sale", "validated"], f"""
SELECT ROW_NUMBER() OVER (ORDER BY address_key) AS property_id, address_key, npc AS postcode FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY address_key ORDER BY TRY_CAST(sale_date AS DATE), {_PRICE}, sale_id) AS rn
  FROM (SELECT r.*, {_NPC} AS npc, {_AK} AS address_key FROM raw_sale r
        WHERE sale_id IN (SELECT sale_id FROM validated WHERE valid)))
WHERE rn = 1""")

register("txn_src", ["raw_sale", "validated"], f"""
SELECT sale_id, {_AK} AS address_key, {_NPC} AS postcode, TRY_CAST(trim(sale_price) AS DECIMAL(12,2)) AS sale_price,
       TRY_CAST(sale_date AS DATE) AS sale_date, {_map_sql('ppd_category', SQL_CATEGORIES)} AS category
FROM raw_sale WHERE sale_id IN (SELECT sale_id FROM validated WHERE valid)""")


@query("load_sales", with_("props", "txn_src") + """
SELECT t.sale_id, p.property_id, t.sale_price, t.sale_date, t.category FROM txn_src t JOIN props p USING (address_key)""")
def q_load_sales(spark, d):
    return transactions(spark, d, "address")


@query("load_sales_postcode", with_("props", "txn_src") + """
SELECT t.sale_id, p.property_id, t.sale_price, t.sale_date, t.category FROM txn_src t JOIN props p USING (postcode)""")
def q_load_sales_postcode(spark, d):
    return transactions(spark, d, "postcode")


@query("denorm_outcode", with_("props", "txn_src", "pc_clean") + """
SELECT t.sale_id, l.outcode FROM txn_src t JOIN props p USING (address_key)
LEFT JOIN (SELECT DISTINCT postcode, outcode FROM pc_clean) l ON l.postcode = p.postcode""")
def q_denorm_outcode(spark, d):
    t = transactions(spark, d, "address").select("sale_id", "property_id")
    p = properties(spark, d)
    loc = C.clean_postcodes(b.raw_postcode(spark, d)).select("postcode", "outcode").distinct()
    return G.attach_outcode(t, p, loc).select("sale_id", "outcode")


@query("column_migration", with_("location") + """
SELECT postcode, COALESCE(CASE WHEN lsoa_code % 2 = 0 THEN borough END, borough) AS district FROM location""")
def q_column_migration(spark, d):
    loc = b.location(spark, d)
    expanded = loc.withColumn("district", F.when(F.col("lsoa_code") % 2 == 0, F.col("borough")))
    return G.migrate_column(expanded, "borough", "district").select("postcode", "district")


# --- contracts and quality -------------------------------------------------------------------

@query("contract_violations", with_("sale", "asset_property", "crime_stat") + f"""
SELECT 'sale_price_range' AS contract, 'transaction' AS "table", COUNT(*) FILTER (WHERE sale_price <= 0 OR sale_price >= 100000000) AS n FROM sale
UNION ALL SELECT 'sale_date_not_future', 'transaction', COUNT(*) FILTER (WHERE sale_date > {AS_OF_SALE}) FROM sale
UNION ALL SELECT 'bedrooms_range', 'property', COUNT(*) FILTER (WHERE bedrooms < 0 OR bedrooms > 20) FROM asset_property
UNION ALL SELECT 'crime_count_non_negative', 'crime_stat', COUNT(*) FILTER (WHERE count < 0) FROM crime_stat""")
def q_contract_violations(spark, d):
    as_of = b.sale_as_of(spark, d)
    s = b.sale(spark, d)
    a = K.violations(s, "transaction", {"sale_price_range": (F.col("sale_price") <= 0) | (F.col("sale_price") >= 100_000_000),
                                         "sale_date_not_future": F.col("sale_date") > F.lit(as_of)})
    p = K.violations(asset_property(spark, d), "property",
                     {"bedrooms_range": (F.col("bedrooms") < 0) | (F.col("bedrooms") > 20)})
    c = K.violations(b.crime_stat(spark, d), "crime_stat", {"crime_count_non_negative": F.col("count") < 0})
    return a.unionByName(p).unionByName(c)


def _uprns(spark, d):
    """Property references, some absent and some given twice."""
    k = F.col("p_partkey")
    return read(spark, d, "part", ["p_partkey"]).select(F.when(k % 3 != 0, F.expr("p_partkey div 2")).alias("uprn"))


def _dup_sql(table_sql: str, keys: list[str], name: str) -> str:
    k = ", ".join(keys)
    nn = " AND ".join(f"{c} IS NOT NULL" for c in keys)
    return (f"SELECT 'unique({','.join(keys)})' AS contract, '{name}' AS \"table\", COUNT(*) AS n FROM "
            f"(SELECT {k} FROM {table_sql} WHERE {nn} GROUP BY {k} HAVING COUNT(*) > 1)")


@query("duplicate_keys", with_("location", "pc_clean", "hpi_index", "rental_index", "crime_stat", "request") + "\nUNION ALL ".join([
    _dup_sql("location", ["postcode"], "location"), _dup_sql("pc_clean", ["postcode"], "postcode_directory"),
    _dup_sql("hpi_index", ["outcode", "reference_month"], "hpi_index"),
    _dup_sql("rental_index", ["region", "reference_month"], "rental_index"),
    _dup_sql("crime_stat", ["lsoa_code", "reference_period", "category"], "crime_stat"),
    _dup_sql("(SELECT CASE WHEN p_partkey % 3 <> 0 THEN p_partkey // 2 END AS uprn FROM part)", ["uprn"], "property"),
    _dup_sql("(SELECT 'slug-' || CAST(request_id // 3 AS VARCHAR) AS shareable_slug FROM request)", ["shareable_slug"], "investor_scenario")]))
def q_duplicate_keys(spark, d):
    parts = [K.duplicate_keys(b.location(spark, d), "location", ["postcode"]),
             K.duplicate_keys(C.clean_postcodes(b.raw_postcode(spark, d)), "postcode_directory", ["postcode"]),
             K.duplicate_keys(b.hpi_index(spark, d), "hpi_index", ["outcode", "reference_month"]),
             K.duplicate_keys(b.rental_index(spark, d), "rental_index", ["region", "reference_month"]),
             K.duplicate_keys(b.crime_stat(spark, d), "crime_stat", ["lsoa_code", "reference_period", "category"]),
             K.duplicate_keys(_uprns(spark, d), "property", ["uprn"]),
             K.duplicate_keys(b.request(spark, d).select(F.concat(F.lit("slug-"), F.expr("request_id div 3").cast("string")).alias("shareable_slug")),
                              "investor_scenario", ["shareable_slug"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("orphan_rows", with_("props", "txn_src", "pc_clean", "request", "mortgage_product") + """
SELECT 'fk(postcode)' AS contract, 'property' AS "table", COUNT(*) AS n FROM props
  WHERE postcode IS NOT NULL AND postcode NOT IN (SELECT postcode FROM pc_clean)
UNION ALL SELECT 'fk(address_key)', 'transaction', COUNT(*) FROM txn_src
  WHERE address_key IS NOT NULL AND address_key NOT IN (SELECT address_key FROM props)
UNION ALL SELECT 'fk(mortgage_product_id)', 'investor_scenario', COUNT(*) FROM request
  WHERE mortgage_product_id IS NOT NULL AND mortgage_product_id NOT IN (SELECT mortgage_product_id FROM mortgage_product)""")
def q_orphan_rows(spark, d):
    p = properties(spark, d)
    vr, lon = valid_raw(spark, d)
    t = vr.select(C.address_key(vr).alias("address_key"))
    return (K.orphans(p, lon, "postcode", "postcode", "property")
             .unionByName(K.orphans(t, p, "address_key", "address_key", "transaction"))
             .unionByName(K.orphans(b.request(spark, d), b.mortgage_product(spark, d), "mortgage_product_id",
                                    "mortgage_product_id", "investor_scenario")))


@query("enum_violations", with_("raw_sale", "mortgage_product", "request") + """
SELECT 'property_type_code' AS contract, 'price_paid' AS "table", COUNT(*) FILTER (WHERE trim(property_type) NOT IN ('D','S','T','F','O')) AS n FROM raw_sale
UNION ALL SELECT 'tenure_code', 'price_paid', COUNT(*) FILTER (WHERE trim(tenure) NOT IN ('F','L')) FROM raw_sale
UNION ALL SELECT 'category_code', 'price_paid', COUNT(*) FILTER (WHERE trim(ppd_category) NOT IN ('A','B')) FROM raw_sale
UNION ALL SELECT 'property_type_enum', 'property', COUNT(*) FILTER (WHERE form_type NOT IN ('DETACHED','SEMI_DETACHED','TERRACED','FLAT','OTHER')) FROM request
UNION ALL SELECT 'tenure_enum', 'property', COUNT(*) FILTER (WHERE CASE trim(tenure) WHEN 'F' THEN 'FREEHOLD' WHEN 'L' THEN 'LEASEHOLD' ELSE trim(tenure) END
  NOT IN ('FREEHOLD','LEASEHOLD','SHARED_OWNERSHIP')) FROM raw_sale
UNION ALL SELECT 'transaction_category_enum', 'transaction', COUNT(*) FILTER (WHERE CASE trim(ppd_category) WHEN 'A' THEN 'STANDARD_SALE' ELSE trim(ppd_category) END
  NOT IN ('STANDARD_SALE','NEW_BUILD','OTHER')) FROM raw_sale
UNION ALL SELECT 'mortgage_type_enum', 'mortgage_product', COUNT(*) FILTER (WHERE mortgage_type NOT IN ('REPAYMENT','INTEREST_ONLY')) FROM mortgage_product""")
def q_enum_violations(spark, d):
    r = b.raw_sale(spark, d)
    raw = K.violations(r, "price_paid", {"property_type_code": ~F.trim("property_type").isin(*PROPERTY_TYPE_CODES),
                                         "tenure_code": ~F.trim("tenure").isin(*TENURE_CODES),
                                         "category_code": ~F.trim("ppd_category").isin(*CATEGORY_CODES)})
    # stored values: decoded where there is a code for them, as written where there is none (for categories: with one code unknown)
    tenure = F.coalesce(decode(F.col("tenure"), TENURE_CODES), F.trim("tenure"))
    category = F.when(F.trim("ppd_category") == "A", F.lit(CATEGORY_CODES["A"])).otherwise(F.trim("ppd_category"))
    types = K.violations(b.request(spark, d), "property", {"property_type_enum": K.not_in(F.col("form_type"), K.ENUMS["property_type_enum"])})
    a = raw.unionByName(types).unionByName(K.violations(r, "property", {"tenure_enum": K.not_in(tenure, K.ENUMS["tenure_enum"])}))
    c = K.violations(r, "transaction", {"transaction_category_enum": K.not_in(category, K.ENUMS["transaction_category_enum"])})
    m = K.violations(b.mortgage_product(spark, d), "mortgage_product",
                     {"mortgage_type_enum": ~F.col("mortgage_type").isin("REPAYMENT", "INTEREST_ONLY")})
    return a.unionByName(c).unionByName(m)


@query("null_violations", with_("location", "txn_src", "raw_sale", "hpi_index", "crime_stat", "mortgage_product", "asset_property") + f"""
SELECT 'postcode_not_null' AS contract, 'location' AS "table", COUNT(*) FILTER (WHERE postcode IS NULL) AS n FROM location
UNION ALL SELECT 'outcode_not_null', 'location', COUNT(*) FILTER (WHERE outcode IS NULL) FROM location
UNION ALL SELECT 'sale_price_not_null', 'transaction', COUNT(*) FILTER (WHERE sale_price IS NULL) FROM txn_src
UNION ALL SELECT 'sale_date_not_null', 'transaction', COUNT(*) FILTER (WHERE sale_date IS NULL) FROM txn_src
UNION ALL SELECT 'postcode_not_null', 'raw_sale', COUNT(*) FILTER (WHERE {_NPC} IS NULL) FROM raw_sale
UNION ALL SELECT 'average_price_not_null', 'hpi_index', COUNT(*) FILTER (WHERE average_price IS NULL) FROM hpi_index
UNION ALL SELECT 'annual_pct_change_not_null', 'hpi_index', COUNT(*) FILTER (WHERE annual_pct_change IS NULL) FROM hpi_index
UNION ALL SELECT 'count_not_null', 'crime_stat', COUNT(*) FILTER (WHERE count IS NULL) FROM crime_stat
UNION ALL SELECT 'category_not_null', 'crime_stat', COUNT(*) FILTER (WHERE category IS NULL) FROM crime_stat
UNION ALL SELECT 'lender_not_null', 'mortgage_product', COUNT(*) FILTER (WHERE lender IS NULL) FROM mortgage_product
UNION ALL SELECT 'product_name_not_null', 'mortgage_product', COUNT(*) FILTER (WHERE product_name IS NULL) FROM mortgage_product
UNION ALL SELECT 'source_url_not_null', 'mortgage_product', COUNT(*) FILTER (WHERE source_url IS NULL) FROM mortgage_product
UNION ALL SELECT 'floor_area_not_null', 'property', COUNT(*) FILTER (WHERE floor_area_sqm IS NULL) FROM asset_property""")
def q_null_violations(spark, d):
    loc = b.location(spark, d)
    vr, _ = valid_raw(spark, d)
    t = vr.select(F.trim("sale_price").try_cast("decimal(12,2)").alias("sale_price"),
                  F.col("sale_date").try_cast("date").alias("sale_date"))
    return (K.violations(loc, "location", {"postcode_not_null": F.col("postcode").isNull(),
                                           "outcode_not_null": F.col("outcode").isNull()})
             .unionByName(K.violations(t, "transaction", {"sale_price_not_null": F.col("sale_price").isNull(),
                                                          "sale_date_not_null": F.col("sale_date").isNull()}))
             .unionByName(K.violations(b.raw_sale(spark, d), "raw_sale",
                                       {"postcode_not_null": norm_key(F.col("postcode")).isNull()}))
             .unionByName(_nulls(b.hpi_index(spark, d), "hpi_index", ["average_price", "annual_pct_change"]))
             .unionByName(_nulls(b.crime_stat(spark, d), "crime_stat", ["count", "category"]))
             .unionByName(_nulls(b.mortgage_product(spark, d), "mortgage_product", ["lender", "product_name", "source_url"]))
             .unionByName(_nulls(asset_property(spark, d).withColumnRenamed("floor_area_sqm", "floor_area"), "property", ["floor_area"])))


def _nulls(df, table, columns):
    return K.violations(df, table, {f"{c}_not_null": F.col(c).isNull() for c in columns})


@query("width_violations", with_("location", "raw_sale", "mortgage_product") + """
SELECT 'postcode_len_10' AS contract, 'location' AS "table", COUNT(*) FILTER (WHERE length(postcode) > 10) AS n FROM location
UNION ALL SELECT 'outcode_len_6', 'location', COUNT(*) FILTER (WHERE length(outcode) > 6) FROM location
UNION ALL SELECT 'lsoa_len_20', 'location', COUNT(*) FILTER (WHERE length(CAST(lsoa_code AS VARCHAR)) > 20) FROM location
UNION ALL SELECT 'sale_price_numeric_12_2', 'transaction',
  COUNT(*) FILTER (WHERE TRY_CAST(trim(sale_price) AS DOUBLE) IS NOT NULL AND TRY_CAST(trim(sale_price) AS DECIMAL(12,2)) IS NULL) FROM raw_sale
UNION ALL SELECT 'lender_len_100', 'mortgage_product', COUNT(*) FILTER (WHERE length(lender) > 100) FROM mortgage_product
UNION ALL SELECT 'product_name_len_255', 'mortgage_product', COUNT(*) FILTER (WHERE length(product_name) > 255) FROM mortgage_product
UNION ALL SELECT 'source_url_len_500', 'mortgage_product', COUNT(*) FILTER (WHERE length(source_url) > 500) FROM mortgage_product
UNION ALL SELECT 'max_ltv_numeric_5_2', 'mortgage_product', COUNT(*) FILTER (WHERE abs(max_ltv_pct) >= 1000) FROM mortgage_product
UNION ALL SELECT 'initial_rate_numeric_5_3', 'mortgage_product', COUNT(*) FILTER (WHERE abs(initial_rate_pct) >= 100) FROM mortgage_product
UNION ALL SELECT 'product_fee_numeric_8_2', 'mortgage_product', COUNT(*) FILTER (WHERE abs(product_fee_gbp) >= 1000000) FROM mortgage_product""")
def q_width_violations(spark, d):
    loc = b.location(spark, d)
    r = b.raw_sale(spark, d)
    sp = F.trim("sale_price")
    return (K.violations(loc, "location", {"postcode_len_10": F.length("postcode") > 10,
                                           "outcode_len_6": F.length("outcode") > 6,
                                           "lsoa_len_20": F.length(F.col("lsoa_code").cast("string")) > 20})
             .unionByName(K.violations(r, "transaction", {"sale_price_numeric_12_2":
                                                          sp.try_cast("double").isNotNull() & sp.try_cast("decimal(12,2)").isNull()}))
             .unionByName(K.violations(b.mortgage_product(spark, d), "mortgage_product", {
                 "lender_len_100": F.length("lender") > 100, "product_name_len_255": F.length("product_name") > 255,
                 "source_url_len_500": F.length("source_url") > 500, "max_ltv_numeric_5_2": F.abs("max_ltv_pct") >= 1000,
                 "initial_rate_numeric_5_3": F.abs("initial_rate_pct") >= 100, "product_fee_numeric_8_2": F.abs("product_fee_gbp") >= 1_000_000})))


# written out here, so that a wrong constant of the library shows
SQL_DQ = [("Completeness", "location_count", 100000, "gte"), ("Completeness", "property_count", 100000, "gte"),
          ("Completeness", "transaction_count", 490000, "gte"), ("Completeness", "rental_index_count", 500, "gte"),
          ("Completeness", "hpi_index_count", 500, "gte"), ("Completeness", "crime_stat_count", 10000, "gte"),
          ("Completeness", "mortgage_product_count", 15, "eq"), ("Validity", "invalid_sale_prices", 0, "eq"),
          ("Timeliness", "future_sale_dates", 0, "eq"), ("Validity", "invalid_bedrooms", 0, "eq"), ("Validity", "negative_crime_counts", 0, "eq")]


@query("dq_checks", with_("pc_clean", "props", "txn_src", "rental_index", "hpi_index", "crime_stat", "mortgage_product",
                          "asset_property") + f"""
, v AS (SELECT (SELECT COUNT(*) FROM pc_clean) AS location_count, (SELECT COUNT(*) FROM props) AS property_count,
         (SELECT COUNT(*) FROM txn_src t JOIN props p USING (postcode)) AS transaction_count,
         (SELECT COUNT(*) FROM rental_index) AS rental_index_count, (SELECT COUNT(*) FROM hpi_index) AS hpi_index_count,
         (SELECT COUNT(*) FROM crime_stat) AS crime_stat_count, (SELECT COUNT(*) FROM mortgage_product) AS mortgage_product_count,
         (SELECT COUNT(*) FROM txn_src WHERE sale_price <= 0 OR sale_price >= 100000000) AS invalid_sale_prices,
         (SELECT COUNT(*) FROM txn_src WHERE sale_date > {AS_OF_SALE}) AS future_sale_dates,
         (SELECT COUNT(*) FROM asset_property WHERE bedrooms < 0 OR bedrooms > 20) AS invalid_bedrooms,
         (SELECT COUNT(*) FROM crime_stat WHERE count < 0) AS negative_crime_counts)
SELECT dimension, metric, CAST(value AS BIGINT) AS value, CAST(threshold AS BIGINT) AS threshold,
       CASE op WHEN 'gte' THEN value >= threshold WHEN 'eq' THEN value = threshold ELSE value <= threshold END AS pass
FROM (""" + " UNION ALL ".join(f"SELECT '{dm}' AS dimension, '{m}' AS metric, {m} AS value, {t} AS threshold, '{op}' AS op FROM v"
                               for dm, m, t, op in SQL_DQ) + ")")
def q_dq_checks(spark, d):
    as_of = b.sale_as_of(spark, d)
    loc = C.clean_postcodes(b.raw_postcode(spark, d))
    vr, _ = valid_raw(spark, d)
    # per address first: that is the property count, and properties times sales of a postcode is what a join would make
    p, sold = F.trim("sale_price").try_cast("decimal(12,2)"), F.col("sale_date").try_cast("date")
    bad = [F.count_if(F.coalesce(x, F.lit(False))) for x in ((p <= 0) | (p >= 100_000_000), sold > F.lit(as_of))]
    by_address = vr.groupBy(C.address_key(vr).alias("address_key"), norm_key(F.col("postcode")).alias("postcode")).agg(
        F.count(F.lit(1)).alias("sales"), bad[0].alias("prices"), bad[1].alias("dates"))
    by_postcode = by_address.groupBy("postcode").agg(F.count(F.lit(1)).alias("props"), *[F.sum(c).alias(c) for c in ("sales", "prices", "dates")])
    t = by_postcode.agg(F.coalesce(F.sum("props"), F.lit(0)).alias("property_count"), F.coalesce(F.sum(F.col("props") * F.col("sales")), F.lit(0)).alias("transaction_count"),
                        F.coalesce(F.sum("prices"), F.lit(0)).alias("invalid_sale_prices"), F.coalesce(F.sum("dates"), F.lit(0)).alias("future_sale_dates"))
    sales = t.selectExpr("stack(4, 'property_count', property_count, 'transaction_count', transaction_count, "
                         "'invalid_sale_prices', invalid_sale_prices, 'future_sale_dates', future_sale_dates) as (metric, value)")

    def cnt(df, metrics: dict):
        """All metrics of one relation in a single aggregation, unpivoted to (metric, value) rows."""
        agg = df.agg(*[F.count_if(F.coalesce(pred, F.lit(False))).alias(m) for m, pred in metrics.items()])
        stack = ", ".join(f"'{m}', `{m}`" for m in metrics)
        return agg.selectExpr(f"stack({len(metrics)}, {stack}) as (metric, value)")

    every = F.lit(True)
    parts = [cnt(loc, {"location_count": every}), sales, cnt(b.rental_index(spark, d), {"rental_index_count": every}),
             cnt(b.hpi_index(spark, d), {"hpi_index_count": every}),
             cnt(b.crime_stat(spark, d), {"crime_stat_count": every, "negative_crime_counts": F.col("count") < 0}),
             cnt(b.mortgage_product(spark, d), {"mortgage_product_count": every}),
             cnt(asset_property(spark, d), {"invalid_bedrooms": (F.col("bedrooms") < 0) | (F.col("bedrooms") > 20)})]
    v = parts[0]
    for p in parts[1:]:
        v = v.unionByName(p)
    return K.dq_table(v)

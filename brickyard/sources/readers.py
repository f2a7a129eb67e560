"""Readers for the landed feed formats.

Each reader has a file form (``spark.read…``) and a column form that parses
text already in a DataFrame, so the same parsing rules serve batch files,
streams and staged text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.postcode import js_parse_float, parse_month

# The 16 columns of the price-paid file, in file order.
PPD_COLUMNS = ["txn_uid", "sale_price", "sale_date", "postcode", "property_type", "new_build", "tenure", "paon",
               "saon", "street", "locality", "town", "district", "county", "ppd_category", "record_status"]

# Quoted empty fields read as '' (like the reference's CSV parser); the NUL sentinel keeps
# Spark from turning them into NULL.  Missing trailing columns of ragged rows are NULL.
CSV_READ = {"mode": "PERMISSIVE", "quote": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
            "nullValue": "\u0000"}
CSV_WRITE = {"quote": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "quoteAll": "true"}


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def header_columns(header_line: str) -> list[str]:
    """Column names of a side-car header line (quotes and blanks stripped)."""
    return [c.replace('"', "").strip() for c in header_line.strip().split(",")]


def read_csv_with_header_file(spark: SparkSession, data_path: str, header_path: str) -> DataFrame:
    """Headerless CSV whose column names live in a separate one-line file."""
    header = spark.read.text(header_path).first()[0]
    return spark.read.schema(string_schema(header_columns(header))).options(**CSV_READ).csv(data_path)


def read_ppd(spark: SparkSession, path: str) -> DataFrame:
    """Headerless 16-column price-paid CSV (S2); a directory stream uses the same schema (S3)."""
    return spark.read.schema(string_schema(PPD_COLUMNS)).options(**CSV_READ).csv(path)


def to_csv_line(df: DataFrame, columns: list[str]) -> Column:
    return F.to_csv(F.struct(*[F.col(c) for c in columns]), CSV_WRITE)


HPI_PREFIX = "ukhpi:"


def read_hpi_json(docs: DataFrame, json_col: str, key_col: str) -> DataFrame:
    """``result.items[]`` → rows; the month is a string *or* ``{"@value": …}``; no month → skipped.

    A document is parsed once, to a map per item; only a month that is an object is parsed again.
    """
    parsed = F.from_json(F.col(json_col), "result STRUCT<items: ARRAY<MAP<STRING, STRING>>>")
    items = docs.select(key_col, F.explode(parsed.getField("result").getField("items")).alias("_it"))
    field = lambda f: F.try_element_at("_it", F.lit(f"{HPI_PREFIX}{f}"))
    text = field("refMonth")
    month = F.when(text.startswith("{"), F.get_json_object(text, "$['@value']")).otherwise(text)
    num = lambda f: field(f).try_cast("double")
    return items.select(key_col, "_it", month.alias("_month")).where(F.col("_month").isNotNull()).select(
        F.col(key_col).alias("outcode"), F.concat("_month", F.lit("-01")).try_cast("date").alias("reference_month"),
        num("averagePrice").alias("average_price"), num("housePriceIndex").alias("index_value"),
        num("percentageAnnualChange").alias("annual_pct_change"))


def read_wide_index(lines: DataFrame, header_marker: str, keep: str) -> DataFrame:
    """Wide CSV with preamble → long.

    ``lines`` has (line_no, line).  The first line with a cell matching
    ``header_marker`` is the header; later lines starting with 4 digits are
    data; regions whose name matches ``keep`` are kept; unparsable values dropped.
    """
    cells = F.transform(F.split(F.col("line"), ","), lambda c: F.trim(F.regexp_replace(c, '"', "")))
    x = lines.select("line_no", cells.alias("cells"))
    hdr = x.where(F.exists("cells", lambda c: F.lower(c).rlike(header_marker)))
    first = hdr.agg(F.min("line_no").alias("h")).first()["h"]
    if first is None:
        return lines.sparkSession.createDataFrame([], "region string, reference_month date, index_value double")
    header = hdr.where(F.col("line_no") == first).select(F.posexplode("cells").alias("pos", "region")).where(F.col("pos") > 0)
    data = (x.where((F.col("line_no") > first) & F.element_at("cells", 1).rlike(r"^\d{4}"))
             .select(parse_month(F.element_at("cells", 1)).alias("reference_month"), F.posexplode("cells").alias("pos", "v"))
             .where((F.col("pos") > 0) & F.col("reference_month").isNotNull()))
    j = data.join(F.broadcast(header.select("pos", "region")), "pos")
    val = js_parse_float(F.col("v"))
    return j.where(val.isNotNull() & F.lower("region").rlike(keep) & (F.length("region") > 0)).select(
        F.trim("region").alias("region"), "reference_month", val.alias("index_value"))


def wide_index_skips(lines: DataFrame, header_marker: str, keep: str) -> DataFrame:
    """reason, n over all filled cells below the header: ``kept``, or why ``read_wide_index`` leaves one out."""
    cells = F.transform(F.split(F.col("line"), ","), lambda c: F.trim(F.regexp_replace(c, '"', "")))
    x = lines.select("line_no", cells.alias("cells"))
    hdr = x.where(F.exists("cells", lambda c: F.lower(c).rlike(header_marker)))
    head = hdr.agg(F.min_by(F.struct("line_no", "cells"), "line_no").alias("h")).first()["h"]
    if head is None:
        return lines.sparkSession.createDataFrame([], "reason string, n long")
    names = F.array(*[F.lit(c.lower()) for c in head["cells"]])
    rows = x.where(F.col("line_no") > head["line_no"]).select(F.element_at("cells", 1).alias("label"), F.posexplode("cells").alias("pos", "v"))
    region = F.element_at(names, F.least(F.col("pos") + 1, F.lit(len(head["cells"]))))
    reason = (F.when(js_parse_float(F.col("v")).isNull(), "no_number").when(~region.rlike(keep) | (F.length(region) == 0), "region")
              .when(~F.col("label").rlike(r"^\d{4}"), "no_leading_year").when(parse_month(F.col("label")).isNull(), "no_month").otherwise("kept"))
    return rows.where((F.col("pos") > 0) & (F.length("v") > 0)).groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def count_incidents(docs: DataFrame, json_col: str, keys: list[str]) -> DataFrame:
    """JSON array of incidents → count per category, blank category → 'other' (S6)."""
    inc = docs.select(*keys, F.explode(F.from_json(F.col(json_col), "ARRAY<STRUCT<category: STRING>>")).alias("_i"))
    cat = F.coalesce(F.when(F.length(F.col("_i.category")) > 0, F.col("_i.category")), F.lit("other"))
    return inc.groupBy(*keys, cat.alias("category")).agg(F.count(F.lit(1)).alias("n"))


EPC_FIELDS = ["uprn", "number-habitable-rooms", "total-floor-area", "current-energy-rating",
              "current-energy-efficiency", "construction-age-band"]


def read_epc(docs: DataFrame, json_col: str) -> DataFrame:
    """Kebab-case string fields → typed columns with parseInt/parseFloat prefix semantics; no UPRN → dropped."""
    s = "STRUCT<" + ", ".join(f"`{f}`: STRING" for f in EPC_FIELDS) + ">"
    r = docs.select(F.explode(F.from_json(F.col(json_col), f"STRUCT<rows: ARRAY<{s}>>").getField("rows")).alias("_r"))

    def js_int(c: Column) -> Column:
        m = F.regexp_extract(c, r"^\s*([+-]?[0-9]+)", 1)
        return F.when(F.length(m) > 0, m.try_cast("long"))

    f = lambda n: F.col("_r").getField(n)
    uprn = js_int(f("uprn"))
    return r.where(uprn.isNotNull()).select(
        uprn.alias("uprn"), js_int(f("number-habitable-rooms")).alias("bedrooms"),
        js_parse_float(f("total-floor-area")).alias("floor_area_sqm"), f("current-energy-rating").alias("epc_rating"),
        js_int(f("current-energy-efficiency")).alias("epc_score"), f("construction-age-band").alias("construction_age_band"))


def read_features(docs: DataFrame, json_col: str, key_col: str, fallback: DataFrame, min_features: int = 20) -> DataFrame:
    """GeoJSON FeatureCollection accepted iff its type matches and it has ≥ ``min_features``
    features; otherwise the document's centroid points (``fallback``: key, name, lng, lat) are used (S11)."""
    fs = "STRUCT<type: STRING, features: ARRAY<STRUCT<properties: STRUCT<name: STRING>, geometry: STRUCT<type: STRING>>>>"
    d = docs.select(key_col, F.from_json(F.col(json_col), fs).alias("_g"))
    ok = (F.col("_g.type") == "FeatureCollection") & (F.coalesce(F.size("_g.features"), F.lit(0)) >= min_features)
    good = d.where(ok).select(key_col, F.explode("_g.features").alias("_f")).select(
        key_col, F.col("_f.properties.name").alias("name"), F.col("_f.geometry.type").alias("geometry_type"),
        F.lit("geojson").alias("source"))
    bad = d.where(~ok).select(key_col)
    pts = fallback.join(bad, key_col, "left_semi").select(key_col, "name", F.lit("Point").alias("geometry_type"),
                                                           F.lit("centroid").alias("source"))
    return good.unionByName(pts)


def accumulate(candidates: list[tuple[str, DataFrame]], keys: list[str], min_rows: int, supplement=None) -> DataFrame:
    """Sources added up in order until they have ``min_rows`` rows, then supplemented.

    Each source's rows join those before it; the next one is read only while
    the sum is below ``min_rows``.  If all together have fewer, ``supplement``
    makes rows from what there is, and those with a new key are added as
    ``generated``.  Of rows with one key the latest source's stays, as an upsert
    of the list would leave it.  The counts are bounded by ``min_rows``.
    """
    taken, total = None, 0
    for rank, (name, rows) in enumerate(candidates):
        total += rows.limit(min_rows).count()
        own = rows.withColumn("source", F.lit(name)).withColumn("_rank", F.lit(rank))
        taken = own if taken is None else taken.unionByName(own)
        if total >= min_rows:
            break
    values = [c for c in taken.columns if c not in keys and c != "_rank"]
    kept = (taken.groupBy(*keys).agg(F.max_by(F.struct(*values), "_rank").alias("_v"))
            .select(*keys, *[F.col("_v")[c].alias(c) for c in values]))
    if total >= min_rows or supplement is None:
        return kept
    made = supplement(kept.drop("source")).join(kept.select(*keys), keys, "left_anti")
    return kept.unionByName(made.withColumn("source", F.lit("generated")).select(*kept.columns))

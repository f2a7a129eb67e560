"""Registered queries: streaming intakes (checked against their batch equivalents) and text jobs (step 8)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import textjobs as X
from ..sources import bindings as b
from ..sources.readers import CSV_WRITE, PPD_COLUMNS, to_csv_line
from ..sources.tables import read, scalar
from ..streaming import intake as S
from .oracle_bindings import with_
from .q_clean import _NPC
from .registry import query

STREAM_CHUNKS = 4


@query("stream_sales", with_("raw_sale", "validated") + f"""
SELECT r.txn_uid, {_NPC} AS postcode, TRY_CAST(trim(r.sale_price) AS DECIMAL(12,2)) AS sale_price,
       TRY_CAST(r.sale_date AS DATE) AS sale_date
FROM raw_sale r WHERE r.sale_id IN (SELECT sale_id FROM validated WHERE valid)""")
def q_stream_sales(spark, d):
    raw = b.raw_sale(spark, d).select(
        "sale_id", *[F.col(c) if c in ("txn_uid", "sale_price", "sale_date", "postcode", "property_type", "tenure", "paon",
                                          "saon", "street", "town", "ppd_category") else F.lit("").alias(c)
                     for c in PPD_COLUMNS])
    root = S.work_dir(spark, "stream-sales")
    landing = f"{root}/landing"
    # land the feed as several CSV drops; the last drop repeats earlier rows (replayed file)
    for i in range(STREAM_CHUNKS):
        part = raw.where(F.col("sale_id") % STREAM_CHUNKS == i)
        part.select(to_csv_line(part, PPD_COLUMNS).alias("value")).write.mode("append").text(landing)
    # sent again with another date, in another month: the stored sale stays as it is
    again = raw.where(F.col("sale_id") % 10 == 0).withColumn(
        "sale_date", F.coalesce(F.date_sub(F.col("sale_date").try_cast("date"), 40).cast("string"), F.col("sale_date")))
    again.select(to_csv_line(again, PPD_COLUMNS).alias("value")).write.mode("append").text(landing)
    london = C.clean_postcodes(b.raw_postcode(spark, d))
    return S.stream_sales(spark, landing, london, b.sale_as_of(spark, d), f"{root}/store", f"{root}/checkpoint")


@query("stream_crime_counts", with_("crime_stat") + "SELECT * FROM crime_stat")
def q_stream_crime_counts(spark, d):
    ev = read(spark, d, "events")
    root = S.work_dir(spark, "stream-crime")
    landing = f"{root}/landing"
    # land events in the order of dates, a fifth of the time per drop
    day = F.col("ts").cast("date")
    first, last = ev.agg(F.min(day), F.max(day)).first()
    span = (last - first).days // 5 + 1 if first else 1
    for i in range(5 if first else 0):
        at = first + dt.timedelta(days=i * span)
        ev.where((day >= F.lit(at)) & (day < F.lit(at + dt.timedelta(days=span)))).write.mode("append").parquet(landing)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ev.schema.fields)
    # the files of a drop come in any order, so events may be a drop's time late
    return S.stream_crime_counts(spark, landing, schema, f"{root}/store", f"{root}/checkpoint", watermark=f"{span + 1} days")


def ref_docs(spark, d):
    """Reference lists as whole text documents (50 parts each), mixing book/DOI/web/plain lines."""
    p = read(spark, d, "part", ["p_partkey", "p_name", "p_size"])
    pages = read(spark, d, "pages", ["page_id", "url"])
    npages = scalar(pages.agg(F.count(F.lit(1)).alias("n")), "n")
    k = F.col("p_partkey")
    surname = F.initcap(F.split("p_name", " ").getItem(0))
    initial = F.upper(F.substring(F.split("p_name", " ").getItem(1), 1, 1))
    head = F.concat(surname, F.lit(", "), initial, F.lit(". ("), (1950 + F.col("p_size")).cast("string"), F.lit(") '"),
                    F.col("p_name"), F.lit("'."))
    isbn = F.concat(F.lit("978-0-"), F.lpad((k % 100000).cast("string"), 5, "0"), F.lit("-"),
                    F.lpad((k % 1000).cast("string"), 3, "0"), F.lit("-"), (k % 10).cast("string"))
    x = p.withColumn("_pg", k % F.lit(npages))
    x = x.join(pages, x._pg == pages.page_id, "left")
    line = (F.when(k % 4 == 0, F.concat(head, F.lit(" London: Press. ISBN: "), isbn))
             .when(k % 4 == 1, F.concat(head, F.lit(" Journal of Parts, 12(3). doi:10.5555/"), k.cast("string"), F.lit(",")))
             .when(k % 4 == 2, F.concat(head, F.lit(" Available at: "), F.col("url"), F.lit(".")))
             .otherwise(F.concat(F.col("p_name"), F.lit(" — notes"))))
    lines = x.select((k / 50).cast("long").alias("doc_id"), k.alias("k"), line.alias("line"))
    return lines.groupBy("doc_id").agg(
        F.concat(F.lit("# References\n"), F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("k", "line"))),
                                                                          lambda s: s.getField("line")))).alias("text"))


def _ref_sql() -> str:
    surname = "upper(substring(split_part(p_name, ' ', 1), 1, 1)) || lower(substring(split_part(p_name, ' ', 1), 2))"
    initial = "upper(substring(split_part(p_name, ' ', 2), 1, 1))"
    head = f"{surname} || ', ' || {initial} || '. (' || CAST(1950 + p_size AS VARCHAR) || ') ''' || p_name || '''.'"
    isbn = ("'978-0-' || lpad(CAST(p_partkey % 100000 AS VARCHAR), 5, '0') || '-' || lpad(CAST(p_partkey % 1000 AS VARCHAR), 3, '0')"
            " || '-' || CAST(p_partkey % 10 AS VARCHAR)")
    return f"""
WITH x AS (SELECT p.*, g.url FROM part p LEFT JOIN pages g ON g.page_id = p.p_partkey % (SELECT COUNT(*) FROM pages)),
l AS (SELECT CAST(p_partkey // 50 AS BIGINT) AS doc_id, p_partkey,
             CASE p_partkey % 4 WHEN 0 THEN {head} || ' London: Press. ISBN: ' || {isbn}
                                WHEN 1 THEN {head} || ' Journal of Parts, 12(3). doi:10.5555/' || CAST(p_partkey AS VARCHAR) || ','
                                WHEN 2 THEN {head} || ' Available at: ' || url || '.'
                                ELSE p_name || ' — notes' END AS raw FROM x),
n AS (SELECT doc_id, CAST(ROW_NUMBER() OVER (PARTITION BY doc_id ORDER BY p_partkey) AS INTEGER) AS line_no, trim(raw) AS raw FROM l)
SELECT doc_id, line_no,
       replace(NULLIF(regexp_extract(raw, '(?i)ISBN[:\\s]*([0-9-Xx]{{10,17}})', 1), ''), '-', '') AS isbn,
       COALESCE(NULLIF(regexp_extract(raw, '(?i)doi[:\\s]*(10\\.\\d{{4,}}/[^\\s,)]+)', 1), ''),
                NULLIF(regexp_extract(raw, '(10\\.\\d{{4,}}/[^\\s,)]+)', 1), '')) AS doi,
       regexp_replace(NULLIF(regexp_extract(raw, '(https?://[^\\s)]+)', 1), ''), '[.,;]+$', '') AS url,
       NULLIF(regexp_extract(raw, '^([A-Z][a-zA-Z''-]+(?:,\\s*[A-Z]\\.?(?:\\s*[A-Z]\\.?)*)?)', 1), '') AS author,
       NULLIF(regexp_extract(raw, '\\((\\d{{4}})\\)', 1), '') AS year,
       regexp_replace(trim(NULLIF(regexp_extract(raw, '\\(\\d{{4}}\\)\\s*[''"]?([^.''"]+)', 1), '')), '[''"]+$', '') AS title,
       CASE WHEN COALESCE(NULLIF(regexp_extract(raw, '(?i)doi[:\\s]*(10\\.\\d{{4,}}/[^\\s,)]+)', 1), ''),
                          NULLIF(regexp_extract(raw, '(10\\.\\d{{4,}}/[^\\s,)]+)', 1), '')) IS NOT NULL THEN 'journal'
            WHEN NULLIF(regexp_extract(raw, '(?i)ISBN[:\\s]*([0-9-Xx]{{10,17}})', 1), '') IS NOT NULL THEN 'book'
            WHEN NULLIF(regexp_extract(raw, '(https?://[^\\s)]+)', 1), '') IS NOT NULL THEN 'web'
            ELSE 'unknown' END AS type
FROM n WHERE length(raw) > 0"""


@query("extract_references", _ref_sql())
def q_extract_references(spark, d):
    return X.extract_references(X.reference_lines(ref_docs(spark, d), "doc_id", "text"))


# Names to look for in the corpus; the first half also has reference entries.
MENTION_NAMES = ["thing", "nicht", "mente", "ating", "attion", "erble", "ersch", "heble"]
LISTED_NAMES = MENTION_NAMES[:4]


@query("unmatched_mentions", "SELECT d.doc_id, n.name FROM documents d, (SELECT unnest(["
       + ", ".join(f"'{n}'" for n in MENTION_NAMES[4:]) + "]) AS name) n "
       "WHERE regexp_matches(d.text, '(?i)(^|[^A-Za-z0-9_])' || n.name || '([^A-Za-z0-9_]|$)')")
def q_unmatched_mentions(spark, d):
    docs = read(spark, d, "documents", ["doc_id", "text"])
    entries = spark.createDataFrame([(f"{n.title()}, A. (2020) 'On {n}'.",) for n in LISTED_NAMES], "line string")
    return X.unmatched_mentions(docs, "doc_id", "text", MENTION_NAMES, entries)

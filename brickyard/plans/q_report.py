"""Registered queries: page computations, gap fill, listings (step 7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import decision as D
from ..operators import ranking as R
from ..operators import report as T
from ..operators import series
from ..sources import bindings as b
from ..sources.tables import read
from .oracle_bindings import register, with_
from .q_metrics import metrics_table
from .registry import ORACLE, query

register("crime_group", ["crime_stat", "location"], ORACLE["crime_by_group"][ORACLE["crime_by_group"].index("SELECT l.borough"):]
         .replace(" ORDER BY crime_rate DESC", ""))


def _crime_group(spark, d):
    return D.crime_by_group(b.crime_stat(spark, d), b.location(spark, d), b.crime_as_of(spark, d))


@query("minmax_scale", with_("outcode_metrics") + """
SELECT outcode,
       round((yoy_price_growth_pct - x0) / CASE WHEN x1 - x0 <> 0 THEN x1 - x0 ELSE 1.0 END * 80 + 10, 6) AS x_pct,
       round(90 - (avg_yield_pct - y0) / CASE WHEN y1 - y0 <> 0 THEN y1 - y0 ELSE 1.0 END * 80, 6) AS y_pct
FROM outcode_metrics, (SELECT min(yoy_price_growth_pct) AS x0, max(yoy_price_growth_pct) AS x1,
                              min(avg_yield_pct) AS y0, max(avg_yield_pct) AS y1 FROM outcode_metrics)""")
def q_minmax_scale(spark, d):
    return T.minmax_scale(metrics_table(spark, d), "yoy_price_growth_pct", "avg_yield_pct", "outcode")


@query("relative_rate", with_("crime_group") + """
SELECT borough, crime_rate, round(greatest(CASE WHEN mx > 0 THEN crime_rate / mx * 100 ELSE 0.0 END, 2.0), 6) AS pct,
       CAST(floor((1 - crime_rate / mx) * 120 + 0.5) AS BIGINT) AS hue
FROM crime_group, (SELECT max(crime_rate) AS mx FROM crime_group)""")
def q_relative_rate(spark, d):
    return T.relative_rate(_crime_group(spark, d), "borough", "crime_rate")


@query("top_bottom_k", with_("crime_group") + """
SELECT side, CAST(rk AS BIGINT) AS rank, borough, crime_rate FROM (
  SELECT 'safest' AS side, ROW_NUMBER() OVER (ORDER BY crime_rate ASC, borough ASC) AS rk, borough, crime_rate FROM crime_group
  UNION ALL
  SELECT 'least_safe', ROW_NUMBER() OVER (ORDER BY crime_rate DESC, borough DESC), borough, crime_rate FROM crime_group)
WHERE rk <= 5""")
def q_top_bottom_k(spark, d):
    return T.top_bottom_k(_crime_group(spark, d), "borough", "crime_rate")


_DRILL = ORACLE["drilldown"]


@query("chart_series", _DRILL.replace("SELECT geo_level, geo_value, month, CAST(avg_micro AS DOUBLE) / 1000000.0 AS avg_price,",
                                      ", fin AS (SELECT geo_level, geo_value, month, CAST(avg_micro AS DOUBLE) / 1000000.0 AS avg_price,")
       + ")\nSELECT geo_level, geo_value, strftime(month, '%Y-%m') AS month, COALESCE(rolling_12m_avg, 0.0) AS rolling, "
         "COALESCE(yoy_growth_pct, 0.0) AS yoy FROM fin")
def q_chart_series(spark, d):
    s = b.sale(spark, d)
    return T.chart_series(series.drilldown(s, b.sale_as_of(spark, d)))


@query("latest_trend", _DRILL.replace("SELECT geo_level, geo_value, month, CAST(avg_micro AS DOUBLE) / 1000000.0 AS avg_price,",
                                      ", fin AS (SELECT geo_level, geo_value, month, CAST(avg_micro AS DOUBLE) / 1000000.0 AS avg_price,")
       + """)
SELECT geo_level, geo_value, strftime(max(month), '%Y-%m') AS last_month, arg_max(yoy_growth_pct, month) AS yoy,
       CASE WHEN arg_max(yoy_growth_pct, month) IS NOT NULL AND arg_max(yoy_growth_pct, month) <> 0
            THEN geo_value || ': ' || (CASE WHEN arg_max(yoy_growth_pct, month) > 0 THEN '+' ELSE '' END)
                 || CAST(CAST(round(CAST(arg_max(yoy_growth_pct, month) AS DECIMAL(12,2)), 1) AS DECIMAL(12,1)) AS VARCHAR) || '% YoY'
            ELSE geo_value || ' trend' END AS trend
FROM fin GROUP BY geo_level, geo_value""")
def q_latest_trend(spark, d):
    s = b.sale(spark, d)
    return T.latest_trend(series.drilldown(s, b.sale_as_of(spark, d)))


@query("list_products", with_("mortgage_product") + """
SELECT mortgage_product_id, lender, product_name, mortgage_type, max_ltv_pct, CAST(initial_rate_pct AS DOUBLE) AS initial_rate_pct,
       initial_period_months, CAST(follow_on_rate_pct AS DOUBLE) AS follow_on_rate_pct, product_fee_gbp, captured_at, source_url FROM mortgage_product ORDER BY lender, product_name""")
def q_list_products(spark, d):
    p = b.mortgage_product(spark, d)
    return p.select("mortgage_product_id", "lender", "product_name", "mortgage_type", "max_ltv_pct",
                    F.col("initial_rate_pct").cast("double").alias("initial_rate_pct"), "initial_period_months",
                    F.col("follow_on_rate_pct").cast("double").alias("follow_on_rate_pct"), "product_fee_gbp", "captured_at", "source_url") \
            .orderBy("lender", "product_name")


@query("distinct_lsoa", with_("location") + """
SELECT DISTINCT lsoa_code FROM location WHERE lsoa_code IS NOT NULL AND length(trim(CAST(lsoa_code AS VARCHAR))) > 0""")
def q_distinct_lsoa(spark, d):
    return T.distinct_lsoa(b.location(spark, d))


@query("latest_months", with_("crime_stat") + """
SELECT DISTINCT reference_period AS month FROM crime_stat ORDER BY month DESC LIMIT 12""")
def q_latest_months(spark, d):
    return T.latest_months(b.crime_stat(spark, d), "reference_period", 12)


@query("nearest_rank_quantiles", """
SELECT event_type, CAST(floor(list_sort(list(value))[CAST(floor(count(*) * 0.5) AS BIGINT) + 1] + 0.5) AS BIGINT) AS p50,
       CAST(floor(list_sort(list(value))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] + 0.5) AS BIGINT) AS p95,
       CAST(floor(list_sort(list(value))[CAST(floor(count(*) * 0.99) AS BIGINT) + 1] + 0.5) AS BIGINT) AS p99
FROM events WHERE value IS NOT NULL GROUP BY event_type""")
def q_nearest_rank_quantiles(spark, d):
    e = read(spark, d, "events", ["event_type", "value"])
    return R.nearest_rank(e, ["event_type"], "value", {"p50": "0.5", "p95": "0.95", "p99": "0.99"}, rounded=True)


register("hpi_holes", ["hpi_index"], """
SELECT * FROM hpi_index WHERE (month(reference_month) + CAST(regexp_extract(outcode, '[0-9]+$') AS INTEGER)) % 5 <> 0""")


def _hpi_holes(spark, d):
    h = b.hpi_index(spark, d)
    return h.where((F.month("reference_month") + F.regexp_extract("outcode", r"[0-9]+$", 0).cast("int")) % 5 != 0)


@query("gap_fill", with_("hpi_holes") + """
, base AS (SELECT outcode, arg_max(average_price, reference_month) AS b FROM hpi_holes GROUP BY outcode),
grid AS (SELECT outcode, b, m, CAST((SELECT max(reference_month) FROM hpi_holes) - to_months(CAST(m AS INTEGER)) AS DATE) AS reference_month
         FROM base, (SELECT unnest(range(0, 36)) AS m))
SELECT outcode, reference_month, average_price, index_value, false AS is_generated FROM hpi_holes
UNION ALL
SELECT g.outcode, g.reference_month, CAST(floor(g.b * pow(1 - 0.03 / 12, CAST(g.m AS DOUBLE)) + 0.5) AS DOUBLE),
       CAST(100.0 + (36 - g.m) * 0.25 AS DOUBLE), true
FROM grid g ANTI JOIN hpi_holes h ON h.outcode = g.outcode AND h.reference_month = g.reference_month""")
def q_gap_fill(spark, d):
    return T.gap_fill(_hpi_holes(spark, d))

"""Registered queries: outcode metrics, growth, crime index, quartiles, quadrant, compare (step 2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import metrics as M
from ..sources import bindings as b
from .oracle_bindings import AS_OF_CRIME, AS_OF_SALE, register, with_
from .registry import query
from .sqlfrag import HU, RATIO, STDDEV

COMPARE_OUTCODES = ["nation_1", "NATION_7", "NATION_13", "NATION_24"]
COMPARE_REQUESTED = ["NATION_3", "nation_11", "NATION_99"]

RECENT = f"(SELECT * FROM sale WHERE outcode IS NOT NULL AND sale_date >= {AS_OF_SALE} - INTERVAL 12 MONTH)"
CRIME12 = f"(SELECT * FROM crime_stat WHERE reference_period >= {AS_OF_CRIME} - INTERVAL 12 MONTH)"

register("price_growth", ["hpi_index"], f"""
SELECT outcode, {HU('(a0 - a12) * 100', 'a12', 6)} AS yoy_price_growth_pct,
       {HU('(a0 - a36) * 100', 'a36', 6)} AS three_year_price_growth_pct
FROM (SELECT outcode,
             MAX(CASE WHEN reference_month = m0 THEN avg_cents END) AS a0,
             MAX(CASE WHEN reference_month = m0 - INTERVAL 12 MONTH THEN avg_cents END) AS a12,
             MAX(CASE WHEN reference_month = m0 - INTERVAL 36 MONTH THEN avg_cents END) AS a36
      FROM hpi_index, (SELECT MAX(reference_month) AS m0 FROM hpi_index) GROUP BY outcode)
WHERE a0 IS NOT NULL""")

register("crime_rate", ["crime_stat", "location"], f"""
SELECT l.outcode, {HU('SUM(cs.count)', 'COUNT(DISTINCT cs.reference_period)', 6)} AS crime_rate_index
FROM {CRIME12} cs JOIN location l ON l.lsoa_code = cs.lsoa_code GROUP BY l.outcode""")

register("outcode_metrics", ["sale", "rental_index", "price_growth", "crime_rate"], f"""
SELECT *, CASE WHEN yield_quartile >= 3 AND growth_quartile >= 3 THEN 'UNICORN'
               WHEN yield_quartile >= 3 THEN 'CASH_COW' WHEN growth_quartile >= 3 THEN 'GROWTH_PLAY'
               ELSE 'AVOID' END AS quadrant
FROM (
  SELECT *, CAST(NTILE(4) OVER (ORDER BY avg_yield_pct ASC NULLS LAST, outcode) AS BIGINT) AS yield_quartile,
            CAST(NTILE(4) OVER (ORDER BY yoy_price_growth_pct ASC NULLS LAST, outcode) AS BIGINT) AS growth_quartile
  FROM (
    SELECT s.outcode, s.median_sale_price_12m,
           COALESCE(CASE WHEN s.median_sale_price_12m > 0
                         THEN {HU('r.index_centi * 120000', 'CAST(ROUND(s.median_sale_price_12m * 10000) AS BIGINT)', 6)} END, 0.0) AS avg_yield_pct,
           COALESCE(g.yoy_price_growth_pct, 0.0) AS yoy_price_growth_pct,
           COALESCE(g.three_year_price_growth_pct, 0.0) AS three_year_price_growth_pct,
           COALESCE(CASE WHEN {RATIO('s._s1', 's._n * 100')} <> 0
                         THEN {STDDEV('s._n', 's._s1', 's._s2', 100.0)} / {RATIO('s._s1', 's._n * 100')} END, 0.0) AS price_volatility_score,
           COALESCE(c.crime_rate_index, 0.0) AS crime_rate_index
    FROM (SELECT outcode, ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY CAST(sale_price AS DOUBLE)), 4) AS median_sale_price_12m,
                 COUNT(price_cents) AS _n, SUM(price_cents) AS _s1, SUM(CAST(price_cents AS HUGEINT) * price_cents) AS _s2
          FROM {RECENT} GROUP BY outcode) s
    LEFT JOIN (SELECT arg_max(index_centi, reference_month) AS index_centi FROM rental_index WHERE region = 'EUROPE') r ON true
    LEFT JOIN price_growth g ON s.outcode = g.outcode
    LEFT JOIN crime_rate c ON s.outcode = c.outcode))""")


def _asof(spark, d):
    return b.sale_as_of(spark, d), b.crime_as_of(spark, d)


@query("median_by_outcode", with_("sale") + f"""
SELECT outcode, ROUND(PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY CAST(sale_price AS DOUBLE)), 4) AS p25,
       ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY CAST(sale_price AS DOUBLE)), 4) AS median,
       ROUND(PERCENTILE_CONT(0.75) WITHIN GROUP (ORDER BY CAST(sale_price AS DOUBLE)), 4) AS p75
FROM {RECENT} GROUP BY outcode""")
def q_median_by_outcode(spark, d):
    return M.median_by_outcode(b.sale(spark, d), b.sale_as_of(spark, d))


@query("price_volatility", with_("sale") + f"""
SELECT outcode, {STDDEV('_n', '_s1', '_s2', 100.0)} AS stddev_price,
       CASE WHEN {RATIO('_s1', '_n * 100')} <> 0 THEN {STDDEV('_n', '_s1', '_s2', 100.0)} / {RATIO('_s1', '_n * 100')} END AS cv
FROM (SELECT outcode, COUNT(price_cents) AS _n, SUM(price_cents) AS _s1,
             SUM(CAST(price_cents AS HUGEINT) * price_cents) AS _s2 FROM {RECENT} GROUP BY outcode)""")
def q_price_volatility(spark, d):
    return M.price_volatility(b.sale(spark, d), b.sale_as_of(spark, d))


@query("price_growth", with_("price_growth") + "SELECT * FROM price_growth")
def q_price_growth(spark, d):
    return M.price_growth(b.hpi_index(spark, d))


@query("latest_value", with_("rental_index") + """
SELECT region, MAX(reference_month) AS reference_month,
       CAST(arg_max(index_centi, reference_month) AS DOUBLE) / 100.0 AS index_value
FROM rental_index GROUP BY region""")
def q_latest_value(spark, d):
    return M.latest_value(b.rental_index(spark, d)).drop("index_centi")


@query("crime_rate_index", with_("crime_rate") + "SELECT * FROM crime_rate")
def q_crime_rate_index(spark, d):
    return M.crime_rate_index(b.crime_stat(spark, d), b.location(spark, d), b.crime_as_of(spark, d))


@query("outcode_metrics", with_("outcode_metrics") + "SELECT * FROM outcode_metrics")
def q_outcode_metrics(spark, d):
    """K8: compute and materialise the snapshot (refresh), then serve it."""
    return metrics_table(spark, d)


def metrics_table(spark, d):
    """Readers of the metrics table use the refreshed snapshot (K8), like the reference's view."""
    from .refresh import metrics_snapshot
    return metrics_snapshot(spark, d)


@query("quartiles", with_("outcode_metrics") +
       "SELECT outcode, avg_yield_pct, yoy_price_growth_pct, yield_quartile, growth_quartile FROM outcode_metrics")
def q_quartiles(spark, d):
    return metrics_table(spark, d).select("outcode", "avg_yield_pct", "yoy_price_growth_pct",
                                          "yield_quartile", "growth_quartile")


@query("quadrant", with_("outcode_metrics") +
       "SELECT outcode, avg_yield_pct, yoy_price_growth_pct, yield_quartile, growth_quartile, quadrant "
       "FROM outcode_metrics ORDER BY outcode")
def q_quadrant(spark, d):
    return metrics_table(spark, d).select("outcode", "avg_yield_pct", "yoy_price_growth_pct",
                                          "yield_quartile", "growth_quartile", "quadrant").orderBy("outcode")


@query("risk_quartile", with_("crime_stat", "location") + f"""
SELECT outcode, avg_crime_rate,
       CAST(NTILE(4) OVER (ORDER BY avg_crime_rate DESC NULLS FIRST, outcode) AS BIGINT) AS risk_quartile
FROM (SELECT l.outcode, {HU('SUM(cs.count)', 'COUNT(*)', 6)} AS avg_crime_rate
      FROM {CRIME12} cs JOIN location l ON l.lsoa_code = cs.lsoa_code GROUP BY l.outcode)""")
def q_risk_quartile(spark, d):
    return M.risk_quartile(b.crime_stat(spark, d), b.location(spark, d), b.crime_as_of(spark, d))


_ups = ", ".join(f"'{o.upper()}'" for o in COMPARE_OUTCODES)


@query("compare_snapshot", with_("outcode_metrics") + f"""
SELECT outcode, median_sale_price_12m AS median_price_12m, avg_yield_pct, yoy_price_growth_pct AS yoy_growth_pct,
       crime_rate_index, quadrant
FROM outcode_metrics WHERE outcode = ANY([{_ups}]) ORDER BY outcode""")
def q_compare_snapshot(spark, d):
    return M.compare(metrics_table(spark, d), COMPARE_OUTCODES)


_req = " UNION ALL ".join(f"SELECT '{o}' AS outcode" for o in COMPARE_REQUESTED)


@query("compare_snapshot_left", with_("outcode_metrics") + f"""
SELECT r.outcode, m.outcode IS NOT NULL AS found, COALESCE(m.quadrant, 'No data found') AS quadrant
FROM (SELECT DISTINCT upper(outcode) AS outcode FROM ({_req})) r LEFT JOIN outcode_metrics m ON m.outcode = r.outcode""")
def q_compare_snapshot_left(spark, d):
    req = spark.createDataFrame([(o,) for o in COMPARE_REQUESTED], "outcode string")
    return M.compare_left(metrics_table(spark, d), req)


@query("growth_risk_volatility", with_("hpi_index", "crime_stat", "location", "request") + f"""
SELECT k.outcode,
       COALESCE((SELECT {HU('SUM(apc_centi)', 'COUNT(apc_centi) * 100', 6)} FROM hpi_index h
                 WHERE h.outcode = k.outcode AND h.reference_month >= {AS_OF_SALE} - INTERVAL 36 MONTH), 0.0) AS avg_annual_growth,
       COALESCE((SELECT {HU('SUM(cs.count)', 'COUNT(*)', 6)} FROM {CRIME12} cs JOIN location l ON l.lsoa_code = cs.lsoa_code
                 WHERE l.outcode = k.outcode), 0.0) AS avg_crime_rate,
       COALESCE((SELECT {STDDEV('COUNT(apc_centi)', 'SUM(apc_centi)', 'SUM(CAST(apc_centi AS HUGEINT) * apc_centi)', 100.0)}
                 FROM hpi_index h WHERE h.outcode = k.outcode), 0.0) AS price_volatility
FROM (SELECT DISTINCT outcode FROM request) k""")
def q_growth_risk_volatility(spark, d):
    as_of, cas = _asof(spark, d)
    g = M.growth_risk_volatility(b.hpi_index(spark, d), b.crime_stat(spark, d), b.location(spark, d), as_of, cas)
    keys = b.request(spark, d).select("outcode").distinct()
    return keys.join(g, "outcode", "left").select(
        "outcode", *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("avg_annual_growth", "avg_crime_rate", "price_volatility")])

"""Registered queries: monthly series and drill-down."""

from __future__ import annotations

from ..operators import series
from ..sources import bindings as b
from .oracle_bindings import with_
from .registry import query
from .sqlfrag import HU, HUI

_MONTHLY = f"""
monthly AS (
  SELECT outcode, CAST(date_trunc('month', sale_date) AS DATE) AS month, SUM(price_cents) AS _s, COUNT(*) AS n
  FROM sale GROUP BY ALL),
m2 AS (SELECT *, {HUI('_s * 10000', 'n')} AS avg_micro FROM monthly)
"""


def _trend_cols(part: str) -> str:
    w = f"(PARTITION BY {part} ORDER BY month)"
    w12 = f"(PARTITION BY {part} ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
    lag = f"lag(avg_micro, 12) OVER {w}"
    return (f"{HU(f'SUM(avg_micro) OVER {w12}', f'COUNT(avg_micro) OVER {w12} * 1000000', 6)} AS rolling_12m_avg, "
            f"CASE WHEN {lag} > 0 THEN {HU(f'(avg_micro - {lag}) * 100', lag, 2)} END AS yoy_growth_pct")


@query("monthly_avg", with_("sale") + "," + _MONTHLY +
       "SELECT outcode, month, CAST(avg_micro AS DOUBLE) / 1000000.0 AS avg_price, n FROM m2")
def q_monthly_avg(spark, d):
    return series.monthly_avg(b.sale(spark, d))


@query("rolling_12m", with_("sale") + "," + _MONTHLY +
       f"SELECT outcode, month, CAST(avg_micro AS DOUBLE) / 1000000.0 AS avg_price, {_trend_cols('outcode').split(', CASE')[0]} FROM m2")
def q_rolling_12m(spark, d):
    g = series.monthly_totals(b.sale(spark, d), ["outcode"])
    t = series.with_trends(g, ["outcode"])
    return t.select("outcode", "month", (t.avg_micro.cast("double") / 1e6).alias("avg_price"), "rolling_12m_avg")


@query("yoy_growth", with_("sale") + "," + _MONTHLY +
       f"SELECT outcode, month, CASE{_trend_cols('outcode').split(', CASE')[1]} FROM m2")
def q_yoy_growth(spark, d):
    g = series.monthly_totals(b.sale(spark, d), ["outcode"])
    return series.with_trends(g, ["outcode"]).select("outcode", "month", "yoy_growth_pct")


def _drill_sql() -> str:
    lv = [("postcode_sector", "sector"), ("outcode", "outcode"), ("area", "area"), ("region", "region")]
    union = "\nUNION ALL ".join(
        f"SELECT '{name}' AS geo_level, {col} AS geo_value, sale_date, price_cents FROM s5" for name, col in lv)
    return with_("sale") + f""",
s5 AS (SELECT * FROM sale WHERE outcode IS NOT NULL
       AND sale_date >= (SELECT MAX(sale_date) FROM sale) - INTERVAL 60 MONTH),
e AS ({union}),
g AS (SELECT geo_level, geo_value, CAST(date_trunc('month', sale_date) AS DATE) AS month,
             {HUI('SUM(price_cents) * 10000', 'COUNT(*)')} AS avg_micro FROM e GROUP BY ALL)
SELECT geo_level, geo_value, month, CAST(avg_micro AS DOUBLE) / 1000000.0 AS avg_price,
       {_trend_cols('geo_level, geo_value')}
FROM g"""


@query("drilldown", _drill_sql())
def q_drilldown(spark, d):
    s = b.sale(spark, d)
    return series.drilldown(s, b.sale_as_of(spark, d)).orderBy("geo_level", "geo_value", "month")


@query("drilldown_outcode", "SELECT * FROM (" + _drill_sql() + ")" + """
WHERE geo_level = 'region' OR (geo_level = 'outcode' AND geo_value = 'NATION_3')
   OR (geo_level = 'postcode_sector' AND geo_value LIKE 'NATION_3/%')
   OR (geo_level = 'area' AND geo_value IN (SELECT r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_name = 'NATION_3'))""")
def q_drilldown_outcode(spark, d):
    """The drill-down of one outcode, as a user asks for it."""
    return series.drilldown(b.sale(spark, d), b.sale_as_of(spark, d), outcode="nation_3")

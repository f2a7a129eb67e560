"""Report-shaping operators behind the pages.

All are DataFrame transforms; global extremes (min / max) are one-row
aggregates joined back with a broadcast of that single row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.finance import js_round
from ..functions.dates import months_back
from ..sources.tables import scalar
from .ranking import top_k

GAP_MONTHS = 36
GAP_MONTHLY_GROWTH = 0.03 / 12  # fixed value: 3 % a year back-cast
INDEX_BASE, INDEX_STEP = 100.0, 0.25  # fixed values: generated index 100 + (36 − m)·0.25


def minmax_scale(df: DataFrame, x: str, y: str, key: str) -> DataFrame:
    """x → ((v−min)/range)·80+10, y → 90−((v−min)/range)·80, a zero range counts as 1."""
    e = df.agg(F.min(x).alias("x0"), F.max(x).alias("x1"), F.min(y).alias("y0"), F.max(y).alias("y1")).first()
    x0, y0 = F.lit(e["x0"]).cast("double"), F.lit(e["y0"]).cast("double")
    xr = F.lit((e["x1"] - e["x0"]) or 1.0) if e["x0"] is not None else F.lit(1.0)
    yr = F.lit((e["y1"] - e["y0"]) or 1.0) if e["y0"] is not None else F.lit(1.0)
    return df.select(key, F.round((F.col(x) - x0) / xr * 80 + 10, 6).alias("x_pct"),
                     F.round(90 - (F.col(y) - y0) / yr * 80, 6).alias("y_pct"))


def relative_rate(df: DataFrame, key: str, rate: str) -> DataFrame:
    """Share of the maximum rate (bar floor 2 %) and a green→red hue."""
    mx = F.lit(scalar(df.agg(F.max(rate).alias("m")), "m")).cast("double")
    pct = F.when(mx > 0, F.col(rate) / mx * 100).otherwise(F.lit(0.0))
    return df.select(key, rate, F.round(F.greatest(pct, F.lit(2.0)), 6).alias("pct"),
                     js_round((1 - F.col(rate) / mx) * 120).alias("hue"))


def top_bottom_k(df: DataFrame, key: str, rate: str, k: int = 5) -> DataFrame:
    """Lowest k and highest k rows by ``rate`` (L4), ``key`` breaking ties."""
    x = df.select(key, rate, F.lit(0).alias("_g"))
    low = top_k(x, ["_g"], [F.col(rate).asc(), F.col(key)], k, "rank").withColumn("side", F.lit("safest"))
    high = top_k(x, ["_g"], [F.col(rate).desc(), F.col(key).desc()], k, "rank").withColumn("side", F.lit("least_safe"))
    return low.unionByName(high).select("side", "rank", key, rate)


def chart_series(drill: DataFrame) -> DataFrame:
    """Month as yyyy-MM, missing rolling/YoY drawn as 0."""
    return drill.select("geo_level", "geo_value", F.date_format("month", "yyyy-MM").alias("month"),
                        F.coalesce("rolling_12m_avg", F.lit(0.0)).alias("rolling"),
                        F.coalesce("yoy_growth_pct", F.lit(0.0)).alias("yoy"))


def latest_trend(drill: DataFrame) -> DataFrame:
    """Last month of each series and its sentence ``value: +x.x% YoY``."""
    g = drill.groupBy("geo_level", "geo_value").agg(
        F.max_by(F.struct("month", "yoy_growth_pct"), "month").alias("_l"))
    yoy = F.col("_l.yoy_growth_pct")
    one = F.round(yoy.cast("decimal(12,2)"), 1).cast("decimal(12,1)").cast("string")
    text = F.when(yoy.isNotNull() & (yoy != 0),
                  F.concat(F.col("geo_value"), F.lit(": "), F.when(yoy > 0, "+").otherwise(""), one, F.lit("% YoY"))) \
            .otherwise(F.concat(F.col("geo_value"), F.lit(" trend")))
    return g.select("geo_level", "geo_value", F.date_format("_l.month", "yyyy-MM").alias("last_month"),
                    yoy.alias("yoy"), text.alias("trend"))


def distinct_lsoa(loc: DataFrame) -> DataFrame:
    c = F.col("lsoa_code").cast("string")
    return loc.where(c.isNotNull() & (F.length(F.trim(c)) > 0)).select("lsoa_code").distinct()


def latest_months(periods: DataFrame, col: str, n: int = 12) -> DataFrame:
    """Newest ``n`` distinct periods, newest first (S7, L6): a top-n report by design."""
    return periods.select(F.col(col).alias("month")).distinct().orderBy(F.col("month").desc()).limit(n)


def gap_fill(hpi: DataFrame, months: int = GAP_MONTHS) -> DataFrame:
    """Scaffold every (outcode × last ``months`` months) and back-cast the missing ones (G1).

    Generated price: latest known price · (1 − 0.25 %)^m, Math.round; index
    100 + (36 − m)·0.25.  The reference's random noise is not reproduced.
    """
    m0 = scalar(hpi.agg(F.max("reference_month").alias("m")), "m")
    base = hpi.groupBy("outcode").agg(F.max_by("average_price", "reference_month").alias("_base"))
    grid = (base.select("outcode", "_base", F.explode(F.sequence(F.lit(0), F.lit(months - 1))).alias("m"))
                .withColumn("reference_month", F.add_months(F.lit(m0), -F.col("m"))))
    missing = grid.join(hpi.select("outcode", "reference_month"), ["outcode", "reference_month"], "left_anti")
    gen = missing.select("outcode", "reference_month",
                         js_round(F.col("_base") * F.pow(F.lit(1 - GAP_MONTHLY_GROWTH), F.col("m").cast("double")))
                         .cast("double").alias("average_price"),
                         (F.lit(INDEX_BASE) + (months - F.col("m")) * INDEX_STEP).cast("double").alias("index_value"),
                         F.lit(True).alias("is_generated"))
    have = hpi.select("outcode", "reference_month", "average_price", "index_value", F.lit(False).alias("is_generated"))
    return have.unionByName(gen)

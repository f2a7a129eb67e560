"""Monthly price series, rolling mean, year-on-year change and the drill-down.

The sales are summed once per sector and month; those sums are expanded to the
four geographic levels and summed again, which moves a few rows per level; windows then run per
(level, value) over at most a few hundred monthly rows each.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import months_back
from ..functions.exact import half_up, half_up_int

LEVELS = ("postcode_sector", "outcode", "area", "region")


def monthly_totals(sales: DataFrame, keys: list[str]) -> DataFrame:
    """Exact per-(keys, month) sums: ``_s`` cents, ``n`` rows, ``avg_micro`` HALF_UP mean in µ-units."""
    return with_mean(month_sums(sales, keys))


def month_sums(sales: DataFrame, keys: list[str]) -> DataFrame:
    """``_s`` (38 digits: no month of any size overflows) and ``n`` per (keys, month)."""
    return sales.groupBy(*keys, F.trunc("sale_date", "MM").alias("month")).agg(
        F.sum(F.col("price_cents").cast("decimal(28,0)")).alias("_s"), F.count(F.lit(1)).alias("n"))


def with_mean(g: DataFrame) -> DataFrame:
    """``avg_micro`` from the quotient and the remainder of ``_s / n``, so that nothing is scaled up before the division."""
    whole = F.expr("_s div n")
    rest = F.expr("_s % n").cast("long")
    return g.withColumn("avg_micro", whole * 10000 + half_up_int(rest * 10000, F.col("n")))


def monthly_avg(sales: DataFrame, keys: list[str] | None = None) -> DataFrame:
    keys = keys or ["outcode"]
    g = monthly_totals(sales, keys)
    return g.select(*keys, "month", (F.col("avg_micro").cast("double") / 1e6).alias("avg_price"), "n")


def with_trends(g: DataFrame, keys: list[str], calendar: bool = False) -> DataFrame:
    """Add ``rolling_12m_avg`` and ``yoy_growth_pct`` per ``keys`` ordered by month.

    ``calendar=False`` reproduces the row-offset semantics (11 PRECEDING / LAG 12,
    a missing month shifts the window); ``calendar=True`` uses real month offsets.
    """
    if calendar:
        idx = F.year("month") * 12 + F.month("month")
        w = Window.partitionBy(*keys).orderBy(idx)
        frame = w.rangeBetween(-11, 0)
        lag = F.first("avg_micro").over(w.rangeBetween(-12, -12))
    else:
        w = Window.partitionBy(*keys).orderBy("month")
        frame = w.rowsBetween(-11, 0)
        lag = F.lag("avg_micro", 12).over(w)
    x = (g.withColumn("_rs", F.sum("avg_micro").over(frame))
          .withColumn("_rn", F.count("avg_micro").over(frame))
          .withColumn("_lag", lag))
    return x.select(
        *g.columns,
        half_up(F.col("_rs"), F.col("_rn") * 1000000, 6).alias("rolling_12m_avg"),
        F.when(F.col("_lag") > 0, half_up((F.col("avg_micro") - F.col("_lag")) * 100, F.col("_lag"), 2))
         .alias("yoy_growth_pct"),
    )


def drilldown(sales: DataFrame, as_of: dt.date, outcode: str | None = None,
              calendar: bool = False) -> DataFrame:
    """geo_level, geo_value, month, avg_price, rolling_12m_avg, yoy_growth_pct for the last 5 years.

    ``outcode=None`` answers every sector/outcode/area at once (batch form);
    a given outcode keeps its own sectors, its area and the region.
    """
    recent = sales.where((F.col("sale_date") >= F.lit(months_back(as_of, 60))) & F.col("outcode").isNotNull())
    s = month_sums(recent, ["sector", "outcode", "area", "region"])
    lv = F.explode(F.array(
        F.struct(F.lit(LEVELS[0]).alias("geo_level"), F.col("sector").alias("geo_value")),
        F.struct(F.lit(LEVELS[1]).alias("geo_level"), F.col("outcode").alias("geo_value")),
        F.struct(F.lit(LEVELS[2]).alias("geo_level"), F.col("area").alias("geo_value")),
        F.struct(F.lit(LEVELS[3]).alias("geo_level"), F.col("region").alias("geo_value")),
    )).alias("lv")
    if outcode is not None:
        oc = outcode.upper()
        own = s.where(F.col("outcode") == oc).select(F.col("area").alias("_area")).distinct().withColumn("_own_area", F.lit(True))
        s = s.join(own, F.col("area") == F.col("_area"), "left")
    e = s.select("month", "_s", "n", "outcode", "_own_area" if outcode is not None else F.lit(None).alias("_own_area"), lv)
    if outcode is not None:
        lvl = F.col("lv.geo_level")
        e = e.where(((lvl.isin(LEVELS[0], LEVELS[1])) & (F.col("outcode") == oc))
                    | ((lvl == LEVELS[2]) & F.col("_own_area").isNotNull()) | (lvl == LEVELS[3]))
    g = e.groupBy(F.col("lv.geo_level").alias("geo_level"), F.col("lv.geo_value").alias("geo_value"), "month").agg(
        F.sum("_s").alias("_s"), F.sum("n").alias("n"))
    t = with_trends(with_mean(g), ["geo_level", "geo_value"], calendar=calendar)
    return t.select("geo_level", "geo_value", "month",
                    (F.col("avg_micro").cast("double") / 1e6).alias("avg_price"),
                    "rolling_12m_avg", "yoy_growth_pct")

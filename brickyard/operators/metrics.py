"""Per-outcode metrics table and its classifications.

``outcode_metrics`` is written as a snapshot by ``refresh_metrics``; the
quadrant / compare readers consume either the snapshot or the lazy frame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import months_back, trailing
from ..functions.exact import half_up, ratio, stddev_exact
from ..session import ensure_checkpoint_dir
from ..sources.tables import scalar
from .ranking import ntile, percentile_cont

QUARTILE_PROBS = {"p25": "0.25", "median": "0.5", "p75": "0.75"}
QUADRANTS = ("UNICORN", "CASH_COW", "GROWTH_PLAY", "AVOID")
RENT_REGION = "EUROPE"  # region whose latest rental index plays the outcode rent level


def recent_sales(sales: DataFrame, as_of: dt.date, months: int = 12) -> DataFrame:
    return sales.where(trailing(F.col("sale_date"), as_of, months) & F.col("outcode").isNotNull())


def median_by_outcode(sales: DataFrame, as_of: dt.date) -> DataFrame:
    """outcode, p25, median, p75 of sale prices in the last 12 months (exact PERCENTILE_CONT)."""
    return percentile_cont(recent_sales(sales, as_of), ["outcode"], "sale_price", QUARTILE_PROBS)


def price_moments(sales: DataFrame, keys: list[str]) -> DataFrame:
    c = F.col("price_cents")
    return sales.groupBy(*keys).agg(
        F.count(c).alias("_n"), F.sum(c).alias("_s1"),
        F.sum(c.cast("decimal(38,0)") * c).alias("_s2"))


def price_volatility(sales: DataFrame, as_of: dt.date) -> DataFrame:
    """outcode, stddev_price, cv = STDDEV/NULLIF(AVG, 0) over the last 12 months."""
    m = price_moments(recent_sales(sales, as_of), ["outcode"])
    sd = stddev_exact(F.col("_n"), F.col("_s1"), F.col("_s2"), 100.0)
    avg = ratio(F.col("_s1"), F.col("_n") * 100)
    return m.select("outcode", sd.alias("stddev_price"), F.when(avg != 0, sd / avg).alias("cv"))


def price_growth(hpi: DataFrame) -> DataFrame:
    """outcode, yoy and 3-year growth: latest month vs exactly −12 / −36 months.

    The index (a row per outcode and month) is written once, since its latest
    month must be known before the three months can be picked.
    """
    ensure_checkpoint_dir(hpi.sparkSession)
    hpi = hpi.select("outcode", "reference_month", "avg_cents").checkpoint()
    m0 = scalar(hpi.agg(F.max("reference_month").alias("m")), "m")
    if m0 is None:
        return hpi.select("outcode", F.lit(None).cast("double").alias("yoy_price_growth_pct"),
                          F.lit(None).cast("double").alias("three_year_price_growth_pct")).limit(0)
    m = F.col("reference_month")
    g = hpi.where(m.isin(m0, months_back(m0, 12), months_back(m0, 36))).groupBy("outcode").agg(
        F.max(F.when(m == F.lit(m0), F.col("avg_cents"))).alias("_a0"),
        F.max(F.when(m == F.lit(months_back(m0, 12)), F.col("avg_cents"))).alias("_a12"),
        F.max(F.when(m == F.lit(months_back(m0, 36)), F.col("avg_cents"))).alias("_a36"))
    g = g.where(F.col("_a0").isNotNull())
    return g.select(
        "outcode",
        half_up((F.col("_a0") - F.col("_a12")) * 100, F.col("_a12"), 6).alias("yoy_price_growth_pct"),
        half_up((F.col("_a0") - F.col("_a36")) * 100, F.col("_a36"), 6).alias("three_year_price_growth_pct"))


def latest_value(rental: DataFrame) -> DataFrame:
    """region, reference_month, index_value of the latest month per region."""
    g = rental.groupBy("region").agg(
        F.max("reference_month").alias("reference_month"),
        F.max_by("index_centi", "reference_month").alias("index_centi"))
    return g.select("region", "reference_month", (F.col("index_centi").cast("double") / 100.0).alias("index_value"),
                    "index_centi")


def crime_by_location(crime: DataFrame, loc: DataFrame, as_of: dt.date, months: int = 12,
                      weighting: str = "postcode") -> DataFrame:
    """Crime rows joined to outcodes with explicit multiplicity (J2, pre-aggregated).

    Crime is reduced to (lsoa, period) before the join and the location side to
    (lsoa, outcode, postcodes), so the many-to-many fan-out becomes a weight
    ``_w`` instead of duplicated rows.  ``weighting='postcode'`` reproduces the
    postcode-weighted sums; ``'lsoa'`` counts each (lsoa, outcode) once.
    """
    c = crime.where(trailing(F.col("reference_period"), as_of, months)).groupBy("lsoa_code", "reference_period").agg(
        F.sum("count").alias("_cnt"), F.count(F.lit(1)).alias("_rows"))
    l = loc.where(F.col("lsoa_code").isNotNull()).groupBy("lsoa_code", "outcode").agg(F.count(F.lit(1)).alias("_w"))
    if weighting == "lsoa":
        l = l.withColumn("_w", F.lit(1).cast("long"))
    return c.join(l, "lsoa_code")


def crime_rate_index(crime: DataFrame, loc: DataFrame, as_of: dt.date) -> DataFrame:
    """outcode, SUM(count)/COUNT(DISTINCT month) over the trailing 12 months."""
    j = crime_by_location(crime, loc, as_of)
    g = j.groupBy("outcode").agg(F.sum(F.col("_cnt") * F.col("_w")).alias("_s"),
                                 F.countDistinct("reference_period").alias("_p"))
    return g.select("outcode", half_up(F.col("_s"), F.col("_p"), 6).alias("crime_rate_index"))


def avg_crime_rate(crime: DataFrame, loc: DataFrame, as_of: dt.date) -> DataFrame:
    """outcode, AVG(count) over crime rows joined to the outcode's postcodes."""
    j = crime_by_location(crime, loc, as_of)
    g = j.groupBy("outcode").agg(F.sum(F.col("_cnt") * F.col("_w")).alias("_s"),
                                 F.sum(F.col("_rows") * F.col("_w")).alias("_r"))
    return g.select("outcode", half_up(F.col("_s"), F.col("_r"), 6).alias("avg_crime_rate"))


def outcode_metrics(sales: DataFrame, hpi: DataFrame, rental: DataFrame, crime: DataFrame, loc: DataFrame,
                    as_of: dt.date, crime_as_of: dt.date) -> DataFrame:
    """The 10-column metrics table; one row per outcode with sales in the last 12 months."""
    recent = recent_sales(sales, as_of)
    med = percentile_cont(recent, ["outcode"], "sale_price", {"median": "0.5"})
    return _metrics(med, price_moments(recent, ["outcode"]), hpi, rental, crime, loc, crime_as_of)


def metrics_of_histogram(hist: DataFrame, hpi: DataFrame, rental: DataFrame, crime: DataFrame, loc: DataFrame, crime_as_of: dt.date) -> DataFrame:
    """The same table from kept counts of the window's prices: outcode, price_cents, c."""
    c = F.col("price_cents").cast("decimal(38,0)")
    priced = hist.withColumn("sale_price", (F.col("price_cents").cast("decimal(14,0)") / 100).cast("decimal(12,2)"))
    med = percentile_cont(priced, ["outcode"], "sale_price", {"median": "0.5"}, weight="c")
    mom = hist.groupBy("outcode").agg(F.sum("c").alias("_n"), F.sum(F.col("price_cents") * F.col("c")).alias("_s1"),
                                      F.sum((c * F.col("price_cents")).cast("decimal(28,0)") * F.col("c").cast("decimal(18,0)")).cast("decimal(38,0)").alias("_s2"))
    return _metrics(med, mom, hpi, rental, crime, loc, crime_as_of)


def _metrics(med: DataFrame, mom: DataFrame, hpi: DataFrame, rental: DataFrame, crime: DataFrame, loc: DataFrame, crime_as_of: dt.date) -> DataFrame:
    # the latest rent level of the chosen region: a one-row aggregate used as a literal
    rent = scalar(latest_value(rental.where(F.col("region") == RENT_REGION)).select("index_centi"), "index_centi")
    med_e4 = F.round(F.col("median") * 10000).cast("long")
    sd = stddev_exact(F.col("_n"), F.col("_s1"), F.col("_s2"), 100.0)
    avg = ratio(F.col("_s1"), F.col("_n") * 100)
    base = (med.join(mom, "outcode")
               .select("outcode", F.col("median").alias("median_sale_price_12m"),
                       F.when(F.col("median") > 0, half_up(F.lit(rent).cast("long") * 120000, med_e4, 6)).alias("_y"),
                       F.when(avg != 0, sd / avg).alias("_v")))
    growth = price_growth(hpi)
    cri = crime_rate_index(crime, loc, crime_as_of)
    m = (base.join(growth, "outcode", "left").join(cri, "outcode", "left")
             .select("outcode", "median_sale_price_12m",
                     F.coalesce("_y", F.lit(0.0)).alias("avg_yield_pct"),
                     F.coalesce("yoy_price_growth_pct", F.lit(0.0)).alias("yoy_price_growth_pct"),
                     F.coalesce("three_year_price_growth_pct", F.lit(0.0)).alias("three_year_price_growth_pct"),
                     F.coalesce("_v", F.lit(0.0)).alias("price_volatility_score"),
                     F.coalesce("crime_rate_index", F.lit(0.0)).alias("crime_rate_index")))
    return with_quadrant(with_quartiles(m))


def with_quartiles(m: DataFrame) -> DataFrame:
    """NTILE(4) by yield and by growth, ASC NULLS LAST, outcode as the final tie-break.

    One row per outcode: a bounded domain, so the single-partition window is fine.
    """
    m = ntile(m, 4, [F.col("avg_yield_pct").asc_nulls_last(), F.col("outcode")], "yield_quartile",
              bounded=True)
    return ntile(m, 4, [F.col("yoy_price_growth_pct").asc_nulls_last(), F.col("outcode")], "growth_quartile",
                 bounded=True)


def quadrant_of(yq: F.Column, gq: F.Column) -> F.Column:
    return (F.when((yq >= 3) & (gq >= 3), F.lit(QUADRANTS[0]))
             .when(yq >= 3, F.lit(QUADRANTS[1]))
             .when(gq >= 3, F.lit(QUADRANTS[2]))
             .otherwise(F.lit(QUADRANTS[3])))


def with_quadrant(m: DataFrame) -> DataFrame:
    return m.withColumn("quadrant", quadrant_of(F.col("yield_quartile"), F.col("growth_quartile")))


def risk_quartile(crime: DataFrame, loc: DataFrame, as_of: dt.date) -> DataFrame:
    """outcode, avg_crime_rate, NTILE(4) ORDER BY avg_crime_rate DESC (W2; unused by the score, Q-4)."""
    a = avg_crime_rate(crime, loc, as_of)
    return ntile(a, 4, [F.col("avg_crime_rate").desc_nulls_first(), F.col("outcode")], "risk_quartile",
                 bounded=True)


def compare(metrics: DataFrame, outcodes: list[str]) -> DataFrame:
    """Snapshot rows for 1-4 requested outcodes."""
    if not 1 <= len(outcodes) <= 4:
        raise ValueError(f"between 1 and 4 outcodes can be compared, not {len(outcodes)}")
    ups = [o.upper() for o in outcodes]
    return (metrics.where(F.col("outcode").isin(ups))
                   .select("outcode", F.col("median_sale_price_12m").alias("median_price_12m"), "avg_yield_pct",
                           F.col("yoy_price_growth_pct").alias("yoy_growth_pct"), "crime_rate_index", "quadrant")
                   .orderBy("outcode"))


def compare_left(metrics: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested outcodes ⟕ snapshot; unmatched rows are flagged not found."""
    r = requested.select(F.upper("outcode").alias("outcode")).distinct()
    m = metrics.select("outcode", "quadrant", F.lit(True).alias("_hit"))
    return (r.join(m, "outcode", "left")
             .select("outcode", F.coalesce("_hit", F.lit(False)).alias("found"),
                     F.coalesce("quadrant", F.lit("No data found")).alias("quadrant")))


def growth_risk_volatility(hpi: DataFrame, crime: DataFrame, loc: DataFrame, as_of: dt.date,
                           crime_as_of: dt.date) -> DataFrame:
    """outcode, avg_annual_growth (3 y), avg_crime_rate (12 m), price_volatility (all months)."""
    apc = F.col("apc_centi")
    recent = F.when(F.col("reference_month") >= F.lit(months_back(as_of, 36)), apc)
    # both figures from one aggregate per outcode; outcodes with crime alone come by the outer join
    index = hpi.groupBy("outcode").agg(F.sum(recent).alias("_gs"), F.count(recent).alias("_gn"), F.count(apc).alias("_n"), F.sum(apc).alias("_s1"),
                                       F.sum(apc.cast("decimal(38,0)") * apc).alias("_s2"))
    x = index.join(avg_crime_rate(crime, loc, crime_as_of), "outcode", "full_outer")
    return x.select(
        "outcode",
        F.coalesce(half_up(F.col("_gs"), F.col("_gn") * 100, 6), F.lit(0.0)).alias("avg_annual_growth"),
        F.coalesce("avg_crime_rate", F.lit(0.0)).alias("avg_crime_rate"),
        F.coalesce(stddev_exact(F.col("_n"), F.col("_s1"), F.col("_s2"), 100.0), F.lit(0.0)).alias("price_volatility"))

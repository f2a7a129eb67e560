"""Per-request decisions: composite score, mortgage scenarios, comparables, findings.

Batch-first: every function answers a whole DataFrame of requests in one job;
a single request is a one-row DataFrame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import months_back, trailing
from ..functions.exact import half_up, half_up_dec, ratio, stddev_exact
from ..functions.finance import (gross_yield_pct, js_round, loan_cents, monthly_payment, net_yield_pct)
from .metrics import QUARTILE_PROBS, recent_sales
from .ranges import range_quantiles
from .ranking import ntile, percentile_cont, top_k

VERDICTS = ("UNICORN", "CASH_COW", "GROWTH_PLAY", "AVOID")
SCENARIOS = ("INTEREST_ONLY", "REPAYMENT")
DEFAULT_SCORE = 50.0


def with_payment(requests: DataFrame, products: DataFrame, rounded: bool = True) -> DataFrame:
    p = products.select("mortgage_product_id", "mortgage_type", "rate_tenths")
    x = requests.join(p, "mortgage_product_id", "left")
    pc = loan_cents(F.col("asking_price"), F.col("deposit_pct"))
    return (x.withColumn("_loan_c", pc)
             .withColumn("monthly_payment", F.when(F.col("rate_tenths").isNotNull(),
                         monthly_payment(pc, F.col("rate_tenths"), F.col("mortgage_type"), rounded=rounded))))


def composite_score(requests: DataFrame, metrics: DataFrame, products: DataFrame, grv: DataFrame,
                    risk: DataFrame | None = None) -> DataFrame:
    """Weighted-quartile score per request (X3, A17); no matching outcode or product → 50.

    By default the risk term is the reference's constant 3/4 (Q-4).  Given
    ``risk`` (outcode, risk_quartile: 1 = most crime), the term uses the
    outcode's quartile instead; outcodes without crime data count as 2.
    """
    x = with_payment(requests, products)
    if risk is not None:
        x = x.join(risk.select("outcode", "risk_quartile"), "outcode", "left")
    q = metrics.select("outcode", "yield_quartile", "growth_quartile")
    x = x.join(q, "outcode", "left").join(grv, "outcode", "left")
    pay_c = F.round(F.col("monthly_payment") * 100).cast("long")
    cash = half_up(3 * F.col("rent_cents") - 4 * pay_c, F.lit(400), 4)
    has = F.col("yield_quartile").isNotNull() & F.col("monthly_payment").isNotNull()
    risk_term = 20 * F.coalesce("risk_quartile", F.lit(2)) if risk is not None else F.lit(60)
    num = (35 * F.coalesce("yield_quartile", F.lit(2)) + 25 * F.coalesce("growth_quartile", F.lit(2)) + risk_term
           + 20 * F.when(cash > 0, 3).otherwise(1))
    score = half_up(num, F.lit(4), 2)
    return x.select(
        "request_id",
        F.when(has, F.col("yield_quartile")).alias("yield_quartile"),
        F.when(has, F.col("growth_quartile")).alias("growth_quartile"),
        F.when(has, gross_yield_pct(F.col("rent_cents"), F.col("asking_price"))).otherwise(0.0).alias("gross_yield_pct"),
        F.when(has, net_yield_pct(F.col("rent_cents"), F.col("asking_price"))).otherwise(0.0).alias("net_yield_pct"),
        F.when(has, F.coalesce("avg_annual_growth", F.lit(0.0))).alias("avg_annual_growth"),
        F.when(has, F.coalesce("avg_crime_rate", F.lit(0.0))).alias("avg_crime_rate"),
        F.when(has, F.coalesce("price_volatility", F.lit(0.0))).alias("price_volatility"),
        F.when(has, F.col("monthly_payment")).otherwise(0.0).alias("monthly_payment"),
        F.when(has, cash).alias("net_monthly_cashflow"),
        F.when(has, score).otherwise(DEFAULT_SCORE).alias("composite_score"),
    )


def verdict(scores: DataFrame) -> DataFrame:
    """UNICORN / CASH_COW / GROWTH_PLAY / AVOID from score and quartiles (X3b); missing quartile = 2."""
    s, yq, gq = F.col("composite_score"), F.coalesce("yield_quartile", F.lit(2)), F.coalesce("growth_quartile", F.lit(2))
    v = (F.when((s > 75) & (yq >= 3) & (gq >= 3), F.lit(VERDICTS[0]))
          .when((s > 60) & (yq >= 3), F.lit(VERDICTS[1]))
          .when((s > 60) & (gq >= 3), F.lit(VERDICTS[2]))
          .otherwise(F.lit(VERDICTS[3])))
    return scores.select("request_id", "composite_score",
                         F.when(F.col("net_monthly_cashflow").isNull() & F.col("yield_quartile").isNull(),
                                F.lit(VERDICTS[3])).otherwise(v).alias("verdict"))


def score_components(scores: DataFrame) -> DataFrame:
    """Four 0-100 component scores (X3c); zeros when the request had no score row."""
    has = F.col("yield_quartile").isNotNull()
    yq, gq = F.col("yield_quartile"), F.col("growth_quartile")
    return scores.select(
        "request_id",
        F.when(has, js_round(yq / 4 * 100)).otherwise(0).cast("long").alias("yield_score"),
        F.when(has, js_round(F.coalesce(gq, F.lit(2)) / 4 * 100)).otherwise(0).cast("long").alias("growth_score"),
        F.when(has, 75).otherwise(0).cast("long").alias("risk_score"),
        F.when(has, F.when(F.col("net_monthly_cashflow") > 0, 75).otherwise(25)).otherwise(0).cast("long")
         .alias("cashflow_score"))


def score_band(scores: DataFrame) -> DataFrame:
    s = F.col("composite_score")
    return scores.select("request_id", "composite_score",
                         F.when(s > 60, "green").when(s >= 40, "amber").otherwise("red").alias("band"))


def payments(requests: DataFrame, products: DataFrame, rounded: bool = True) -> DataFrame:
    x = with_payment(requests, products, rounded)
    return x.select("request_id", (F.col("_loan_c").cast("double") / 100.0).alias("loan_amount"), "monthly_payment")


def scenarios(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Interest-only vs repayment per request with the client formula (X11)."""
    p = products.select("mortgage_product_id", "rate_tenths")
    x = requests.join(p, "mortgage_product_id", "left") \
                .withColumn("rate_tenths", F.coalesce("rate_tenths", F.lit(50).cast("long")))
    x = x.withColumn("_loan_c", loan_cents(F.col("asking_price"), F.col("deposit_pct")))
    x = x.select("*", F.explode(F.array(*[F.lit(s) for s in SCENARIOS])).alias("scenario"))
    raw = monthly_payment(F.col("_loan_c"), F.col("rate_tenths"), F.col("scenario"), rounded=False)
    return x.select("request_id", "scenario", "rent_cents", "_loan_c", "mortgage_product_id", raw.alias("monthly"))


def mortgage_scenarios(requests: DataFrame, products: DataFrame) -> DataFrame:
    s = scenarios(requests, products)
    return s.select("request_id", "scenario", "monthly", F.round(F.col("monthly") * 300, 4).alias("total_paid"),
                    F.when(F.col("scenario") == SCENARIOS[0], F.col("_loan_c").cast("double") / 100.0)
                     .otherwise(0.0).alias("remaining_balance"))


def cashflow_waterfall(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Rent, payment, 25 % costs and net per scenario, each rounded like Math.round."""
    s = scenarios(requests, products)
    rent = F.col("rent_cents").cast("double") / 100.0
    costs = rent * 0.25
    return s.select("request_id", "scenario", js_round(rent).alias("rent_income"),
                    js_round(F.col("monthly")).alias("mortgage_payment"), js_round(costs).alias("costs"),
                    js_round(rent - F.col("monthly") - costs).alias("net_cashflow"))


def payment_diff(requests: DataFrame, products: DataFrame) -> DataFrame:
    """Difference of a scenario's payment from the server's rounded one, and whether it is above £1."""
    s = scenarios(requests, products)
    server = payments(requests, products).select("request_id", F.col("monthly_payment").alias("_srv"))
    x = s.join(server, "request_id", "left")
    diff = F.abs(F.col("monthly") - F.coalesce("_srv", F.lit(0.0)))
    return x.select("request_id", "scenario", diff.alias("server_diff"), (diff > 1).alias("diff_gt_1"))


def yield_metrics(requests: DataFrame) -> DataFrame:
    return requests.select("request_id", gross_yield_pct(F.col("rent_cents"), F.col("asking_price")).alias("gross_yield_pct"),
                           net_yield_pct(F.col("rent_cents"), F.col("asking_price")).alias("net_yield_pct"))


# --- comparables (X1) -----------------------------------------------------------------

COMP_KEY = ["outcode", "bedrooms", "property_type", "floor_area_sqm"]
SQFT_PER_SQM = "10.764"  # fixed value from the reference


def comparable_pairs(assets: DataFrame, requests: DataFrame, as_of: dt.date, months: int = 24,
                     band_pct: int = 20) -> DataFrame:
    """(comparable key, sale) pairs: same outcode/beds/type, area NULL or within ±band %, last ``months``.

    Requests are reduced to distinct comparable keys first, so requests that
    ask the same question share one set of matches.
    """
    keys = requests.select(*COMP_KEY).distinct().withColumnRenamed("floor_area_sqm", "target_sqm")
    s = assets.where(trailing(F.col("sale_date"), as_of, months)).select(
        "outcode", "bedrooms", "property_type", F.col("floor_area_sqm").alias("sqm"), "postcode", "sale_date",
        "sale_price", "price_cents")
    band = (F.col("sqm").isNull()
            | ((F.col("sqm") * 100 >= F.col("target_sqm") * (100 - band_pct))
               & (F.col("sqm") * 100 <= F.col("target_sqm") * (100 + band_pct))))
    j = s.join(keys, ["outcode", "bedrooms", "property_type"]).where(band)
    gbp6 = half_up_dec(F.col("price_cents") * 1000, F.col("sqm") * 10764 * 100, 6)
    return j.withColumnRenamed("target_sqm", "floor_area_sqm").withColumn(
        "gbp_per_sqft", F.when(F.col("sqm") > 0, gbp6))


def comparables_stats(assets: DataFrame, requests: DataFrame, as_of: dt.date) -> DataFrame:
    """p25 / median / p75 price, median £/sqft and count per request, both metrics in one ranked pass."""
    pairs = comparable_pairs(assets, requests, as_of)
    stacked = pairs.select(*COMP_KEY, F.explode(F.array(
        F.struct(F.lit("price").alias("_m"), F.col("sale_price").cast("decimal(30,6)").alias("_x")),
        F.struct(F.lit("gbp").alias("_m"), F.col("gbp_per_sqft").cast("decimal(30,6)").alias("_x")),
    )).alias("s")).select(*COMP_KEY, F.col("s._m").alias("_m"), F.col("s._x").alias("_x"))
    q = percentile_cont(stacked, [*COMP_KEY, "_m"], "_x", QUARTILE_PROBS, count_as="_cnt")
    price, gbp = F.col("_m") == "price", F.col("_m") == "gbp"
    st = q.groupBy(*COMP_KEY).agg(
        *[F.max(F.when(price, F.col(n))).alias(n) for n in QUARTILE_PROBS],
        F.max(F.when(gbp, F.col("median"))).alias("median_gbp_per_sqft"),
        F.max(F.when(price, F.col("_cnt"))).alias("comparable_count"))
    r = requests.select("request_id", *COMP_KEY).join(st, COMP_KEY, "left")
    return r.select("request_id", "p25", "median", "p75", "median_gbp_per_sqft",
                    F.coalesce("comparable_count", F.lit(0)).alias("comparable_count"))


def sold_counts(assets: DataFrame, as_of: dt.date, months: int) -> DataFrame:
    """(outcode, beds, type, area, price) → ``_sold``: the window's sales, counted."""
    return (assets.where(trailing(F.col("sale_date"), as_of, months) & F.col("price_cents").isNotNull())
            .groupBy(*COMP_KEY, "price_cents").agg(F.count(F.lit(1)).alias("_sold")))


def metric_counts(counts: DataFrame, *keep: str) -> DataFrame:
    """Two rows per count, price and £/sqft (``_m``), as whole millionths of a pound (``_x``)."""
    gbp6 = half_up_dec(F.col("price_cents") * 1000, F.col("_sqm") * 10764 * 100, 6)
    return counts.select(*keep, "_sold", F.explode(F.array(
        F.struct(F.lit("price").alias("_m"), (F.col("price_cents") * 10000).alias("_x")),
        F.struct(F.lit("gbp").alias("_m"), F.when(F.col("_sqm") > 0, (gbp6 * 1000000).cast("long")).alias("_x")),
    )).alias("s")).select(*keep, "s._m", "s._x", "_sold")


def comparables_by_range(assets: DataFrame, requests: DataFrame, as_of: dt.date, months: int = 24, band_pct: int = 20) -> DataFrame:
    """``comparables_stats`` for many requests on few, hot (outcode, beds, type) triples: no request meets single sales.

    Sales are counted by (outcode, beds, type, area, price) and laid into a tree over the
    floor areas, whose nodes the requests' bands are cut into.  The tree has a fixed price, so where a
    triple has a few hundred sales ``comparables_stats`` is faster.
    """
    triple = COMP_KEY[:3]
    hist = metric_counts(sold_counts(assets, as_of, months).withColumnRenamed("floor_area_sqm", "_sqm"), *triple, "_sqm")
    target = F.col("floor_area_sqm")
    asks = requests.select(*COMP_KEY).where(target.isNotNull()).distinct().select(
        *COMP_KEY, F.ceil(target * (100 - band_pct) / 100).alias("_lo"), F.floor(target * (100 + band_pct) / 100).alias("_hi"),
        F.explode(F.array(F.lit("price"), F.lit("gbp"))).alias("_m"))
    q = range_quantiles(hist, asks.select(*triple, "_m", "_lo", "_hi").distinct(), [*triple, "_m"], "_sqm", "_x", "_sold",
                        "_lo", "_hi", QUARTILE_PROBS, unit="0.000001", count_as="_cnt")
    price, gbp = F.col("_m") == "price", F.col("_m") == "gbp"
    st = q.groupBy(*triple, "_lo", "_hi").agg(
        *[F.max(F.when(price, F.col(n))).alias(n) for n in QUARTILE_PROBS],
        F.max(F.when(gbp, F.col("median"))).alias("median_gbp_per_sqft"),
        F.max(F.when(price, F.col("_cnt"))).alias("comparable_count"))
    r = requests.select("request_id", *triple, F.ceil(target * (100 - band_pct) / 100).alias("_lo"),
                        F.floor(target * (100 + band_pct) / 100).alias("_hi")).join(st, [*triple, "_lo", "_hi"], "left")
    return r.select("request_id", "p25", "median", "p75", "median_gbp_per_sqft",
                    F.coalesce("comparable_count", F.lit(0)).alias("comparable_count"))


def comparables_rows(assets: DataFrame, requests: DataFrame, as_of: dt.date, k: int = 10) -> DataFrame:
    """Ten most recent comparables per request, ties broken on every output column (L1)."""
    pairs = comparable_pairs(assets, requests, as_of).select(
        *COMP_KEY, F.col("postcode").alias("area"), "sale_date",
        F.col("sale_price").cast("double").alias("sale_price"),
        F.when(F.col("sqm") > 0, half_up(F.col("price_cents") * 10, F.col("sqm") * 10764, 2)).alias("gbp_per_sqft"),
        "bedrooms")
    order = [F.col("sale_date").desc(), F.col("sale_price").desc(), F.col("area"),
             F.col("gbp_per_sqft").desc_nulls_last()]
    top = top_k(pairs, COMP_KEY, order, k, "recency_rank")
    r = requests.select("request_id", *COMP_KEY).join(top, COMP_KEY)
    return r.select("request_id", "area", "sale_date", "sale_price", "gbp_per_sqft", "bedrooms")


def sorted_comparables(rows: DataFrame, key: str = "gbp_per_sqft", descending: bool = True) -> DataFrame:
    """User-chosen order of the comparables table, NULL £/sqft sorting as 0."""
    from pyspark.sql import Window
    v = F.coalesce(F.col(key), F.lit(0)) if key != "sale_date" else F.col(key)
    o = v.desc() if descending else v.asc()
    w = Window.partitionBy("request_id").orderBy(o, F.col("sale_date").desc(), F.col("sale_price").desc(),
                                                  F.col("area"), F.col("gbp_per_sqft").desc_nulls_last())
    return rows.withColumn("position", F.row_number().over(w).cast("long"))


def limited_comparables(stats: DataFrame, minimum: int = 3) -> DataFrame:
    """Whether a request has too few comparables, and the sentence shown then."""
    n = F.col("comparable_count")
    text = F.concat(F.lit("Only "), n.cast("string"), F.lit(" comparable"), F.when(n == 1, "").otherwise("s"),
                    F.lit(" found — consider widening criteria."))
    return stats.select("request_id", "comparable_count", (n < minimum).alias("limited"), F.when(n < minimum, text).alias("message"))


# --- insights ----------------------------------------------------------------------

def low_crime_premium(metrics: DataFrame, sales: DataFrame, as_of: dt.date) -> DataFrame:
    """Median price of the lowest vs highest crime quartile of outcodes, premium % to 1 dp."""
    cq = ntile(metrics.where(F.col("crime_rate_index").isNotNull()).select("outcode", "crime_rate_index"),
               4, [F.col("crime_rate_index").asc_nulls_last(), F.col("outcode")], "crime_quartile", bounded=True)
    s = recent_sales(sales, as_of).select("outcode", "sale_price")
    j = s.join(cq.where(F.col("crime_quartile").isin(1, 4)).select("outcode", "crime_quartile"), "outcode")
    med = percentile_cont(j, ["crime_quartile"], "sale_price", {"median": "0.5"})
    x = med.agg(F.max(F.when(F.col("crime_quartile") == 1, F.col("median"))).alias("low_crime_median"),
                F.max(F.when(F.col("crime_quartile") == 4, F.col("median"))).alias("high_crime_median"),
                F.max(F.when(F.col("crime_quartile") == 1, 1)).alias("_has_lo"),
                F.max(F.when(F.col("crime_quartile") == 4, 1)).alias("_has_hi")) \
           .where(F.col("_has_lo").isNotNull() & F.col("_has_hi").isNotNull())
    le4 = F.round(F.col("low_crime_median") * 10000).cast("long")
    he4 = F.round(F.col("high_crime_median") * 10000).cast("long")
    return x.select("low_crime_median", "high_crime_median",
                    F.when(F.col("high_crime_median") > 0, half_up((le4 - he4) * 100, he4, 1)).alias("premium_pct"))


def period_findings(sales: DataFrame, as_of: dt.date) -> DataFrame:
    """Recent 12 m vs prior 12 m averages per outcode and for all outcodes, in one pass."""
    recent = trailing(F.col("sale_date"), as_of, 12)
    prior = trailing(F.col("sale_date"), as_of, 24, skip_months=12)
    c = F.col("price_cents")
    s = sales.where(F.col("outcode").isNotNull() & (F.col("sale_date") >= F.lit(months_back(as_of, 24))))
    aggs = [F.sum(F.when(recent, c)).alias("_r1"), F.count(F.when(recent, c)).alias("_rn"),
            F.sum(F.when(recent, c.cast("decimal(38,0)") * c)).alias("_r2"),
            F.sum(F.when(prior, c)).alias("_p1"), F.count(F.when(prior, c)).alias("_pn")]
    per = s.groupBy("outcode").agg(*aggs)
    t = per.agg(F.sum("_r1").alias("g1"), F.sum("_rn").alias("gn"), F.sum("_p1").alias("h1"),
                F.sum("_pn").alias("hn")).first()
    x = per.select("*", *[F.lit(t[c]).cast("long").alias(f"_{c}") for c in ("g1", "gn", "h1", "hn")])
    return x.select(
        "outcode",
        half_up(F.col("_r1"), F.col("_rn") * 100, 6).alias("oc_avg"),
        half_up(F.col("_p1"), F.col("_pn") * 100, 6).alias("oc_prior_avg"),
        half_up(F.col("_g1"), F.col("_gn") * 100, 6).alias("reg_avg"),
        half_up(F.col("_h1"), F.col("_hn") * 100, 6).alias("reg_prior_avg"),
        stddev_exact(F.col("_rn"), F.col("_r1"), F.col("_r2"), 100.0).alias("oc_stddev"),
        F.col("_rn").alias("tx_count"))


def findings_text(pf: DataFrame) -> DataFrame:
    """Up to three findings per outcode: relative growth (pp), volatility (CV %), liquidity."""
    a1 = F.round(F.col("oc_avg") * 1e6).cast("decimal(38,0)")
    a0 = F.round(F.col("oc_prior_avg") * 1e6).cast("decimal(38,0)")
    b1 = F.round(F.col("reg_avg") * 1e6).cast("decimal(38,0)")
    b0 = F.round(F.col("reg_prior_avg") * 1e6).cast("decimal(38,0)")
    num = ((a1 - a0) * b0 - (b1 - b0) * a0) * 100
    diff1 = half_up(num, a0 * b0, 1, wide=True)
    growth_ok = (F.coalesce(F.col("oc_prior_avg"), F.lit(0.0)) > 0) & (F.coalesce(F.col("reg_prior_avg"), F.lit(0.0)) > 0)
    g = F.struct(F.lit(1).alias("slot"),
                 F.when(num > 0, "Outperforming London").otherwise("Underperforming London").alias("title"),
                 F.concat(F.when(num > 0, "+").otherwise(""), F.format_string("%.1f", diff1), F.lit("pp")).alias("value"),
                 F.concat(F.col("outcode"), F.lit(" prices grew "), F.format_string("%.1f", half_up(F.abs(a1 - a0) * 100, a0, 1, wide=True)),
                          F.lit("% YoY vs London average of "), F.format_string("%.1f", half_up((b1 - b0) * 100, b0, 1, wide=True)),
                          F.lit("%.")).alias("description"),
                 growth_ok.alias("ok"))
    avg = F.coalesce(F.col("oc_avg"), F.lit(0.0))
    sd = F.coalesce(F.col("oc_stddev"), F.lit(0.0))
    cv = sd / avg * 100
    v = F.struct(F.lit(2).alias("slot"),
                 F.when(cv > 50, "High Price Volatility").otherwise("Moderate Price Stability").alias("title"),
                 F.concat(F.lit("CV "), F.format_string("%.1f", cv), F.lit("%")).alias("value"),
                 F.concat(F.lit("Coefficient of variation is "), F.format_string("%.1f", cv), F.lit("% over the last 12 months.")).alias("description"),
                 ((avg > 0) & (sd > 0)).alias("ok"))
    t = F.struct(F.lit(3).alias("slot"),
                 F.when(F.col("tx_count") > 100, "Active Market").otherwise("Low Liquidity").alias("title"),
                 F.concat(F.col("tx_count").cast("string"), F.lit(" sales")).alias("value"),
                 F.concat(F.col("tx_count").cast("string"), F.lit(" transactions recorded in the last 12 months.")).alias("description"),
                 F.lit(True).alias("ok"))
    e = pf.where(F.col("tx_count") > 0).select("outcode", F.explode(F.array(g, v, t)).alias("f")).where("f.ok")
    from pyspark.sql import Window
    w = Window.partitionBy("outcode").orderBy("f.slot")
    return e.select("outcode", F.row_number().over(w).cast("long").alias("ord"),
                    F.col("f.title").alias("title"), F.col("f.value").alias("value"), F.col("f.description").alias("description")).where(F.col("ord") <= 3)


def crime_by_group(crime: DataFrame, loc: DataFrame, as_of: dt.date, group: str = "borough") -> DataFrame:
    """total crimes, distinct LSOAs and crimes per LSOA by borough, trailing 12 months."""
    c = crime.where(trailing(F.col("reference_period"), as_of, 12)).groupBy("lsoa_code").agg(F.sum("count").alias("_cnt"))
    l = loc.where(F.col(group).isNotNull()).groupBy("lsoa_code", group).agg(F.count(F.lit(1)).alias("_w"))
    j = c.join(l, "lsoa_code")
    g = j.groupBy(group).agg(F.sum(F.col("_cnt") * F.col("_w")).alias("_s"),
                             F.countDistinct("lsoa_code").alias("lsoa_count"))
    return g.select(group, F.col("_s").cast("long").alias("total_crimes"), "lsoa_count",
                    half_up(F.col("_s"), F.col("lsoa_count"), 2).alias("crime_rate")).orderBy(F.col("crime_rate").desc())


# The insight's texts and the canned fallback used when no premium can be computed.
PREMIUM_TITLE = "Low-Crime Premium"
PREMIUM_METHODOLOGY = ("Median sale price comparison: lowest-crime-quartile outcodes vs highest-crime-quartile outcodes from "
                       "mv_postcode_investment_metrics, filtered to transactions in the last 12 months.")
PREMIUM_FALLBACK_VALUE = "~40% premium"
PREMIUM_FALLBACK_TEXT = ("Properties in London's safest quartile of outcodes typically command a significant "
                         "price premium over the highest-crime areas.")


def _js_number_1dp(x: F.Column) -> F.Column:
    """A 1-dp value printed like a JavaScript number (12.0 → '12', -5.5 → '-5.5')."""
    return F.regexp_replace(x.cast("decimal(20,1)").cast("string"), r"\.0$", "")


def premium_insight(premium: DataFrame) -> DataFrame:
    """title, value, description, methodology for the low-crime premium (X5 text), falling back when absent."""
    # a global aggregate always yields exactly one row: NULL when there is no usable premium
    x = premium.agg(F.max(F.when(F.col("premium_pct") != 0, F.col("premium_pct"))).alias("premium_pct"))
    pct = F.col("premium_pct")
    has = pct.isNotNull()
    desc = F.concat(F.lit("Properties in London's safest quartile of outcodes sell for "), _js_number_1dp(F.abs(pct)),
                    F.lit("% "), F.when(pct > 0, "more").otherwise("less"),
                    F.lit(" than those in the highest-crime quartile (last 12 months)."))
    return x.select(F.lit(PREMIUM_TITLE).alias("title"),
                    F.when(has, F.concat(F.when(pct > 0, "+").otherwise(""), _js_number_1dp(pct), F.lit("%")))
                     .otherwise(F.lit(PREMIUM_FALLBACK_VALUE)).alias("value"),
                    F.when(has, desc).otherwise(F.lit(PREMIUM_FALLBACK_TEXT)).alias("description"),
                    F.when(has, F.lit(PREMIUM_METHODOLOGY)).otherwise("fallback").alias("methodology"))

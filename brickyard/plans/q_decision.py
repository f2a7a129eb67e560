"""Registered queries: composite score, finance, comparables, insights (steps 3-4)."""

from __future__ import annotations

from ..functions.sqlfunctions import register as register_functions
from ..operators import decision as D
from ..operators import metrics as M
from ..sources import bindings as b
from .oracle_bindings import AS_OF_ASSET, AS_OF_CRIME, AS_OF_SALE, register, with_
from .q_metrics import CRIME12, RECENT, metrics_table
from .registry import ORACLE, query
from .sqlfrag import HU, STDDEV


def PAY(pc: str, rt: str, mtype: str, rounded: bool = True) -> str:
    p, rate, r = f"(CAST({pc} AS DOUBLE) / 100.0)", f"(CAST({rt} AS DOUBLE) / 10.0)", f"(CAST({rt} AS DOUBLE) / 12000.0)"
    f = f"pow(1.0 + {r}, 300.0)"
    ann = f"{p} * {r} * {f} / ({f} - 1.0)"
    if rounded:
        io, flat, ann = HU(f"{pc} * {rt}", "1200000", 2), HU(pc, "30000", 2), f"round({ann}, 2)"
    else:
        io, flat, ann = f"round({p} * {rate} / 100.0 / 12.0, 6)", f"round({p} / 300.0, 6)", f"round({ann}, 6)"
    return f"(CASE WHEN {pc} = 0 THEN 0.0 WHEN {mtype} = 'INTEREST_ONLY' THEN {io} WHEN {rt} = 0 THEN {flat} ELSE {ann} END)"


_grv = ORACLE["growth_risk_volatility"]
register("grv", ["hpi_index", "crime_stat", "location", "request"], _grv[_grv.index("SELECT k.outcode"):])

register("pay", ["request", "mortgage_product"], f"""
SELECT *, CASE WHEN rate_tenths IS NOT NULL THEN {PAY('_loan_c', 'rate_tenths', 'mortgage_type')} END AS monthly_payment
FROM (SELECT r.*, p.mortgage_type, p.rate_tenths, r.asking_price * (100 - r.deposit_pct) AS _loan_c
      FROM request r LEFT JOIN mortgage_product p USING (mortgage_product_id))""")

register("score", ["pay", "outcode_metrics", "grv"], f"""
SELECT request_id,
       CASE WHEN has THEN yield_quartile END AS yield_quartile, CASE WHEN has THEN growth_quartile END AS growth_quartile,
       CASE WHEN has THEN {HU('rent_cents * 12', 'asking_price', 6)} ELSE 0.0 END AS gross_yield_pct,
       CASE WHEN has THEN {HU('rent_cents * 9', 'asking_price', 6)} ELSE 0.0 END AS net_yield_pct,
       CASE WHEN has THEN COALESCE(avg_annual_growth, 0.0) END AS avg_annual_growth,
       CASE WHEN has THEN COALESCE(avg_crime_rate, 0.0) END AS avg_crime_rate,
       CASE WHEN has THEN COALESCE(price_volatility, 0.0) END AS price_volatility,
       CASE WHEN has THEN monthly_payment ELSE 0.0 END AS monthly_payment,
       CASE WHEN has THEN cash END AS net_monthly_cashflow,
       CASE WHEN has THEN {HU('35 * COALESCE(yield_quartile, 2) + 25 * COALESCE(growth_quartile, 2) + 60 + 20 * (CASE WHEN cash > 0 THEN 3 ELSE 1 END)', '4', 2)}
            ELSE 50.0 END AS composite_score
FROM (SELECT pay.*, m.yield_quartile, m.growth_quartile, g.avg_annual_growth, g.avg_crime_rate, g.price_volatility,
             {HU('3 * rent_cents - 4 * CAST(ROUND(monthly_payment * 100) AS BIGINT)', '400', 4)} AS cash,
             (m.yield_quartile IS NOT NULL AND monthly_payment IS NOT NULL) AS has
      FROM pay LEFT JOIN outcode_metrics m USING (outcode) LEFT JOIN grv g USING (outcode))""")

register("risk_q", ["crime_stat", "location"], ORACLE["risk_quartile"][ORACLE["risk_quartile"].index("SELECT outcode, avg_crime_rate"):])

register("score_risk", ["pay", "outcode_metrics", "grv", "risk_q"], f"""
SELECT request_id,
       CASE WHEN has THEN yield_quartile END AS yield_quartile, CASE WHEN has THEN growth_quartile END AS growth_quartile,
       CASE WHEN has THEN {HU('rent_cents * 12', 'asking_price', 6)} ELSE 0.0 END AS gross_yield_pct,
       CASE WHEN has THEN {HU('rent_cents * 9', 'asking_price', 6)} ELSE 0.0 END AS net_yield_pct,
       CASE WHEN has THEN COALESCE(avg_annual_growth, 0.0) END AS avg_annual_growth,
       CASE WHEN has THEN COALESCE(avg_crime_rate, 0.0) END AS avg_crime_rate,
       CASE WHEN has THEN COALESCE(price_volatility, 0.0) END AS price_volatility,
       CASE WHEN has THEN monthly_payment ELSE 0.0 END AS monthly_payment,
       CASE WHEN has THEN cash END AS net_monthly_cashflow,
       CASE WHEN has THEN {HU('35 * COALESCE(yield_quartile, 2) + 25 * COALESCE(growth_quartile, 2) + 20 * COALESCE(risk_quartile, 2) + 20 * (CASE WHEN cash > 0 THEN 3 ELSE 1 END)', '4', 2)}
            ELSE 50.0 END AS composite_score
FROM (SELECT pay.*, m.yield_quartile, m.growth_quartile, rq.risk_quartile, g.avg_annual_growth, g.avg_crime_rate, g.price_volatility,
             {HU('3 * rent_cents - 4 * CAST(ROUND(monthly_payment * 100) AS BIGINT)', '400', 4)} AS cash,
             (m.yield_quartile IS NOT NULL AND monthly_payment IS NOT NULL) AS has
      FROM pay LEFT JOIN outcode_metrics m USING (outcode) LEFT JOIN grv g USING (outcode) LEFT JOIN risk_q rq USING (outcode))""")

register("scen", ["request", "mortgage_product"], f"""
SELECT request_id, scenario, rent_cents, _loan_c, {PAY('_loan_c', 'rate_tenths', 'scenario', rounded=False)} AS monthly
FROM (SELECT r.*, COALESCE(p.rate_tenths, 50) AS rate_tenths, r.asking_price * (100 - r.deposit_pct) AS _loan_c
      FROM request r LEFT JOIN mortgage_product p USING (mortgage_product_id)),
     (SELECT unnest(['INTEREST_ONLY', 'REPAYMENT']) AS scenario)""")


def _frames(spark, d):
    as_of, cas = b.sale_as_of(spark, d), b.crime_as_of(spark, d)
    grv = M.growth_risk_volatility(b.hpi_index(spark, d), b.crime_stat(spark, d), b.location(spark, d), as_of, cas)
    return D.composite_score(b.request(spark, d), metrics_table(spark, d), b.mortgage_product(spark, d), grv)


@query("composite_score", with_("score") + "SELECT * FROM score")
def q_composite_score(spark, d):
    return _frames(spark, d)


@query("composite_score_risk", with_("score_risk") + "SELECT * FROM score_risk")
def q_composite_score_risk(spark, d):
    as_of, cas = b.sale_as_of(spark, d), b.crime_as_of(spark, d)
    grv = M.growth_risk_volatility(b.hpi_index(spark, d), b.crime_stat(spark, d), b.location(spark, d), as_of, cas)
    risk = M.risk_quartile(b.crime_stat(spark, d), b.location(spark, d), cas)
    return D.composite_score(b.request(spark, d), metrics_table(spark, d), b.mortgage_product(spark, d), grv, risk=risk)


@query("verdict", with_("score") + """
SELECT request_id, composite_score,
       CASE WHEN composite_score > 75 AND COALESCE(yield_quartile, 2) >= 3 AND COALESCE(growth_quartile, 2) >= 3 THEN 'UNICORN'
            WHEN composite_score > 60 AND COALESCE(yield_quartile, 2) >= 3 THEN 'CASH_COW'
            WHEN composite_score > 60 AND COALESCE(growth_quartile, 2) >= 3 THEN 'GROWTH_PLAY'
            ELSE 'AVOID' END AS verdict FROM score""")
def q_verdict(spark, d):
    return D.verdict(_frames(spark, d))


@query("score_components", with_("score") + """
SELECT request_id,
       CAST(CASE WHEN yield_quartile IS NOT NULL THEN floor(yield_quartile / 4 * 100 + 0.5) ELSE 0 END AS BIGINT) AS yield_score,
       CAST(CASE WHEN yield_quartile IS NOT NULL THEN floor(COALESCE(growth_quartile, 2) / 4 * 100 + 0.5) ELSE 0 END AS BIGINT) AS growth_score,
       CAST(CASE WHEN yield_quartile IS NOT NULL THEN 75 ELSE 0 END AS BIGINT) AS risk_score,
       CAST(CASE WHEN yield_quartile IS NOT NULL THEN (CASE WHEN net_monthly_cashflow > 0 THEN 75 ELSE 25 END) ELSE 0 END AS BIGINT) AS cashflow_score
FROM score""")
def q_score_components(spark, d):
    return D.score_components(_frames(spark, d))


@query("score_band", with_("score") + """
SELECT request_id, composite_score,
       CASE WHEN composite_score > 60 THEN 'green' WHEN composite_score >= 40 THEN 'amber' ELSE 'red' END AS band FROM score""")
def q_score_band(spark, d):
    return D.score_band(_frames(spark, d))


@query("mortgage_payment", with_("pay") +
       "SELECT request_id, CAST(_loan_c AS DOUBLE) / 100.0 AS loan_amount, monthly_payment FROM pay")
def q_mortgage_payment(spark, d):
    return D.payments(b.request(spark, d), b.mortgage_product(spark, d))


@query("sql_monthly_payment", with_("pay", "request", "mortgage_product") + f"""
SELECT request_id, pay.monthly_payment,
       CASE WHEN rate_tenths IS NULL THEN NULL WHEN _loan_c = 0 THEN 0.0 WHEN mortgage_type = 'INTEREST_ONLY' THEN {HU('_loan_c * rate_tenths', '1200000', 6)}
            WHEN rate_tenths = 0 THEN {HU('_loan_c', '30000', 6)} ELSE {PAY('_loan_c', 'rate_tenths', 'mortgage_type', rounded=False)} END AS monthly_payment_raw
FROM (SELECT request_id, monthly_payment FROM pay) pay JOIN (SELECT r.request_id, p.mortgage_type, p.rate_tenths, r.asking_price * (100 - r.deposit_pct) AS _loan_c
               FROM request r LEFT JOIN mortgage_product p USING (mortgage_product_id)) USING (request_id)""")
def q_sql_monthly_payment(spark, d):
    """F1 and F2 by their names in SQL."""
    register_functions(spark)
    b.request(spark, d).createOrReplaceTempView("payment_request")
    b.mortgage_product(spark, d).createOrReplaceTempView("payment_product")
    return spark.sql("""
        SELECT request_id, CAST(calculate_monthly_payment(loan, rate, 25, mortgage_type) AS DOUBLE) AS monthly_payment,
               CAST(calculate_monthly_payment_raw(loan, rate, 25, mortgage_type) AS DOUBLE) AS monthly_payment_raw
        FROM (SELECT request_id, CAST(asking_price * (100 - deposit_pct) AS DECIMAL(18,0)) / 100 AS loan, p.mortgage_type,
                     CAST(p.rate_tenths AS DECIMAL(9,0)) / 10 AS rate
              FROM payment_request LEFT JOIN payment_product p USING (mortgage_product_id))""")


@query("mortgage_payment_raw", with_("request", "mortgage_product") + f"""
SELECT request_id, CAST(_loan_c AS DOUBLE) / 100.0 AS loan_amount,
       CASE WHEN rate_tenths IS NOT NULL THEN {PAY('_loan_c', 'rate_tenths', 'mortgage_type', rounded=False)} END AS monthly_payment
FROM (SELECT r.*, p.mortgage_type, p.rate_tenths, r.asking_price * (100 - r.deposit_pct) AS _loan_c
      FROM request r LEFT JOIN mortgage_product p USING (mortgage_product_id))""")
def q_mortgage_payment_raw(spark, d):
    return D.payments(b.request(spark, d), b.mortgage_product(spark, d), rounded=False)


@query("mortgage_scenarios", with_("scen") + """
SELECT request_id, scenario, monthly, round(monthly * 300, 4) AS total_paid,
       CASE WHEN scenario = 'INTEREST_ONLY' THEN CAST(_loan_c AS DOUBLE) / 100.0 ELSE 0.0 END AS remaining_balance FROM scen""")
def q_mortgage_scenarios(spark, d):
    return D.mortgage_scenarios(b.request(spark, d), b.mortgage_product(spark, d))


@query("cashflow_waterfall", with_("scen") + """
SELECT request_id, scenario,
       CAST(floor(CAST(rent_cents AS DOUBLE) / 100.0 + 0.5) AS BIGINT) AS rent_income,
       CAST(floor(monthly + 0.5) AS BIGINT) AS mortgage_payment,
       CAST(floor(CAST(rent_cents AS DOUBLE) / 100.0 * 0.25 + 0.5) AS BIGINT) AS costs,
       CAST(floor(CAST(rent_cents AS DOUBLE) / 100.0 - monthly - CAST(rent_cents AS DOUBLE) / 100.0 * 0.25 + 0.5) AS BIGINT) AS net_cashflow
FROM scen""")
def q_cashflow_waterfall(spark, d):
    return D.cashflow_waterfall(b.request(spark, d), b.mortgage_product(spark, d))


@query("payment_diff", with_("scen", "pay") + """
SELECT s.request_id, s.scenario, abs(s.monthly - COALESCE(p.monthly_payment, 0.0)) AS server_diff,
       abs(s.monthly - COALESCE(p.monthly_payment, 0.0)) > 1 AS diff_gt_1
FROM scen s LEFT JOIN pay p USING (request_id)""")
def q_payment_diff(spark, d):
    return D.payment_diff(b.request(spark, d), b.mortgage_product(spark, d))


@query("yield_metrics", with_("request") + f"""
SELECT request_id, {HU('rent_cents * 12', 'asking_price', 6)} AS gross_yield_pct,
       {HU('rent_cents * 9', 'asking_price', 6)} AS net_yield_pct FROM request""")
def q_yield_metrics(spark, d):
    return D.yield_metrics(b.request(spark, d))


# --- comparables ---------------------------------------------------------------------

register("pairs", ["asset_sale", "request"], f"""
SELECT r.request_id, a.postcode AS area, a.sale_date, a.sale_price, a.price_cents, a.bedrooms, a.floor_area_sqm AS sqm,
       CASE WHEN a.floor_area_sqm > 0 THEN {HU('a.price_cents * 10', 'a.floor_area_sqm * 10764', 6)} END AS gbp6,
       CASE WHEN a.floor_area_sqm > 0 THEN {HU('a.price_cents * 10', 'a.floor_area_sqm * 10764', 2)} END AS gbp2
FROM request r JOIN asset_sale a ON a.outcode = r.outcode AND a.bedrooms = r.bedrooms AND a.property_type = r.property_type
WHERE (a.floor_area_sqm IS NULL OR (a.floor_area_sqm * 100 BETWEEN r.floor_area_sqm * 80 AND r.floor_area_sqm * 120))
  AND a.sale_date >= {AS_OF_ASSET} - INTERVAL 24 MONTH""")

register("comp_stats", ["pairs", "request"], """
SELECT r.request_id,
       ROUND(PERCENTILE_CONT(0.25) WITHIN GROUP (ORDER BY CAST(p.sale_price AS DOUBLE)), 4) AS p25,
       ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY CAST(p.sale_price AS DOUBLE)), 4) AS median,
       ROUND(PERCENTILE_CONT(0.75) WITHIN GROUP (ORDER BY CAST(p.sale_price AS DOUBLE)), 4) AS p75,
       ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY p.gbp6), 8) AS median_gbp_per_sqft,
       COUNT(p.request_id) AS comparable_count
FROM request r LEFT JOIN pairs p USING (request_id) GROUP BY r.request_id""")

register("comp_rows", ["pairs"], """
SELECT request_id, area, sale_date, CAST(sale_price AS DOUBLE) AS sale_price, gbp2 AS gbp_per_sqft, bedrooms
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY sale_date DESC, sale_price DESC, area,
                                   gbp2 DESC NULLS LAST) AS rn FROM pairs) WHERE rn <= 10""")


def _comp(spark, d):
    return b.asset_sale(spark, d), b.request(spark, d), b.asset_as_of(spark, d)


@query("comparables_stats", with_("comp_stats") + "SELECT * FROM comp_stats")
def q_comparables_stats(spark, d):
    return D.comparables_stats(*_comp(spark, d))


@query("comparables_by_range", with_("comp_stats") + "SELECT * FROM comp_stats")
def q_comparables_by_range(spark, d):
    return D.comparables_by_range(*_comp(spark, d))


@query("comparables_rows", with_("comp_rows") + "SELECT * FROM comp_rows")
def q_comparables_rows(spark, d):
    return D.comparables_rows(*_comp(spark, d))


@query("sorted_comparables", with_("comp_rows") + """
SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY request_id ORDER BY COALESCE(gbp_per_sqft, 0) DESC, sale_date DESC,
                                  sale_price DESC, area, gbp_per_sqft DESC NULLS LAST) AS BIGINT) AS position
FROM comp_rows""")
def q_sorted_comparables(spark, d):
    return D.sorted_comparables(D.comparables_rows(*_comp(spark, d)))


@query("limited_comparables", with_("comp_stats") +
       "SELECT request_id, comparable_count, comparable_count < 3 AS limited, CASE WHEN comparable_count < 3 THEN 'Only ' || "
       "CAST(comparable_count AS VARCHAR) || CASE WHEN comparable_count = 1 THEN ' comparable' ELSE ' comparables' END || "
       "' found — consider widening criteria.' END AS message FROM comp_stats")
def q_limited_comparables(spark, d):
    return D.limited_comparables(D.comparables_stats(*_comp(spark, d)))


# --- insights ------------------------------------------------------------------------

@query("low_crime_premium", with_("outcode_metrics", "sale") + f"""
SELECT lo.m AS low_crime_median, hi.m AS high_crime_median,
       CASE WHEN hi.m > 0 THEN {HU('(CAST(ROUND(lo.m * 10000) AS BIGINT) - CAST(ROUND(hi.m * 10000) AS BIGINT)) * 100', 'CAST(ROUND(hi.m * 10000) AS BIGINT)', 1)} END AS premium_pct
FROM (SELECT cq, ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY CAST(t.sale_price AS DOUBLE)), 4) AS m
      FROM (SELECT outcode, NTILE(4) OVER (ORDER BY crime_rate_index ASC NULLS LAST, outcode) AS cq
            FROM outcode_metrics WHERE crime_rate_index IS NOT NULL) c
      JOIN {RECENT} t ON t.outcode = c.outcode GROUP BY cq) lo,
     (SELECT cq, ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY CAST(t.sale_price AS DOUBLE)), 4) AS m
      FROM (SELECT outcode, NTILE(4) OVER (ORDER BY crime_rate_index ASC NULLS LAST, outcode) AS cq
            FROM outcode_metrics WHERE crime_rate_index IS NOT NULL) c
      JOIN {RECENT} t ON t.outcode = c.outcode GROUP BY cq) hi
WHERE lo.cq = 1 AND hi.cq = 4""")
def q_low_crime_premium(spark, d):
    return D.low_crime_premium(metrics_table(spark, d), b.sale(spark, d), b.sale_as_of(spark, d))


_PREM = ORACLE["low_crime_premium"]


def _js1(x: str) -> str:
    return f"regexp_replace(CAST(CAST({x} AS DECIMAL(20,1)) AS VARCHAR), '\\.0$', '')"


@query("low_crime_insight", _PREM.replace("SELECT lo.m AS low_crime_median", ", prem AS (SELECT lo.m AS low_crime_median", 1)
       + f""")
SELECT 'Low-Crime Premium' AS title,
       CASE WHEN p.premium_pct IS NOT NULL AND p.premium_pct <> 0
            THEN (CASE WHEN p.premium_pct > 0 THEN '+' ELSE '' END) || {_js1('p.premium_pct')} || '%'
            ELSE '~40% premium' END AS value,
       CASE WHEN p.premium_pct IS NOT NULL AND p.premium_pct <> 0
            THEN 'Properties in London''s safest quartile of outcodes sell for ' || {_js1('abs(p.premium_pct)')} || '% '
                 || (CASE WHEN p.premium_pct > 0 THEN 'more' ELSE 'less' END)
                 || ' than those in the highest-crime quartile (last 12 months).'
            ELSE 'Properties in London''s safest quartile of outcodes typically command a significant price premium over the highest-crime areas.'
            END AS description,
       CASE WHEN p.premium_pct IS NOT NULL AND p.premium_pct <> 0 
            THEN 'Median sale price comparison: lowest-crime-quartile outcodes vs highest-crime-quartile outcodes from mv_postcode_investment_metrics, filtered to transactions in the last 12 months.'
            ELSE 'fallback' END AS methodology
FROM (SELECT 1 AS k) one LEFT JOIN (SELECT 1 AS k, premium_pct FROM prem) p ON one.k = p.k""")
def q_low_crime_insight(spark, d):
    return D.premium_insight(D.low_crime_premium(metrics_table(spark, d), b.sale(spark, d), b.sale_as_of(spark, d)))


register("pf", ["sale"], f"""
SELECT o.outcode,
       {HU('o.r1', 'o.rn * 100', 6)} AS oc_avg, {HU('o.p1', 'o.pn * 100', 6)} AS oc_prior_avg,
       {HU('g.r1', 'g.rn * 100', 6)} AS reg_avg, {HU('g.p1', 'g.pn * 100', 6)} AS reg_prior_avg,
       {STDDEV('o.rn', 'o.r1', 'o.r2', 100.0)} AS oc_stddev, o.rn AS tx_count
FROM (SELECT outcode,
             SUM(CASE WHEN sale_date >= {AS_OF_SALE} - INTERVAL 12 MONTH THEN price_cents END) AS r1,
             COUNT(CASE WHEN sale_date >= {AS_OF_SALE} - INTERVAL 12 MONTH THEN price_cents END) AS rn,
             SUM(CASE WHEN sale_date >= {AS_OF_SALE} - INTERVAL 12 MONTH THEN CAST(price_cents AS HUGEINT) * price_cents END) AS r2,
             SUM(CASE WHEN sale_date < {AS_OF_SALE} - INTERVAL 12 MONTH THEN price_cents END) AS p1,
             COUNT(CASE WHEN sale_date < {AS_OF_SALE} - INTERVAL 12 MONTH THEN price_cents END) AS pn
      FROM sale WHERE outcode IS NOT NULL AND sale_date >= {AS_OF_SALE} - INTERVAL 24 MONTH GROUP BY outcode) o,
     (SELECT SUM(CASE WHEN sale_date >= {AS_OF_SALE} - INTERVAL 12 MONTH THEN price_cents END) AS r1,
             COUNT(CASE WHEN sale_date >= {AS_OF_SALE} - INTERVAL 12 MONTH THEN price_cents END) AS rn,
             SUM(CASE WHEN sale_date < {AS_OF_SALE} - INTERVAL 12 MONTH THEN price_cents END) AS p1,
             COUNT(CASE WHEN sale_date < {AS_OF_SALE} - INTERVAL 12 MONTH THEN price_cents END) AS pn
      FROM sale WHERE outcode IS NOT NULL AND sale_date >= {AS_OF_SALE} - INTERVAL 24 MONTH) g""")


@query("period_findings", with_("pf") + "SELECT * FROM pf")
def q_period_findings(spark, d):
    return D.period_findings(b.sale(spark, d), b.sale_as_of(spark, d))


_A = "CAST(ROUND({} * 1000000) AS HUGEINT)"
_A1, _A0, _B1, _B0 = (_A.format(c) for c in ("oc_avg", "oc_prior_avg", "reg_avg", "reg_prior_avg"))
_NUM = (f"((({_A.format('oc_avg')} - {_A.format('oc_prior_avg')}) * {_A.format('reg_prior_avg')} - "
        f"({_A.format('reg_avg')} - {_A.format('reg_prior_avg')}) * {_A.format('oc_prior_avg')}) * 100)")
_DEN = f"({_A.format('oc_prior_avg')} * {_A.format('reg_prior_avg')})"
_CV = "(COALESCE(oc_stddev, 0.0) / COALESCE(oc_avg, 0.0) * 100)"


@query("findings_text", with_("pf") + f"""
SELECT outcode, CAST(ROW_NUMBER() OVER (PARTITION BY outcode ORDER BY slot) AS BIGINT) AS ord, title, value, description FROM (
  SELECT outcode, 1 AS slot, CASE WHEN {_NUM} > 0 THEN 'Outperforming London' ELSE 'Underperforming London' END AS title,
         (CASE WHEN {_NUM} > 0 THEN '+' ELSE '' END) || printf('%.1f', {HU(_NUM, _DEN, 1)}) || 'pp' AS value,
         outcode || ' prices grew ' || printf('%.1f', {HU(f'abs({_A1} - {_A0}) * 100', _A0, 1)}) || '% YoY vs London average of '
         || printf('%.1f', {HU(f'({_B1} - {_B0}) * 100', _B0, 1)}) || '%.' AS description
  FROM pf WHERE tx_count > 0 AND COALESCE(oc_prior_avg, 0) > 0 AND COALESCE(reg_prior_avg, 0) > 0
  UNION ALL
  SELECT outcode, 2, CASE WHEN {_CV} > 50 THEN 'High Price Volatility' ELSE 'Moderate Price Stability' END,
         'CV ' || printf('%.1f', {_CV}) || '%', 'Coefficient of variation is ' || printf('%.1f', {_CV}) || '% over the last 12 months.'
  FROM pf WHERE tx_count > 0 AND COALESCE(oc_avg, 0) > 0 AND COALESCE(oc_stddev, 0) > 0
  UNION ALL
  SELECT outcode, 3, CASE WHEN tx_count > 100 THEN 'Active Market' ELSE 'Low Liquidity' END, CAST(tx_count AS VARCHAR) || ' sales',
         CAST(tx_count AS VARCHAR) || ' transactions recorded in the last 12 months.'
  FROM pf WHERE tx_count > 0)""")
def q_findings_text(spark, d):
    return D.findings_text(D.period_findings(b.sale(spark, d), b.sale_as_of(spark, d)))


@query("crime_by_group", with_("crime_stat", "location") + f"""
SELECT l.borough, CAST(SUM(cs.count) AS BIGINT) AS total_crimes, COUNT(DISTINCT l.lsoa_code) AS lsoa_count,
       {HU('SUM(cs.count)', 'COUNT(DISTINCT l.lsoa_code)', 2)} AS crime_rate
FROM {CRIME12} cs JOIN location l ON l.lsoa_code = cs.lsoa_code
WHERE l.borough IS NOT NULL GROUP BY l.borough ORDER BY crime_rate DESC""")
def q_crime_by_group(spark, d):
    return D.crime_by_group(b.crime_stat(spark, d), b.location(spark, d), b.crime_as_of(spark, d))

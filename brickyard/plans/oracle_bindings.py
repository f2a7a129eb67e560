"""DuckDB text of the relations in ``sources.bindings`` (same rules, same names)."""

from __future__ import annotations

from .sqlfrag import CENTS, HUI, PCDS

B: dict[str, tuple[str, list[str]]] = {}


def _b(name: str, deps: list[str], sql: str) -> None:
    B[name] = (sql, deps)


_b("sale", [], f"""
SELECT o.o_orderkey AS sale_id, n.n_name || '/' || c.c_mktsegment AS sector, n.n_name AS outcode,
       r.r_name AS area, 'ALL' AS region, CAST(o.o_totalprice AS DECIMAL(12,2)) AS sale_price,
       {CENTS('o.o_totalprice')} AS price_cents, CAST(o.o_orderdate AS DATE) AS sale_date,
       o.o_orderpriority AS category
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")

_b("asset_sale", [], f"""
SELECT l.l_orderkey, l.l_linenumber, p.p_partkey AS property_id, p.p_type AS property_type,
       CAST(p.p_size % 5 + 1 AS BIGINT) AS bedrooms,
       CAST(CASE WHEN p.p_partkey % 10 = 0 THEN NULL ELSE 10 + 2 * p.p_size END AS BIGINT) AS floor_area_sqm,
       n.n_name AS outcode, s.s_name AS postcode, CAST(l.l_extendedprice AS DECIMAL(12,2)) AS sale_price,
       {CENTS('l.l_extendedprice')} AS price_cents, CAST(l.l_shipdate AS DATE) AS sale_date
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey""")

_b("hpi_index", ["sale"], f"""
SELECT outcode, reference_month, CAST(avg_cents AS DOUBLE) / 100.0 AS average_price,
       CAST({HUI('avg_cents * 10000', '_first')} AS DOUBLE) / 100.0 AS index_value,
       CAST(apc_centi AS DOUBLE) / 100.0 AS annual_pct_change, avg_cents, apc_centi
FROM (
  SELECT *, CASE WHEN _lag > 0 THEN {HUI('(avg_cents - _lag) * 10000', '_lag')} END AS apc_centi
  FROM (
    SELECT *, first_value(avg_cents) OVER (PARTITION BY outcode ORDER BY reference_month) AS _first,
           lag(avg_cents, 12) OVER (PARTITION BY outcode ORDER BY reference_month) AS _lag
    FROM (
      SELECT outcode, reference_month, {HUI('_s', '_n')} AS avg_cents
      FROM (SELECT outcode, CAST(date_trunc('month', sale_date) AS DATE) AS reference_month,
                   SUM(price_cents) AS _s, COUNT(*) AS _n FROM sale GROUP BY ALL)
      WHERE last_day(reference_month) <= (SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders))))""")

_b("rental_index", [], f"""
SELECT region, reference_month, CAST(index_centi AS DOUBLE) / 100.0 AS index_value, index_centi
FROM (SELECT r.r_name AS region, CAST(date_trunc('month', CAST(l.l_shipdate AS DATE)) AS DATE) AS reference_month,
             {HUI(f"SUM({CENTS('l.l_extendedprice')})", 'SUM(CAST(l.l_quantity AS BIGINT)) * 10')} AS index_centi
      FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
      JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
      GROUP BY ALL)""")

_b("location", [], """
SELECT CAST(u.user_id AS VARCHAR) || '-' || CAST(k.k AS VARCHAR) AS postcode, n.n_name AS outcode,
       r.r_name AS borough, 'London' AS region, u.user_id AS lsoa_code
FROM (SELECT DISTINCT user_id FROM events) u
CROSS JOIN LATERAL (SELECT unnest(range(0, CAST(u.user_id % 3 AS BIGINT) + 1)) AS k) k
JOIN nation n ON u.user_id % 25 = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey""")

_b("crime_stat", [], """
SELECT user_id AS lsoa_code, CAST(ts AS DATE) AS reference_period, event_type AS category, COUNT(*) AS count
FROM events GROUP BY ALL""")

_b("mortgage_product", [], """
SELECT s_suppkey AS mortgage_product_id, s_name AS lender, 'Product ' || CAST(s_suppkey AS VARCHAR) AS product_name,
       CASE WHEN s_suppkey % 2 = 0 THEN 'REPAYMENT' ELSE 'INTEREST_ONLY' END AS mortgage_type,
       CAST(60 + 5 * (s_suppkey % 5) AS BIGINT) AS max_ltv_pct,
       CAST(CAST(rate_tenths AS DECIMAL(5,3)) / 10 AS DECIMAL(5,3)) AS initial_rate_pct, rate_tenths,
       CAST((s_suppkey % 4) * 500 AS BIGINT) AS product_fee_gbp,
       CAST(24 + 12 * (s_suppkey % 4) AS BIGINT) AS initial_period_months,
       CAST(CAST(70 + s_suppkey % 30 AS DECIMAL(5,3)) / 10 AS DECIMAL(5,3)) AS follow_on_rate_pct,
       DATE '2024-01-01' + CAST(s_suppkey % 365 AS INTEGER) AS captured_at,
       CASE WHEN s_suppkey % 7 <> 0 THEN 'https://lender.example/' || CAST(s_suppkey AS VARCHAR) END AS source_url
FROM (SELECT *, CAST(CASE WHEN s_suppkey % 50 = 0 THEN 0 ELSE 30 + s_suppkey % 40 END AS BIGINT) AS rate_tenths FROM supplier)""")

_b("request", [], f"""
SELECT c.c_custkey AS request_id, n.n_name AS outcode, CAST(50000 + 100 * c.c_custkey AS BIGINT) AS asking_price,
       {HUI('(50000 + 100 * c.c_custkey) * (4 + c.c_custkey % 5) * 100', '1200')} AS rent_cents,
       CAST(5 + c.c_custkey % 46 AS BIGINT) AS deposit_pct,
       c.c_custkey % (SELECT COUNT(*) FROM supplier) AS mortgage_product_id,
       CAST(c.c_custkey % 5 + 1 AS BIGINT) AS bedrooms,
       (['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'])[CAST(c.c_custkey % 6 + 1 AS INTEGER)] AS property_type,
       CAST(12 + 2 * (c.c_custkey % 50) AS BIGINT) AS floor_area_sqm,
       CASE WHEN c.c_custkey % 9 = 0 THEN 'INVALID' ELSE {PCDS('c.c_custkey')} END AS postcode,
       CASE WHEN c.c_custkey % 11 = 0 THEN 'CASTLE'
            ELSE (['DETACHED', 'SEMI_DETACHED', 'TERRACED', 'FLAT', 'OTHER'])[CAST(c.c_custkey % 5 + 1 AS INTEGER)] END AS form_type
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")


def with_(*names: str) -> str:
    """``WITH`` clause defining ``names`` and their dependencies, in order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in B[n][1]:
            visit(dep)
        order.append(n)

    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({B[n][0]})" for n in order) + "\n"


def register(name: str, deps: list[str], sql: str) -> None:
    """Add a derived relation (used by later modules for shared CTEs)."""
    _b(name, deps, sql)

AS_OF_SALE = "(SELECT CAST(MAX(o_orderdate) AS DATE) FROM orders)"
AS_OF_ASSET = "(SELECT CAST(MAX(l_shipdate) AS DATE) FROM lineitem)"
AS_OF_CRIME = "(SELECT CAST(MAX(ts) AS DATE) FROM events)"

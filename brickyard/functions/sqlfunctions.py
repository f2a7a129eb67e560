"""Functions and the metrics refresh by name in SQL.

``register`` puts SQL-bodied functions into the session catalogue; the optimiser
inlines their expressions, so that they cost what the expressions cost.  Whole
statements can't be functions: the refresh is a session variable that holds its
statement, run by ``EXECUTE IMMEDIATE refresh_postcode_metrics``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The payment, unrounded or rounded to pence; interest-only and 0 % are exact quotients, the annuity is a double.
_PAYMENT = """
CASE WHEN principal = 0 THEN CAST(0 AS DECIMAL(18,{scale}))
     WHEN mortgage_type = 'INTEREST_ONLY' THEN CAST(ROUND(principal * annual_rate_pct / 1200, {scale}) AS DECIMAL(18,{scale}))
     WHEN annual_rate_pct = 0 THEN CAST(ROUND(principal / (term_years * 12), {scale}) AS DECIMAL(18,{scale}))
     ELSE CAST(ROUND(CAST(principal AS DOUBLE) * (CAST(annual_rate_pct AS DOUBLE) / 1200)
                     * POWER(1 + CAST(annual_rate_pct AS DOUBLE) / 1200, term_years * 12)
                     / (POWER(1 + CAST(annual_rate_pct AS DOUBLE) / 1200, term_years * 12) - 1), {scale}) AS DECIMAL(18,{scale})) END"""
_ARGUMENTS = "principal DECIMAL(18,2), annual_rate_pct DECIMAL(9,4), term_years INT, mortgage_type STRING"
FUNCTIONS = {
    "calculate_monthly_payment": (_ARGUMENTS, "DECIMAL(18,2)", _PAYMENT.format(scale=2)),
    "calculate_monthly_payment_raw": (_ARGUMENTS, "DECIMAL(18,6)", _PAYMENT.format(scale=6)),
}
#: Session variable with the refresh statement, the table that it fills, and the view that it reads.
REFRESH, STORE, DEFINITION = "refresh_postcode_metrics", "mv_postcode_investment_metrics", "postcode_investment_metrics_now"


def register(spark: SparkSession) -> None:
    """Create or replace the session's functions."""
    for name, (arguments, result, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {result} RETURN {body}")


def register_refresh(spark: SparkSession, metrics: DataFrame, path: str) -> None:
    """Make ``metrics`` refreshable by name: a table at ``path``, and the statement that overwrites it."""
    metrics.createOrReplaceTempView(DEFINITION)
    spark.sql(f"DROP TABLE IF EXISTS {STORE}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in metrics.schema)
    spark.sql(f"CREATE TABLE {STORE} ({columns}) USING PARQUET LOCATION '{path}'")
    spark.sql(f"DECLARE OR REPLACE VARIABLE {REFRESH} STRING DEFAULT 'INSERT OVERWRITE TABLE {STORE} SELECT * FROM {DEFINITION}'")

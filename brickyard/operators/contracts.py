"""Data contracts and the quality table.

A CHECK passes on NULL, so a violation is ``NOT(pred)`` evaluated to TRUE.
Each check family is one aggregation per table (a single scan), unpivoted
into (contract, table, n) rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def violations(df: DataFrame, table: str, checks: dict[str, Column]) -> DataFrame:
    """(contract, table, n) with n = rows where the check predicate is TRUE."""
    agg = df.agg(*[F.count_if(F.coalesce(pred, F.lit(False))).alias(name) for name, pred in checks.items()])
    stack = ", ".join(f"'{n}', `{n}`" for n in checks)
    return agg.selectExpr(f"stack({len(checks)}, {stack}) as (contract, n)").select(
        "contract", F.lit(table).alias("table"), F.col("n").cast("long").alias("n"))


# The domains of the stored enum columns.
ENUMS = {
    "property_type_enum": ["DETACHED", "SEMI_DETACHED", "TERRACED", "FLAT", "OTHER"],
    "tenure_enum": ["FREEHOLD", "LEASEHOLD", "SHARED_OWNERSHIP"],
    "transaction_category_enum": ["STANDARD_SALE", "NEW_BUILD", "OTHER"],
}


def not_in(col: Column, domain: list[str]) -> Column:
    """A value outside its domain; NULL passes, as in a CHECK."""
    return ~col.isin(*domain)


def duplicate_keys(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """Number of key values that occur more than once; NULL keys are distinct and ignored."""
    d = df.na.drop(subset=keys).groupBy(*keys).count().where(F.col("count") > 1)
    return d.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("unique(" + ",".join(keys) + ")").alias("contract"), F.lit(table).alias("table"), F.col("n").cast("long"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str, table: str) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent."""
    p = parent.select(F.col(parent_key).alias(child_key)).distinct()
    o = child.where(F.col(child_key).isNotNull()).join(p, child_key, "left_anti")
    return o.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(f"fk({child_key})").alias("contract"), F.lit(table).alias("table"), F.col("n").cast("long"))


# The quality checks (dimension, metric, threshold, operator).
DQ_CHECKS = [
    ("Completeness", "location_count", 100000, "gte"),
    ("Completeness", "property_count", 100000, "gte"),
    ("Completeness", "transaction_count", 490000, "gte"),
    ("Completeness", "rental_index_count", 500, "gte"),
    ("Completeness", "hpi_index_count", 500, "gte"),
    ("Completeness", "crime_stat_count", 10000, "gte"),
    ("Completeness", "mortgage_product_count", 15, "eq"),
    ("Validity", "invalid_sale_prices", 0, "eq"),
    ("Timeliness", "future_sale_dates", 0, "eq"),
    ("Validity", "invalid_bedrooms", 0, "eq"),
    ("Validity", "negative_crime_counts", 0, "eq"),
]


def dq_table(values: DataFrame) -> DataFrame:
    """values: (metric, value) rows, one per metric → (dimension, metric, value, threshold, pass)."""
    checks = values.sparkSession.createDataFrame(
        [(d, m, t, op) for d, m, t, op in DQ_CHECKS], "dimension string, metric string, threshold long, op string")
    rows = checks.join(values.select("metric", F.col("value").cast("long").alias("value")), "metric", "left") \
                 .withColumn("value", F.coalesce("value", F.lit(0).cast("long")))
    ok = (F.when(F.col("op") == "gte", F.col("value") >= F.col("threshold"))
           .when(F.col("op") == "eq", F.col("value") == F.col("threshold"))
           .otherwise(F.col("value") <= F.col("threshold")))
    return rows.select("dimension", "metric", "value", "threshold", ok.alias("pass"))

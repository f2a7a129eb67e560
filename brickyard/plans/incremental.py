"""Incremental refresh of the outcode metrics.

The state holds what the metrics need of the sales, in one folder:

* ``days``: counts by (outcode, day, price), a part per batch and month, so that
  writing a batch again replaces it;
* ``window``: counts by (outcode, price) of the last 12 months, one folder per version;
* ``meta``: one line per version with its ``as_of`` and batch, written last.

A batch adds its sales to the window and takes off the days that its newest
date has pushed out.  So a refresh reads the batch, the window's counts and the
expired days' months, never the sales before.  Late sales act on the day they
bear, however late they come.  A batch that is applied twice counts once; a run
that was lost before its ``meta`` line is simply run again.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import months_back
from ..operators import metrics as M
from ..sources.tables import scalar

MONTHS = 12


def versions(spark: SparkSession, state: str) -> list[tuple[int, dt.date, str]]:
    """(version, as_of, batch) of every applied batch, oldest first."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{state}/meta")
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return []
    rows = spark.read.schema("version int, as_of date, batch string").json(f"{state}/meta").collect()  # one line per batch
    return sorted((r.version, r.as_of, r.batch) for r in rows)


def expired_days(spark: SparkSession, state: str, start: dt.date, end: dt.date, batches: list[str]) -> DataFrame:
    """outcode, price_cents, c of the applied batches' days from ``start`` up to ``end``; only their months are read."""
    days = spark.read.schema("outcode string, sale_date date, price_cents long, c long, batch string, month date").parquet(f"{state}/days")
    month = F.col("month")
    return (days.where((month >= F.lit(start.replace(day=1))) & (month <= F.lit(end)) & F.col("batch").isin(batches))
            .where((F.col("sale_date") >= F.lit(start)) & (F.col("sale_date") < F.lit(end))).select("outcode", "price_cents", "c"))


def apply_batch(spark: SparkSession, state: str, batch: str, sales: DataFrame) -> None:
    """Add ``sales`` (outcode, sale_date, price_cents) to the state as ``batch``."""
    done = versions(spark, state)
    if batch in {name for _, _, name in done}:
        return
    own = (sales.where(F.col("outcode").isNotNull() & F.col("sale_date").isNotNull() & F.col("price_cents").isNotNull())
           .groupBy("outcode", "sale_date", "price_cents").agg(F.count(F.lit(1)).alias("c")))
    (own.withColumn("batch", F.lit(batch)).withColumn("month", F.trunc("sale_date", "MM"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch", "month").parquet(f"{state}/days"))
    kept = spark.read.schema("outcode string, sale_date date, price_cents long, c long").parquet(f"{state}/days/batch={batch}") if _any(spark, state, batch) \
        else own.limit(0)
    version, old = (done[-1][0], done[-1][1]) if done else (0, None)
    newest = scalar(kept.agg(F.max("sale_date").alias("m")), "m")
    as_of = max((x for x in (old, newest) if x is not None), default=None)
    if as_of is None:
        return
    start = months_back(as_of, MONTHS)
    window = kept.where(F.col("sale_date") >= F.lit(start)).select("outcode", "price_cents", "c")
    if old is not None:
        window = window.unionByName(spark.read.parquet(f"{state}/window/v{version}"))
        if months_back(old, MONTHS) < start:
            gone = expired_days(spark, state, months_back(old, MONTHS), start, [name for _, _, name in done])
            window = window.unionByName(gone.withColumn("c", -F.col("c")))
    counts = window.groupBy("outcode", "price_cents").agg(F.sum("c").alias("c")).where("c > 0")
    counts.write.mode("overwrite").parquet(f"{state}/window/v{version + 1}")
    line = spark.createDataFrame([(version + 1, as_of, batch)], "version int, as_of date, batch string")
    line.coalesce(1).write.mode("append").json(f"{state}/meta")


def _any(spark: SparkSession, state: str, batch: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{state}/days/batch={batch}")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def window_counts(spark: SparkSession, state: str) -> DataFrame:
    """outcode, price_cents, c of the present window."""
    done = versions(spark, state)
    if not done:
        raise ValueError(f"no batch is applied to {state}")
    return spark.read.parquet(f"{state}/window/v{done[-1][0]}")


def refreshed(spark: SparkSession, state: str, hpi: DataFrame, rental: DataFrame, crime: DataFrame, loc: DataFrame, crime_as_of: dt.date) -> DataFrame:
    """The metrics table of the present state."""
    return M.metrics_of_histogram(window_counts(spark, state), hpi, rental, crime, loc, crime_as_of)

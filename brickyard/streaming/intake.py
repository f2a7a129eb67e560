"""Structured Streaming forms of the incremental intakes.

Both reuse the batch functions inside ``foreachBatch``; each micro-batch is
idempotent against what is already stored, so a replayed batch after a
failure leaves the same result (the file sink commit protocol never exposes
a partially written batch).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.postcode import norm_key
from ..operators import clean as C
from ..operators import merge as G
from ..session import ensure_checkpoint_dir
from ..sources.readers import CSV_READ, PPD_COLUMNS, string_schema

SALE_COLUMNS = "txn_uid STRING, postcode STRING, sale_price DECIMAL(12,2), sale_date DATE, bucket INT"
#: The store is bucketed by a hash of the key, so that a sale sent again is found whatever its date is now.
SALE_BUCKETS = 64
#: Batches of a backlog: each reads the keys stored so far, so their number must not grow with the files.
SALE_BATCHES = 8


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/brickyard-{name}-{uuid.uuid4().hex}"


def sales_batch(raw: DataFrame, london: DataFrame, as_of: dt.date) -> DataFrame:
    """Validated, typed sales of one batch, one row per txn_uid (P7 + K5 key).

    Of several valid rows with one key that of the file that landed first stays
    (``landed``, if given), then the smallest (date, price, postcode); keys are
    free text (the feed's are braced GUIDs), without one a row can't be stored.
    """
    key = F.trim("txn_uid")
    ok = C.with_reason(raw.withColumn("sale_id", key), london, as_of).where(F.col("reason").isNull() & (F.length(key) > 0))
    row = F.struct(F.col("sale_date").try_cast("date").alias("sale_date"), F.trim("sale_price").try_cast("decimal(12,2)").alias("sale_price"),
                   norm_key(F.col("postcode")).alias("postcode"))
    first = F.struct("landed", row.alias("r")) if "landed" in raw.columns else F.struct(row.alias("r"))
    one = ok.groupBy(key.alias("txn_uid")).agg(F.min(first).getField("r").alias("r"))
    return one.select("txn_uid", "r.postcode", "r.sale_price", "r.sale_date",
                      F.pmod(F.xxhash64("txn_uid"), F.lit(SALE_BUCKETS)).cast("int").alias("bucket"))


def files_at(spark: SparkSession, folder: str) -> int:
    """Number of files in ``folder``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return sum(f.isFile() for f in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path))


def stream_sales(spark: SparkSession, landing_dir: str, london: DataFrame, as_of: dt.date, store: str,
                 checkpoint: str, files_per_trigger: int = 2) -> DataFrame:
    """Incremental price-paid intake: file stream → validate → insert-ignore on txn_uid.

    Each batch is held against its own buckets of the store.  A replayed
    batch, or a sale sent again with other values, finds its key stored and
    adds nothing.  A batch takes ``files_per_trigger`` files, or as many more
    as bring all that has landed into SALE_BATCHES of them; a sale that is
    twice in a batch is taken from the file that landed first, as it would be
    from two batches.  A batch writes a file or a few per bucket.
    """
    ensure_checkpoint_dir(spark)
    files_per_trigger = max(files_per_trigger, -(-files_at(spark, landing_dir) // SALE_BATCHES))
    london = london.select("postcode").distinct().checkpoint()  # of use to every batch
    spark.createDataFrame([], SALE_COLUMNS).write.mode("ignore").partitionBy("bucket").parquet(store)
    src = (spark.readStream.schema(string_schema(PPD_COLUMNS)).options(**CSV_READ)
           .option("maxFilesPerTrigger", files_per_trigger).csv(landing_dir)
           .select("*", F.col("_metadata.file_modification_time").alias("landed")))

    def load(batch: DataFrame, epoch_id: int) -> None:
        # used twice: for the buckets it touches (SALE_BUCKETS numbers at most) and for its rows
        fresh = sales_batch(batch, london, as_of).checkpoint()
        touched = [r[0] for r in fresh.select("bucket").distinct().collect()]
        stored = spark.read.schema(SALE_COLUMNS).parquet(store).where(F.col("bucket").isin(touched)).select("txn_uid")
        fresh.join(stored, "txn_uid", "left_anti").hint("rebalance", "bucket").write.mode("append").partitionBy("bucket").parquet(store)

    q = (src.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(SALE_COLUMNS).parquet(store).drop("bucket")


CRIME_KEYS = ["lsoa_code", "reference_period", "category"]


def stream_crime_counts(spark: SparkSession, events_dir: str, schema: str, store: str, checkpoint: str,
                        watermark: str = "2 days", files_per_trigger: int = 2) -> DataFrame:
    """Event stream → watermarked daily counts per (lsoa, day, category) → upsert snapshot (R2, K4).

    ``update`` mode emits changed counts each trigger.  The snapshot is
    partitioned by day; a batch merges its rows into the days it touches only
    (overwrite rule), stages the merged days in a new folder and swaps them in
    with a dynamic partition overwrite.  Replaying a batch rewrites the same
    values, so the result equals the batch group-by.  Events may come up to
    ``watermark`` after the latest one seen; later ones are not counted, so
    feeds must land in about the order of time.
    """
    snap_schema = "lsoa_code BIGINT, category STRING, count BIGINT, reference_period DATE"
    spark.createDataFrame([], snap_schema).write.mode("ignore").partitionBy("reference_period").parquet(store)
    # event time as an explicit UTC instant, so day windows do not depend on the session time zone;
    # the reported day comes from the zone-free timestamp and coincides with the UTC window
    ts = F.col("ts")
    utc = F.make_timestamp(F.year(ts), F.month(ts), F.dayofmonth(ts), F.hour(ts), F.minute(ts),
                           F.second(ts).cast("decimal(8,6)"), F.lit("UTC"))
    ev = (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(events_dir)
          .select(utc.alias("event_time"), ts.cast("date").alias("day"), "user_id", "event_type"))
    agg = (ev.withWatermark("event_time", watermark)
             .groupBy(F.window("event_time", "1 day"), "day", "user_id", "event_type").count()
             .select(F.col("user_id").alias("lsoa_code"), F.col("day").alias("reference_period"),
                     F.col("event_type").alias("category"), "count"))

    def merge(batch: DataFrame, epoch_id: int) -> None:
        base = spark.read.schema(snap_schema).parquet(store)
        # the days of a batch are joined, not listed: a first load may bring all of history
        touched = base.join(batch.select("reference_period").distinct(), "reference_period", "left_semi")
        merged = G.upsert(touched.select(*CRIME_KEYS, "count"), batch, CRIME_KEYS).drop("changed")
        staging = f"{store}_staging/{epoch_id}"
        merged.write.mode("overwrite").partitionBy("reference_period").parquet(staging)
        (spark.read.schema(snap_schema).parquet(staging).write.mode("overwrite")
              .option("partitionOverwriteMode", "dynamic").partitionBy("reference_period").parquet(store))

    q = (agg.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(snap_schema).parquet(store).select(*CRIME_KEYS, "count")

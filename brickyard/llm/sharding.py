"""Sharding by weighted rendezvous hashing, in DataFrame operations only.

Every (key, shard) pair has a pseudo-random score ``-weight / ln(u)`` with u
from a hash of both; a record goes to its best shard.  Adding a shard moves a
record only if the new shard wins it, and only into that shard.

``slot`` numbers a shard's rows without gaps: rows are dealt to (shard, bucket)
cells by key hash, cells get their first slot from running sums of the cell
counts, and ranks are taken inside cells, so no task holds a whole shard.

Defined results: a null key hashes like any other value; a null text has no
bytes; rows with equal keys go to the same shard and get slots of their own in
the order of size and text checksum; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Bytes that a record takes beside its text.
OVERHEAD = 8


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard with the highest weighted score; ties go to the smallest shard."""
    # 53 bits of the hash, shifted off 0 and 1
    def score(shard: int, weight: float) -> Column:
        u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 11).cast("double") + 0.5) / F.lit(float(1 << 53))
        return F.lit(-weight) / F.log(u)

    ranked = F.array(*[F.struct(score(i, w).alias("score"), F.lit(-i).alias("shard")) for i, w in enumerate(weights)])
    return -F.array_max(ranked)["shard"]


def shard_rows(documents: DataFrame, weights: list[float], grown: list[float] | None = None, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """key, size, text_crc32, shard, grown_shard (null without ``grown``), slot."""
    spark = documents.sparkSession
    text = F.coalesce(documents[text_col].cast("binary"), F.lit(b""))
    rows = documents.select(documents[key_col].alias("key"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.select("*", rendezvous(F.col("key"), weights).alias("shard"),
                       (rendezvous(F.col("key"), grown) if grown else F.lit(None).cast("int")).alias("grown_shard"))
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # another seed than the scores, or the buckets would follow the shards
    dealt = rows.withColumn("bucket", F.pmod(F.xxhash64(F.lit("bucket"), "key"), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    first = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    # shards x buckets rows, both fixed by settings and not by the data
    cells = counts.select("shard", "bucket", first.alias("first"))
    inside = F.row_number().over(Window.partitionBy("bucket", "shard").orderBy("key", "size", "text_crc32"))
    return (dealt.withColumn("inside", inside).join(cells, ["shard", "bucket"])
            .select("key", "size", "text_crc32", "shard", "grown_shard", (F.col("first") + F.col("inside") - 1).alias("slot")))

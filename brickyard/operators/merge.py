"""Merges into snapshots.

Parquet has no MERGE, so one generic ``upsert`` expresses every
``INSERT … ON CONFLICT`` of the reference as a full-outer join on the natural
key with a per-column rule; the caller writes the result as a new snapshot.
Applying the same update twice gives the same table as applying it once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OVERWRITE = "overwrite"
KEEP_IF_NULL = "keep_if_null"


def _null_key(keys: list[str]) -> F.Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def latest_per_key(df: DataFrame, keys: list[str], order_col: str, sparse: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """The effect of a batch's rows applied one by one in the order of ``order_col``; map-side ``max_by``.

    A column takes the last row's value, a ``sparse`` one the last value that
    isn't NULL.  Rows with a NULL key are distinct from all others and all kept.
    """
    cols = [c for c in df.columns if c not in keys and c != order_col]
    last = F.max_by(F.struct(*[c for c in cols if c not in sparse], F.lit(0).alias("_")), F.col(order_col)).alias("_r")
    filled = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order_col))).alias(f"_s_{c}") for c in cols if c in sparse]
    g = df.where(~_null_key(keys)).groupBy(*keys).agg(last, *filled)
    one = g.select(*keys, *[F.col(f"_s_{c}" if c in sparse else f"_r.{c}").alias(c) for c in cols])
    return one.unionByName(df.where(_null_key(keys)).select(*one.columns))


def upsert(base: DataFrame, updates: DataFrame, keys: list[str], rules: dict[str, str] | None = None,
           order_col: str | None = None, default_rule: str = OVERWRITE, stamp=None) -> DataFrame:
    """Full merged table; ``changed`` marks inserted or updated rows.

    With ``stamp`` (a date), a base carrying ``created_at`` / ``updated_at`` gets
    them maintained like the reference's triggers (T1).

    ``overwrite``: the update's value wins, NULL included; ``keep_if_null``:
    COALESCE(new, old).  Rows with NULL keys never match (they are distinct,
    as in a unique index) and are kept from both sides.
    """
    rules = rules or {}
    if order_col:
        sparse = [c for c in updates.columns if rules.get(c, default_rule) == KEEP_IF_NULL]
        updates = latest_per_key(updates, keys, order_col, sparse)
    stamps = [c for c in ("created_at", "updated_at") if stamp is not None and c in base.columns]
    if stamps:
        updates = updates.drop(*stamps)
        for c in stamps:
            updates = updates.withColumn(c, F.lit(None).cast(base.schema[c].dataType))
    cols = [c for c in base.columns if c not in keys]
    b = base.select(*keys, *[F.col(c).alias(f"_o_{c}") for c in cols], F.lit(True).alias("_ib"))
    u = updates.select(*keys, *[F.col(c).alias(f"_n_{c}") for c in cols], F.lit(True).alias("_iu"))
    j = b.join(u, keys, "full_outer")
    out = []
    for c in cols:
        new, old = F.col(f"_n_{c}"), F.col(f"_o_{c}")
        if c == "created_at" and c in stamps:  # T1: set once on insert
            out.append(F.coalesce(old, F.lit(stamp).cast(base.schema[c].dataType)).alias(c))
            continue
        if c == "updated_at" and c in stamps:  # T1: stamped on every insert or update
            out.append(F.when(F.col("_iu").isNotNull(), F.lit(stamp).cast(base.schema[c].dataType)).otherwise(old).alias(c))
            continue
        v = F.coalesce(new, old) if rules.get(c, default_rule) == KEEP_IF_NULL else new
        out.append(F.when(F.col("_iu").isNotNull(), v).otherwise(old).alias(c))
    return j.select(*keys, *out, F.col("_iu").isNotNull().alias("changed"))


def insert_missing(base: DataFrame, new: DataFrame, keys: list[str], order_col: str | None = None) -> DataFrame:
    """``INSERT … ON CONFLICT DO NOTHING`` on a natural key (K5).

    Of several new rows with one key the first by ``order_col`` goes in (by
    the row's values without one); rows with a NULL key conflict with nothing.
    """
    cols = [c for c in new.columns if c != order_col]
    rest = [c for c in cols if c not in keys]
    row = F.struct(*([order_col] if order_col else []), *rest, F.lit(0).alias("_"))
    first = new.where(~_null_key(keys)).groupBy(*keys).agg(F.min(row).alias("_r"))
    first = first.select(*[F.col(c) if c in keys else F.col(f"_r.{c}").alias(c) for c in cols])
    fresh = first.join(base.select(*keys), keys, "left_anti").unionByName(new.where(_null_key(keys)).select(*cols))
    return base.withColumn("inserted", F.lit(False)).unionByName(fresh.withColumn("inserted", F.lit(True)))


def enrich(base: DataFrame, updates: DataFrame, key: str, cols: list[str], order_col: str | None = None,
           stamp=None) -> DataFrame:
    """Sparse attribute update: each column COALESCE(new, old); unmatched updates dropped (K7).

    Several updates of one key act in the order of ``order_col``, so a NULL in
    a later one leaves an earlier value.  With ``stamp`` (a date) a base that
    carries ``updated_at`` has it set on every updated row.
    """
    if order_col:
        updates = latest_per_key(updates, [key], order_col, cols)
    u = updates.select(key, *[F.col(c).alias(f"_n_{c}") for c in cols], F.lit(True).alias("_u"))
    j = base.join(u, key, "left")
    out = {c: F.coalesce(F.col(f"_n_{c}"), F.col(c)) for c in cols}
    if stamp is not None:
        out["updated_at"] = F.when(F.col("_u"), F.lit(stamp).cast(base.schema["updated_at"].dataType)).otherwise(F.col("updated_at"))
    return j.select(*[out[c].alias(c) if c in out else F.col(c) for c in base.columns])


def migrate_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Expand/contract rename: backfill ``new`` from ``old`` where NULL, then drop ``old``."""
    if new not in df.columns:
        df = df.withColumn(new, F.lit(None).cast(df.schema[old].dataType))
    return df.withColumn(new, F.coalesce(F.col(new), F.col(old))).drop(old)


def attach_outcode(sales: DataFrame, prop: DataFrame, loc: DataFrame) -> DataFrame:
    """Denormalise outcode through property → location; NULL when unmatched."""
    p = prop.select("property_id", "postcode")
    l = loc.select("postcode", "outcode")
    return sales.drop("outcode").join(p, "property_id", "left").join(l, "postcode", "left").drop("postcode")

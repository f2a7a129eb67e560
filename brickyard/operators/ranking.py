"""Distributed ranks, exact quantiles and NTILE.

A group (or the whole input) may be far larger than one task can hold, so no
operator here collects a group: values are first reduced to a histogram
(value, count) with a map-side combine, then range-partitioned on
(keys, value) so that one hot key spreads over many tasks.  Cumulative counts
come from per-partition subtotals (a table of at most partitions × keys rows)
plus a within-partition running sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BUCKETS = 256  # value buckets per key for the cumulative-count pass (subtotal rows ≤ distinct values)


def log_scale(col: Column) -> Column:
    """sign(v)·log1p(|v|): monotone (log1p is semi-monotonic), so equal-width buckets on this
    scale keep the value order while spreading heavy-tailed values such as prices evenly."""
    d = col.cast("double")
    return F.signum(d) * F.log1p(F.abs(d))


def bucketed(hist: DataFrame, keys: list[str], value: Column, nulls_first: bool = False) -> DataFrame:
    """Add ``_b``: which of ``BUCKETS`` equal ranges between the key's least and largest ``value`` a row is in."""
    h = hist.withColumn("_bv", value.cast("double"))
    if keys:
        stats = h.groupBy(*keys).agg(F.min("_bv").alias("_mn"), F.max("_bv").alias("_mx"))
        h = h.join(stats, keys)
    else:  # one global group: its min/max are two scalars, folded into the plan as literals
        st = h.agg(F.min("_bv").alias("mn"), F.max("_bv").alias("mx")).first()
        h = h.withColumn("_mn", F.lit(st["mn"]).cast("double")).withColumn("_mx", F.lit(st["mx"]).cast("double"))
    span = F.col("_mx") - F.col("_mn")
    b = F.least(F.lit(BUCKETS - 1), F.floor(F.when(span > 0, (F.col("_bv") - F.col("_mn")) * BUCKETS / span)
                                             .otherwise(F.lit(0.0)))).cast("int")
    b = F.when(F.col("_bv").isNull(), F.lit(-1 if nulls_first else BUCKETS)).otherwise(b)
    return h.withColumn("_b", b).drop("_bv", "_mn", "_mx")


def _offsets(h: DataFrame, keys: list[str], count_col: str) -> DataFrame:
    """keys, _b, _sub (rows in the bucket), _off (rows before it), _n (rows of the key); at most ``BUCKETS`` rows per key."""
    sub = h.groupBy(*keys, "_b").agg(F.sum(count_col).alias("_sub"))
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy()  # global: one row per bucket (bounded)
    before = F.sum("_sub").over(wk.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1))
    return sub.withColumn("_off", F.coalesce(before, F.lit(0))).withColumn("_n", F.sum("_sub").over(wk))


def values_at(hist: DataFrame, keys: list[str], ranks) -> DataFrame:
    """Rows of ``hist`` (keys, _v, _c) that hold asked ranks: keys, _v, _n and the fields of ``ranks(_n)``.

    ``ranks`` makes an array of structs with a 1-based rank ``rk`` from the
    key's number of rows.  A rank meets its key's bucket counts first, and only
    the values of the buckets that hold one are dealt by (key, bucket), sorted
    and counted; of a large key that is a few of its ``BUCKETS``.
    """
    h = bucketed(hist, keys, log_scale(F.col("_v")))
    off = _offsets(h, keys, "_c")
    inside = F.filter(ranks(F.col("_n")), lambda r: (r["rk"] > F.col("_off")) & (r["rk"] <= F.col("_off") + F.col("_sub")))
    asked = off.select(*keys, "_b", "_off", "_n", inside.alias("_rs")).where(F.size("_rs") > 0)  # one row per (key, bucket)
    local = h.join(asked, [*keys, "_b"]).withColumn("_lc", F.sum("_c").over(
        Window.partitionBy(*keys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)))
    at = F.col("_r.rk") - F.col("_off")
    return local.withColumn("_r", F.explode("_rs")).where((at > F.col("_lc") - F.col("_c")) & (at <= F.col("_lc"))).select(*keys, "_v", "_n", "_r.*")


def cumulative_counts(hist: DataFrame, keys: list[str], order: list[Column | str], count_col: str,
                      bucket_value: Column | None = None, nulls_first: bool = False,
                      with_totals: bool = False, bucket: Column | None = None):
    """Add ``_cum`` (inclusive running total of ``count_col`` within ``keys`` in ``order``) and ``_n``.

    Rows are cut into ``BUCKETS`` ordered value ranges per key from that key's
    min/max of ``bucket_value`` (a numeric expression that is non-decreasing
    in ``order``; default the first order column).  Subtotals per (key, bucket)
    give each bucket's offset; the running sum inside a bucket is a window over
    (key, bucket), so a hot key is spread over many tasks.  Every step is
    deterministic (no sampling), so recomputation after a lost executor
    yields the same ranks.  ``order`` must be unique within a key.
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    if bucket is not None:  # caller-supplied order-preserving integer bucket: no min/max pass
        h = hist.withColumn("_b", bucket.cast("int"))
        return _from_buckets(h, keys, order_cols, count_col, with_totals)
    bv = bucket_value if bucket_value is not None else F.col(order[0]) if isinstance(order[0], str) else None
    if bv is None:
        raise ValueError("bucket_value is required when the first order item is an expression")
    h = bucketed(hist, keys, bv, nulls_first)
    return _from_buckets(h, keys, order_cols, count_col, with_totals)


def _from_buckets(h: DataFrame, keys: list[str], order_cols: list[Column], count_col: str, with_totals: bool):
    """Running counts from per-(key, bucket) subtotals plus a window inside each bucket."""
    off = _offsets(h, keys, count_col).drop("_sub")
    local = h.withColumn("_lc", F.sum(count_col).over(
        Window.partitionBy(*keys, "_b").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)))
    j = local.join(off, [*keys, "_b"])
    ranked = j.withColumn("_cum", F.col("_off") + F.col("_lc")).drop("_off", "_lc", "_b")
    if with_totals:
        return ranked, off.select(*keys, "_n").distinct()
    return ranked


def percentile_cont(df: DataFrame, keys: list[str], value: str, probs: dict[str, str],
                    count_as: str | None = None, weight: str | None = None) -> DataFrame:
    """Exact PERCENTILE_CONT for each ``name -> p`` (p given as a decimal string).

    ``value`` must be an exact (integer or decimal) column; NULLs are ignored.
    Linear interpolation v_lo + frac·(v_hi − v_lo) is done in decimal, so the
    double result is the correctly rounded exact value.  ``count_as`` also
    returns the number of non-NULL values per key; with ``weight`` a row stands for
    so many equal ones.
    """
    if not keys:
        return _global_quantiles(df, value, probs, "cont", count_as)
    v = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"), (F.col(weight) if weight else F.lit(1).cast("long")).alias("_w"))
    hist = v.groupBy(*keys, "_v").agg(F.sum("_w").alias("_c"))

    def ranks(n: Column) -> Column:
        out = []
        for name, p in probs.items():
            h = (n - 1).cast("decimal(20,0)") * F.lit(p).cast("decimal(10,6)")
            fl, frac = F.floor(h).cast("long"), (h - F.floor(h)).cast("decimal(7,6)")
            for hi, rk in ((0, fl + 1), (1, F.when(frac > 0, fl + 2).otherwise(fl + 1))):
                out.append(F.struct(F.lit(name).alias("pname"), frac.alias("_frac"), F.lit(hi).alias("hi"), rk.alias("rk")))
        return F.array(*out)

    hit = values_at(hist, keys, ranks)
    aggs, outs = [], []
    for i, n in enumerate(probs):
        is_n = F.col("pname") == n
        aggs += [F.max(F.when(is_n & (F.col("hi") == 0), F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when(is_n & (F.col("hi") == 1), F.col("_v"))).alias(f"_hi{i}"),
                 F.max(F.when(is_n, F.col("_frac"))).alias(f"_f{i}")]
        lo, hi_, f = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_f{i}")
        outs.append((lo + f * (hi_ - lo)).cast("double").alias(n))
    if count_as:
        aggs.append(F.max("_n").alias("_cnt_"))
        outs.append(F.col("_cnt_").alias(count_as))
    return hit.groupBy(*keys).agg(*aggs).select(*keys, *outs)


def nearest_rank(df: DataFrame, keys: list[str], value: str, probs: dict[str, str], rounded: bool = False) -> DataFrame:
    """Nearest-rank quantile sorted[floor(n·q)] (0-based, clamped to n−1) per key.

    ``rounded`` gives whole numbers, halves going up.
    """
    if rounded:
        exact = nearest_rank(df, keys, value, probs)
        return exact.select(*keys, *[F.floor(F.col(c) + 0.5).cast("long").alias(c) for c in probs])
    if not keys:
        return _global_quantiles(df, value, probs, "rank")
    v = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("_v"))
    hist = v.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c"))

    def ranks(n: Column) -> Column:
        return F.array(*[F.struct(F.lit(name).alias("pname"), (F.least(F.floor(n.cast("decimal(20,0)") * F.lit(p).cast("decimal(10,6)")).cast("long"), n - 1) + 1).alias("rk"))
                         for name, p in probs.items()])

    hit = values_at(hist, keys, ranks)
    return hit.groupBy(*keys).agg(*[F.max(F.when(F.col("pname") == n, F.col("_v"))).alias(n) for n in probs])


def _global_quantiles(df: DataFrame, value: str, probs: dict[str, str], kind: str,
                      count_as: str | None = None) -> DataFrame:
    """One-group quantiles: the row count is a scalar, so target ranks are literals (no join)."""
    from decimal import Decimal
    import math
    v = df.where(F.col(value).isNotNull()).select(F.col(value).alias("_v"))
    hist = v.groupBy("_v").agg(F.count(F.lit(1)).alias("_c"))
    ranked, totals = cumulative_counts(hist, [], ["_v"], "_c", bucket_value=log_scale(F.col("_v")), with_totals=True)
    n = totals.agg(F.max("_n").alias("n")).first()["n"] or 0
    tags, outs = [], []
    for i, (name, p) in enumerate(probs.items()):
        if n == 0:
            outs.append(F.lit(None).cast("double").alias(name))
            continue
        if kind == "cont":
            h = (n - 1) * Decimal(p)
            fl = int(math.floor(h))
            frac = h - fl
            lo_rk, hi_rk = fl + 1, (fl + 2 if frac > 0 else fl + 1)
        else:
            lo_rk = hi_rk = min(int(math.floor(n * Decimal(p))), n - 1) + 1
            frac = Decimal(0)
        tags += [(i, 0, lo_rk), (i, 1, hi_rk)]
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        val = (lo + F.lit(frac).cast("decimal(7,6)") * (hi - lo)).cast("double") if kind == "cont" else lo
        outs.append(val.alias(name))
    if count_as:
        outs.append(F.lit(n).cast("long").alias(count_as))
    if not tags:
        return df.sparkSession.range(1).select(*outs)
    hitc = [F.when((F.lit(rk) > F.col("_cum") - F.col("_c")) & (F.lit(rk) <= F.col("_cum")),
                   F.struct(F.lit(i).alias("i"), F.lit(hi).alias("hi"))) for i, hi, rk in tags]
    hit = ranked.select("_v", F.explode(F.filter(F.array(*hitc), lambda t: t.isNotNull())).alias("t"))
    aggs = []
    for i in range(len(probs)):
        aggs += [F.max(F.when((F.col("t.i") == i) & (F.col("t.hi") == 0), F.col("_v"))).alias(f"_lo{i}"),
                 F.max(F.when((F.col("t.i") == i) & (F.col("t.hi") == 1), F.col("_v"))).alias(f"_hi{i}")]
    return hit.agg(*aggs).select(*outs)


def ntile(df: DataFrame, n: int, order: list[Column], name: str, partition: list[str] | None = None,
          bounded: bool = False, bucket_value: Column | None = None, nulls_first: bool = False) -> DataFrame:
    """``NTILE(n) OVER ([PARTITION BY partition] ORDER BY order)`` as a long column ``name``.

    ``order`` must be a total order (end it with a unique key).  ``bounded=True``
    is for inputs whose row count is bounded by a fixed domain (one row per
    outcode: a few thousand at most), where the plain window is cheapest.
    Otherwise ranks come from the two-phase bucketed cumulative count and the
    NTILE bucket formula, so no single task sees the whole input;
    ``bucket_value`` is the numeric value of the first order item
    (negated for descending order).
    """
    partition = partition or []
    if bounded:
        w = Window.partitionBy(*partition).orderBy(*order) if partition else Window.orderBy(*order)
        return df.withColumn(name, F.ntile(n).over(w).cast("long"))
    ranked = cumulative_counts(df.withColumn("_one", F.lit(1)), partition, order, "_one",
                               bucket_value=bucket_value, nulls_first=nulls_first).drop("_one")
    return ranked.withColumn(name, ntile_of(F.col("_cum"), F.col("_n"), n)).drop("_cum", "_n")


def ntile_of(rank: Column, total: Column, n: int) -> Column:
    """Bucket of 1-based ``rank`` among ``total`` rows: the first total % n buckets get one extra row."""
    q = F.floor(total / n).cast("long")
    rem = (total % n).cast("long")
    big = rem * (q + 1)
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1) \
            .otherwise(rem + F.floor((rank - 1 - big) / F.greatest(q, F.lit(1))) + 1).cast("long")


def top_k(df: DataFrame, keys: list[str], order: list[Column], k: int, name: str = "rank",
          salt_buckets: int = 32, salt_cols: list[str] | None = None) -> DataFrame:
    """First ``k`` rows per key in ``order`` with their 1-based position ``name``.

    Two stages so that a hot key never lands in one task: each (key, salt)
    slice keeps its own top ``k``, then at most ``k · salt_buckets`` candidates
    per key are ranked.  The salt hashes ``salt_cols`` (default: all columns).
    """
    cols = salt_cols or df.columns
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(salt_buckets)))
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    cand = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k).drop("_r1", "_salt")
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return cand.withColumn(name, F.row_number().over(w2).cast("long")).where(F.col(name) <= k)

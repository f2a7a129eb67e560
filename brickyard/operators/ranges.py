"""Exact quantiles over ranges of an ordered whole-number attribute.

Pairing each request with every row in its range costs requests times rows.
Here the rows are counted into a tree over the attribute: a node covers 1, 8 or
64 neighbouring places, and holds its values in sorted blocks with their counts.
A range is cut into a few nodes, so a request meets those nodes and no row:

1. the nodes' block counts add up to the block that holds each asked rank;
2. only that block of those nodes is opened, and the rank is found among its values.

A block is a fixed interval of the value on a log scale, so blocks of a node are
bounded by the value's domain, and equal values are one entry however many
rows have them.  Nothing is sampled: a recomputed task gives the same ranks.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHIFTS = (0, 3, 6)  # a node of level i covers 2**SHIFTS[i] places
ANYWHERE = -1  # level of the rows without a place, which lie in every range
PER_OCTAVE = 16  # blocks between a value and its double


def block_of(value: Column) -> Column:
    """Number of the block that holds ``value``; never falls as the value rises."""
    return F.floor(F.signum(value.cast("double")) * F.log2(F.abs(value.cast("double")) + 1) * PER_OCTAVE).cast("int")


def with_nodes(df: DataFrame, lo: str, hi: str) -> DataFrame:
    """One row per node (``level``, ``node``) that the places ``lo`` to ``hi`` are cut into, and one for the placeless rows."""
    def run(level: int, a: Column, b: Column) -> Column:
        return F.when(a < b, F.transform(F.sequence(a, b - 1), lambda i: F.struct(F.lit(level).alias("level"), i.alias("node")))) \
                .otherwise(F.array().cast("array<struct<level:int,node:bigint>>"))

    x = df.withColumn("_a", F.col(lo).cast("long")).withColumn("_z", F.col(hi).cast("long") + 1)
    pieces = [F.array(F.struct(F.lit(ANYWHERE).alias("level"), F.lit(0).cast("long").alias("node")))]
    for level in range(len(SHIFTS) - 1):
        wide = 1 << (SHIFTS[level + 1] - SHIFTS[level])
        a, z = F.col("_a"), F.col("_z")
        up, down = F.ceil(a / wide).cast("long"), F.floor(z / wide).cast("long")
        x = (x.withColumn("_up", F.when(up < down, up)).withColumn("_down", F.when(up < down, down))
              .withColumn(f"_l{level}", run(level, a, F.coalesce(F.col("_up") * wide, z)))
              .withColumn(f"_r{level}", F.when(F.col("_up").isNotNull(), run(level, F.col("_down") * wide, z)).otherwise(
                  F.array().cast("array<struct<level:int,node:bigint>>")))
              .withColumn("_a", F.coalesce("_up", F.lit(0))).withColumn("_z", F.coalesce("_down", F.lit(0))))
        pieces += [F.col(f"_l{level}"), F.col(f"_r{level}")]
    pieces.append(run(len(SHIFTS) - 1, F.col("_a"), F.col("_z")))
    return x.select(*df.columns, F.explode(F.concat(*pieces)).alias("_at")).select(*df.columns, "_at.level", "_at.node")


def tree(hist: DataFrame, keys: list[str], place: str, value: str, count: str) -> DataFrame:
    """keys, level, node, _b, _vals: the sorted blocks of every node, from counted rows, by one shuffle."""
    p = F.col(place)
    at = F.when(p.isNull(), F.array(F.struct(F.lit(ANYWHERE).alias("level"), F.lit(0).cast("long").alias("node")))).otherwise(
        F.array(*[F.struct(F.lit(i).alias("level"), F.shiftright(p.cast("long"), s).alias("node")) for i, s in enumerate(SHIFTS)]))
    block = [*keys, "level", "node", "_b"]
    entries = (hist.select(*keys, F.explode(at).alias("_at"), F.col(value).alias("_v"), F.col(count).alias("_c"))
               .select(*keys, "_at.level", "_at.node", block_of(F.col("_v")).alias("_b"), "_v", "_c").repartition(*block))
    return (entries.groupBy(*block, "_v").agg(F.sum("_c").alias("_c"))
            .groupBy(*block).agg(F.sum("_c").alias("_sum"), F.collect_list(F.struct("_v", "_c")).alias("_vals")))


def _total(cells: Column) -> Column:
    return F.aggregate(cells, F.lit(0).cast("long"), lambda n, c: n + c["_c"])


def _holder(cells: Column, rank: Column, value: str) -> Column:
    """``x`` of the cell, in order, at which the running count reaches ``rank``, and the count ``off`` before cells of that ``x``."""
    nil = F.lit(None).cast("long")
    start = F.struct(F.lit(0).cast("long").alias("n"), nil.alias("at"), F.lit(0).cast("long").alias("before"), nil.alias("x"), nil.alias("off"))

    def step(s: Column, c: Column) -> Column:
        v = c[value].cast("long")
        before = F.when(s["at"] == v, s["before"]).otherwise(s["n"])
        hit = s["x"].isNull() & (s["n"] + c["_c"] >= rank)
        return F.struct((s["n"] + c["_c"]).alias("n"), v.alias("at"), before.alias("before"),
                        F.when(hit, v).otherwise(s["x"]).alias("x"), F.when(hit, before).otherwise(s["off"]).alias("off"))

    return F.aggregate(cells, start, step, lambda s: F.struct(s["x"].alias("x"), s["off"].alias("off")))


def range_quantiles(hist: DataFrame, asks: DataFrame, keys: list[str], place: str, value: str, count: str,
                    lo: str, hi: str, probs: dict[str, str], unit: str = "1", count_as: str | None = None) -> DataFrame:
    """Exact PERCENTILE_CONT of ``value`` for each ask (keys, ``lo``, ``hi``; distinct), over the rows of its keys placed in lo..hi.

    ``hist`` holds counted rows with a whole-number ``value``, results are
    multiplied by ``unit``; rows with a NULL place lie in every range, NULL
    values don't count.  Asks without rows are missing in the result.
    """
    blocks = tree(hist.where(F.col(value).isNotNull()), keys, place, value, count)
    ask = [*keys, lo, hi]
    asked = with_nodes(asks.select(*ask), lo, hi)
    at = [*keys, "level", "node"]
    nodes = blocks.groupBy(*at).agg(F.collect_list(F.struct("_b", F.col("_sum").alias("_c"))).alias("_cells"))
    met = asked.join(nodes, at).groupBy(*ask).agg(F.sort_array(F.flatten(F.collect_list("_cells"))).alias("_cells"))
    met = met.withColumn("_n", _total(F.col("_cells")))
    ranks = []
    for name, p in probs.items():
        h = (F.col("_n") - 1).cast("decimal(19,0)") * F.lit(Decimal(p)).cast("decimal(7,6)")
        whole, frac = F.floor(h).cast("long"), (h - F.floor(h)).cast("decimal(7,6)")
        for end, rk in ((0, whole + 1), (1, F.when(frac > 0, whole + 2).otherwise(whole + 1))):
            ranks.append(F.struct(F.lit(name).alias("p"), F.lit(end).alias("end"), frac.alias("frac"), rk.alias("rk")))
    held = _holder(F.col("_cells"), F.col("_r.rk"), "_b")
    found = (met.select(*ask, "_n", "_cells", F.explode(F.array(*ranks)).alias("_r")).select(*ask, "_n", "_r", held.alias("_h"))
             .groupBy(*ask, "_n", F.col("_h.x").cast("int").alias("_b"))
             .agg(F.collect_list(F.struct("_r.p", "_r.end", "_r.frac", (F.col("_r.rk") - F.col("_h.off")).alias("rk"))).alias("_ranks")))
    opened = (with_nodes(found, lo, hi).join(blocks.select(*at, "_b", "_vals"), [*at, "_b"])
              .groupBy(*ask, "_n", "_b").agg(F.first("_ranks").alias("_ranks"), F.sort_array(F.flatten(F.collect_list("_vals"))).alias("_vals")))
    hit = (opened.select(*ask, "_n", "_vals", F.explode("_ranks").alias("_r"))
           .select(*ask, "_n", "_r", _holder(F.col("_vals"), F.col("_r.rk"), "_v")["x"].alias("_v")))
    outs, aggs = [], []
    for i, name in enumerate(probs):
        own = F.col("_r.p") == name
        aggs += [F.max(F.when(own & (F.col("_r.end") == e), F.col("_v"))).alias(f"_{e}{i}") for e in (0, 1)]
        aggs.append(F.max(F.when(own, F.col("_r.frac"))).alias(f"_f{i}"))
        low, high = F.col(f"_0{i}").cast("decimal(18,0)"), F.col(f"_1{i}").cast("decimal(18,0)")
        outs.append(((low + F.col(f"_f{i}") * (high - low)) * F.lit(Decimal(unit))).cast("double").alias(name))
    if count_as:
        aggs.append(F.max("_n").alias("_cnt"))
        outs.append(F.col("_cnt").alias(count_as))
    return hit.groupBy(*ask).agg(*aggs).select(*ask, *outs)

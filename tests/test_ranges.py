"""Range quantiles by the tree over places, against brute force over all rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickyard.operators.ranges import block_of, range_quantiles, with_nodes

PROBS = {"p25": "0.25", "median": "0.5", "p75": "0.75"}


def test_nodes_cover_each_range_once(spark):
    ranges = [(0, 0), (7, 8), (5, 200), (64, 127), (63, 128), (9, 8), (0, 511), (100, 1300)]
    df = spark.createDataFrame([(i, a, z) for i, (a, z) in enumerate(ranges)], "i int, lo long, hi long")
    got = {i: [] for i in range(len(ranges))}
    for r in with_nodes(df, "lo", "hi").collect():
        if r.level >= 0:
            wide = 8 ** r.level
            got[r.i] += range(r.node * wide, (r.node + 1) * wide)
    assert {i: sorted(v) for i, v in got.items()} == {i: list(range(a, z + 1)) for i, (a, z) in enumerate(ranges)}
    longest = max(r["count"] for r in with_nodes(df, "lo", "hi").groupBy("i").count().collect())
    assert longest <= 50  # 1,201 places


@pytest.mark.parametrize("seed", [1, 2])
def test_half_of_all_rows_in_one_key(spark, seed):
    rng = random.Random(seed)
    rows = [("hot" if rng.random() < 0.5 else rng.choice("abc"), rng.choice([None, *range(10, 90)]),
             rng.choice([None, -5, 0, 1, rng.randrange(10 ** 3), rng.randrange(10 ** 11)]), rng.randrange(1, 4)) for _ in range(1500)]
    asks = [(k, lo, lo + rng.randrange(0, 60)) for k in ("hot", "a", "missing") for lo in rng.sample(range(5, 95), 6)]
    hist = spark.createDataFrame(rows, "k string, place long, x long, n long")
    got = {(r.k, r.lo, r.hi): (r.p25, r.median, r.p75, r.n) for r in range_quantiles(
        hist, spark.createDataFrame(asks, "k string, lo long, hi long"), ["k"], "place", "x", "n", "lo", "hi", PROBS, count_as="n").collect()}
    for k, lo, hi in asks:
        own = [x for kk, p, x, n in rows for _ in range(n) if kk == k and x is not None and (p is None or lo <= p <= hi)]
        if not own:
            assert (k, lo, hi) not in got
            continue
        assert got[k, lo, hi][3] == len(own)
        assert np.allclose(got[k, lo, hi][:3], np.percentile(own, [25, 50, 75]), rtol=1e-12)


def test_blocks_keep_the_order_and_empty_tables_give_nothing(spark):
    values = sorted({-10 ** 12, -3, -1, 0, 1, 2, 3, 10 ** 12, *range(0, 10 ** 6, 997)})
    blocks = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v long").coalesce(1).select(block_of(F.col("v"))).collect()]
    assert blocks == sorted(blocks)
    none = spark.createDataFrame([], "k string, place long, x long, n long")
    asks = spark.createDataFrame([("a", 1, 2)], "k string, lo long, hi long")
    assert range_quantiles(none, asks, ["k"], "place", "x", "n", "lo", "hi", PROBS).count() == 0

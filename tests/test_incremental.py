"""Metrics from kept counts: equal to the full refresh after every batch, late sales and repeated batches included."""

import datetime as dt
import random

from brickyard.operators import metrics as M
from brickyard.plans import incremental as I

SCHEMA = "outcode string, sale_date date, price_cents long"


def frames(spark):
    month = lambda i: dt.date(2023 + i // 12, i % 12 + 1, 1)
    hpi = spark.createDataFrame([(o, month(i), 100000 + 500 * i) for o in ("E1", "N1") for i in range(24)], "outcode string, reference_month date, avg_cents long")
    rental = spark.createDataFrame([(M.RENT_REGION, month(20), 12345)], "region string, reference_month date, index_centi long")
    crime = spark.createDataFrame([("L1", month(22), 7)], "lsoa_code string, reference_period date, count long")
    area = spark.createDataFrame([("L1", "E1")], "lsoa_code string, outcode string")
    return hpi, rental, crime, area


def full(spark, rows, extra):
    sales = spark.createDataFrame([(o, d, p, p) for o, d, p in rows], SCHEMA + ", cents long").selectExpr("outcode", "sale_date", "price_cents", "cast(cents / 100 as decimal(12,2)) as sale_price")
    return sorted(map(tuple, M.outcode_metrics(sales, *extra, max(d for _, d, _ in rows if d), dt.date(2024, 11, 1)).collect()))


def test_batches_equal_the_full_refresh(spark, tmp_path):
    rng = random.Random(4)
    day = lambda a, b: dt.date(2023, 1, 1) + dt.timedelta(days=rng.randrange(a, b))
    sale = lambda a, b: (rng.choice(["E1", "N1", "W9"]), day(a, b), rng.randrange(5, 60) * 1_000_000)
    # the third batch pushes days out and brings late sales of all months; the last one is late altogether
    batches = [[sale(0, 300) for _ in range(200)], [sale(300, 420) for _ in range(80)] + [(None, day(300, 420), 5)], [sale(0, 690) for _ in range(150)], [sale(0, 100) for _ in range(30)], []]
    extra, state, rows = frames(spark), str(tmp_path / "state"), []
    for i, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, SCHEMA)
        I.apply_batch(spark, state, f"b{i}", frame)
        I.apply_batch(spark, state, f"b{i}", frame)  # once more: it counts once
        rows += [r for r in batch if r[0]]
        assert sorted(map(tuple, I.refreshed(spark, state, *extra, dt.date(2024, 11, 1)).collect())) == full(spark, rows, extra)
    assert len(I.versions(spark, state)) == 5


def test_a_batch_reads_expired_months_alone(spark, tmp_path):
    state = str(tmp_path / "state")
    rows = [("E1", dt.date(2023, 1, 5) + dt.timedelta(days=31 * i), 100 * (i + 1)) for i in range(12)]
    I.apply_batch(spark, state, "a", spark.createDataFrame(rows, SCHEMA))
    gone = I.expired_days(spark, state, dt.date(2023, 1, 1), dt.date(2023, 2, 20), ["a"])
    plan = gone._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan.split("PartitionFilters")[1].split("]")[0]
    assert {r.price_cents for r in gone.collect()} == {100, 200}
    # a run lost before its last line is run again
    I.apply_batch(spark, state, "b", spark.createDataFrame([("E1", dt.date(2024, 2, 10), 7)], SCHEMA))
    import shutil
    kept = sorted(tuple(r) for r in I.window_counts(spark, state).collect())
    meta = [p for p in (tmp_path / "state" / "meta").glob("*.json") if '"b"' in p.read_text()]
    shutil.move(meta[0], tmp_path / "lost")
    assert I.versions(spark, state)[-1][2] == "a"
    I.apply_batch(spark, state, "b", spark.createDataFrame([("E1", dt.date(2024, 2, 10), 7)], SCHEMA))
    assert sorted(tuple(r) for r in I.window_counts(spark, state).collect()) == kept

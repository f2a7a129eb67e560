"""The load graph: order, inputs read from written tables, counts, a failed step and what the next load keeps."""

import os
import tempfile

import pytest

from brickyard.functions.sqlfunctions import REFRESH, STORE, register, register_refresh
from brickyard.plans import catalog  # noqa: F401  (registers the queries used by the load)
from brickyard.plans import load as L
from brickyard.plans.refresh import refresh_metrics
from brickyard.sources.readers import accumulate

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder():
    return tempfile.mkdtemp(prefix="brickyard-load-")


def test_a_failed_step_stops_its_readers_only_and_the_next_load_goes_on(spark, folder):
    def broken(spark, d, t):
        raise OSError("feed is gone")

    steps = tuple(s._replace(make=broken) if s.name == "hpi_index" else s for s in L.STEPS)
    with pytest.raises(L.StepFailed, match="failed: hpi_index; not run: quality, outcode_metrics"):
        L.load_all(spark, SF, folder, steps)
    first = L.whole_steps(spark, folder)
    assert first == {s.name for s in L.STEPS} - {"hpi_index", "quality", "outcode_metrics"}
    stamps = {n: os.path.getmtime(f"{folder}/{n}/_SUCCESS") for n in first}
    paths = L.load_all(spark, SF, folder)
    assert L.whole_steps(spark, folder) == set(paths)
    assert {n: os.path.getmtime(f"{folder}/{n}/_SUCCESS") for n in first} == stamps


def test_observed_counts_are_the_tables_rows(spark, folder):
    counts = {(r.script, r.metric): r.value for r in L.run_counts(spark, folder).collect()}
    for s in L.STEPS:
        assert counts[s.name, "rows"] == spark.read.parquet(f"{folder}/{s.name}").count()
    assert sum(v for (s, m), v in counts.items() if s == "checked_sale" and m != "rows") == counts["checked_sale", "rows"]
    assert counts["quality", "rows"] == 11


def test_metrics_of_the_load_equal_the_refresh(spark, folder):
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(spark.read.parquet(f"{folder}/outcode_metrics")) == rows(refresh_metrics(spark, SF))


def test_steps_name_their_inputs_before_them():
    seen = set()
    for s in L.STEPS:
        assert seen.issuperset(s.inputs)
        seen.add(s.name)


def test_a_step_reads_nothing_but_its_written_inputs(spark, folder):
    by_name = {s.name: s for s in L.STEPS}
    for name in ("transaction", "median_by_outcode", "outcode_metrics"):
        step = by_name[name]
        made = step.make(spark, SF, {n: spark.read.parquet(f"{folder}/{n}") for n in step.inputs})
        assert made.inputFiles() and all(f"/{folder.strip('/')}/" in f or "ckpt" in f for f in made.inputFiles())


# --- functions by name in SQL

def test_five_reference_cases_in_sql(spark):
    register(spark)
    cases = [(300000, 5.5, "REPAYMENT", 1841, 1843), (300000, 5.5, "INTEREST_ONLY", 1375, 1375), (300000, 0, "REPAYMENT", 1000, 1000),
             (0, 5.5, "REPAYMENT", 0, 0), (500000, 4.25, "REPAYMENT", 2459, 2461)]
    for p, r, kind, low, high in cases:
        row = spark.sql(f"SELECT calculate_monthly_payment({p}, {r}, {30 if p == 500000 else 25}, '{kind}') AS x").first()
        assert low <= row.x <= high
    plan = spark.range(3).selectExpr("calculate_monthly_payment(id, 5.5, 25, 'REPAYMENT') AS x")._jdf.queryExecution().toString()
    assert "Python" not in plan and "calculate_monthly_payment(" not in plan.split("Optimized Logical Plan")[1]
    assert spark.sql("SELECT calculate_monthly_payment(NULL, 5.5, 25, 'REPAYMENT') AS x").first().x is None


def test_refresh_by_name_in_sql(spark):
    base = tempfile.mkdtemp(prefix="brickyard-refresh-")
    rows = f"{base}/rows"
    spark.createDataFrame([("E1", 1.0)], "outcode string, avg_yield_pct double").write.parquet(rows)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW refresh_rows AS SELECT * FROM parquet.`{rows}`")
    register_refresh(spark, spark.table("refresh_rows"), f"{base}/store")
    assert spark.table(STORE).count() == 0
    spark.sql(f"EXECUTE IMMEDIATE {REFRESH}")
    spark.sql(f"EXECUTE IMMEDIATE {REFRESH}")
    assert [tuple(r) for r in spark.sql(f"SELECT * FROM {STORE}").collect()] == [("E1", 1.0)]
    spark.sql(f"DROP TABLE {STORE}")


# --- sources added up

@pytest.mark.parametrize(("least", "rows"), [(2, {(1, "a", "x"), (2, "a", "x")}), (3, {(1, "a", "x"), (2, "b", "y"), (3, "b", "y")}),
                                            (9, {(1, "a", "x"), (2, "b", "y"), (3, "b", "y"), (4, "m", "generated")})])
def test_sources_add_up_and_are_supplemented(spark, least, rows):
    frame = lambda xs: spark.createDataFrame(xs, "k int, v string")
    got = accumulate([("x", frame([(1, "a"), (2, "a")])), ("y", frame([(2, "b"), (3, "b")]))], ["k"], least, lambda have: frame([(1, "m"), (4, "m")]))
    assert {(r.k, r.v, r.source) for r in got.collect()} == rows
    assert accumulate([("x", frame([])), ("y", frame([]))], ["k"], 3).count() == 0

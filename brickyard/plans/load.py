"""Load of all feeds as a dependency graph (K11), with counts observed while writing.

A step names the tables it reads and those must be whole before it starts; steps
that don't depend on each other run at once, each in its own scheduler pool and
under its own job tag.  A step reads the *written* tables of its inputs, never the
feeds behind them: sales are read and checked once, and properties, transactions,
quality and metrics come from what was written.  Counts are an
``Observation`` of the write itself.  A step that is whole leaves a line in
the run log and isn't run again by a later load into the same folder, so a
load goes on after its last whole steps.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.postcode import CATEGORY_CODES, decode, norm_key
from ..operators import clean as C
from ..operators import contracts as K
from ..operators import merge as G
from ..operators import metrics as M
from ..session import ensure_checkpoint_dir
from ..sources import bindings as b
from ..sources.tables import scalar
from ..streaming.intake import work_dir

Tables = dict[str, DataFrame]


class Step(NamedTuple):
    name: str
    inputs: tuple[str, ...]
    make: Callable[[SparkSession, str, Tables], DataFrame]
    counts: Callable[[DataFrame], dict[str, Column]] = lambda df: {}


def _checked_sales(spark: SparkSession, d: str, t: Tables) -> DataFrame:
    return C.with_reason(b.raw_sale(spark, d), t["location"], b.sale_as_of(spark, d))


def _valid(t: Tables) -> DataFrame:
    return t["checked_sale"].where("reason is null").drop("reason")


def _properties(spark: SparkSession, d: str, t: Tables) -> DataFrame:
    # written once, as the ids take the keys from it and then the rows
    ensure_checkpoint_dir(spark)
    return C.assign_ids(C.property_rows(_valid(t)).checkpoint(), "address_key", "property_id")


def _transactions(spark: SparkSession, d: str, t: Tables) -> DataFrame:
    v = _valid(t)
    own = v.select("sale_id", C.address_key(v).alias("address_key"), F.trim("sale_price").try_cast("decimal(12,2)").alias("sale_price"),
                   F.col("sale_date").try_cast("date").alias("sale_date"), decode(F.col("ppd_category"), CATEGORY_CODES).alias("category"))
    return own.join(t["property"].select("address_key", "property_id"), "address_key").drop("address_key")


def _attributes(spark: SparkSession, d: str, t: Tables) -> DataFrame:
    from . import q_merge
    return G.enrich(q_merge.asset_property(spark, d), q_merge.epc_update(spark, d), "property_id", q_merge.EPC_COLUMNS, order_col="seq", stamp=b.sale_as_of(spark, d))


def _metrics(spark: SparkSession, d: str, t: Tables) -> DataFrame:
    newest = lambda name, col: scalar(t[name].agg(F.max(col).alias("m")), "m")
    return M.outcode_metrics(t["sale"], t["hpi_index"], t["rental_index"], t["crime_stat"], t["area"], newest("sale", "sale_date"), newest("crime_stat", "reference_period"))


def _medians(spark: SparkSession, d: str, t: Tables) -> DataFrame:
    outcodes = t["property"].select("property_id", norm_key(F.col("postcode")).alias("postcode")).join(
        t["location"].select(norm_key(F.col("postcode")).alias("postcode"), "outcode").distinct(), "postcode")
    return M.percentile_cont(t["transaction"].join(outcodes, "property_id"), ["outcode"], "sale_price", {"median": "0.5"}, count_as="sales")


def _quality(spark: SparkSession, d: str, t: Tables) -> DataFrame:
    def counts(name: str, **extra: Column) -> DataFrame:
        x = {f"{name}_count": F.lit(True)} if name != "property_attributes" else {}
        x |= extra
        agg = t[name].agg(*[F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in x.items()])
        return agg.selectExpr(f"stack({len(x)}, " + ", ".join(f"'{k}', `{k}`" for k in x) + ") as (metric, value)")

    price = F.col("sale_price")
    parts = [counts("location"), counts("property"), counts("rental_index"), counts("hpi_index"), counts("mortgage_product"),
             counts("transaction", invalid_sale_prices=(price <= 0) | (price >= 100_000_000), future_sale_dates=F.col("sale_date") > F.lit(b.sale_as_of(spark, d))),
             counts("crime_stat", negative_crime_counts=F.col("count") < 0),
             counts("property_attributes", invalid_bedrooms=(F.col("bedrooms") < 0) | (F.col("bedrooms") > 20))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return K.dq_table(out)


def _feed(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str, Tables], DataFrame]:
    return lambda spark, d, t: fn(spark, d)


def _skips(df: DataFrame) -> dict[str, Column]:
    return {r: F.count_if(F.col("reason") == r) for r in C.REASONS} | {"kept": F.count_if(F.col("reason").isNull())}


#: Postcodes first, then sales and products, then the indices, crime and certificates, then quality and metrics.
STEPS = (
    Step("location", (), lambda spark, d, t: C.clean_postcodes(b.raw_postcode(spark, d))),
    Step("checked_sale", ("location",), _checked_sales, _skips),
    Step("mortgage_product", ("location",), _feed(b.mortgage_product)),
    Step("property", ("checked_sale",), _properties),
    Step("transaction", ("checked_sale", "property"), _transactions),
    Step("sale", ("transaction",), _feed(b.sale)),
    Step("area", ("location",), _feed(b.location)),
    Step("property_attributes", ("property",), _attributes),
    Step("hpi_index", ("sale", "mortgage_product"), lambda spark, d, t: b.hpi_of(t["sale"], b.sale_as_of(spark, d))),
    Step("rental_index", ("transaction", "mortgage_product"), _feed(b.rental_index)),
    Step("crime_stat", ("transaction", "mortgage_product"), _feed(b.crime_stat)),
    Step("quality", ("location", "property", "transaction", "mortgage_product", "hpi_index", "rental_index", "crime_stat", "property_attributes"), _quality),
    Step("median_by_outcode", ("location", "property", "transaction"), _medians),
    Step("outcode_metrics", ("sale", "hpi_index", "rental_index", "crime_stat", "area"), _metrics),
)


class StepFailed(RuntimeError):
    """Some steps failed; the whole ones stay and are kept by the next load into the same folder."""


def whole_steps(spark: SparkSession, out: str) -> set[str]:
    """Names of the steps whose line of the run log was committed in ``out``."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/_runlog/*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return {f.getPath().getParent().getName() for f in found or ()}


def run_step(spark: SparkSession, d: str, out: str, step: Step, paths: dict[str, str]) -> None:
    """Write one table and its line of the run log, each into a folder of its own, as steps write at once."""
    from .refresh import write_runlog
    context = spark.sparkContext
    context.setLocalProperty("spark.scheduler.pool", step.name)
    tag = f"load-{step.name}"
    spark.addTag(tag)
    began = time.time()
    try:
        seen = Observation()
        made = step.make(spark, d, {name: spark.read.parquet(paths[name]) for name in step.inputs})
        made.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in step.counts(made).items()]).write.mode("overwrite").parquet(f"{out}/{step.name}")
        fields = {k: int(v) for k, v in seen.get.items()} | {"ms": int((time.time() - began) * 1000)}
        write_runlog(spark, [{"script": step.name, "message": "loaded", "fields": fields}], f"{out}/_runlog/{step.name}")
    finally:
        spark.removeTag(tag)
        context.setLocalProperty("spark.scheduler.pool", None)


def load_all(spark: SparkSession, d: str, out: str | None = None, steps: tuple[Step, ...] = STEPS, at_once: int = 4) -> dict[str, str]:
    """Run the graph into the folder ``out`` and return table -> path; steps that are whole there are kept."""
    out = out or work_dir(spark, "load")
    done = whole_steps(spark, out) & {s.name for s in steps}
    paths = {s.name: f"{out}/{s.name}" for s in steps}
    todo, running, failed = [s for s in steps if s.name not in done], {}, {}
    with ThreadPoolExecutor(at_once) as pool:
        while todo or running:
            ready = [s for s in todo if done.issuperset(s.inputs)]
            todo = [s for s in todo if s not in ready]
            running |= {pool.submit(run_step, spark, d, out, s, paths): s for s in ready}
            if not running:
                break  # what is left waits for a step that failed
            ended: set[Future] = wait(running, return_when=FIRST_COMPLETED).done
            for f in ended:
                step = running.pop(f)
                if f.exception() is None:
                    done.add(step.name)
                else:
                    failed[step.name] = f.exception()
    if failed:
        raise StepFailed(f"failed: {', '.join(sorted(failed))}; not run: {', '.join(s.name for s in todo) or 'none'}") from next(iter(failed.values()))
    return paths


def run_counts(spark: SparkSession, out: str) -> DataFrame:
    """script, metric, value: what the steps of a load counted while writing."""
    log = spark.read.schema("script string, fields string").json(f"{out}/_runlog/*")
    pairs = log.select("script", F.explode(F.from_json("fields", "map<string, long>")).alias("metric", "value"))
    return pairs.where("metric <> 'ms'")

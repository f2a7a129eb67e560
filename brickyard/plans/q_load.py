"""Registered queries over the tables that one load writes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..sources import bindings as b
from ..sources.tables import per_session
from ..streaming.intake import work_dir
from . import incremental as I
from .load import load_all, run_counts
from .oracle_bindings import with_
from .registry import query


@per_session
def loaded(spark, d) -> str:
    """Folder of a load of the present data; one load serves all readers until the data change."""
    out = work_dir(spark, "load")
    load_all(spark, d, out)
    return out


_ROWS = {"location": "pc_clean", "checked_sale": "raw_sale", "property": "props", "transaction": "txn_src t JOIN props p USING (address_key)", "sale": "sale",
         "area": "location", "property_attributes": "asset_property", "mortgage_product": "mortgage_product", "hpi_index": "hpi_index", "rental_index": "rental_index",
         "crime_stat": "crime_stat", "outcode_metrics": "outcode_metrics"}
_SKIPPED = ("null_postcode", "invalid_price", "invalid_date", "future_date", "not_london", "too_old")


@query("load_counts", with_("pc_clean", "raw_sale", "validated", "props", "txn_src", "sale", "location", "asset_property", "mortgage_product", "hpi_index",
                            "rental_index", "crime_stat", "outcode_metrics") + " UNION ALL ".join(
    [f"SELECT '{name}' AS script, 'rows' AS metric, COUNT(*) AS value FROM {table}" for name, table in _ROWS.items()] +
    [f"SELECT 'checked_sale', '{r}', COUNT(*) FILTER (WHERE reason = '{r}') FROM validated" for r in _SKIPPED] +
    ["SELECT 'checked_sale', 'kept', COUNT(*) FILTER (WHERE valid) FROM validated", "SELECT 'quality', 'rows', 11",
     "SELECT 'median_by_outcode', 'rows', COUNT(DISTINCT l.outcode) FROM txn_src t JOIN props p USING (address_key) JOIN pc_clean l ON l.postcode = p.postcode"]))
def q_load_counts(spark, d):
    """What every step of a load counted while it wrote."""
    return run_counts(spark, loaded(spark, d))


@query("loaded_medians", with_("pc_clean", "props", "txn_src") + """
SELECT outcode, ROUND(PERCENTILE_CONT(0.5) WITHIN GROUP (ORDER BY CAST(sale_price AS DOUBLE)), 4) AS median, COUNT(*) AS sales
FROM txn_src t JOIN props p USING (address_key) JOIN (SELECT DISTINCT postcode, outcode FROM pc_clean) l ON l.postcode = p.postcode GROUP BY outcode""")
def q_loaded_medians(spark, d):
    """Median price and sales per outcode, all from the written tables."""
    return spark.read.parquet(f"{loaded(spark, d)}/median_by_outcode")


def sale_batches(spark, d):
    """The whole sale table in three batches by date; every eleventh sale comes a batch or two late."""
    s = b.sale(spark, d)
    newest = b.sale_as_of(spark, d)
    cuts = [newest - dt.timedelta(days=n) for n in (200, 90)]
    number = F.when(F.col("sale_date") < F.lit(cuts[0]), 1).when(F.col("sale_date") < F.lit(cuts[1]), 2).otherwise(3)
    number = F.when(F.col("sale_id") % 11 == 0, 3).otherwise(number)
    return [(f"b{i}", s.where(number == i).select("outcode", "sale_date", "price_cents")) for i in (1, 2, 3)]


@query("metrics_incremental", with_("outcode_metrics") + "SELECT * FROM outcode_metrics")
def q_metrics_incremental(spark, d):
    """K8: the metrics after three batches, from the kept counts."""
    state = work_dir(spark, "metrics-state")
    for name, sales in sale_batches(spark, d):
        I.apply_batch(spark, state, name, sales)
    return I.refreshed(spark, state, b.hpi_index(spark, d), b.rental_index(spark, d), b.crime_stat(spark, d), b.location(spark, d), b.crime_as_of(spark, d))

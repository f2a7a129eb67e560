"""Upsert semantics and idempotence (K1-K7)."""

from pyspark.sql import functions as F

from brickyard.operators import merge as G


def _rows(df):
    return sorted(tuple(r) for r in df.drop("changed").collect())


def test_upsert_rules_and_idempotence(spark):
    base = spark.createDataFrame([("a", "x", "b1"), ("b", "y", "b2"), (None, "z", "b3")], "k string, v string, w string")
    upd = spark.createDataFrame([("a", None, None), ("c", "n", None), (None, "q", "b9")], "k string, v string, w string")
    rules = {"w": G.KEEP_IF_NULL}
    once = G.upsert(base, upd, ["k"], rules)
    got = {(r["k"], r["v"], r["w"], r["changed"]) for r in once.collect()}
    assert ("a", None, "b1", True) in got          # overwrite: NULL wins; keep_if_null keeps old
    assert ("b", "y", "b2", False) in got
    assert ("c", "n", None, True) in got
    assert (None, "z", "b3", False) in got and (None, "q", "b9", True) in got  # NULL keys never match
    twice = G.upsert(once.drop("changed"), upd, ["k"], rules)
    assert _rows(twice.where(F.col("k").isNotNull())) == _rows(once.where(F.col("k").isNotNull()))


def test_batch_duplicates_keep_last(spark):
    base = spark.createDataFrame([("a", 1)], "k string, n long")
    upd = spark.createDataFrame([("a", 5, 1), ("a", 7, 2), ("b", 3, 1)], "k string, n long, seq int")
    got = {r["k"]: r["n"] for r in G.upsert(base, upd, ["k"], order_col="seq").collect()}
    assert got == {"a": 7, "b": 3}


def test_insert_missing_and_enrich(spark):
    base = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    new = spark.createDataFrame([(2, "zz"), (3, "w")], "id long, v string")
    got = sorted((r["id"], r["v"], r["inserted"]) for r in G.insert_missing(base, new, ["id"]).collect())
    assert got == [(1, "x", False), (2, "y", False), (3, "w", True)]
    upd = spark.createDataFrame([(1, None), (9, "ghost")], "id long, v string")
    en = sorted(tuple(r) for r in G.enrich(base, upd, "id", ["v"]).collect())
    assert en == [(1, "x"), (2, "y")]


def test_migrate_column(spark):
    df = spark.createDataFrame([("a", None, "old"), ("b", "new", "old")], "k string, district string, borough string")
    got = sorted(tuple(r) for r in G.migrate_column(df, "borough", "district").collect())
    assert got == [("a", "old"), ("b", "new")]


def test_stamps_like_triggers(spark):
    import datetime as dt
    base = spark.createDataFrame([("a", "x", dt.date(2020, 1, 1), dt.date(2020, 1, 1))],
                                 "k string, v string, created_at date, updated_at date")
    upd = spark.createDataFrame([("a", "y"), ("b", "z")], "k string, v string")
    got = {r["k"]: r for r in G.upsert(base, upd, ["k"], stamp=dt.date(2024, 5, 1)).collect()}
    assert got["a"]["created_at"] == dt.date(2020, 1, 1) and got["a"]["updated_at"] == dt.date(2024, 5, 1)
    assert got["b"]["created_at"] == dt.date(2024, 5, 1) and got["b"]["updated_at"] == dt.date(2024, 5, 1)


def test_null_key_updates_are_all_kept(spark):
    base = spark.createDataFrame([("a", 1)], "k string, n long")
    upd = spark.createDataFrame([(None, 5, 1), (None, 7, 2), ("a", 3, 1)], "k string, n long, seq int")
    got = sorted((r["k"] or "", r["n"]) for r in G.upsert(base, upd, ["k"], order_col="seq").collect())
    assert got == [("", 5), ("", 7), ("a", 3)]


def test_insert_missing_keeps_the_first_of_a_repeated_key(spark):
    base = spark.createDataFrame([(1, "x")], "id long, v string")
    new = spark.createDataFrame([(2, "b", 2), (2, "c", 1), (None, "n", 1), (None, "n", 1)], "id long, v string, seq int")
    got = sorted((r["id"] or 0, r["v"]) for r in G.insert_missing(base, new, ["id"], order_col="seq").collect())
    assert got == [(0, "n"), (0, "n"), (1, "x"), (2, "c")]
    assert G.insert_missing(base, new.drop("seq"), ["id"]).where("id = 2").select("v").collect()[0][0] == "b"


def test_sparse_updates_act_one_after_another(spark):
    import datetime as dt
    base = spark.createDataFrame([(1, 0, 9, None), (2, 0, 9, None)], "id long, a long, b long, updated_at date")
    upd = spark.createDataFrame([(1, 3, None, 1), (1, None, 4, 2)], "id long, a long, b long, seq int")
    day = dt.date(2024, 1, 1)
    got = sorted(tuple(r) for r in G.enrich(base, upd, "id", ["a", "b"], order_col="seq", stamp=day).collect())
    assert got == [(1, 3, 4, day), (2, 0, 9, None)]
    up = G.upsert(base.select("id", "a", "b"), upd, ["id"], {"a": G.KEEP_IF_NULL}, order_col="seq").where("id = 1").collect()[0]
    assert (up["a"], up["b"]) == (3, 4)

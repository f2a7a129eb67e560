"""Benchmark decontamination by a positional inverted index, in DataFrame operations only.

Every benchmark item is cut into windows of ``k`` consecutive words.

1. ``write_index``: one scan of the documents stores the postings (term, row,
   position) of the benchmark's words, sorted by term within each file; a row of
   its own per document carries its id and number of words.
2. The index gives the corpus frequency of every term, hence the order of each
   window's terms from the rarest on.
3. ``phrases``: postings of a window's rarest term, shifted by the term's offset,
   are its possible starts.  They are intersected with the list of the second
   rarest term, shifted by its own offset, then with the lists of all other terms
   in the documents that are left.
4. ``proximities``: from the same lists, all words of the window near its rarest.

Windows, terms and rows are numbers; an item's ids are joined to the distinct
(row, window) pairs only.  Hits are intervals; their union per document is a
running maximum over sorted intervals.  What is broadcast has at most
``SENT_ROWS`` rows, counted before; larger tables are joined by a shuffle.

Defined results: null, empty or word-less texts have no words, no hit and, as
items, no window; an item shorter than ``k`` is one window; repeated item rows
count once; a document's row is judged by its own text, whether its id is null,
repeated or neither; empty tables give empty or unhit results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickyard.session import ensure_checkpoint_dir

#: Words of a window; rows of a table that is sent to all executors.
WORDS, SENT_ROWS = 10, 500_000
#: Everything that is not part of a word, and the letters to lower.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Can't be in a word; it ends each document's words, so that its position is their number.
COUNTER, COUNTED = "\u0001", -1


def words(text: Column) -> Column:
    """Words of a text; ASCII texts take the fast lower-casing, which agrees on A-Z."""
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.filter(F.split(low, NO_WORD), lambda w: w != "")


def windows(items: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """item, terms: the distinct windows of each item."""
    cut = items.select(items[id_col].cast("string").alias("item"), words(items[text_col]).alias("all")).filter("size(all) > 0")
    at = cut.select("item", "all", F.explode(F.expr(f"sequence(1, greatest(1, size(all) - {k - 1}))")).alias("at"))
    return at.select("item", F.expr(f"slice(all, at, {k})").alias("terms")).distinct()


def sent(table: DataFrame) -> DataFrame:
    """``table``, marked for broadcast if a count shows that it is small enough."""
    return F.broadcast(table) if table.limit(SENT_ROWS + 1).count() <= SENT_ROWS else table


class Index:
    """Windows of the items, and the stored postings of their terms.

    ``windows``: win, size; ``owners``: win, item; ``needs``: win, rank (1 is the
    rarest), term, offset, distinct terms of the window; ``postings``: row, pos, term;
    ``counts``: row, id, n_words.
    """

    def __init__(self, documents: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text: str, k: int):
        spark = documents.sparkSession
        path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/postings-{uuid.uuid4().hex}"
        cut = windows(items, item_col, item_text, k)
        shapes = cut.select("terms").distinct().withColumn("win", F.monotonically_increasing_id()).checkpoint()
        vocabulary = shapes.select(F.explode("terms").alias("word")).distinct().withColumn("term", F.monotonically_increasing_id()).checkpoint()
        self.owners = cut.join(shapes, "terms").select("win", "item").checkpoint()
        write_index(documents, vocabulary, path, id_col, text_col)
        stored = spark.read.parquet(path)
        self.counts = stored.filter(F.col("term") == COUNTED).select("row", "id", F.col("pos").cast("long").alias("n_words"))
        self.postings = stored.filter(F.col("term") != COUNTED).select("row", "pos", "term")
        frequency = self.postings.groupBy("term").agg(F.count("*").alias("cf"))
        places = shapes.select("win", F.size(F.array_distinct("terms")).alias("kinds"), F.size("terms").alias("size"), F.posexplode("terms").alias("offset", "word"))
        order = Window.partitionBy("win").orderBy("cf", "offset")
        ranked = (places.join(sent(vocabulary), "word").join(frequency, "term", "left").withColumn("cf", F.coalesce("cf", F.lit(0)))
                  .withColumn("rank", F.row_number().over(order)).withColumn("least", F.min("cf").over(Window.partitionBy("win"))))
        # a term that no document has rules its window out
        self.needs = ranked.filter("least > 0").select("win", "rank", "term", "offset", "size", "kinds").checkpoint()


def write_index(documents: DataFrame, vocabulary: DataFrame, path: str, id_col: str, text_col: str) -> None:
    """Write row, id, pos, term of every word in ``vocabulary`` (word, term); id is on the rows that count the words."""
    ends = F.coalesce(words(documents[text_col]), F.array().cast("array<string>"))
    numbered = documents.select(F.monotonically_increasing_id().alias("row"), documents[id_col].alias("id"), F.concat(ends, F.array(F.lit(COUNTER))).alias("all"))
    known = vocabulary.union(documents.sparkSession.sql(f"select '{COUNTER}' word, {COUNTED}L term"))
    found = (numbered.select("row", "id", F.posexplode("all").alias("pos", "word")).join(sent(known), "word")
             .select("row", F.when(F.col("term") == COUNTED, F.col("id")).alias("id"), "pos", "term"))
    found.sortWithinPartitions("term", "row").write.parquet(path)


def phrases(index: Index) -> DataFrame:
    """row, win, start: where all words of a window stand in their order."""
    needs, postings = index.needs, index.postings
    first = needs.filter("rank = 1").select("win", "term", "offset")
    starts = (postings.join(sent(first), "term").select("row", "win", (F.col("pos") - F.col("offset")).alias("start")).filter("start >= 0"))
    second = needs.filter("rank = 2").select("win", "term", "offset")
    lists = postings.join(sent(second.select("term").distinct()), "term", "left_semi")
    single = starts.join(sent(needs.filter("size = 1").select("win")), "win", "left_semi")
    asked = starts.join(sent(second), "win").select("row", "win", "start", "term", (F.col("start") + F.col("offset")).alias("pos"))
    both = asked.join(lists, ["row", "term", "pos"]).select("row", "win", "start").checkpoint()
    done = both.join(sent(needs.filter("rank = 1 and size = 2").select("win")), "win", "left_semi")
    # the other terms, in the documents that are left
    others = needs.filter("rank > 2").select("win", "term", "offset", "size")
    rows = sent(both.select("row").distinct())
    rest = postings.join(rows, "row", "left_semi")
    met = (both.join(sent(others), "win").select("row", "win", "start", "size", "term", (F.col("start") + F.col("offset")).alias("pos"))
           .join(rest, ["row", "term", "pos"]).groupBy("row", "win", "start").agg(F.count("*").alias("met"), F.first("size").alias("size")))
    return single.unionByName(done).unionByName(met.filter("met = size - 2").select("row", "win", "start"))


def proximities(index: Index, slop: int) -> DataFrame:
    """row, win, start: all words of a window within its size + slop words around its rarest term, in any order."""
    anchors = index.needs.filter("rank = 1").select("win", "term", "offset", "size", "kinds")
    here = index.postings.join(sent(anchors), "term").select("row", "win", "size", "kinds", F.col("pos").alias("at"), (F.col("pos") - F.col("offset")).alias("start"))
    terms = index.needs.select("win", "term").distinct()
    asked = here.join(sent(terms), "win")
    near = F.abs(F.col("pos") - F.col("at")) < F.col("size") + slop
    met = asked.join(index.postings, ["row", "term"]).filter(near).groupBy("row", "win", "start", "kinds").agg(F.countDistinct("term").alias("met"))
    return met.filter("met = kinds").select("row", "win", "start")


def match_windows(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", k: int = WORDS, slop: int | None = None) -> DataFrame:
    """id, n_words, item, kind, start, stop: one row per match and item, and one row (item null) per document.

    kind ``phrase``: the window's words stand at start..stop-1.  With ``slop``,
    kind ``proximity`` for the other places where all words of the window are within
    ``k + slop`` words around its rarest term, in any order.  The row with a null
    item carries the document's number of words.
    """
    index = Index(documents, items, id_col, text_col, item_col, item_text, k)
    found = phrases(index).withColumn("kind", F.lit("phrase"))
    if slop is not None:
        exact = found.select("row", "win", "start")
        found = found.unionByName(proximities(index, slop).join(exact, ["row", "win", "start"], "left_anti").withColumn("kind", F.lit("proximity")))
    sizes = index.needs.filter("rank = 1").select("win", "size")
    rows = (found.join(sent(sizes), "win").join(index.owners, "win").join(index.counts, "row")
            .select("id", F.lit(None).cast("long").alias("n_words"), "item", "kind", F.col("start").cast("long").alias("start"), (F.col("start") + F.col("size")).cast("long").alias("stop")))
    whole = index.counts.select("id", "n_words", F.lit(None).cast("string").alias("item"), F.lit("count").alias("kind"),
                                F.lit(None).cast("long").alias("start"), F.lit(None).cast("long").alias("stop"))
    return rows.union(whole)


def contamination(documents: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", k: int = WORDS) -> DataFrame:
    """id, n_words, n_hit, n_items, items_sha256, contaminated of every document row."""
    index = Index(documents, items, id_col, text_col, item_col, item_text, k)
    found = phrases(index).checkpoint()
    sizes = index.needs.filter("rank = 1").select("win", "size")
    spans = found.join(sent(sizes), "win").select("row", "start", (F.col("start") + F.col("size")).alias("stop")).distinct()
    order = Window.partitionBy("row").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    covered = spans.withColumn("done", F.coalesce(F.max("stop").over(order), F.lit(0)))
    fresh = F.greatest(F.col("stop") - F.greatest("start", "done"), F.lit(0))
    hit = covered.groupBy("row").agg(F.sum(fresh).alias("n_hit"))
    held = (found.select("row", "win").distinct().join(index.owners, "win")
            .groupBy("row").agg(F.sort_array(F.collect_set("item")).alias("items")))
    joined = index.counts.join(hit.join(held, "row"), "row", "left")
    return joined.select("id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                         F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                         (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"))

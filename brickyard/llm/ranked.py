"""Ranked lexical search over a length-stratified index.

A document's normaliser ``m`` depends on its length alone, and a term's impact
on a document, ``(10^9 tf) div (1000 tf + 20 m)``, on ``tf`` and ``m``.  So

1. ``term_counts`` stages id, length, terms and their counts of every text, of
   the terms that are asked for (all of them, if these are more than
   ``VOCABULARY``); the collection's figures follow from the staged table.
2. ``write_index``: documents of equal ``m`` form a stratum, cut into parts of
   ``PART_ROWS`` by a hash where it is large.  A part is one row: its ids, and for
   each term runs of documents with equal ``tf``, the largest ``tf`` first.  The
   index is a Parquet folder in the shared folder.
3. ``search``: a task takes the parts of its index files in chunks of bounded
   size.  An impact is computed once per (term, tf) run.  The first run of every
   term bounds what a part can give to an item; parts are visited in the order
   of these bounds, in rounds of growing size, until the next bound is below the
   item's score at rank ``top``.  The tasks' best rows are ranked once more.

Items go to the tasks in blocks of about ``BLOCK_PAIRS`` (item, term) pairs.  The
terms are told apart by 64-bit hashes (of ``m`` distinct ones ``m * m / 2 ** 65``
pairs count as the same).  Scores are exact integers.

Defined results: null, empty or word-less texts have no terms, take part in no
figure and are never returned; as items they have no rows; item rows with one id
(null included) are one item with the terms of all; repeated document rows are
documents of their own; equal scores are ordered by id, null ids first; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brickyard.llm import textkit as K
from brickyard.session import ensure_checkpoint_dir

#: Bytes between terms: all of ASCII but letters and digits.
GAPS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
#: Terms that an index is restricted to; (item, term) pairs sent to the tasks at once.
VOCABULARY, BLOCK_PAIRS = 1 << 20, 1 << 19
#: Documents of a part; bytes of index rows searched at once; documents of the first round of visits.
PART_ROWS, CHUNK_BYTES, FIRST_ROWS = 8192, 48 << 20, 4096
#: Stands for a null id.
NULL_ID = -(1 << 63)
_RUNS = ("terms", "tfs", "starts", "docs")


def _term_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and row of every term of a text column."""
    data, offsets = K.text_buffer(column)
    starts, ends, row = K.word_spans(data, offsets, GAPS)
    return K.span_hashes(data, starts, ends, K.byte_codes(lower=True)), row


def asked_terms(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """item, term (hash): the distinct terms of every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in K.blocks(batch, "text"):
                terms, row = _term_hashes(block.column("text"))
                yield pa.RecordBatch.from_arrays([block.column("item").take(pa.array(row)), pa.array(terms.view(np.int64))], ["item", "term"])

    kind = items.schema[item_col].dataType.simpleString()
    return items.select(items[item_col].alias("item"), items[text_col].alias("text")).mapInArrow(run, f"item {kind}, term long").distinct()


def term_counts(documents: DataFrame, id_col: str, text_col: str, vocabulary: np.ndarray | None) -> DataFrame:
    """id, n, terms, tfs of every text with a term: its length, and the distinct terms (of the sorted ``vocabulary``) with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in K.blocks(batch, "text"):
                terms, row = _term_hashes(block.column("text"))
                n = np.bincount(row, minlength=block.num_rows)
                if vocabulary is not None:
                    at = np.searchsorted(vocabulary, terms)
                    at[at == len(vocabulary)] = 0
                    keep = vocabulary[at] == terms if len(vocabulary) else np.zeros(len(terms), bool)
                    terms, row = terms[keep], row[keep]
                order = np.lexsort((terms, row))
                terms, row = terms[order], row[order]
                first = np.flatnonzero(np.concatenate(([True], (terms[1:] != terms[:-1]) | (row[1:] != row[:-1])))) if len(terms) else np.zeros(0, np.int64)
                tfs = np.diff(np.append(first, len(terms))).astype(np.uint32)
                bounds = np.searchsorted(row[first], np.arange(block.num_rows + 1))
                out = pa.RecordBatch.from_arrays([block.column("id"), pa.array(n), K.packed(terms[first], bounds), K.packed(tfs, bounds)], ["id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    source = documents.select(documents[id_col].cast("long").alias("id"), documents[text_col].alias("text"))
    return source.mapInArrow(run, "id long, n long, terms binary, tfs binary")


def document_frequencies(staged: DataFrame) -> DataFrame:
    """term, df"""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            terms, counts = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts)], ["term", "df"])

        for batch in batches:
            held.append(np.frombuffer(K.text_buffer(batch["terms"])[0].tobytes(), np.uint64))
            size += len(held[-1])
            if size > 4_000_000:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    return staged.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def write_index(staged: DataFrame, path: str, n_docs: int, n_terms: int, part_rows: int = PART_ROWS) -> None:
    """Write the strata of ``staged`` (with a stored ``place`` of each row) below ``path``: m, part, ids and the runs of their terms."""
    spark = staged.sparkSession
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sized = staged.withColumn("m", F.expr(f"100 - 50 + (50 * n * {n_docs}L) div {max(n_terms, 1)}L"))
    large = sized.groupBy("m").agg(F.ceil(F.count("*") / F.lit(part_rows)).cast("int").alias("parts")).filter("parts > 1")
    split = (sized.join(large, "m", "left")
             .select("m", F.when(F.col("parts") > 1, F.pmod(F.xxhash64("place"), F.col("parts"))).otherwise(0).cast("int").alias("part"),
                     "id", "terms", "tfs"))
    keyed = split.repartition(slots, "m", "part").sortWithinPartitions("m", "part")

    def row(key: tuple[int, int], held: list[pa.RecordBatch]) -> list[tuple]:
        rows = pa.Table.from_batches(held).combine_chunks()
        ids = rows["id"].combine_chunks().fill_null(NULL_ID).to_numpy()
        data, bounds = K.text_buffer(rows["terms"].combine_chunks())
        terms = np.frombuffer(data.tobytes(), np.uint64)
        tfs = np.frombuffer(K.text_buffer(rows["tfs"].combine_chunks())[0].tobytes(), np.uint32)
        docs = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(bounds) // 8)
        order = np.lexsort((-tfs.astype(np.int64), terms))
        terms, tfs, docs = terms[order], tfs[order], docs[order]
        starts = np.flatnonzero(np.concatenate(([True], (terms[1:] != terms[:-1]) | (tfs[1:] != tfs[:-1])))) if len(terms) else np.zeros(0, np.int64)
        return (*key, ids.tobytes(), terms[starts].tobytes(), tfs[starts].tobytes(), starts.astype(np.int32).tobytes(), docs.tobytes())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def emit() -> pa.RecordBatch:
            done = row(key, held)
            return pa.RecordBatch.from_arrays([pa.array([done[0]], pa.int64()), pa.array([done[1]], pa.int32()), *[K.binaries([x]) for x in done[2:]]], ["m", "part", "ids", *_RUNS])

        for batch in batches:
            m, part = batch["m"].to_numpy(), batch["part"].to_numpy()
            at = np.concatenate(([0], np.flatnonzero((m[1:] != m[:-1]) | (part[1:] != part[:-1])) + 1, [len(m)]))
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if hi == lo:
                    continue
                if (own := (int(m[lo]), int(part[lo]))) != key:
                    if held:
                        yield emit()
                    key, held = own, []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield emit()

    keyed.mapInArrow(run, "m long, part int, ids binary, terms binary, tfs binary, starts binary, docs binary").write.parquet(path)


class Items:
    """A block of items: the terms of each, as places in the block's sorted vocabulary, with their weights."""

    def __init__(self, item: np.ndarray, term: np.ndarray, weight: np.ndarray, n_items: int):
        self.vocabulary, place = np.unique(term, return_inverse=True)
        order = np.argsort(item, kind="stable")
        self.bounds = np.searchsorted(item[order], np.arange(n_items + 1))
        self.place, self.weight = place[order], weight[order]

    def terms(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(self.bounds[i], self.bounds[i + 1])
        return self.place[own], self.weight[own]


class Chunk:
    """Parts of the index that are searched together, with the runs of an item block's vocabulary, by term and part."""

    def __init__(self, parts: list[dict], vocabulary: np.ndarray):
        ids, runs, docs = [], [], []
        n_docs = n_posts = 0
        self.size = np.zeros(len(parts), np.int64)
        for i, part in enumerate(parts):
            own = np.frombuffer(part["ids"], np.int64)
            terms, tfs, starts, posts = (np.frombuffer(part[c], kind) for c, kind in zip(_RUNS, (np.uint64, np.uint32, np.int32, np.int32), strict=True))
            sizes = np.diff(np.append(starts, len(posts)))
            at = np.searchsorted(vocabulary, terms)
            at[at == len(vocabulary)] = 0
            keep = np.flatnonzero(vocabulary[at] == terms)
            tf = tfs[keep].astype(np.int64)
            runs.append(np.stack([at[keep], np.full(len(keep), i), starts[keep] + n_posts, sizes[keep], (10 ** 9 * tf) // (1000 * tf + 20 * part["m"])]))
            docs.append(posts.astype(np.int64) + n_docs)
            ids.append(own)
            self.size[i] = len(own)
            n_docs, n_posts = n_docs + len(own), n_posts + len(posts)
        self.ids, self.docs = np.concatenate(ids), np.concatenate(docs)
        runs = np.concatenate(runs, axis=1)
        runs = runs[:, np.argsort(runs[0], kind="stable")]  # parts ascend and the largest tf comes first within a term
        self.term, self.part, self.start, self.length, self.impact = runs
        self.head = np.concatenate(([True], (self.term[1:] != self.term[:-1]) | (self.part[1:] != self.part[:-1]))) if len(self.term) else np.zeros(0, bool)
        self.bounds = np.searchsorted(self.term, np.arange(len(vocabulary) + 1))

    def best(self, place: np.ndarray, weight: np.ndarray, top: int, scores: np.ndarray, ids: np.ndarray, first_rows: int = FIRST_ROWS) -> tuple[np.ndarray, np.ndarray]:
        """The ``top`` scores and ids among those given and this chunk's documents; best first, ties by id."""
        counts = self.bounds[place + 1] - self.bounds[place]
        runs, gain = K.ragged(self.bounds[place], counts), np.repeat(weight, counts)
        gain = gain * self.impact[runs]
        part, head = self.part[runs], self.head[runs]
        limit = np.zeros(len(self.size), np.int64)
        np.add.at(limit, part[head], gain[head])
        order = np.argsort(-limit, kind="stable")
        order = order[limit[order] > 0]
        reach = np.cumsum(self.size[order])
        done, rows = 0, first_rows
        while done < len(order):
            least = scores[top - 1] if len(scores) >= top else 1
            open_ = int(np.searchsorted(-limit[order], -least, "right"))  # bounds of at least this score
            if open_ <= done:
                break
            stop = min(open_, max(done + 1, int(np.searchsorted(reach, (reach[done - 1] if done else 0) + rows, "right"))))
            seen = np.zeros(len(self.size), bool)
            seen[order[done:stop]] = True
            own = np.flatnonzero(seen[part])
            posts = self.docs[K.ragged(self.start[runs[own]], self.length[runs[own]])]
            # sums of products below 2^53 are exact in doubles
            total = np.bincount(posts, np.repeat(gain[own].astype(np.float64), self.length[runs[own]]), minlength=len(self.ids)) if float(limit.max()) < 2.0 ** 53 else \
                _whole_sums(posts, np.repeat(gain[own], self.length[runs[own]]), len(self.ids))
            some = np.flatnonzero(total >= least)
            scores, ids = np.concatenate((scores, total[some].astype(np.int64))), np.concatenate((ids, self.ids[some]))
            if len(scores) > top:
                keep = np.lexsort((ids, -scores))[:top]
                scores, ids = scores[keep], ids[keep]
            done, rows = stop, rows * 4
        return scores, ids


def _whole_sums(at: np.ndarray, gain: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, at, gain)
    return out


def search_block(index: DataFrame, items: Items, n_items: int, top: int) -> DataFrame:
    """item (its number), score, id: the best documents of every task for every item."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(n_items)]
        held, size = [], 0

        def visit() -> None:
            chunk = Chunk(held, items.vocabulary)
            for i in range(n_items):
                place, weight = items.terms(i)
                if len(place):
                    found[i] = chunk.best(place, weight, top, *found[i])

        for batch in batches:
            for part in batch.to_pylist():
                held.append(part)
                size += sum(len(part[c]) for c in ("ids", *_RUNS))
                if size >= CHUNK_BYTES:
                    visit()
                    held, size = [], 0
        if held:
            visit()
        numbers = np.repeat(np.arange(n_items), [len(s) for s, _ in found])
        scores, ids = (np.concatenate([f[j] for f in found] or [np.zeros(0, np.int64)]) for j in (0, 1))
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(scores), pa.array(ids, mask=ids == NULL_ID)], ["number", "score", "id"])

    return index.mapInArrow(run, "number int, score long, id long")


def ranked_search(documents: DataFrame, items: DataFrame, path: str, top: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", vocabulary_bound: int = VOCABULARY, block_pairs: int = BLOCK_PAIRS, part_rows: int = PART_ROWS) -> DataFrame:
    """item, rank, id, score: the ``top`` documents of each item; staging table and index are written below ``path``."""
    spark = documents.sparkSession
    K.prepare(spark)
    ensure_checkpoint_dir(spark)
    asked = asked_terms(items, item_col, item_text).checkpoint()
    vocabulary = None
    if asked.select("term").distinct().count() <= vocabulary_bound:
        vocabulary = np.unique(np.array([r.term for r in asked.select("term").distinct().collect()], np.int64).view(np.uint64))
    # the place of a row, stored with it, deals equal rows to different parts
    term_counts(documents, id_col, text_col, vocabulary).withColumn("place", F.monotonically_increasing_id()).write.parquet(f"{path}/staged")
    staged = spark.read.parquet(f"{path}/staged")
    n_docs, n_terms = staged.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    write_index(staged, f"{path}/index", n_docs, n_terms, part_rows)
    index = spark.read.parquet(f"{path}/index")
    weight = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1).cast("double"))).cast("long")
    weighed = asked.join(document_frequencies(staged), "term").withColumn("weight", weight).filter("weight > 0").checkpoint()
    blocks = -(-weighed.count() // block_pairs)
    kind, found = items.schema[item_col].dataType, None
    for block in range(blocks):
        pairs = weighed.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == block).collect()
        names = sorted({r["item"] for r in pairs}, key=lambda x: (x is not None, x))
        number = {x: i for i, x in enumerate(names)}
        own = Items(np.array([number[r["item"]] for r in pairs], np.int64), np.array([r.term for r in pairs], np.int64).view(np.uint64),
                    np.array([r.weight for r in pairs], np.int64), len(names))
        named = spark.createDataFrame([(i, x) for x, i in number.items()], f"number int, item {kind.simpleString()}")
        best = search_block(index, own, len(names), top).join(F.broadcast(named), "number").drop("number")
        found = best if found is None else found.union(best)
    if found is None:
        found = weighed.select(F.lit(0).cast("long").alias("score"), F.lit(0).cast("long").alias("id"), "item").limit(0)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).select("item", "rank", "id", "score")

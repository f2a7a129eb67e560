"""Nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, each quantised to its own centroids (k-means on
a bounded sample), so a vector's cell is a pair of centroids.  Every row is
stored once with its cell.  A query adds its products with both halves'
centroids and takes cells in descending order of the sum, with a heap over the
sorted lists, until the cells hold the part of all rows that a calibration on
the sample asks for.  The entries of the taken cells are reranked with the
original vectors.

Neighbouring cells' lists lie together in shards of bounded size; a cell of more
rows is dealt to shards of its own by id hash.  A query is sent to the shards
that hold a taken cell and to no other.  A task holds one shard's entries and
lets its queries pass in batches; a shard that very many queries visit is
repeated for blocks of them, so entries sent grow with the visits and not with
rows times queries.

Defined results: vectors that are null, empty, zero, hold nulls or non-finite
numbers, or differ in length from the commonest length take no part; equal
scores rank by the smaller id; rows that repeat an id count as one candidate
with its best score, and never as their own neighbour, and such an id asks with
its least vector; an empty table or one without queries gives an empty result;
fewer candidates than ``top`` give all.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickyard.llm import textkit as K
from brickyard.session import ensure_checkpoint_dir

#: Centroids of each half; vectors of the fitting sample; part of true neighbours that the calibration keeps.
CENTROIDS, SAMPLE, KEEP = 64, 12_000, 0.96
#: Most centroids of each half, and rows of a cell above which a larger table gets more of them.
MOST_CENTROIDS, CELL_ROWS = 256, 256
#: Rows of a shard, visits of a block of its queries, queries that are reranked side by side, and shards of a task.
SHARD_ROWS, VISITS, SIDE, SHARDS_A_TASK = 4_096, 65_536, 256, 16
#: Shards up to which their numbers of blocks are broadcast.
BROADCAST_ROWS = 500_000
#: Sample queries of the calibration; what equal sums may differ by after rounding.
CALIBRATE, SLACK = 128, 1e-9


def v_type(vectors: DataFrame, vector_col: str) -> bool:
    """Whether the components are floating already; they are stored as they are and scored in doubles."""
    return vectors.schema[vector_col].dataType.simpleString() in ("array<float>", "array<double>")


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v of the vectors that take part."""
    v = vectors[vector_col]
    kept = v if v_type(vectors, vector_col) else v.cast("array<double>")
    rows = vectors.select(vectors[id_col].cast("long").alias("id"), kept.alias("v")).filter(
        "id is not null and size(v) > 0 and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(v, x -> x <> 0)")
    common = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (common[0].n if common else 0))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 11) -> np.ndarray:
    if not x.shape[1]:  # the second half of vectors with one component
        return np.zeros((1, 0))
    rng = np.random.Generator(np.random.PCG64(seed))
    distinct = np.unique(x, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        own = nearest(x, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        count = np.bincount(own, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(1) - 2 * x @ centres.T, 1)


class MultiIndex:
    """Centroids of both halves, rows of every cell, and the part of the rows to visit."""

    def __init__(self, sample: np.ndarray, top: int, centroids: int = CENTROIDS):
        self.half = (sample.shape[1] + 1) // 2
        self.left, self.right = kmeans(sample[:, :self.half], centroids), kmeans(sample[:, self.half:], centroids)
        self.counts = np.zeros((len(self.left), len(self.right)), np.int64)
        self.part = self._calibrate(sample, top)

    def cells(self, x: np.ndarray) -> np.ndarray:
        return nearest(x[:, :self.half], self.left) * len(self.right) + nearest(x[:, self.half:], self.right)

    def sums(self, q: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """(queries, cells): the summed products that order the cells."""
        a, b = q[:, :self.half] @ self.left.T, q[:, self.half:] @ self.right.T
        return a[:, cells // len(self.right)] + b[:, cells % len(self.right)]

    def place(self) -> None:
        """First shard and number of shards of every cell: light cells share one, heavy ones have their own."""
        self.first, self.span = np.zeros(self.counts.size, np.int64), np.ones(self.counts.size, np.int64)
        self.filled = np.flatnonzero(self.counts.ravel())
        shard, room = 0, SHARD_ROWS
        for cell, n in enumerate(self.counts.ravel().tolist()):
            if n > room and room < SHARD_ROWS:
                shard, room = shard + 1, SHARD_ROWS
            self.first[cell], self.span[cell] = shard, max(1, math.ceil(n / SHARD_ROWS))
            if n > SHARD_ROWS:
                shard += int(self.span[cell])
            else:
                room -= n
        self.n_shards = int(self.first[-1] + self.span[-1])

    def shards(self, cells: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The shard of each entry."""
        return self.first[cells] + (K.mix(ids.view(np.uint64)) % self.span[cells].astype(np.uint64)).astype(np.int64)

    def _calibrate(self, sample: np.ndarray, top: int) -> float:
        """The smallest part of the sample, in cell order, that holds KEEP of the sample queries' true neighbours."""
        q = sample[:: max(1, len(sample) // CALIBRATE)][:CALIBRATE]
        exact, cells = q @ sample.T, self.cells(sample)
        order = self.sums(q, cells)
        top = min(top + 1, len(sample))
        best = np.argpartition(-exact, top - 1, axis=1)[:, :top]
        ranks = np.argsort(np.argsort(-order, axis=1, kind="stable"), axis=1)
        return float(np.quantile(np.take_along_axis(ranks, best, 1), KEEP) + 1) / len(sample)

    def traverse(self, q: np.ndarray, rows: int) -> tuple[float, np.ndarray]:
        """Take centroid pairs by descending sum until their cells hold ``rows`` entries; the last sum, the shards to visit."""
        a, b = self.left @ q[:self.half], self.right @ q[self.half:]
        i_order, j_order = np.argsort(-a), np.argsort(-b)
        counts = self.counts[np.ix_(i_order, j_order)].tolist()
        a, b = a[i_order].tolist(), b[j_order].tolist()
        heap, had, last = [(-a[0] - b[0], 0, 0)], 0, math.inf
        while heap and had < rows:
            last, i, j = heapq.heappop(heap)
            had += counts[i][j]
            # each pair is pushed once: along the row, and down from the row's first column
            if j + 1 < len(b):
                heapq.heappush(heap, (-a[i] - b[j + 1], i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-a[i + 1] - b[0], i + 1, 0))
        taken = self.filled[self.sums(q[None], self.filled)[0] >= -last - SLACK]
        wide = [np.arange(self.first[c], self.first[c] + self.span[c]) for c in taken[self.span[taken] > 1]]
        return -last, np.unique(np.concatenate([self.first[taken], *wide]))

    def rerank(self, q_ids: np.ndarray, q: np.ndarray, stops: np.ndarray, ids: np.ndarray, x: np.ndarray, cells: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """query, id and score of each query's best entries among its cells in a shard, whose entries lie in order of cell."""
        present = np.unique(cells)
        cut = np.append(np.searchsorted(cells, present), len(cells))
        out: list[tuple] = []
        for at in range(0, len(q), SIDE):
            side = q[at:at + SIDE]
            # sums are rounded differently here than in the traversal
            visit = self.sums(side, present) >= stops[at:at + SIDE, None] - SLACK
            scores = np.full((len(side), len(ids)), -np.inf)
            for c in range(len(present)):
                who = np.flatnonzero(visit[:, c])
                if len(who):
                    scores[who, cut[c]:cut[c + 1]] = side[who] @ x[cut[c]:cut[c + 1]].T
            scores[q_ids[at:at + SIDE, None] == ids[None]] = -np.inf
            for r in range(len(side)):
                row = scores[r]
                level = np.partition(row, len(row) - top)[len(row) - top] if len(row) > top else -np.inf
                # equal vectors must tie, so the last choice is made with sums in one fixed order
                near = np.flatnonzero((row >= level - 1e-9) & (row > -np.inf))
                exact = (x[near] * side[r]).sum(1)
                pick = np.lexsort((ids[near], -exact))[:top]
                out.append((np.full(len(pick), q_ids[at + r]), ids[near][pick], exact[pick]))
        return tuple(np.concatenate([o[j] for o in out]) for j in range(3))


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 20, centroids: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's ``top`` largest inner products over all other rows.

    ``is_query`` is a condition on the column ``id``.
    """
    spark = vectors.sparkSession
    K.prepare(spark)
    ensure_checkpoint_dir(spark)
    rows = usable(vectors, id_col, vector_col)
    total = rows.count()
    # a sample fixed by id hashes; its size is bounded however large the table is
    share = min(1.0, SAMPLE / max(1, total))
    sample = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int(share * (1 << 30))).select("v").limit(2 * SAMPLE).toArrow()["v"]
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = MultiIndex(matrix(sample), top, centroids or min(MOST_CENTROIDS, max(CENTROIDS, math.isqrt(total // CELL_ROWS))))
    kind = rows.schema["v"].dataType.simpleString()

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(index.cells(matrix(batch["v"])), pa.int64())], ["id", "v", "cell"])

    lists = rows.mapInArrow(assign, f"id long, v {kind}, cell long").checkpoint()
    for r in lists.groupBy("cell").count().collect():  # one row per cell
        index.counts.flat[r.cell] = r["count"]
    index.place()
    wanted = min(total, math.ceil(index.part * total) + top)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                stops, shards = zip(*(index.traverse(q, wanted) for q in matrix(batch["v"])), strict=True)
                yield pa.RecordBatch.from_arrays([batch["id"], batch["v"], pa.array(stops, pa.float64()), pa.array(shards, pa.list_(pa.int64()))], ["id", "v", "stop", "shards"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                shards = index.shards(batch["cell"].to_numpy(), batch["id"].to_numpy())
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.int64())], ["id", "v", "cell", "shard"])

    # few queries make few bytes: they are spread by number, by another hash than the one that joined repeated ids
    tasks = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    queries = lists.filter(is_query).groupBy("id").agg(F.min("v").alias("v")).repartition(tasks, F.xxhash64(F.lit("route"), "id"))
    routed = queries.mapInArrow(route, f"id long, v {kind}, stop double, shards array<long>").checkpoint()
    visits = routed.select(F.explode("shards").alias("shard")).groupBy("shard").agg(F.ceil(F.count("*") / VISITS).alias("blocks"))
    # one row per shard, whose number is known; a join on the shard would bring a hot shard's visits into one task
    if index.n_shards <= BROADCAST_ROWS:
        visits = F.broadcast(visits)
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
    entries = (lists.mapInArrow(deal, f"id long, v {kind}, cell long, shard long").join(visits, "shard")
               .select("shard", block, "cell", F.lit(None).cast("double").alias("stop"), "id", "v"))
    asked = (routed.select("id", "v", "stop", F.explode("shards").alias("shard")).join(visits, "shard")
             .select("shard", F.pmod(F.xxhash64("id"), "blocks").alias("block"), F.lit(None).cast("long").alias("cell"), "stop", "id", "v"))
    # within a shard's block the entries come first, in order of cell, then the queries
    together = (entries.unionByName(asked).repartition(max(tasks, index.n_shards // SHARDS_A_TASK), "shard", "block")
                .sortWithinPartitions("shard", "block", F.col("cell").asc_nulls_last(), "id"))

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, entry = None, [], None
        for batch in batches:
            where = np.stack([batch["shard"].to_numpy(), batch["block"].to_numpy()], 1)
            is_entry = batch["cell"].is_valid().to_numpy(zero_copy_only=False)
            turn = np.flatnonzero((where[1:] != where[:-1]).any(1) | (is_entry[1:] != is_entry[:-1])) + 1
            for lo, hi in zip([0, *turn], [*turn, batch.num_rows], strict=True):
                if hi == lo:
                    continue
                part = batch.slice(lo, hi - lo)
                if at != tuple(where[lo]):
                    at, held, entry = tuple(where[lo]), [], None
                if is_entry[lo]:
                    held.append(part)
                    continue
                if entry is None:
                    if not held:
                        continue
                    t = pa.Table.from_batches(held)
                    entry, held = (t["id"].to_numpy(), matrix(t["v"]), t["cell"].to_numpy()), []
                found = index.rerank(part["id"].to_numpy(), matrix(part["v"]), part["stop"].to_numpy(), *entry, top)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in found], ["query_id", "vec_id", "score"])

    best = together.mapInArrow(rerank, "query_id long, vec_id long, score double")
    once = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")

"""N-gram Jaccard join by a prefix tree over globally ordered shingle sets.

1. ``shingle_profiles``: size and 128-bit fingerprint of every text's shingle
   set; equal sets form one class, represented by its smallest id.
2. ``shared_shingles``: document frequency of every shingle over all texts, in
   packed blocks dealt by hash.  A shingle of one text only is in no
   intersection, so a text keeps its shared shingles alone, and texts with
   fewer of them than a partner needs drop out.
3. ``prefix_groups``: under the global order (rarest first) two linked texts
   share one of the first ``n - ceil(t n) + 1`` shingles; texts chained by such
   shingles form groups, which no link leaves.
4. ``tree_links``: each group, split into bounded blocks, is stored as a
   prefix tree in the reverse order (commonest first, so that near copies share
   long paths).  All texts walk down the tree together, carry their overlaps
   with the path, and leave a subtree when the overlap that remains possible is
   too small, or when all texts below are already in their component.
5. Links of representatives are closed into components; every text gets the
   component of its class.

Defined results: null, empty or word-less text has no shingle, is linked with
nothing and is its own component; fewer words than ``k`` make one shingle of
the whole sequence; repeated rows with equal ids count once per row in the
output; rows with a null id can't be named and are left out; an empty table
gives an empty result.

Shingles are compared by hashes: of 64 bits in fingerprints, by 48 bits inside a
block for frequencies, and from ``gather`` on by 48 bits and the frequency (up
to 65535), without the block number.  So of ``m`` shared shingles of one
frequency about ``m * m / 2 ** 49`` pairs count as the same (1,800 at ``m`` =
1e9, none to be expected below 2e7), which can shift an overlap by one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard.llm import textkit as K
from brickyard.llm.graph import connected_components

#: Words per shingle, and the similarity as a fraction of integers.
WORDS, NEAR, OF = 5, 75, 100
#: Shingles per block that one task sorts at once, and kept before a block is sent on.
BLOCK_SHINGLES, FLUSH_SHINGLES = 1_000_000, 500_000
#: Shingles of a tree block; larger groups are joined block by block.
TREE_SHINGLES = 400_000
_LOW = np.uint64((1 << 48) - 1)
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3,
                 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9C6E6877736C46E3], np.uint64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, one row after another, and the row bounds."""
    starts, ends, row = K.word_spans(data, offsets, K.SPACES)
    words = K.span_hashes(data, starts, ends, K.byte_codes(lower=True))
    rows = len(offsets) - 1
    first = np.searchsorted(row, np.arange(rows + 1))
    salt = [K.mix(np.array([0x51ED + j], np.uint64))[0] | np.uint64(1) if j >= len(_ODD) else _ODD[j] for j in range(k)]
    if len(words) >= k:
        grams = np.zeros(len(words) - k + 1, np.uint64)
        for j in range(k):
            grams += words[j:len(words) - k + 1 + j] * salt[j]
        grams = K.mix(grams)
    sets, bounds = [], np.zeros(rows + 1, np.int64)
    for i in range(rows):
        a, b = first[i], first[i + 1]
        if b - a >= k:
            own = np.sort(grams[a:b - k + 1])
            own = own[np.concatenate(([True], own[1:] != own[:-1]))]
        elif b > a:
            own = K.mix(np.array([np.sum(words[a:b] * np.array(salt[:b - a])) + np.uint64(b - a)], np.uint64))
        else:
            own = words[:0]
        sets.append(own)
        bounds[i + 1] = bounds[i] + len(own)
    return (np.concatenate(sets) if sets else np.zeros(0, np.uint64)), bounds


def _named(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return (documents.select(documents[id_col].cast("long").alias("id"), documents[text_col].alias("text"))
            .filter("id is not null"))


def _id_hash(ids: np.ndarray) -> np.ndarray:
    return (K.mix(ids.view(np.uint64)) >> np.uint64(2)).astype(np.int64)


def shingle_profiles(documents: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """id, n_shingles, f1, f2, h: set size, fingerprint of the set and a hash of the id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in K.blocks(batch, "text"):
                data, offsets = K.text_buffer(block.column("text"))
                tokens, bounds = shingle_sets(data, offsets, k)
                sums = [np.concatenate((np.zeros(1, np.uint64), np.cumsum(x))) for x in (K.mix(tokens + np.uint64(1)), K.mix(tokens ^ np.uint64(0xA5A5A5A5A5A5A5A5)))]
                ids = block.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(np.diff(bounds)), *[pa.array((s[bounds[1:]] - s[bounds[:-1]]).view(np.int64)) for s in sums],
                     pa.array(_id_hash(ids))], ["id", "n_shingles", "f1", "f2", "h"])

    source = _named(documents, id_col, text_col)
    return source.mapInArrow(run, "id long, n_shingles long, f1 long, f2 long, h long")


def _dealt(documents: DataFrame, id_col: str, text_col: str, k: int, buckets: int) -> DataFrame:
    """Rows (bucket, ids, sizes, counts, low, high): the shingles of a bucket by text, packed, 6 bytes each."""
    width = np.uint64((1 << 64) // buckets)

    def flush(held: list[tuple]) -> pa.RecordBatch:
        ids, sizes = (np.concatenate([h[j] for h in held]) for j in (0, 1))
        tokens = np.concatenate([h[2] for h in held])
        owner = np.repeat(np.arange(len(ids)), np.concatenate([np.diff(h[3]) for h in held]))
        bucket = np.minimum(tokens // width, np.uint64(buckets - 1)).astype(np.int64)
        order = np.lexsort((owner, bucket)) if buckets > 65536 else np.argsort(bucket.astype(np.uint16), kind="stable")
        tokens, owner, bucket = tokens[order], owner[order], bucket[order]
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(cut)):
            t, o = tokens[cut[b]:cut[b + 1]], owner[cut[b]:cut[b + 1]]
            at = np.flatnonzero(np.concatenate(([True], o[1:] != o[:-1])))
            counts = np.diff(np.append(at, len(o))).astype(np.uint32)
            t = t & _LOW
            rows.append((int(b), ids[o[at]].tobytes(), sizes[o[at]].astype(np.uint32).tobytes(), counts.tobytes(),
                         t.astype(np.uint32).tobytes(), (t >> np.uint64(32)).astype(np.uint16).tobytes()))
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64())] + [K.binaries([r[j] for r in rows]) for j in range(1, 6)],
                                          ["bucket", "ids", "sizes", "counts", "low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for block in K.blocks(batch, "text"):
                data, offsets = K.text_buffer(block.column("text"))
                tokens, bounds = shingle_sets(data, offsets, k)
                some = np.flatnonzero(np.diff(bounds))
                ids = block.column("id").to_numpy(zero_copy_only=False).astype(np.int64)[some]
                held.append((ids, np.diff(bounds)[some], tokens, np.append(bounds[:-1][some], len(tokens))))
                size += len(tokens)
                if size >= FLUSH_SHINGLES:
                    yield flush(held)
                    held, size = [], 0
        if size:
            yield flush(held)

    source = _named(documents, id_col, text_col)
    return source.mapInArrow(run, "bucket long, ids binary, sizes binary, counts binary, low binary, high binary")


def _join(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in column.to_pylist()]) if len(column) else np.zeros(0, kind)


def shared_shingles(documents: DataFrame, id_col: str, text_col: str, k: int, near: int, of: int, representatives: DataFrame, buckets: int) -> DataFrame:
    """id, n, tokens of the representatives that keep enough shared shingles.

    A token is (document frequency, hash) in one integer, so that its natural
    order is the global one; ``tokens`` is their sorted array.
    """
    def frequent(key: tuple, rows: pa.Table) -> pa.Table:
        tokens = _join(rows["low"], np.uint32).astype(np.uint64) | _join(rows["high"], np.uint16).astype(np.uint64) << np.uint64(32)
        counts, ids, sizes = _join(rows["counts"], np.uint32), _join(rows["ids"], np.int64), _join(rows["sizes"], np.uint32)
        order = np.argsort(tokens)
        ranked = tokens[order]
        at = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        freq = np.diff(np.append(at, len(ranked)))
        df = np.empty(len(tokens), np.uint64)
        df[order] = np.repeat(np.minimum(freq, 65535), freq).astype(np.uint64)
        keep = df > 1
        owner = np.repeat(np.arange(len(ids)), counts)[keep]
        own = (df[keep] << np.uint64(48)) | tokens[keep]
        counts = np.bincount(owner, minlength=len(ids)).astype(np.uint32)
        cut = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        home, out = _id_hash(ids) % buckets, []
        some = np.flatnonzero(counts)
        some = some[np.argsort(home[some], kind="stable")]
        for h in np.split(some, np.flatnonzero(np.diff(home[some])) + 1) if len(some) else []:
            out.append((int(home[h[0]]), ids[h].tobytes(), sizes[h].tobytes(), counts[h].tobytes(), own[K.ragged(cut[h], counts[h].astype(np.int64))].tobytes()))
        return pa.Table.from_arrays([pa.array([o[0] for o in out], pa.int64())] + [K.binaries([o[j] for o in out]) for j in range(1, 5)],
                                    ["home", "ids", "sizes", "counts", "tokens"])

    def gather(left: pa.Table, right: pa.Table) -> pa.Table:
        ids, sizes, counts, tokens = (_join(left[c], t) for c, t in (("ids", np.int64), ("sizes", np.uint32), ("counts", np.uint32), ("tokens", np.uint64)))
        cut = np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))
        order = np.argsort(ids, kind="stable")
        at = np.flatnonzero(np.concatenate(([True], ids[order][1:] != ids[order][:-1]))) if len(ids) else np.zeros(0, np.int64)
        wanted = set(right["id"].to_pylist())
        rows = []
        for group in np.split(order, at[1:]) if len(ids) else []:
            one, n = int(ids[group[0]]), int(sizes[group[0]])
            if one in wanted and int(counts[group].sum()) >= (n * near + of - 1) // of:
                # a repeated id brings the same shingles again
                own = np.unique(np.concatenate([tokens[cut[g]:cut[g + 1]] for g in group]))
                rows.append((one, n, own.tobytes()))
        return pa.Table.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), K.binaries([r[2] for r in rows])],
                                    ["id", "n", "tokens"])

    dealt = _dealt(documents, id_col, text_col, k, buckets)
    found = dealt.groupBy("bucket").applyInArrow(frequent, "home long, ids binary, sizes binary, counts binary, tokens binary")
    ids = representatives.select("id", F.pmod(F.col("home"), F.lit(buckets)).alias("home"))
    return found.groupBy("home").cogroup(ids.groupBy("home")).applyInArrow(gather, "id long, n long, tokens binary")


def _ranks(tokens: np.ndarray, n: int, near: int, of: int) -> np.ndarray:
    """The shared shingles within the first n - ceil(t n) + 1 of all n; unshared ones come before them."""
    return tokens[:max(0, len(tokens) - (n * near + of - 1) // of + 1)]


def prefix_groups(sets: DataFrame, near: int, of: int, buckets: int) -> DataFrame:
    """(node, component): texts chained by a common prefix shingle."""
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tokens = [], []
            for one, n, raw in zip(batch["id"].to_pylist(), batch["n"].to_pylist(), batch["tokens"], strict=True):
                head = _ranks(np.frombuffer(raw.as_buffer(), np.uint64), n, near, of)
                ids.append(np.full(len(head), one, np.int64))
                tokens.append(head)
            if not ids:
                continue
            own, tok = np.concatenate(ids), np.concatenate(tokens)
            home = (K.mix(tok) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(home, kind="stable")
            cut = np.searchsorted(home[order], np.arange(buckets + 1))
            some = [b for b in range(buckets) if cut[b] < cut[b + 1]]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), K.binaries([own[order[cut[b]:cut[b + 1]]].tobytes() for b in some]),
                                              K.binaries([tok[order[cut[b]:cut[b + 1]]].tobytes() for b in some])], ["home", "ids", "tokens"])

    def stars(key: tuple, rows: pa.Table) -> pa.Table:
        ids, tokens = _join(rows["ids"], np.int64), _join(rows["tokens"], np.uint64)
        order = np.argsort(tokens, kind="stable")
        ids, tokens = ids[order], tokens[order]
        at = np.flatnonzero(np.concatenate(([True], tokens[1:] != tokens[:-1])))
        low = np.repeat(np.minimum.reduceat(ids, at), np.diff(np.append(at, len(ids))))
        edges = np.unique(np.stack((ids, low), 1)[ids != low], axis=0)
        return pa.table({"u": edges[:, 0], "v": edges[:, 1]})

    edges = (sets.mapInArrow(emit, "home long, ids binary, tokens binary")
             .groupBy("home").applyInArrow(stars, "u long, v long"))
    return connected_components(edges)


class ShingleTree:
    """Radix tree over sets that are sorted in one global order.

    ``texts`` is in the order of the tree's leaves, so that a node covers a run
    ``lo..hi`` of it.  A node holds the run of tokens on its edge, the smallest
    set below it, and the most tokens that any set still has below it.
    """

    def __init__(self, texts: list[tuple[int, int, np.ndarray]]):
        self.texts = sorted(texts, key=lambda x: x[2].astype(">u8").tobytes())
        self.nodes: list[tuple[np.ndarray, list[int], int, int, int, int]] = []
        if self.texts:
            self._build()

    def _common(self, lo: int, hi: int, depth: int) -> int:
        """Depth to which the first and last of a sorted run agree, hence all of it."""
        a, b = self.texts[lo][2], self.texts[hi - 1][2]
        size = min(len(a), len(b))
        differ = np.flatnonzero(a[depth:size] != b[depth:size])
        return depth + int(differ[0]) if len(differ) else size

    def _build(self) -> None:
        todo = [(0, 0, len(self.texts), -1)]
        while todo:
            depth, lo, hi, up = todo.pop()
            deep = self._common(lo, hi, depth)
            least = min(self.texts[i][1] for i in range(lo, hi))
            rest = max(len(self.texts[i][2]) for i in range(lo, hi)) - deep
            me = len(self.nodes)
            self.nodes.append((self.texts[lo][2][depth:deep], [], lo, hi, least, rest))
            if up >= 0:
                self.nodes[up][1].append(me)
            if hi - lo == 1:
                continue
            at = lo
            while at < hi and len(self.texts[at][2]) == deep:  # sets that end here are leaves of their own
                self.nodes[me][1].append(len(self.nodes))
                self.nodes.append((self.texts[at][2][:0], [], at, at + 1, self.texts[at][1], 0))
                at += 1
            heads = np.array([self.texts[i][2][deep] for i in range(at, hi)], np.uint64)
            cut = np.concatenate(([0], np.flatnonzero(heads[1:] != heads[:-1]) + 1, [len(heads)])) if len(heads) else [0]
            todo.extend((deep, at + int(a), at + int(b), me) for a, b in zip(cut[:-1], cut[1:], strict=True))


class Queries:
    """Texts that walk a tree together: postings of their tokens, and where each text's tokens lie."""

    def __init__(self, texts: list[tuple[int, int, np.ndarray]]):
        self.n = np.array([x[1] for x in texts], np.int64)
        self.size = np.array([len(x[2]) for x in texts], np.int64)
        owner = np.repeat(np.arange(len(texts)), self.size)
        self.words, rank = np.unique(np.concatenate([x[2] for x in texts]), return_inverse=True)
        self.first = np.cumsum(self.size) - self.size
        self.keys = owner * (len(self.words) + 1) + rank
        self.posting = owner[np.argsort(rank, kind="stable")]
        self.start = np.concatenate(([0], np.cumsum(np.bincount(rank, minlength=len(self.words)))))

    def overlap(self, edge: np.ndarray) -> np.ndarray:
        """How many tokens of ``edge`` each text has."""
        at = np.searchsorted(self.words, edge)
        at = at[at < len(self.words)] if at[-1] == len(self.words) else at
        at = at[self.words[at] == edge[:len(at)]]
        return np.bincount(self.posting[K.ragged(self.start[at], self.start[at + 1] - self.start[at])], minlength=len(self.n))

    def left(self, texts: np.ndarray, token: np.uint64) -> np.ndarray:
        """How many tokens each text has after ``token``."""
        after = np.searchsorted(self.words, token, "right")
        return self.first[texts] + self.size[texts] - np.searchsorted(self.keys, texts * (len(self.words) + 1) + after)


def walk(tree: ShingleTree, queries: Queries, label: np.ndarray, shift: int, near: int, of: int) -> None:
    """Join ``queries`` with the tree in one traversal and merge the labels of linked texts.

    Labels of the tree's texts come first, those of the queries from ``shift``
    on; with shift 0 the tree is joined with itself.  On the way down the
    overlaps of all queries that are still possible are carried along; a query
    leaves a subtree that can't hold a link, or whose texts all have its label.
    """
    todo = [(0, np.arange(len(queries.n)), np.zeros(len(queries.n), np.int64))]
    while todo:
        node, who, had = todo.pop()
        edge, below, lo, hi, least, rest = tree.nodes[node]
        keep = np.ones(len(who), bool) if shift else who > lo  # each pair once
        own = label[lo:hi]
        if (own == own[0]).all():
            keep &= label[who + shift] != own[0]
        who, had = who[keep], had[keep]
        if not len(who):
            continue
        possible = had + rest
        if len(edge):
            had = had + queries.overlap(edge)[who]
            possible = had + np.minimum(rest, queries.left(who, edge[-1]))
        # |x & y| >= t / (1 + t) * (|x| + |y|), here for the smallest set below
        keep = possible >= -(-near * (queries.n[who] + least) // (near + of))
        who, had = who[keep], had[keep]
        if not len(who):
            continue
        if below:
            todo.extend((b, who, had) for b in below)
        else:
            merged = np.unique(np.append(label[who + shift], label[lo]))
            label[np.isin(label, merged)] = merged[0]


def group_links(left: list[tuple[int, int, np.ndarray]], right: list[tuple[int, int, np.ndarray]] | None, near: int, of: int) -> list[tuple[int, int]]:
    """Components of one block (right None) or across two, as links of each member with the smallest one."""
    tree = ShingleTree(left)
    texts = tree.texts + (right or [])
    label = np.arange(len(texts))
    # neighbouring leaves share the longest paths: try them before the walk
    for i, (a, b) in enumerate(zip(tree.texts, tree.texts[1:])):
        need = -(-near * (a[1] + b[1]) // (near + of))
        if min(len(a[2]), len(b[2])) >= need and len(np.intersect1d(a[2], b[2], assume_unique=True)) >= need:
            label[i + 1] = label[i]
    if right is not None:
        if left and right:
            walk(tree, Queries(right), label, len(left), near, of)
    elif len(left) > 2:
        walk(tree, Queries(tree.texts), label, 0, near, of)
    ids = np.array([x[0] for x in texts], np.int64)
    order = np.lexsort((ids, label))
    heads = np.concatenate(([True], label[order][1:] != label[order][:-1]))
    low = ids[order][np.flatnonzero(heads)][np.cumsum(heads) - 1]
    return [(int(u), int(v)) for u, v in zip(ids[order], low, strict=True) if u != v]


def tree_links(sets: DataFrame, groups: DataFrame, near: int, of: int, buckets: int) -> DataFrame:
    """(u, v) links between representatives, enough of them to connect every component."""
    sized = sets.join(groups.withColumnRenamed("node", "id"), "id")
    sums = (sets.select("id", F.octet_length("tokens").alias("bytes")).join(groups.withColumnRenamed("node", "id"), "id")
            .groupBy("component").agg(F.ceil(F.sum("bytes") / F.lit(8 * TREE_SHINGLES)).cast("int").alias("parts")).filter("parts > 1"))
    split = (sized.join(sums, "component", "left")
             .withColumn("parts", F.coalesce("parts", F.lit(1)))
             .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("component", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "id", "n", "tokens"))
    keyed = split.repartition(buckets, "component", "a", "b").sortWithinPartitions("component", "a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> pa.RecordBatch:
            _, a, b = key
            if a == b:
                links = group_links([x[1:] for x in held], None, near, of)
            else:
                links = group_links([x[1:] for x in held if x[0] == a], [x[1:] for x in held if x[0] == b], near, of)
            return pa.RecordBatch.from_arrays([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], ["u", "v"])

        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("component", "a", "b", "part", "id", "n", "tokens")]
            for component, a, b, part, one, n, raw in zip(*columns, strict=True):
                if (component, a, b) != key:
                    if len(held) > 1:
                        yield done()
                    key, held = (component, a, b), []
                # commonest first: the complement reverses the global order
                held.append((part, one, n, ~np.frombuffer(raw, np.uint64)[::-1]))
        if len(held) > 1:
            yield done()

    return keyed.mapInArrow(run, "u long, v long")


def jaccard_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, near: int = NEAR, of: int = OF) -> DataFrame:
    """Components of the Jaccard join: id, n_shingles, class_id, component_id (one row per input row).

    Two texts link when ``of * |a & b| >= near * |a | b|``; ``near / of`` must
    be positive.  ``class_id`` is the smallest id with an equal set.
    """
    spark = documents.sparkSession
    K.prepare(spark)
    profiles = shingle_profiles(documents, id_col, text_col, k).checkpoint()
    classes = (profiles.filter("n_shingles > 0").groupBy("n_shingles", "f1", "f2")
               .agg(F.min(F.struct("id", "h")).alias("first"), F.count("*").alias("copies")))
    total = profiles.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(slots, math.ceil(total / BLOCK_SHINGLES))
    heads = classes.select(F.col("first.id").alias("id"), F.col("first.h").alias("home"))
    sets = shared_shingles(documents, id_col, text_col, k, near, of, heads, buckets).checkpoint()
    groups = prefix_groups(sets, near, of, buckets)
    links = tree_links(sets, groups, near, of, buckets)
    members = connected_components(links)
    # classes of several texts, dealt to salted copies so that a large class is no single task's
    salts = 16
    named = classes.select("n_shingles", "f1", "f2", F.col("first.id").alias("class_id"), "copies")
    several = named.filter("copies > 1").drop("copies").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    rows = profiles.withColumn("salt", F.pmod(F.col("h"), F.lit(salts)).cast("int"))
    rows = (rows.join(several, ["n_shingles", "f1", "f2", "salt"], "left")
            .select("id", "n_shingles", F.coalesce("class_id", "id").alias("class_id"), "salt"))
    copies = members.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(F.col("node").alias("class_id"), "salt", "component")
    return (rows.join(copies, ["class_id", "salt"], "left")
            .select("id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id")))

"""SimHash near-duplicate detection by tables of distances to reference fingerprints.

1. ``fingerprints``: XXH64 of every 3-word shingle, repeats included; a bit of
   the fingerprint is set where more than half of the hashes have it.
2. ``distance_tables``: the Hamming distances of every distinct fingerprint to
   ``PIVOTS`` reference fingerprints (Walsh codes, which differ from each other in
   32 bits, so that no distance tells what another one told).
3. ``cells``: by the triangle inequality the tables of two fingerprints at most
   ``near`` bits apart differ by at most ``near`` in every coordinate.  A few
   coordinates are cut in two, with ``near`` distances that belong to both sides,
   so that two such fingerprints share a cell; the cuts, and how many there are,
   follow from the counts of distances.
4. ``cell_links``: inside a cell, sorted by its widest coordinate, pairs are
   discarded by the largest coordinate difference, one coordinate after another,
   and the survivors are verified.  Cells of more than ``BLOCK`` members are
   joined block by block.
5. Links between fingerprints are closed into components.

Defined results: null, empty and word-less texts have the fingerprint zero, which
is linked like any other; fewer words than ``k`` are one shingle of the whole
sequence; a bit set in exactly half of the hashes is 0; repeated rows each get a
row; rows with a null id get their fingerprint and the smallest id reachable,
null if there is none; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard.llm import textkit as K
from brickyard.llm.graph import connected_components
from brickyard.session import ensure_checkpoint_dir

#: Words of a shingle, seed of its hash, and differing bits of linked fingerprints.
WORDS, SEED, NEAR = 3, 42, 2
#: Members that a cell should have, and those of a block that one task joins at once.
CELL, BLOCK = 2048, 4096
#: Pairs that are held at once; hashes whose bits are counted at once; copies of a label that rows are joined with.
PAIRS, HASHES, COPIES = 1 << 21, 1 << 18, 16
#: Reference fingerprints: bit j of number i is the parity of i & j, shifted by one hash, as the
#: fingerprint zero would else be 32 bits from all of them, on the cut of every coordinate.
PIVOTS = np.array([sum(((i & j).bit_count() & 1) << j for j in range(64)) for i in range(64)], np.uint64) ^ K.mix(np.array([SEED], np.uint64))


def simhash(text: bytes, k: int = WORDS, seed: int = SEED) -> int:
    """Fingerprint of one text in UTF-8."""
    words = text.lower().split()  # of bytes: A-Z alone, and ASCII white space
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate((np.zeros(1, np.int64), ends[:-1] + 1))
    ends = ends[min(k, len(words)) - 1:]
    starts = starts[:len(ends)]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(ends), HASHES):
        spans = zip(starts[at:at + HASHES].tolist(), ends[at:at + HASHES].tolist(), strict=True)
        hashes = np.array([digest(line[a:b], seed) for a, b in spans], "<u8")
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, seed: int = SEED) -> DataFrame:
    """id, fingerprint (its 64 bits as a signed integer) of every row."""
    K.prepare(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([simhash(memoryview(x.as_buffer()).tobytes() if x.is_valid else b"", k, seed) for x in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(found.view(np.int64))], ["id", "fingerprint"])

    source = documents.select(documents[id_col].cast("long").alias("id"), documents[text_col].alias("text"))
    return source.mapInArrow(run, "id long, fingerprint long")


def distance_tables(prints: DataFrame) -> DataFrame:
    """fingerprint, distances: one byte per reference fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch["fingerprint"].to_numpy().view(np.uint64)
            table = np.bitwise_count(own[:, None] ^ PIVOTS[None, :]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([batch["fingerprint"], K.packed(table.ravel(), np.arange(len(own) + 1) * len(PIVOTS))], ["fingerprint", "distances"])

    return prints.select("fingerprint").mapInArrow(run, "fingerprint long, distances binary")


def _table(column: pa.Array) -> np.ndarray:
    data, _ = K.text_buffer(column)
    return data.reshape(-1, len(PIVOTS))


def choose_cuts(tables: DataFrame, near: int, cell: int) -> list[tuple[int, int]]:
    """(coordinate, cut): fingerprints with distance cut or more on one side, those below cut + near on the other.

    The counts of all distances (64 by 65 numbers) come to the driver.  Cuts
    are taken, the most even ones first, until a cell should have ``cell`` members.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(PIVOTS), 65), np.int64)
        for batch in batches:
            table = _table(batch["distances"])
            for i in range(len(PIVOTS)):
                sums[i] += np.bincount(table[:, i], minlength=65)
        i, d = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(d, pa.int32()), pa.array(sums[i, d])], ["i", "d", "n"])

    counts = np.zeros((len(PIVOTS), 65), np.int64)
    for r in tables.select("distances").mapInArrow(run, "i int, d int, n long").groupBy("i", "d").agg(F.sum("n").alias("n")).collect():
        counts[r.i, r.d] = r.n
    total = int(counts[0].sum())
    below = np.concatenate((np.zeros((len(PIVOTS), 1), np.int64), np.cumsum(counts, axis=1)), axis=1)
    ranked = []
    for i in range(len(PIVOTS)):
        cuts = np.arange(1, 66 - near)
        left, right = below[i, cuts + near], total - below[i, cuts]
        share = (left.astype(float) ** 2 + right.astype(float) ** 2) / np.maximum(left + right, 1) / max(total, 1)
        best = int(np.argmin(share))
        ranked.append((float(share[best]), i, int(cuts[best])))
    chosen, expected = [], float(total)
    for share, i, cut in sorted(ranked):
        if expected <= cell or share > 0.9 or len(chosen) == 40:
            break
        chosen.append((i, cut))
        expected *= share
    return chosen


def cells(tables: DataFrame, cuts: list[tuple[int, int]], near: int) -> DataFrame:
    """cell, fingerprint, distances: every fingerprint in all the cells that it belongs to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = _table(batch["distances"])
            for lo in range(0, len(table), 256):  # some have hundreds of copies
                own = table[lo:lo + 256]
                row, key = np.arange(len(own)), np.zeros(len(own), np.int64)
                for bit, (i, cut) in enumerate(cuts):
                    d = own[row, i]
                    upper, both = d >= cut, (d >= cut) & (d < cut + near)
                    key, row = np.concatenate((key + (upper << bit), key[both])), np.concatenate((row, row[both]))
                yield pa.RecordBatch.from_arrays([pa.array(key), *[batch[c].take(pa.array(lo + row)) for c in ("fingerprint", "distances")]], ["cell", "fingerprint", "distances"])

    return tables.mapInArrow(run, "cell long, fingerprint long, distances binary")


def close_pairs(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray] | None, near: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints at most ``near`` bits apart, within one (fingerprints, distances) or across two."""
    prints, table = left
    others, other = right or left
    spread = other.max(axis=0).astype(int) - other.min(axis=0)
    axes = np.argsort(-spread, kind="stable")
    by = np.argsort(other[:, axes[0]], kind="stable")
    line = other[by, axes[0]].astype(np.int64)
    if right is None:  # in the order of the widest coordinate: each pair once, the smaller distance first
        order, own = by, line
        first, last = np.arange(1, len(by) + 1), np.searchsorted(line, line + near, "right")
    else:
        order, own = np.arange(len(prints)), table[:, axes[0]].astype(np.int64)
        first, last = np.searchsorted(line, own - near, "left"), np.searchsorted(line, own + near, "right")
    sizes = np.maximum(last - first, 0)
    ends = np.cumsum(sizes)
    lo = 0
    while lo < len(order):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PAIRS, "right")))
        a = np.repeat(order[lo:hi], sizes[lo:hi])
        b = by[K.ragged(first[lo:hi], sizes[lo:hi])]
        lo = hi
        for axis in axes[1:]:
            if len(a) < 64:
                break
            keep = np.abs(table[a, axis].astype(np.int8) - other[b, axis].astype(np.int8)) <= near
            a, b = a[keep], b[keep]
        keep = np.bitwise_count(prints[a] ^ others[b]) <= near
        if keep.any():
            yield a[keep], b[keep]


def _roots(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index reachable from each index."""
    label = np.arange(n)
    if not pairs:
        return label
    a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = np.minimum(new[new], new[label])
        if (new == label).all():
            return label
        label = new


def cell_links(members: DataFrame, near: int, block: int, slots: int) -> DataFrame:
    """(u, v) links of fingerprints, enough of them to connect what is connected inside each cell."""
    large = members.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("parts")).filter("parts > 1")
    split = (members.join(large, "cell", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
             .withColumn("part", F.pmod(F.xxhash64("fingerprint"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("cell", F.least("part", "other").alias("a"), F.greatest("part", "other").alias("b"), "part", "fingerprint", "distances"))
    keyed = split.repartition(slots, "cell", "a", "b").sortWithinPartitions("cell", "a", "b")

    def join(a: int, b: int, held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        part, prints, table = (np.concatenate(x) for x in zip(*held, strict=True))
        if a == b:
            found = [*close_pairs((prints, table), None, near)] if len(prints) > 1 else []
        else:
            x, y = np.flatnonzero(part == a), np.flatnonzero(part == b)
            found = [(x[i], y[j]) for i, j in close_pairs((prints[x], table[x]), (prints[y], table[y]), near)] if len(x) and len(y) else []
        root = _roots(len(prints), found)
        linked = np.flatnonzero(root != np.arange(len(prints)))
        return pa.RecordBatch.from_arrays([pa.array(prints[linked].view(np.int64)), pa.array(prints[root[linked]].view(np.int64))], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            keys = np.stack([batch[c].to_numpy() for c in ("cell", "a", "b")])
            part, prints, table = batch["part"].to_numpy(), batch["fingerprint"].to_numpy().view(np.uint64), _table(batch["distances"])
            at = np.concatenate(([0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, [len(part)]))
            for lo, hi in zip(at[:-1], at[1:], strict=True):
                if hi == lo:
                    continue
                if (own := tuple(keys[:, lo].tolist())) != key:
                    if held:
                        yield join(*key[1:], held)
                    key, held = own, []
                held.append((part[lo:hi].copy(), prints[lo:hi].copy(), table[lo:hi].copy()))
        if held:
            yield join(*key[1:], held)

    return keyed.mapInArrow(run, "u long, v long")


def simhash_components(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS, seed: int = SEED, near: int = NEAR,
                       cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id of every row; ``near`` must be positive."""
    spark = documents.sparkSession
    ensure_checkpoint_dir(spark)
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = fingerprints(documents, id_col, text_col, k, seed).checkpoint()
    classes = rows.groupBy("fingerprint").agg(F.min("id").alias("first"), F.count("*").alias("copies")).checkpoint()
    tables = distance_tables(classes)
    members = cells(tables, choose_cuts(tables, near, cell), near)
    linked = connected_components(cell_links(members, near, block, slots))
    # a component's smallest id, then its label on every fingerprint; both by salted copies, as one component may hold most
    salts = F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1)))
    of_class = classes.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
    least = of_class.filter("component is not null").groupBy("component").agg(F.min("first").alias("least")).withColumn("salt", salts)
    labels = (of_class.withColumn("salt", F.pmod(F.xxhash64("fingerprint"), F.lit(COPIES)).cast("int")).join(least, ["component", "salt"], "left")
              .filter("copies > 1 or component is not null")
              .select("fingerprint", F.coalesce("least", "first").alias("label")).withColumn("salt", salts))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(COPIES)).cast("int"))
    return (salted.join(labels, ["fingerprint", "salt"], "left")
            .select("id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.coalesce("label", "id").alias("component_id")))

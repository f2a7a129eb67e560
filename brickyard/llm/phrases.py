"""Phrase collocation mining by mergeable Misra-Gries summaries per hash partition.

Texts are split into pieces at ``PIECE_ENDS`` and pieces into words; an n-gram
(1 to ``longest`` words) lies within one piece and is counted per language.

1. ``_dealt``: texts are dealt to groups of about ``GROUP_BYTES`` by a hash.
2. ``_local_counts``: each group's distinct n-grams, as 64-bit hashes with their
   counts, go to hash partitions (``bucket``) in packed rows.
3. ``surviving``: the first pass over a partition merges these rows into one
   Misra-Gries summary.  Its capacity exceeds the partition's mass divided by
   ``least``, so what the summary takes off its counters stays below ``least``
   and every n-gram that occurs ``least`` times survives.  The amount taken off
   is carried along: if one partition turns out heavier than planned, its
   capacity doubles before that amount could reach ``least``.
4. ``exact_counts``: the second pass counts the survivors exactly and keeps those
   that occur ``least`` times, each with one group that holds it.
5. ``_named``: that group's texts are split again and give the n-gram its words.
6. Scores, the test against longer phrases and the ranks are joins and windows
   over the frequent n-grams, in decimal arithmetic.

Nothing is collected.  A word or phrase that is in every text sends one entry
per group of texts; languages, however many, only enter the hashes.

Defined results: null and empty texts have no words; a null language is ``und``,
as one row group with the texts that are labelled so; repeated rows count each;
equal scores and counts are ordered by the phrase's bytes; an empty table, or one
without a frequent phrase, gives no rows; ids are not used.  N-grams are told
apart by 64-bit hashes until they get their words: of ``m`` distinct ones about
``m * m / 2 ** 65`` pairs count as the same (0.03 pairs at ``m`` = 1e9).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickyard.llm import textkit as K
from brickyard.session import ensure_checkpoint_dir

#: Bytes that end a piece, and those that end a word.
PIECE_ENDS, WORD_ENDS = np.zeros(256, bool), np.zeros(256, bool)
PIECE_ENDS[[*b".,;:!?", 10, 11, 12, 13]] = True
WORD_ENDS[[*b".,;:!? ", 9, 10, 11, 12, 13]] = True
#: Text bytes of a group; n-grams that a task sorts at once; counters of a summary.
GROUP_BYTES, FLUSH_GRAMS, COUNTERS = 16 << 20, 3_000_000, 1 << 20
#: Parts of a language that are ranked apart first; copies of a word's row that its phrases are joined with.
RANK_PARTS, WORD_COPIES = 16, 8
#: Language of rows without one.
UNKNOWN = "und"
_ODD = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


class Grams:
    """The words of a block of texts, and their n-grams as hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: np.ndarray):
        self.data = data
        self.starts, self.ends, self.row = K.word_spans(data, offsets, WORD_ENDS)
        self.words = K.span_hashes(data, self.starts, self.ends, K.byte_codes(lower=True))
        piece = np.cumsum(PIECE_ENDS[data])[self.starts] if len(self.starts) else self.starts
        self.next = (self.row[1:] == self.row[:-1]) & (piece[1:] == piece[:-1])
        self.lang = langs[self.row]

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the n-grams and the index of each one's first word."""
        count = len(self.words) - n + 1
        if count <= 0:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        whole = np.ones(count, bool)
        for j in range(n - 1):
            whole &= self.next[j:j + count]
        at = np.flatnonzero(whole)
        code = self.lang[at] + np.uint64(n)
        for j in range(n):
            code = K.mix(code + self.words[at + j] * _ODD[j])
        return code, at

    def text(self, i: int) -> str:
        return self.data[self.starts[i]:self.ends[i]].tobytes().lower().decode("utf-8", "replace")


def _lang_hashes(langs: pa.Array) -> np.ndarray:
    """64-bit hash of each row's language."""
    data, offsets = K.text_buffer(langs)
    sums = np.zeros(len(langs), np.uint64)
    filled = np.flatnonzero(np.diff(offsets))
    sums[filled] = K.span_hashes(data, offsets[:-1][filled], offsets[1:][filled], K.byte_codes(lower=False))
    return K.mix(sums + np.uint64(1))


def _dealt(documents: DataFrame, text_col: str, lang_col: str, groups: int, slots: int) -> DataFrame:
    """grp, lang, text: rows in groups; equal rows spread too, by their place in the input."""
    place = F.pmod(F.monotonically_increasing_id(), F.lit(1024))
    rows = documents.select(documents[text_col].alias("text"), F.coalesce(documents[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"))
    rows = rows.select(F.pmod(F.xxhash64("text", "lang", place), F.lit(groups)).alias("grp"), "lang", "text")
    return rows.repartition(max(slots, groups // 32 + 1), "grp")


def _blocks(rows: pa.RecordBatch) -> Iterator[tuple[Grams, pa.RecordBatch]]:
    for block in K.blocks(rows, "text"):
        data, offsets = K.text_buffer(block.column("text"))
        yield Grams(data, offsets, _lang_hashes(block.column("lang"))), block


def _local_counts(dealt: DataFrame, longest: int, buckets: int) -> DataFrame:
    """bucket, grp, hashes, counts: packed counts of a group's n-grams."""
    width = ((1 << 64) - 1) // buckets

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grp, held, size = key[0].as_py(), [], 0

        def flush() -> pa.RecordBatch:
            grams, counts = np.unique(np.concatenate(held), return_counts=True)
            bucket = np.minimum(grams // np.uint64(width), np.uint64(buckets - 1)).astype(np.int64)
            at = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            bounds = np.append(at, len(grams))
            return pa.RecordBatch.from_arrays([pa.array(bucket[at]), pa.array(np.full(len(at), grp, np.int64)), K.packed(grams, bounds),
                                               K.packed(counts.astype(np.uint32), bounds)], ["bucket", "grp", "hashes", "counts"])

        for batch in batches:
            for grams, _ in _blocks(batch):
                for n in range(1, longest + 1):
                    found, _ = grams.of(n)
                    held.append(found)
                    size += len(found)
                if size >= FLUSH_GRAMS:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return dealt.groupBy("grp").applyInArrow(run, "bucket long, grp long, hashes binary, counts binary")


class Summary:
    """Misra-Gries summary: counters that hold an n-gram's count less at most ``off``.

    More than ``capacity`` counters are cut back by the size of the largest one
    too many.  A cut that would bring ``off`` to ``least`` isn't made; the
    capacity doubles instead.
    """

    def __init__(self, least: int, capacity: int):
        self.least, self.capacity, self.off = least, capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, off: int = 0) -> None:
        """Add the counters of another summary, which has taken ``off`` off its own."""
        self.off += off
        keys, counts = np.concatenate((self.keys, keys)), np.concatenate((self.counts, counts))
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
        self.keys, self.counts = keys[at], np.add.reduceat(counts, at) if len(at) else counts
        while len(self.keys) > self.capacity:
            cut = int(np.partition(self.counts, len(self.counts) - self.capacity - 1)[len(self.counts) - self.capacity - 1])
            if self.off + cut >= self.least:
                self.capacity *= 2
                continue
            self.off += cut
            keep = self.counts > cut
            self.keys, self.counts = self.keys[keep], self.counts[keep] - cut

    def survivors(self) -> np.ndarray:
        """All n-grams that may occur ``least`` times: their counters lack ``off`` at most."""
        return self.keys[self.counts + self.off >= self.least]


def surviving(local: DataFrame, least: int, capacity: int) -> DataFrame:
    """bucket, keys: n-grams of each partition that may occur ``least`` times, among them all that do."""
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary, held, size = Summary(least, capacity), [], 0
        for batch in batches:
            for hashes, counts in zip(batch["hashes"], batch["counts"], strict=True):
                held.append((np.frombuffer(hashes.as_buffer(), np.uint64), np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)))
                size += len(held[-1][0])
                if size >= capacity:
                    summary.merge(*map(np.concatenate, zip(*held, strict=True)))
                    held, size = [], 0
        if held:
            summary.merge(*map(np.concatenate, zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int64()), K.binaries([summary.survivors().tobytes()])], ["bucket", "keys"])

    return local.groupBy("bucket").applyInArrow(run, "bucket long, keys binary")


def exact_counts(local: DataFrame, survivors: DataFrame, least: int) -> DataFrame:
    """grp, hashes, counts: n-grams that occur ``least`` times, by a group that holds them."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in left["keys"]] or [np.zeros(0, np.uint64)])
        total, home, best = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.uint64)
        for grp, hashes, counts in zip(right["grp"], right["hashes"], right["counts"], strict=True):
            own = np.frombuffer(hashes.as_buffer(), np.uint64)
            at = np.searchsorted(keys, own)
            at[at == len(keys)] = 0
            here = np.flatnonzero(keys[at] == own) if len(keys) else np.zeros(0, np.int64)
            at = at[here]
            total[at] += np.frombuffer(counts.as_buffer(), np.uint32)[here]
            # of all groups that hold an n-gram a hash picks one, so that no group has to name most of them
            draw = K.mix(own[here] ^ K.mix(np.array([grp.as_py()], np.uint64))) | np.uint64(1)
            more = draw > best[at]
            best[at[more]], home[at[more]] = draw[more], grp.as_py()
        some = np.flatnonzero(total >= least)
        some = some[np.argsort(home[some], kind="stable")]
        bounds = np.concatenate(([0], np.flatnonzero(np.diff(home[some])) + 1, [len(some)])) if len(some) else np.zeros(1, np.int64)
        return pa.Table.from_arrays([pa.array(home[some][bounds[:-1]]), K.packed(keys[some], bounds), K.packed(total[some], bounds)], ["grp", "hashes", "counts"])

    return survivors.groupBy("bucket").cogroup(local.groupBy("bucket")).applyInArrow(run, "grp long, hashes binary, counts binary")


def _named(dealt: DataFrame, found: DataFrame, longest: int) -> DataFrame:
    """lang, n, w1.., f of every frequent n-gram; and with n = 0 the words of each group and language, in ``f``."""
    names = [f"w{j + 1}" for j in range(longest)]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        wanted = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in right["hashes"]] or [np.zeros(0, np.uint64)])
        counts = np.concatenate([np.frombuffer(x.as_buffer(), np.int64) for x in right["counts"]] or [np.zeros(0, np.int64)])
        order = np.argsort(wanted)
        wanted, counts = wanted[order], counts[order]
        open_, words, rows = np.ones(len(wanted), bool), {}, []
        for batch in left.to_batches():
            for grams, block in _blocks(batch):
                langs = block.column("lang").to_pylist()
                for row, size in enumerate(np.bincount(grams.row, minlength=len(langs)).tolist()):
                    words[langs[row]] = words.get(langs[row], 0) + size
                if not open_.any():
                    continue
                for n in range(1, longest + 1):
                    own, first = grams.of(n)
                    at = np.searchsorted(wanted, own)
                    at[at == len(wanted)] = 0
                    here = np.flatnonzero((wanted[at] == own) & open_[at])
                    which, one = np.unique(at[here], return_index=True)
                    open_[which] = False
                    for k, i in zip(which.tolist(), first[here[one]].tolist(), strict=True):
                        rows.append((langs[grams.row[i]], n, int(counts[k]), *[grams.text(i + j) if j < n else None for j in range(longest)]))
        if open_.any():
            raise RuntimeError("a group of texts changed between two passes over it: the input must give the same rows each time it is read")
        rows.extend((lang, 0, size, *[None] * longest) for lang, size in words.items() if size)
        kinds = [pa.string(), pa.int32(), pa.int64()] + [pa.string()] * longest
        return pa.Table.from_arrays([pa.array([r[j] for r in rows], kind) for j, kind in enumerate(kinds)], ["lang", "n", "f", *names])

    return (dealt.groupBy("grp").cogroup(found.groupBy("grp"))
            .applyInArrow(run, "lang string, n int, f long, " + ", ".join(f"{x} string" for x in names)))


def frequent_grams(documents: DataFrame, least: int, longest: int = 3, text_col: str = "text", lang_col: str = "lang",
                   counters: int = COUNTERS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """lang, n, f, w1.. of every n-gram that occurs ``least`` times in its language, and per language parts of its number of words (n = 0)."""
    spark = documents.sparkSession
    K.prepare(spark)
    ensure_checkpoint_dir(spark)
    size = documents.agg(F.coalesce(F.sum(F.octet_length(documents[text_col])), F.lit(0))).first()[0]
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = _dealt(documents, text_col, lang_col, size // group_bytes + 1, slots)
    # a word and its end take two bytes at least, so this is no less than the mass
    buckets = longest * (size + 1) // 2 // (least * counters) + 1
    local = _local_counts(dealt, longest, buckets).repartition(max(slots, buckets), "bucket")
    found = exact_counts(local, surviving(local, least, counters), least)
    return _named(dealt, found, longest).checkpoint()


def _score(whole: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (l * r)), exactly: products have up to 38 digits."""
    wide = [x.cast("decimal(16,0)") for x in (whole, left, right)]
    return F.call_function("div", wide[0] * wide[0] * F.lit(1000000).cast("decimal(7,0)"), wide[1] * wide[2])


def collocations(documents: DataFrame, least: int = 10, top: int = 2000, cover: int = 50, of: int = 100, text_col: str = "text", lang_col: str = "lang",
                 counters: int = COUNTERS, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of two and three words of each language.

    A phrase needs ``least`` occurrences, and no phrase that contains it may
    have ``cover / of`` of them.
    """
    grams = frequent_grams(documents, least, 3, text_col, lang_col, counters, group_bytes)
    totals = grams.filter("n = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    # a common word is part of many phrases: they meet salted copies of its row
    salts = F.explode(F.sequence(F.lit(0), F.lit(WORD_COPIES - 1)))
    words = grams.filter("n = 1").select("lang", F.col("w1").alias("w"), F.col("f").alias("fw"), salts.alias("salt"))
    pairs = grams.filter("n = 2").select("lang", "w1", "w2", F.col("f").alias("a"), F.pmod(F.xxhash64("w1", "w2"), F.lit(WORD_COPIES)).cast("int").alias("salt"))
    for own, count in (("w1", "l"), ("w2", "r")):
        pairs = pairs.join(words.withColumnsRenamed({"w": own, "fw": count}), ["lang", own, "salt"])
    pairs = pairs.checkpoint()  # read by both parts of the triples and by the phrases of two
    triples = grams.filter("n = 3").select("lang", "w1", "w2", "w3", F.col("f").alias("a"))
    heads = pairs.select("lang", "w1", "w2", F.col("l").alias("l1"), F.col("a").alias("l2"))
    tails = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("r1"), F.col("r").alias("r2"))
    triples = triples.join(heads, ["lang", "w1", "w2"]).join(tails, ["lang", "w2", "w3"])
    inner = (triples.select("lang", F.explode(F.array(F.struct("w1", "w2"), F.struct(F.col("w2").alias("w1"), F.col("w3").alias("w2")))).alias("p"), "a")
             .groupBy("lang", F.col("p.w1").alias("w1"), F.col("p.w2").alias("w2")).agg(F.max("a").alias("longer")))
    open_pairs = pairs.join(inner, ["lang", "w1", "w2"], "left").filter(F.col("longer").isNull() | (of * F.col("longer") < cover * F.col("a")))
    two = open_pairs.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", _score(F.col("a"), F.col("l"), F.col("r")).alias("score"))
    cuts = triples.withColumns({"s1": _score(F.col("a"), F.col("l1"), F.col("r1")), "s2": _score(F.col("a"), F.col("l2"), F.col("r2"))})
    second = F.col("s2") < F.col("s1")
    three = cuts.select("lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(second, F.col("l2")).otherwise(F.col("l1")).alias("l"),
                        F.when(second, F.col("r2")).otherwise(F.col("r1")).alias("r"), F.least("s1", "s2").alias("score"))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    parts = two.union(three).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    first = parts.withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("place") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

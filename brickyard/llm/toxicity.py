"""Toxicity by a convolutional text classifier trained in numpy.

A word is the sum of hashed embeddings: of the word itself and of its first
four and five bytes.  Filters of several widths run over the whole text, each
keeps its maximum, and a logistic layer adds them up.  Only the position that
won a filter's maximum receives its gradient.  Embeddings start from the
features' document log-odds.

Training reads every usable labelled text, whole.  A hash of the id deals texts
into shards of about ``SHARD_ROWS`` rows or ``SHARD_BYTES`` bytes; in its order
every CALIBRATE-th id of a shard sets thresholds and the others train:

1. ``counts``: training texts of each label per feature, and word shares of each
   language.
2. ``descend``: each shard descends from the same start, by as many steps as its
   texts need to be drawn about once, both labels alike.  The changes are
   averaged (a feature's over the shards that touched it).  Of a label with few
   texts each text goes to several shards.
3. ``calibrate``: thresholds by language from all the texts that don't train;
   logits are counted in steps of 1 / STEP.

Sums over tasks are sums of integers, so that neither the layout of the input
nor the order of tasks changes a model.

Thresholds are calibrated by language.  The language is the text's own: a
word-likelihood router learnt from the training texts' language column guesses
it, so that column is no input of a score.  A score is shifted so that 0.7
means "at the threshold".

Scoring needs no multiplication per word: the product of every embedding with
every filter slice is a table, looked up by feature.

Defined results: null, empty or word-less texts score as the bias does (every
maximum is 0); texts shorter than a filter are padded with nothing; without
labels of both kinds every score is 0; repeated rows are scored one by one;
repeated labels count each time; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from brickyard.llm import textkit as K
from brickyard.session import ensure_checkpoint_dir

#: Hash buckets, embedding size, filter widths and filters of each.
BUCKETS, SIZE, WIDTHS, FILTERS = 1 << 16, 12, (1, 2, 3), 6
#: Labelled texts that descend together: about so many, or so many bytes; of each label at least about so many.
SHARD_ROWS, SHARD_BYTES, SHARD_LEAST = 8192, 32 << 20, 256
#: Steps of a shard at least, texts of a step, step size, words whose activations are held at once.
STEPS, BATCH, RATE, HOLD = 120, 48, 0.01, 1 << 17
#: Buckets of a row that carries sums, and units of a fixed-point one.
PART, UNIT = 1024, 1 << 20
#: Logits are counted in steps of 1 / STEP.
STEP = 1024
#: Rows of labels that are sent to all tasks; more are joined by a shuffle.
SENT = 500_000
#: The calibrated threshold sits at this score.
AT = 0.7
#: One of so many texts calibrates; a language with fewer of a label there uses the common threshold.
CALIBRATE, LEAST = 4, 20
PREFIXES = (4, 5)

#: ASCII characters that separate words; other bytes belong to words.
_SEPARATE = np.zeros(256, bool)
_SEPARATE[:128] = [not chr(c).isalnum() for c in range(128)]


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(words, 1 + prefixes) feature buckets of all rows, and the row bounds; bucket 0 stands for none."""
    data, offsets = K.text_buffer(pc.utf8_lower(pc.fill_null(column, "")))
    starts, ends, row = K.word_spans(data, offsets, _SEPARATE)
    codes = K.byte_codes(lower=True)
    out = np.zeros((len(starts), 1 + len(PREFIXES)), np.uint16)
    for j, size in enumerate((0, *PREFIXES)):
        stop = np.minimum(ends, starts + size) if size else ends
        hashed = K.span_hashes(data, starts, stop, codes) + np.uint64(j)
        own = (K.mix(hashed) % np.uint64(BUCKETS - 1)).astype(np.uint16) + 1
        out[:, j] = np.where(ends - starts >= size, own, 0)
    return out, np.searchsorted(row, np.arange(len(offsets)))


@dataclass
class Model:
    tables: np.ndarray  # (BUCKETS, sum(widths) * FILTERS): products of embeddings and filter slices
    bias: np.ndarray  # of filters
    dense: np.ndarray
    offset: float
    languages: list[str]
    router: np.ndarray  # (BUCKETS, languages)
    thresholds: np.ndarray  # per language, the common one last

    def pool(self, feats: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        return _pool(self.tables, self.bias, feats, bounds)[0]

    def score(self, feats: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        logits = self.pool(feats, bounds) @ self.dense + self.offset
        level = self.thresholds[self.route(feats, bounds)]
        return 1 / (1 + np.exp(-np.clip(logits - level + np.log(AT / (1 - AT)), -30, 30)))

    def route(self, feats: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Index of the likeliest language; the last index where no word tells."""
        rows = len(bounds) - 1
        out = np.full(rows, len(self.languages))
        some = np.flatnonzero(np.diff(bounds))
        if len(some) and self.languages:
            sums = np.add.reduceat(self.router[feats[:, 0]], bounds[:-1][some], axis=0)
            out[some] = np.argmax(sums, 1)
        return out


def _pool(tables: np.ndarray, bias: np.ndarray, feats: np.ndarray, bounds: np.ndarray, argmax: bool = False):
    """Rectified maxima (rows, widths * FILTERS) and, on request, the word at which each was reached (-1: none)."""
    rows = len(bounds) - 1
    pooled = np.zeros((rows, len(WIDTHS) * FILTERS), np.float32)
    where = np.full(pooled.shape, -1) if argmax else None
    acts = tables[feats[:, 0]]
    for j in range(1, feats.shape[1]):
        acts += tables[feats[:, j]]
    at = 0
    for k, width in enumerate(WIDTHS):
        some = np.flatnonzero(np.diff(bounds) >= width)
        cols = slice(k * FILTERS, (k + 1) * FILTERS)
        n = len(acts) - width + 1
        if len(some):
            conv = acts[:n, at:at + FILTERS].copy()
            for j in range(1, width):
                conv += acts[j:n + j, at + j * FILTERS:at + (j + 1) * FILTERS]
            conv += bias[cols]
            # windows that run over a row's end belong to no row
            if width > 1:
                last = bounds[1:][np.diff(bounds) > 0]
                for j in range(1, width):
                    over = last - j
                    conv[over[(over >= 0) & (over < n)]] = -np.inf
            cut = bounds[:-1][some]
            top = np.maximum.reduceat(conv, cut, axis=0)
            if argmax:
                for i, r in enumerate(some):
                    where[r, cols] = cut[i] + np.argmax(conv[cut[i]:bounds[r + 1] - width + 1], axis=0)
            pooled[some, cols] = np.maximum(top, 0)
        at += width * FILTERS
    return pooled, where


def _tables(embed: np.ndarray, filters: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([embed @ f[j] for f in filters for j in range(len(f))], axis=1).astype(np.float32)


def _start(seen: np.ndarray, total: np.ndarray, seed: int) -> tuple[list[np.ndarray], np.random.Generator]:
    """Embeddings, filters, bias, dense layer and offset before the first step, and what draws on."""
    rng = np.random.Generator(np.random.PCG64(seed))
    odds = np.log((seen[1] + 0.5) / (total[1] + 1)) - np.log((seen[0] + 0.5) / (total[0] + 1))
    embed = rng.normal(0, 0.05, (BUCKETS, SIZE))
    embed[:, 0] = odds / 3 * seen.sum(0) / (seen.sum(0) + 5)  # rare features prove little
    embed[0] = 0
    filters = [rng.normal(0, 0.1, (w, SIZE, FILTERS)) for w in WIDTHS]
    filters[0][0, 0] = 1
    dense = rng.normal(0, 0.1, len(WIDTHS) * FILTERS)
    dense[:FILTERS] = 1 / FILTERS
    return [embed, *filters, np.zeros(len(WIDTHS) * FILTERS), dense, np.zeros(1)], rng


def _held_at_once(texts: list[np.ndarray], pick: np.ndarray) -> Iterator[np.ndarray]:
    """Runs of ``pick`` of about HOLD words (one text at least)."""
    at, words = 0, 0
    for i, one in enumerate(pick):
        if i > at and words + len(texts[one]) > HOLD:
            yield pick[at:i]
            at, words = i, 0
        words += len(texts[one])
    yield pick[at:]


def fit(texts: list[np.ndarray], labels: np.ndarray, start: list[np.ndarray], rng: np.random.Generator) -> list[np.ndarray]:
    """The parameters after descending from ``start``: texts are drawn, both labels alike in a step, about once each at least."""
    params = [p.copy() for p in start]
    embed, filters, (bias, dense, offset) = params[0], params[1:1 + len(WIDTHS)], params[1 + len(WIDTHS):]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params[:-1]]
    sides = [np.flatnonzero(labels == y) for y in (0, 1)]
    size = BATCH // 2
    local, slope = np.zeros(BUCKETS, np.int64), np.zeros_like(embed)
    for step in range(1, max(STEPS, -(-max(len(x) for x in sides) // size)) + 1):
        pick = np.concatenate([rng.choice(x, size) for x in sides])
        grads = [slope, *[np.zeros_like(f) for f in filters], np.zeros_like(bias), 1e-4 * dense]
        total, met = 0.0, np.zeros(BUCKETS, bool)
        for part in _held_at_once(texts, pick):
            feats = np.concatenate([texts[i] for i in part])
            bounds = np.concatenate(([0], np.cumsum([len(texts[i]) for i in part])))
            if len(feats):
                here = np.zeros(BUCKETS, bool)
                here[feats] = True
                words = np.flatnonzero(here)
                local[words] = np.arange(len(words))
                pooled, where = _pool(_tables(embed[words], filters), bias.astype(np.float32), local[feats], bounds, argmax=True)
            else:
                pooled, where = np.zeros((len(part), len(bias)), np.float32), None
            p = 1 / (1 + np.exp(-np.clip(pooled @ dense + offset[0], -30, 30)))
            error = (p - labels[part]) / len(pick)
            total += float(error.sum())
            back = error[:, None] * dense[None] * (pooled > 0)
            grads[-2] += back.sum(0)
            grads[-1] += pooled.T @ error
            for k, width in enumerate(WIDTHS):
                r, f = np.nonzero(back[:, k * FILTERS:(k + 1) * FILTERS])
                if not len(r):
                    continue
                g, spot = back[r, k * FILTERS + f], where[r, k * FILTERS + f]
                for j in range(width):
                    ids = feats[spot + j]
                    word = embed[ids].sum(1)
                    np.add.at(grads[1 + k][j].T, f, g[:, None] * word)
                    for c in range(ids.shape[1]):
                        np.add.at(slope, ids[:, c], g[:, None] * filters[k][j][:, f].T)
                    met[ids] = True
        met[0] = False
        slope[0] = 0
        met = np.flatnonzero(met)
        touched = met[slope[met].any(1)]
        for q, g, (m, v) in zip(params, grads, moments):
            rows = touched if q is embed else slice(None)
            m[rows] = 0.9 * m[rows] + 0.1 * g[rows]
            v[rows] = 0.99 * v[rows] + 0.01 * g[rows] ** 2
            q[rows] -= RATE * (m[rows] / (1 - 0.9 ** step)) / (np.sqrt(v[rows] / (1 - 0.99 ** step)) + 1e-8)
        slope[met] = 0
        offset -= RATE * 10 * total
    return params


def _threshold(logits: np.ndarray, hits: np.ndarray, rows: np.ndarray) -> float:
    """The middle of the widest gap among the cuts with the best F-measure, which counts precision double.

    ``logits`` are distinct, with ``rows`` texts each, ``hits`` of them toxic.
    """
    order = np.argsort(-logits, kind="stable")
    x, y, n = logits[order], hits[order], rows[order]
    if not len(x) or not y.any():
        return 0.0
    f = 1.25 * np.cumsum(y) / (np.cumsum(n) + 0.25 * y.sum())
    after = np.append(x[1:], x[-1] - 2)
    gap = np.where(f >= f.max() - 1e-12, x - after, -1)
    i = int(np.argmax(gap))
    return float((x[i] + max(after[i], x[i] - 4)) / 2)


def _sums(rows: DataFrame, keys: list[str]) -> list:
    """Rows (keys, values): integer vectors added up by key; ``values`` holds 64-bit integers packed."""
    names = [f.name for f in rows.schema.fields]

    def add(table: pa.Table) -> pa.Table:
        values = None
        for raw in table["values"]:
            one = np.frombuffer(raw.as_buffer(), np.int64)
            values = one.copy() if values is None else values + one
        return pa.Table.from_arrays([*[table[k].slice(0, 1) for k in keys], pa.array([values.tobytes()], pa.binary())], names)

    return rows.groupBy(*keys).applyInArrow(add, rows.schema).collect()


def counts(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    """Documents per label and feature, documents per label, and word shares per language of all ``rows``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str | None], np.ndarray] = {("sizes", None): np.zeros(PART, np.int64)}
        for batch in batches:
            for block in K.blocks(batch, "text"):
                feats, bounds = features(block["text"])
                for i, (label, lang) in enumerate(zip(block["label"].to_pylist(), block["lang"].to_pylist(), strict=True)):
                    own = feats[bounds[i]:bounds[i + 1]]
                    held["sizes", None][label] += 1
                    held.setdefault((str(label), None), np.zeros(BUCKETS, np.int64))[np.unique(own)] += 1
                    if lang is not None:
                        share = held.setdefault(("words", lang), np.zeros(BUCKETS, np.int64))
                        if len(own):
                            at, n = np.unique(own[:, 0], return_counts=True)
                            share[at] += np.rint(n * (UNIT / len(own))).astype(np.int64)
        for (what, lang), values in held.items():
            parts = [i for i in range(0, len(values), PART) if i == 0 or values[i:i + PART].any()]
            yield pa.RecordBatch.from_arrays([pa.array([what] * len(parts)), pa.array([lang] * len(parts), pa.string()), pa.array(parts, pa.int32()),
                                              K.binaries([values[i:i + PART].tobytes() for i in parts])], ["what", "lang", "at", "values"])

    seen, sizes, shares = np.zeros((2, BUCKETS)), np.zeros(PART, np.int64), {}
    for r in _sums(rows.select("label", "lang", "text").mapInArrow(run, "what string, lang string, at int, values binary"), ["what", "lang", "at"]):
        values = np.frombuffer(r["values"], np.int64)
        if r.what == "sizes":
            sizes = values
        elif r.what == "words":
            shares.setdefault(r.lang, np.zeros(BUCKETS))[r.at:r.at + PART] = values / UNIT
        else:
            seen[int(r.what), r.at:r.at + PART] = values
    return seen, sizes[:2], shares


def descend(rows: DataFrame, seen: np.ndarray, total: np.ndarray, shards: int, seed: int) -> list[np.ndarray]:
    """Parameters averaged over the shards of all ``rows``; ``seen`` and ``total`` of them are by label."""
    copies = [int(min(shards, -(-SHARD_LEAST * shards // int(n)))) for n in total]
    given = rows.sparkSession.sparkContext.broadcast((seen, total))  # its size is fixed by BUCKETS

    def run(key: tuple, table: pa.Table) -> pa.Table:
        shard, texts = key[0].as_py(), []
        table = table.sort_by([(c, "ascending") for c in ("h", "label", "text")])
        for batch in table.combine_chunks().to_batches():
            for block in K.blocks(batch, "text"):
                feats, bounds = features(block["text"])
                texts.extend(feats[a:b].copy() for a, b in zip(bounds[:-1], bounds[1:], strict=True))
        labels = table["label"].to_numpy().astype(np.int64)
        start, rng = _start(*given.value, seed)
        # with one label there is nothing to tell apart
        params = fit(texts, labels, start, np.random.Generator(np.random.PCG64([seed, shard])) if shard else rng) if labels.any() and not labels.all() else start
        moved = [np.rint((p - q) * UNIT).astype(np.int64) for p, q in zip(params, start, strict=True)]
        embed = np.concatenate((moved[0], moved[0].any(1)[:, None]), axis=1)
        parts = [i for i in range(0, BUCKETS, PART) if embed[i:i + PART, -1].any()]
        shared = np.concatenate([*[m.ravel() for m in moved[1:]], [1]])
        return pa.table({"at": pa.array([*parts, BUCKETS], pa.int32()), "values": K.binaries([*[embed[i:i + PART].tobytes() for i in parts], shared.tobytes()])})

    # the text's own shard and, for a label with few texts, the next ones
    dealt = (rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("label") == 1, copies[1]).otherwise(copies[0]) - 1)))
             .select(F.pmod(F.col("shard") + F.col("copy"), F.lit(shards)).cast("int").alias("shard"), "h", "label", F.coalesce("text", F.lit("")).alias("text")))
    params, _ = _start(seen, total, seed)
    for r in _sums(dealt.groupBy("shard").applyInArrow(run, "at int, values binary"), ["at"]):
        values = np.frombuffer(r["values"], np.int64)
        if r.at < BUCKETS:
            values = values.reshape(-1, SIZE + 1)
            params[0][r.at:r.at + PART] += values[:, :-1] / UNIT / np.maximum(values[:, -1:], 1)
        else:
            at = 0
            for q in params[1:]:
                q += values[at:at + q.size].reshape(q.shape) / UNIT / values[-1]
                at += q.size
    return params


def calibrate(rows: DataFrame, model: Model) -> None:
    """Set the model's thresholds from all ``rows``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in K.blocks(batch, "text", K.BLOCK_BYTES // 4):
                feats, bounds = features(block["text"])
                logits = np.clip(shared.value.pool(feats, bounds) @ shared.value.dense + shared.value.offset, -30, 30)
                yield pa.RecordBatch.from_arrays([pa.array(shared.value.route(feats, bounds), pa.int32()), pa.array(np.rint(logits * STEP).astype(np.int32)), block["label"]],
                                                 ["route", "step", "label"])

    # a row per language and step at most
    found = (rows.select("label", "text").mapInArrow(run, "route int, step int, label int")
             .groupBy("route", "step").agg(F.sum("label").alias("hits"), F.count(F.lit(1)).alias("rows")).collect())
    route, step, hits, n = (np.array([r[i] for r in found], np.int64) for i in range(4))
    at, place = np.unique(step, return_inverse=True)
    model.thresholds[:] = _threshold(at / STEP, np.bincount(place, hits, len(at)), np.bincount(place, n, len(at)))
    for i in range(len(model.languages)):
        mine = route == i
        if hits[mine].sum() >= LEAST and (n - hits)[mine].sum() >= LEAST:
            model.thresholds[i] = _threshold(step[mine] / STEP, hits[mine], n[mine])


def train(documents: DataFrame, labels: DataFrame, usable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic", seed: int = 7) -> Model:
    """Fit on all usable labelled texts; sums of a fixed size alone reach the driver."""
    K.prepare(documents.sparkSession)
    ensure_checkpoint_dir(documents.sparkSession)
    marks = labels.filter(labels[label_col].isin(0, 1)).select(labels[id_col].alias("label_id"), labels[label_col].cast("int").alias("label"))
    text, h = documents[text_col], F.pmod(F.xxhash64(documents[id_col]), F.lit(1 << 30))
    mine = documents.filter(usable).select(documents[id_col].alias("id"), h.alias("h"), documents[lang_col].alias("lang"), text.alias("text"))
    none = Model(np.zeros((BUCKETS, sum(WIDTHS) * FILTERS), np.float32), np.zeros(len(WIDTHS) * FILTERS, np.float32), np.zeros(len(WIDTHS) * FILTERS), -30.0,
                 [], np.zeros((BUCKETS, 0), np.float32), np.zeros(1))
    found = (mine.select("id", F.octet_length("text").alias("bytes")).join(marks, F.col("id") == F.col("label_id"))
             .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first())
    shards = max(1, -(-found.rows // SHARD_ROWS), -(-found.bytes // SHARD_BYTES))
    own = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(shards)).cast("int")
    place = F.row_number().over(Window.partitionBy("shard").orderBy("h", "id"))
    ids = mine.select("id", "h").distinct().join(marks.select(F.col("label_id").alias("id")).distinct(), "id", "left_semi").withColumn("shard", own)
    dealt = ids.withColumn("held", place % CALIBRATE == 0).join(marks, F.col("id") == F.col("label_id")).drop("label_id").checkpoint()
    rows = mine.drop("h").join(F.broadcast(dealt) if found.rows <= SENT else dealt, "id")
    seen, total, shares = counts(rows.filter("not held"))
    if not total.all():
        return none
    languages = sorted(shares)
    router = np.stack([shares[x] for x in languages], 1) if languages else np.zeros((BUCKETS, 0))
    router = np.log(router + 1e-4) - np.log((router + 1e-4).sum(0))
    embed, *filters, bias, dense, offset = descend(rows.filter("not held"), seen, total, shards, seed)
    model = Model(_tables(embed, filters), bias.astype(np.float32), dense, float(offset[0]), languages, router.astype(np.float32), np.zeros(len(languages) + 1))
    calibrate(rows.filter("held"), model)
    return model


def score(documents: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """id, the carried columns and score of every row."""
    spark = documents.sparkSession
    K.prepare(spark)
    shared = spark.sparkContext.broadcast(model)  # its size is fixed by BUCKETS, WIDTHS and FILTERS
    carry = carry or []
    rows = documents.select(documents[id_col].alias("id"), *[documents[c].alias(f"c{i}") for i, c in enumerate(carry)], documents[text_col].alias("text"))
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in K.blocks(batch, "text", K.BLOCK_BYTES // 4):
                found = shared.value.score(*features(block["text"]))
                yield pa.RecordBatch.from_arrays([*[block[f.name] for f in kept], pa.array(found, pa.float64())], [*[f.name for f in kept], "score"])

    out = rows.mapInArrow(run, StructType([*kept, StructField("score", DoubleType())]))
    return out.select("id", *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "score")

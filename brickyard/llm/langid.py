"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent n-grams (one to five letters, words
padded with blanks).  A language's profile comes from its labelled texts; a
document's from its whole text.  The document's distance to a language is the
sum of how far each of its n-grams is out of place there, ``RANKS`` for one
that is missing; the nearest language wins.

Letters are first mapped to at most 62 classes, the commonest letters of the
training texts, so that an n-gram of any length up to five fits one 32-bit
integer; all other letters share a class.

Defined results: null texts and texts without a letter are ``und`` with score
0; equal distances go to the language that sorts first; equal counts rank by
n-gram code; without any labelled text every document is ``und``; an empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from brickyard.llm import textkit as K

#: Longest n-gram, and ranks of a profile.
LONGEST, RANKS = 5, 400
#: Training sample: about this many texts of each language, chosen by a hash of the id.
SAMPLE = 1500
CLASSES, OTHER, BLANK = 62, 63, 1  # 0 ends a code


@functools.cache
def letter_table() -> np.ndarray:
    """Lower-case codepoint of every letter, 0 for everything else."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if unicodedata.category(ch)[0] == "L":
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def code_points(data: np.ndarray) -> np.ndarray:
    raw = data.tobytes()
    return np.frombuffer(raw.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


class Profiles:
    """Letter classes, and the rank of every n-gram in each language's profile."""

    def __init__(self, letters: np.ndarray, grams: dict[str, np.ndarray]):
        self.letters, self.grams = letters, grams
        self.languages = sorted(grams)
        self.keys = np.unique(np.concatenate([grams[x] for x in self.languages])) if grams else np.zeros(0, np.uint32)
        self.rank = np.full((len(self.languages), len(self.keys) + 1), -1, np.int64)  # the last column stands for absence
        for i, name in enumerate(self.languages):
            self.rank[i, np.searchsorted(self.keys, grams[name])] = np.arange(len(grams[name]))

    def classes(self) -> np.ndarray:
        table = np.zeros(0x110000, np.uint8)
        low = letter_table()
        some = np.flatnonzero(low)
        at = np.full(0x110000, OTHER, np.uint8)
        at[self.letters] = np.arange(2, 2 + len(self.letters), dtype=np.uint8)
        table[some] = at[low[some]]
        return table


def gram_codes(points: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of one text, blank-padded words one after another; no code crosses a word."""
    kind = table[points]
    kind = kind[(kind != 0) | np.concatenate(([False], kind[:-1] != 0))]  # one separator between words
    kind = np.concatenate((kind, [0])) if len(kind) and kind[-1] else kind
    if not len(kind):
        return np.zeros(0, np.uint32)
    # a separator is both the blank behind a word and the one before the next
    line = np.concatenate(([0], kind)).astype(np.uint32)
    blank = line == 0
    line[blank] = BLANK
    blanks = np.concatenate(([0], np.cumsum(blank)))
    parts, code = [line[~blank]], line
    for n in range(2, min(LONGEST, len(line)) + 1):
        code = (code[:-1] << np.uint32(6)) | line[n - 1:]
        # a blank may only stand at the ends of an n-gram
        parts.append(code[blanks[n - 1:len(line)] == blanks[1:len(line) - n + 2]])
    return np.concatenate(parts)


def top_ranks(codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The RANKS most frequent codes, commonest first, equal counts by code."""
    if len(codes) > RANKS:
        least = np.partition(counts, len(counts) - RANKS)[len(counts) - RANKS]
        keep = counts >= least
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))][:RANKS]


def profile(codes: np.ndarray) -> np.ndarray:
    codes = np.sort(codes)
    at = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return top_ranks(codes[at], np.diff(np.append(at, len(codes))))


def training_rows(documents: DataFrame, usable: Column, lang_col: str, text_col: str, id_col: str, per_language: int = SAMPLE) -> DataFrame:
    """lang, text of the training sample: about ``per_language`` texts of each language.

    A text is in if the hash of its id is below the language's share, which
    follows from a count over all labelled texts, so a rerun takes the same rows.
    """
    rows = documents.filter(usable & documents[lang_col].isNotNull() & documents[text_col].isNotNull())
    spread = F.pmod(F.xxhash64(documents[id_col]), F.lit(1 << 30))
    rows = rows.select(documents[lang_col].alias("lang"), documents[text_col].alias("text"), spread.alias("h"))
    keep = F.lit(False)
    for r in rows.groupBy("lang").count().collect():  # one row per language
        keep = keep | ((F.col("lang") == r.lang) & (F.col("h") < int(min(1.0, per_language / r["count"]) * (1 << 30))))
    return rows.filter(keep).select("lang", "text")


def train(sample: DataFrame) -> Profiles:
    """Profiles of the languages of a bounded (lang, text) sample, counted on the executors."""
    K.prepare(sample.sparkSession)

    def letters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, int] = {}
        for batch in batches:
            for block in K.blocks(batch, "text"):
                low = letter_table()[code_points(K.text_buffer(block["text"])[0])]
                for c, n in zip(*(x.tolist() for x in np.unique(low[low > 0], return_counts=True)), strict=True):
                    sums[c] = sums.get(c, 0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array(list(sums.values()), pa.int64())], ["letter", "n"])

    common = sample.select("text").mapInArrow(letters, "letter long, n long").groupBy("letter").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "letter").limit(CLASSES - 1).collect()
    alphabet = np.array([r.letter for r in common], np.int64)
    table_of = Profiles(alphabet, {})

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of.classes()
        for batch in batches:
            for block in K.blocks(batch, "text"):
                for lang in pc.unique(block["lang"]).to_pylist():
                    own = block.filter(pc.equal(block["lang"], lang))
                    data, offsets = K.text_buffer(own["text"])
                    codes = np.concatenate([gram_codes(code_points(data[a:b]), table) for a, b in zip(offsets[:-1], offsets[1:], strict=True)])
                    codes, counts = np.unique(codes, return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts)], ["lang", "code", "n"])

    counted = sample.mapInArrow(grams, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    ranked = counted.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))).filter(F.col("r") <= RANKS)
    found: dict[str, list] = {}
    for r in ranked.orderBy("lang", "r").collect():  # RANKS rows per language
        found.setdefault(r.lang, []).append(r.code)
    return Profiles(alphabet, {k: np.array(v, np.uint32) for k, v in found.items()})


def place(profiles: Profiles, codes: np.ndarray) -> tuple[str, float]:
    """Nearest language and a score: one minus its distance as a part of the largest possible one."""
    own = profile(codes)
    at = np.searchsorted(profiles.keys, own)
    at[at == len(profiles.keys)] = 0
    at = np.where(profiles.keys[at] == own, at, len(profiles.keys))
    rank = profiles.rank[:, at]
    far = np.where(rank < 0, RANKS, np.abs(rank - np.arange(len(own)))).sum(1)
    best = int(np.argmin(far))
    return profiles.languages[best], 1.0 - float(far[best]) / (RANKS * len(own))


def identify(documents: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """id, the carried columns, lang_pred, score of every row."""
    K.prepare(documents.sparkSession)
    carry = carry or []
    rows = documents.select(documents[id_col].alias("id"), *[documents[c].alias(f"c{i}") for i, c in enumerate(carry)], documents[text_col].alias("text"))
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = profiles.classes()
        for batch in batches:
            for block in K.blocks(batch, "text"):
                data, offsets = K.text_buffer(block["text"])
                found = []
                for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                    codes = gram_codes(code_points(data[a:b]), table) if b > a and profiles.languages else np.zeros(0, np.uint32)
                    found.append(place(profiles, codes) if len(codes) else ("und", 0.0))
                yield pa.RecordBatch.from_arrays([*[block[f.name] for f in kept], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                                                 [*[f.name for f in kept], "lang_pred", "score"])

    out = rows.mapInArrow(run, StructType([*kept, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
    return out.select("id", *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)], "lang_pred", "score")

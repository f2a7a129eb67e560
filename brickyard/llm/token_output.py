"""Token-ID files: canonical length-limited Huffman blocks with bit-offset checkpoints.

1. Every text is encoded once, its ids kept as a compact staging table.
2. Global id counts (a vocabulary-sized table) give code lengths by package-merge;
   the canonical code follows from the lengths alone.
3. The staging rows are range-partitioned and sorted by id; each partition writes
   blocks of a bounded number of ids.  A block is decodable on its own: row ids,
   row lengths, the packed bits, and the bit offset of every ``STRIDE``-th id.
4. The reader runs all checkpoints of a block side by side: one table lookup per
   step yields an id and its code length for every lane.

The file format is a Parquet folder of such blocks (``magic``, ``version``,
``part``, ``block``, ``row_ids``, ``row_sizes``, ``checkpoints``, ``bits``) and a
folder ``code`` with (token, length).  ``start`` of a row comes from the running
sums of block sizes, so ids are in ascending order of row id over all files.

Literals of the file's added tokens (such as ``<|endoftext|>``) become their ids
with ``added_tokens``, as by the library's own call, and are plain text without
(its ``encode_special_tokens``); the query has them become ids.

Defined results: null and empty texts hold the end id alone; repeated rows are
written one by one in an order fixed by id and text hash; an empty table gives
an empty file set.  Rows with a null id come first.
"""

from __future__ import annotations

import functools
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brickyard.llm import textkit as K
from brickyard.session import ensure_checkpoint_dir

#: Longest code (the decoding table has 2 ** LIMIT entries); ids between checkpoints; ids per block.
LIMIT, STRIDE, BLOCK_IDS = 18, 128, 1 << 17
#: Distinct pieces that a worker remembers, by 64-bit hashes (some 30 bytes each); pieces in a line for the library; text bytes looked up at once.
CACHE_WORDS, LINE_WORDS, BLOCK_BYTES = 2_000_000, 1000, 4 << 20
#: Stands between the pieces of a line, apart from both.
MARK = " \x7f "
#: End of the blocks of precomposed Latin letters; the characters that stand for bytes in the vocabulary: printable
#: ones for themselves, the rest from U+0100 on.
LATIN_END = "\u0180"
_OTHERS = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
BYTE_CHARACTERS = {b: 256 + i for i, b in enumerate(_OTHERS)}
MAGIC, VERSION = "BYTK", 1


_KIND = np.full(256, 3, np.uint8)  # white space 0, letters and digits 1, other ASCII marks 2; apostrophes and bytes of other characters 3
_KIND[:128] = [0 if K.SPACES[c] else 1 if chr(c).isalnum() else 3 if c == 39 else 2 for c in range(128)]


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every piece that the tokenizer treats on its own."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = _KIND[data]
    cut = np.ones(len(data) + 1, bool)
    before, after = kind[:-1], kind[1:]
    cut[1:-1] = (before == 0) | (after == 0) | (before + after == 3) & (before != 0) & (after != 0)
    cut[offsets] = True
    at = np.flatnonzero(cut)
    starts, ends = at[:-1], at[1:]
    word = kind[starts] != 0
    return starts[word], ends[word]


class WordIds:
    """Ids of texts by the tokenizers library, which sees every distinct piece once.

    The tokenizer lower-cases, drops white space, and ends a piece between an
    ASCII letter or digit and other ASCII marks; only apostrophes join both
    (contractions).  So texts are cut there and at ASCII white space, and the
    pieces are encoded apart, lower-cased.  With ``added``, texts are split at the
    literals of the file's added tokens first, as the library does.
    """

    def __init__(self, path: str, added: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # of pieces: no literal is among them
        self.mark, = self.tokenizer.encode(MARK, add_special_tokens=False).ids
        tokens = self.tokenizer.get_added_tokens_decoder() if added else {}
        if any(t.normalized or t.single_word or t.lstrip or t.rstrip for t in tokens.values()):
            raise ValueError("added tokens are found in raw texts, by their bare literals")
        self.added = {t.content.encode(): i for i, t in tokens.items()}
        # the longest literal counts where several begin
        self.literal = re.compile(b"|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None
        self._forget()

    def _forget(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.used = len(self.added)
        self.arena = np.zeros(1 << 16, np.uint16)
        self.arena[:self.used] = list(self.added.values())
        self.at, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _ids(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each piece.  Lower-case Latin letters, which the library's normaliser and splitter leave as they
        are, go straight to its model; the others go through all of it, many in a line between marks."""
        plain = [w.isalpha() and (w.isascii() or max(w) < LATIN_END and w == w.lower()) for w in words]
        others = iter(self._others([w for w, p in zip(words, plain, strict=True) if not p]))
        merge = self.tokenizer.model.tokenize
        return [np.array([t.id for t in merge(w if w.isascii() else w.encode().decode("latin-1").translate(BYTE_CHARACTERS))], np.uint16) if p else next(others)
                for w, p in zip(words, plain, strict=True)]

    def _others(self, words: list[str]) -> list[np.ndarray]:
        lines = [MARK.join(words[i:i + LINE_WORDS]) for i in range(0, len(words), LINE_WORDS)]
        out: list[np.ndarray] = []
        for line, found in zip(lines, self.tokenizer.encode_batch_fast(lines, add_special_tokens=False), strict=True):
            own = words[len(out):len(out) + LINE_WORDS]
            ids = np.array(found.ids, np.uint16)
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) != len(own) - 1 or line.count(MARK.strip()) != len(cut):  # a piece with the mark's character
                out.extend(np.array(e.ids, np.uint16) for e in self.tokenizer.encode_batch_fast(own, add_special_tokens=False))
            else:
                starts, ends = np.append(0, cut + 1).tolist(), np.append(cut, len(ids)).tolist()
                out.extend(ids[a:b] for a, b in zip(starts, ends, strict=True))
        return out

    def _slots(self, hashes: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Slot of each piece, given by its hash (ascending, distinct) and where it stands in ``raw``."""
        here = np.searchsorted(self.keys, hashes)
        known = here < len(self.keys)
        known[known] = self.keys[here[known]] == hashes[known]
        new = np.flatnonzero(~known)
        if len(new):
            ids = self._ids([raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[new].tolist(), ends[new].tolist(), strict=True)])
            sizes = np.fromiter(map(len, ids), np.int64, len(ids))
            flat = np.concatenate(ids)
            while self.used + len(flat) > len(self.arena):
                self.arena = np.concatenate((self.arena, np.zeros_like(self.arena)))
            self.arena[self.used:self.used + len(flat)] = flat
            fresh = len(self.at) + np.arange(len(new))
            self.at = np.concatenate((self.at, self.used + np.cumsum(sizes) - sizes))
            self.size = np.concatenate((self.size, sizes))
            self.used += len(flat)
            self.keys, self.slot = np.insert(self.keys, here[new], hashes[new]), np.insert(self.slot, here[new], fresh)
            here = np.searchsorted(self.keys, hashes)
        return self.slot[here]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(self.keys) > CACHE_WORDS:
            self._forget()
        rows = len(offsets) - 1
        raw = data.tobytes()
        literals = self._literals(raw, offsets)
        bounds = np.unique(np.concatenate((offsets, literals[:, 0], literals[:, 1])))
        starts, ends = pieces(data, bounds)
        if len(literals):
            within = np.searchsorted(literals[:, 0], starts, "right") - 1
            plain = (within < 0) | (starts >= literals[within, 1])
            starts, ends = starts[plain], ends[plain]
        at, size = self._plain(data, raw, starts, ends)
        if len(literals):
            here = np.searchsorted(starts, literals[:, 0])
            starts, at, size = np.insert(starts, here, literals[:, 0]), np.insert(at, here, literals[:, 2]), np.insert(size, here, 1)
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(rows + 1, np.int64)
        total = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
        return self.arena[K.ragged(at, size)], total[np.searchsorted(starts, offsets)]

    def _literals(self, raw: bytes, offsets: np.ndarray) -> np.ndarray:
        """Start, end and place in the arena of every literal inside a text."""
        found = []
        if self.literal is not None and self.literal.search(raw):
            place = {x: i for i, x in enumerate(self.added)}
            found = [(*m.span(), place[m[0]]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) for m in self.literal.finditer(raw, a, b)]
        return np.array(found, np.int64).reshape(-1, 3)

    def _plain(self, data: np.ndarray, raw: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in the arena and number of ids of every piece."""
        if not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        raw = raw.lower()  # of bytes: A-Z alone
        hashes, sample, which = np.unique(K.span_hashes(data, starts, ends, K.byte_codes(lower=True)), return_index=True, return_inverse=True)
        slots = self._slots(hashes, raw, starts[sample], ends[sample])
        return self.at[slots][which], self.size[slots][which]


@functools.cache
def word_ids(path: str, added: bool = False) -> WordIds:
    return WordIds(path, added)


def stage_ids(documents: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> DataFrame:
    """id, n_tokens, ids, counts: the ids of each text with ``end_id`` behind, as little-endian 16-bit integers.

    ``counts`` has, in the first row of each block of rows, the ids of the block and how often each occurs.
    """
    K.prepare(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer, added_tokens)
        for batch in batches:
            for block in K.blocks(batch, "text", BLOCK_BYTES):
                ids, bounds = words.encode(*K.text_buffer(block.column("text")))
                rows = np.arange(1, len(bounds))
                ids = np.insert(ids, bounds[1:], np.uint16(end_id))
                bounds[1:] += rows
                sums = np.bincount(ids, minlength=1)
                some = np.flatnonzero(sums)
                counts = K.binaries([np.stack((some, sums[some])).tobytes()] + [None] * (block.num_rows - 1))
                yield pa.RecordBatch.from_arrays([block.column("id"), pa.array(np.diff(bounds)), K.packed(ids, bounds), counts], ["id", "n_tokens", "ids", "counts"])

    source = documents.select(documents[id_col].cast("long").alias("id"), documents[text_col].alias("text"))
    return source.mapInArrow(run, "id long, n_tokens long, ids binary, counts binary")


def id_counts(staged: DataFrame) -> dict[int, int]:
    """Global count of every id; at most a vocabulary of rows reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for raw in batch["counts"]:
                ids, counts = np.frombuffer(raw.as_buffer(), np.int64).reshape(2, -1)
                sums[ids] += counts
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sums[some])], ["token", "n"])

    rows = staged.select("counts").filter("counts is not null").mapInArrow(run, "token int, n long").groupBy("token").agg(F.sum("n").alias("n")).collect()
    return {r.token: r.n for r in rows}


def code_lengths(counts: dict[int, int], limit: int = LIMIT) -> dict[int, int]:
    """Optimal prefix-code lengths of at most ``limit`` bits, by package-merge."""
    if len(counts) <= 1:
        return {t: 1 for t in counts}
    if len(counts) > 1 << limit:
        raise ValueError(f"{len(counts)} ids don't fit codes of {limit} bits")
    order = sorted(counts, key=lambda t: (counts[t], t))
    leaves = np.array([counts[t] for t in order], np.float64)
    n = len(leaves)
    # a level's list: leaves and packages of the level before, by weight; only the number of leaves among the first m matters
    weights, is_leaf = leaves, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = weights[:len(weights) // 2 * 2].reshape(-1, 2).sum(1)
        merged = np.concatenate((leaves, pairs))
        rank = np.argsort(merged, kind="stable")
        weights = merged[rank]
        is_leaf.append(rank < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for level in reversed(is_leaf):
        own = int(np.count_nonzero(level[:take]))
        lengths[:own] += 1
        take = 2 * (take - own)
    return {t: int(x) for t, x in zip(order, lengths, strict=True)}


class Canonical:
    """Codes in the order of (length, id); encoder and decoder tables from the lengths alone."""

    def __init__(self, lengths: dict[int, int]):
        order = sorted(lengths, key=lambda t: (lengths[t], t))
        self.code, self.length = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.width = max(lengths.values(), default=1)
        symbol, size = np.zeros(1 << self.width, np.uint16), np.ones(1 << self.width, np.uint8)
        code, last = 0, 0
        for t in order:
            n = lengths[t]
            code <<= n - last
            last = n
            self.code[t], self.length[t] = code, n
            a = code << (self.width - n)
            symbol[a:a + (1 << (self.width - n))] = t
            size[a:a + (1 << (self.width - n))] = n
            code += 1
        self.symbol, self.size = symbol, size

    def pack(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Bits of all ids, and the bit offset of every STRIDE-th one."""
        length = self.length[ids]
        ends = np.cumsum(length)
        first = ends - length
        checkpoints = first[::STRIDE]
        # each code falls into at most two 32-bit words; codes have no bit in common, so sums of words are their union
        word, shift = first >> 5, (first & 31)
        wide = self.code[ids].astype(np.uint64) << (np.uint64(64) - (shift + length).astype(np.uint64))
        total = int(ends[-1]) if len(ids) else 0
        out = np.zeros((total + 31) // 32 + 2, np.uint64)
        heads = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1]))) if len(ids) else np.zeros(0, np.int64)
        if len(ids):
            out[word[heads]] += np.add.reduceat(wide >> np.uint64(32), heads)
            out[word[heads] + 1] += np.add.reduceat(wide & np.uint64(0xFFFFFFFF), heads)
        return out[:(total + 31) // 32].astype(">u4").tobytes(), checkpoints

    def unpack(self, bits: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """Decode every lane between two checkpoints at once."""
        words = np.concatenate((np.frombuffer(bits, ">u4").astype(np.uint64), np.zeros(2, np.uint64)))
        pair = (words[:-1] << np.uint64(32)) | words[1:]
        out = np.empty((STRIDE, len(checkpoints)), np.uint16)
        at = checkpoints.astype(np.int64)
        top, mask = 64 - self.width, np.uint64((1 << self.width) - 1)
        end = 32 * (len(pair) - 1)
        for i in range(STRIDE):
            np.minimum(at, end, out=at)  # the last lane may run past its ids
            look = (pair[at >> 5] >> (top - (at & 31)).astype(np.uint64)) & mask
            out[i] = self.symbol[look]
            at += self.size[look]
        return np.ascontiguousarray(out.T).ravel()[:n]


def write_blocks(staged: DataFrame, path: str, lengths: dict[int, int]) -> None:
    """Write the blocks of ``staged`` in ascending id order, and the code, below ``path``."""
    spark = staged.sparkSession
    spark.createDataFrame(sorted(lengths.items()), "token int, length int").coalesce(1).write.mode("overwrite").parquet(f"{path}/code")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part = Canonical(lengths), TaskContext.get().partitionId()
        block, ids, sizes, names, held = 0, [], [], [], 0

        def emit() -> pa.RecordBatch:
            flat = np.concatenate(ids)
            bits, checkpoints = code.pack(flat)
            row = (MAGIC, VERSION, part, block, len(flat), np.array(names, np.int64).tobytes(), np.array(sizes, np.int64).tobytes(), checkpoints.astype(np.int64).tobytes(), bits)
            return pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, row, strict=True))], schema=SCHEMA)

        for batch in batches:
            for one, raw in zip(batch["id"].to_pylist(), batch["ids"], strict=True):
                own = np.frombuffer(raw.as_buffer(), np.uint16)
                names.append(NULL_ID if one is None else one)
                sizes.append(len(own))
                ids.append(own)
                held += len(own)
                if held >= BLOCK_IDS:
                    yield emit()
                    block, ids, sizes, names, held = block + 1, [], [], [], 0
        if names:
            yield emit()

    ordered = staged.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), F.crc32("ids"), "ids")
    (ordered.select("id", "ids").mapInArrow(run, "magic string, version int, part int, block int, n long, row_ids binary, row_sizes binary, checkpoints binary, bits binary")
     .write.mode("overwrite").option("compression", "uncompressed").parquet(f"{path}/blocks"))


#: Stands for a null id within a block.
NULL_ID = -(1 << 63)
SCHEMA = pa.schema([("magic", pa.string()), ("version", pa.int32()), ("part", pa.int32()), ("block", pa.int32()), ("n", pa.int64()),
                    ("row_ids", pa.binary()), ("row_sizes", pa.binary()), ("checkpoints", pa.binary()), ("bits", pa.binary())])


def read_blocks(spark: SparkSession, path: str, crc32: bool = False) -> DataFrame:
    """id, start, n_tokens, ids (16-bit little-endian) of every row, decoded from the files below ``path``.

    With ``crc32`` the ids' place takes ids_crc32, the unsigned crc32 of the ids as little-endian unsigned 32-bit integers.
    """
    K.prepare(spark)
    lengths = {r.token: r.length for r in spark.read.parquet(f"{path}/code").collect()}  # a vocabulary at most
    stored = spark.read.parquet(f"{path}/blocks")
    # running sums: of whole parts, then of the blocks inside a part
    parts = {r.part: r.n for r in stored.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # one number per written partition
    before, total = {}, 0
    for part in sorted(parts):
        before[part], total = total, total + parts[part]
    sizes = stored.select("part", "block", "n")
    inside = sizes.select("part", "block", (F.sum("n").over(Window.partitionBy("part").orderBy("block")) - F.col("n")).alias("inside"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Canonical(lengths)
        for batch in batches:
            for row in batch.to_pylist():
                if (row["magic"], row["version"]) != (MAGIC, VERSION):
                    raise ValueError("not a token block of this version")
                ids = code.unpack(row["bits"], np.frombuffer(row["checkpoints"], np.int64), row["n"])
                names, size = np.frombuffer(row["row_ids"], np.int64), np.frombuffer(row["row_sizes"], np.int64)
                bounds = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
                first = before[row["part"]] + row["inside"]
                if crc32:
                    wide = memoryview(ids.astype("<u4")).cast("B")
                    last = pa.array([zlib.crc32(wide[4 * a:4 * b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)], pa.int64())
                else:
                    last = K.packed(ids, bounds)
                yield pa.RecordBatch.from_arrays([pa.array(names, mask=names == NULL_ID), pa.array(first + bounds[:-1]), pa.array(size), last], ["id", "start", "n_tokens", out])

    out, kind = ("ids_crc32", "long") if crc32 else ("ids", "binary")
    return stored.join(inside, ["part", "block"]).mapInArrow(run, f"id long, start long, n_tokens long, {out} {kind}")


def write_token_files(documents: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", added_tokens: bool = False) -> None:
    """Encode all texts and write their files below ``path``; the staging table goes beside them."""
    spark = documents.sparkSession
    stage_ids(documents, tokenizer, end_id, id_col, text_col, added_tokens).write.mode("overwrite").parquet(f"{path}/staged")
    staged = spark.read.parquet(f"{path}/staged")
    write_blocks(staged, path, code_lengths(id_counts(staged)))


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path in the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

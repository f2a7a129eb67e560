"""Byte-level BPE encoding and decoding without a regular expression engine.

Pre-tokenisation is a finite automaton over codepoint classes.  Each character
is a function from state to state; functions compose associatively, so a text
block is cut into lanes, every lane composes its own characters for all states
at once, the lane functions are scanned, and a last pass reads off where tokens
start.  The slices are looked up in a cache of merged pieces; only new pieces
run the pair merging, all of a block side by side.  Byte offsets of the tokens are kept for decoding.

Defined results: null and empty texts have no token; a text that isn't valid
UTF-8 is read with U+FFFD in place of its invalid bytes, as any Python string
would be.  Rows, repeated or not, are encoded one by one; an empty table gives
an empty result.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brickyard.llm import textkit as K

#: Lane length of the automaton scan.
LANE = 256
#: Pieces that a worker remembers, and the longest piece that it remembers.
CACHE_PIECES, CACHE_BYTES = 500_000, 64
#: Pieces above this many bytes merge through a heap.
SCAN_BYTES = 512
_NONE = np.iinfo(np.int64).max

# character classes
LETTER, NUMBER, OTHER, SPACE = 0, 1, 2, 3
# symbols: a class with what is needed of the characters after it
S_LETTER, S_NUMBER, S_OTHER, S_QUOTE1, S_QUOTE2, S_LEAD, S_LAST, S_WHITE = range(8)
# states: what the text so far ends with
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_LEAD, IN_WHITE, NEED_1, NEED_2 = range(8)


@functools.cache
def class_table() -> np.ndarray:
    """Class of every codepoint by its Unicode general category."""
    table = np.full(0x110000, OTHER, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            table[c] = LETTER
        elif kind == "N":
            table[c] = NUMBER
    # The codepoints with the White_Space property
    table[[*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = SPACE
    return table


@functools.cache
def automaton() -> tuple[np.ndarray, np.ndarray]:
    """next state and token start, by 8 * symbol + state; symbols from 8 on open a text."""
    step, start = np.zeros((16, 8), np.uint8), np.zeros((16, 8), bool)
    run = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHERS}
    for state in range(8):
        for symbol, inside in run.items():
            step[symbol, state], start[symbol, state] = inside, state not in (inside, AFTER_LEAD)
        for symbol, need in ((S_QUOTE1, NEED_1), (S_QUOTE2, NEED_2)):
            plain = state in (IN_OTHERS, AFTER_LEAD)
            step[symbol, state], start[symbol, state] = (IN_OTHERS, False) if plain else (need, True)
        step[S_LEAD, state], start[S_LEAD, state] = AFTER_LEAD, True
        step[S_LAST, state], start[S_LAST, state] = FRESH, True
        step[S_WHITE, state], start[S_WHITE, state] = IN_WHITE, state != IN_WHITE
    step[S_LETTER, NEED_1], start[S_LETTER, NEED_1] = FRESH, False
    step[S_LETTER, NEED_2], start[S_LETTER, NEED_2] = NEED_1, False
    step[8:], start[8:] = step[:8, FRESH][:, None], True
    return step.ravel(), start.ravel()


def symbols(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Symbol of each codepoint; ``heads`` are the positions where texts begin."""
    kind = class_table()[points]
    after = np.empty(len(points) + 2, np.uint8)
    after[:len(points)], after[len(points):] = kind, SPACE
    later = np.zeros(len(points) + 2, np.uint32)
    later[:len(points)] = points
    first = np.zeros(len(points) + 2, bool)
    first[heads] = True
    first[len(points):] = True
    follows = ~first[1:-1] & (after[1:-1] != SPACE)  # a character that isn't white space comes next in the text
    out = kind.copy()
    white = kind == SPACE
    out[white] = S_WHITE
    out[white & follows] = S_LAST
    out[white & follows & (points == 32)] = S_LEAD
    quote = np.flatnonzero(points == 39)
    one, two = later[quote + 1], later[quote + 2]
    in_text = ~first[quote + 1]
    # The contractions 's 't 'm 'd and 're 've 'll
    out[quote[in_text & np.isin(one, [115, 116, 109, 100])]] = S_QUOTE1
    pair = in_text & ~first[quote + 2] & (((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108))
    out[quote[pair]] = S_QUOTE2
    out[heads] += 8
    return out


def token_starts(sym: np.ndarray) -> np.ndarray:
    """Mask of the characters at which a token starts, by an associative scan of transition functions."""
    step, start = automaton()
    n = len(sym)
    lanes = max(1, -(-n // LANE))
    padded = np.full(lanes * LANE, S_WHITE, np.uint8)
    padded[:n] = sym
    by_step = np.ascontiguousarray(padded.reshape(lanes, LANE).T).astype(np.intp) * 8
    whole = np.repeat(np.arange(8, dtype=np.uint8)[:, None], lanes, 1)
    for row in by_step:
        whole = step[row + whole]
    # inclusive scan of the lane functions: whole[s, i] becomes the state after lane i when lane 0 begins in s
    jump, column = 1, np.arange(lanes)
    while jump < lanes:
        whole[:, jump:] = whole[whole[:, :-jump], column[None, jump:]].astype(np.uint8)
        jump *= 2
    state = np.empty(lanes, np.uint8)
    state[0], state[1:] = FRESH, whole[FRESH, :-1]
    marks = np.empty((LANE, lanes), bool)
    for i, row in enumerate(by_step):
        at = row + state
        marks[i] = start[at]
        state = step[at]
    return np.ascontiguousarray(marks.T).ravel()[:n]


class BytePairs:
    """Encoder and decoder over a rank file (base64 token, rank)."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.token = {rank: piece for piece, rank in self.ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.token}
        self.byte_rank = np.array([self.ranks.get(bytes([b]), _NONE) for b in range(256)], np.int64)
        pairs = {(ranks[p[:i]] << 20) | ranks[p[i:]]: r for ranks in [self.ranks] for p, r in ranks.items() for i in range(1, len(p)) if p[:i] in ranks and p[i:] in ranks}
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.used = 0
        self.arena = np.zeros(1 << 16, np.uint32)
        self.slots = 0
        self.at, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 20) | right
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_rank[at], _NONE)

    def merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and how many each has: in every round each unfinished
        piece merges its lowest-ranked neighbouring pair, the leftmost of equals."""
        sizes = np.array([len(p) for p in pieces], np.int64)
        token = self.byte_rank[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), sizes)
        rank = np.full(len(token), _NONE)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self._pair_ranks(token[inner], token[inner + 1])
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(token):
            heads = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            low = np.repeat(np.minimum.reduceat(rank, heads), np.diff(np.append(heads, len(owner))))
            ended = low == _NONE
            if ended.any():
                done.append((owner[ended], token[ended]))
                going = ~ended
                token, owner, rank, low = token[going], owner[going], rank[going], low[going]
                if not len(token):
                    break
            hits = np.flatnonzero(rank == low)
            hits = hits[np.concatenate(([True], owner[hits][1:] != owner[hits][:-1]))]
            token[hits] = rank[hits]
            stay = np.ones(len(token), bool)
            stay[hits + 1] = False
            token, owner, rank = token[stay], owner[stay], rank[stay]
            hits = hits - np.arange(len(hits))
            rank[hits] = _NONE
            for at in (hits, hits - 1):
                at = at[(at >= 0) & (at + 1 < len(token))]
                at = at[owner[at] == owner[at + 1]]
                rank[at] = self._pair_ranks(token[at], token[at + 1])
        owner, token = (np.concatenate([d[j] for d in done]) for j in (0, 1))
        return token[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(pieces))

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same order of merges in n log n: a heap of (rank, position), stale entries skipped."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that begins at i; 0 once it is merged away
        before = list(range(-1, n - 1))

        def rank(i: int) -> int | None:
            j = end[i]
            return ranks.get(piece[i:end[j]]) if j < n else None

        heap = [(r, i) for i in range(n) if (r := rank(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if not end[i] or rank(i) != r:
                continue
            j = end[i]
            end[i], end[j] = end[j], 0
            if end[i] < n:
                before[end[i]] = i
            for k in (i, before[i]):
                if k >= 0 and (r := rank(k)) is not None:
                    heapq.heappush(heap, (r, k))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i:end[i]]])
            i = end[i]
        return out

    def _slots(self, pieces: list[bytes]) -> np.ndarray:
        known = self.known
        out = [known.get(p, -1) for p in pieces]
        missing = [i for i, slot in enumerate(out) if slot < 0]
        short = [i for i in missing if len(pieces[i]) <= SCAN_BYTES]
        if short:
            self._learn([pieces[i] for i in short], *self.merge([pieces[i] for i in short]))
        for i in missing:
            if len(pieces[i]) > SCAN_BYTES:
                ids = self._merge_long(pieces[i])
                self._learn([pieces[i]], np.array(ids, np.int64), np.array([len(ids)]))
        for i in missing:
            out[i] = known[pieces[i]]
            if len(pieces[i]) > CACHE_BYTES:
                del known[pieces[i]]
        return np.array(out, np.int64)

    def _learn(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        while self.used + len(ids) > len(self.arena):
            self.arena = np.concatenate((self.arena, np.zeros_like(self.arena)))
        while self.slots + len(pieces) > len(self.at):
            self.at, self.size = (np.concatenate((x, np.zeros_like(x))) for x in (self.at, self.size))
        self.arena[self.used:self.used + len(ids)] = ids
        new = slice(self.slots, self.slots + len(pieces))
        self.size[new] = sizes
        self.at[new] = self.used + np.cumsum(sizes) - sizes
        self.known.update(zip(pieces, range(new.start, new.stop), strict=True))
        self.used += len(ids)
        self.slots = new.stop

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all rows, one row after another, and the row bounds."""
        if self.slots > CACHE_PIECES:
            self._forget()
        rows = len(offsets) - 1
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(rows + 1, np.int64)
        raw = data.tobytes()
        points = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        width = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        first = np.concatenate((np.zeros(1, np.int64), np.cumsum(width)))
        heads = np.searchsorted(first, offsets[:-1][np.diff(offsets) > 0])
        starts = first[np.flatnonzero(token_starts(symbols(points, heads)))]
        ends = np.append(starts[1:], len(data))
        _, sample, which = np.unique(K.span_hashes(data, starts, ends, K.byte_codes(lower=False)), return_index=True, return_inverse=True)
        slots = self._slots([raw[a:b] for a, b in zip(starts[sample].tolist(), ends[sample].tolist(), strict=True)])
        at, size = self.at[slots][which], self.size[slots][which]
        ids = self.arena[K.ragged(at, size)]
        total = np.concatenate((np.zeros(1, np.int64), np.cumsum(size)))
        return ids, total[np.searchsorted(starts, offsets)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@functools.cache
def encoder(path: str) -> BytePairs:
    return BytePairs(path)


def _valid(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = K.text_buffer(column)
    try:
        data.tobytes().decode("utf-8")
    except UnicodeDecodeError:
        raw = data.tobytes()
        fixed = [raw[a:b].decode("utf-8", "replace").encode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
        data, offsets = np.frombuffer(b"".join(fixed), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in fixed]))).astype(np.int64)
    return data, offsets


def encode_texts(documents: DataFrame, rank_file: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False) -> DataFrame:
    """id, token_ids array<int> and, on request, token_ends array<int>: the byte at which each token ends."""
    K.prepare(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(rank_file)
        lengths = np.zeros(max(bpe.token) + 1, np.int64)
        for rank, piece in bpe.token.items():
            lengths[rank] = len(piece)
        for batch in batches:
            for block in K.blocks(batch, "text"):
                ids, bounds = bpe.encode(*_valid(block.column("text")))
                columns = [block.column("id"), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32)))]
                if offsets:
                    ends = np.cumsum(lengths[ids])
                    before = np.concatenate((np.zeros(1, np.int64), ends))[bounds[:-1]]
                    ends -= np.repeat(before, np.diff(bounds))
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ends.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["id", "token_ids", "token_ends"][:len(columns)])

    source = documents.select(documents[id_col].cast("long").alias("id"), documents[text_col].alias("text"))
    return source.mapInArrow(run, "id long, token_ids array<int>" + ", token_ends array<int>" * offsets)


def decode_ids(tokens: DataFrame, rank_file: str) -> DataFrame:
    """id, text: the bytes of ``token_ids`` joined (read as UTF-8, U+FFFD for what is invalid)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(rank_file)
        for batch in batches:
            texts = [bpe.decode(x or []).decode("utf-8", "replace") for x in batch["token_ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["id"], pa.array(texts, pa.string())], ["id", "text"])

    return tokens.select("id", "token_ids").mapInArrow(run, "id long, text string")


def encode_digests(documents: DataFrame, rank_file: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 (and token_ids on request) of every text, encoded and decoded again."""
    K.prepare(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(rank_file)
        for batch in batches:
            for block in K.blocks(batch, "text"):
                ids, bounds = bpe.encode(*_valid(block.column("text")))
                own, back = [], []
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    one = ids[a:b].tolist()
                    own.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, one)).encode()).hexdigest())
                    back.append(hashlib.sha256(bpe.decode(one)).hexdigest())
                columns = [block.column("id"), pa.array(np.diff(bounds)), pa.array(own, pa.string()), pa.array(back, pa.string())]
                if keep_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids.view(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids_sha256", "decoded_sha256", "token_ids"][:len(columns)])

    source = documents.select(documents[id_col].cast("long").alias("id"), documents[text_col].alias("text"))
    return source.mapInArrow(run, "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * keep_ids)

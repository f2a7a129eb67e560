"""Operators 11, 12 and 13 against brute force; nulls, ties, repeated rows, empty tables and hot groups."""

import collections
import math
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from brickyard.llm import phrases, ranked, simhash
from brickyard.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, score long, term string, fingerprint int, cell int, rank int"


def docs_of(spark, rows):
    """Rows (id, text, lang) with columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, la, 1, "clash", 1, 1, 1) for i, t, la in rows], DOC)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- 11: phrases

def brute_phrases(rows, least=10, top=2000, cover=50):
    total, counts = collections.Counter(), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, tuple(words[i:i + n])) for n in (1, 2, 3) for i in range(len(words) - n + 1))
    often = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    out = collections.defaultdict(list)
    for (lang, g), a in often.items():
        longer = [b for (x, h), b in often.items() if x == lang and len(h) > len(g) and any(h[i:i + len(g)] == g for i in range(len(h)))]
        if any(100 * b >= cover * a for b in longer):
            continue
        cuts = [(1000000 * a * a // (counts[lang, g[:k]] * counts[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]]))
    return {(lang, i + 1, p.decode(), -a, le, r, total[lang], -s) for lang, found in out.items() for i, (s, a, p, le, r) in enumerate(sorted(found)[:top])}


def phrase_rows(frame):
    return {tuple(r) for r in frame.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def prose(seed, n, langs=("en", "de", None), words=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(6)] + ["Über", "naïve", "x"]
    line = lambda: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "; "]) for _ in range(words))
    return [(i, line(), rng.choice(langs)) for i in range(n)]


def test_phrases_equal_brute_force(spark):
    rows = prose(3, 200) + [(900, None, "en"), (901, "", "fr"), (902, " .,;", "en"), (903, "New York is big. " * 12, "en"), (904, "w1 w2", "und")]
    rows += [(905, "same row here", "de")] * 15
    got = phrase_rows(phrases.collocations(docs_of(spark, rows)))
    assert got == brute_phrases(rows) and len(got) > 30


@pytest.mark.parametrize("counters, group_bytes", [(8, 500), (64, 2000), (1 << 20, 1 << 20)])
def test_phrases_do_not_depend_on_summaries_and_groups(spark, counters, group_bytes):
    rows = prose(5, 60, words=30)
    got = phrase_rows(phrases.collocations(docs_of(spark, rows), least=6, top=25, counters=counters, group_bytes=group_bytes))
    assert got == brute_phrases(rows, least=6, top=25)


def test_phrase_ranks_break_ties_by_bytes(spark):
    rows = [(i, f"{w}a {w}b", "en") for i in range(10) for w in "zéaZ~"]
    got = sorted(phrase_rows(phrases.collocations(docs_of(spark, rows), top=3)), key=lambda r: r[1])
    assert got == sorted(brute_phrases(rows, top=3), key=lambda r: r[1])
    # z and Z are one word after lower-casing, counted 20 times
    assert [r[2] for r in got] == ["za zb", "aa ab", "~a ~b"]


def test_phrases_of_nothing(spark):
    assert phrase_rows(phrases.collocations(docs_of(spark, []))) == set()
    assert phrase_rows(phrases.collocations(docs_of(spark, [(1, None, None), (2, "a b", "en")]))) == set()


def test_one_very_long_text_and_exact_products(spark):
    rows = [(1, "aa bb " * 200_000, "en")]
    got = phrase_rows(phrases.collocations(docs_of(spark, rows)))
    assert got == brute_phrases(rows) and got
    wide = spark.range(1).select(phrases._score(F.lit(3_000_000_000_000), F.lit(4_000_000_000_001), F.lit(5_000_000_000_003)).alias("s"))
    assert wide.first().s == 1000000 * 3_000_000_000_000 ** 2 // (4_000_000_000_001 * 5_000_000_000_003)


def test_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(1)
    for trial in range(20):
        stream = np.concatenate([rng.integers(0, 4000, 6000), np.repeat(rng.integers(5000, 5040, 12), 10)]).astype(np.uint64)
        rng.shuffle(stream)
        mass, least = len(stream), 10
        parts = []
        for piece in np.array_split(stream, 7):
            one = phrases.Summary(least, mass // least + 1)
            one.merge(*np.unique(piece, return_counts=True))
            parts.append(one)
        whole = phrases.Summary(least, mass // least + 1)
        for one in parts:
            whole.merge(one.keys, one.counts, one.off)
        keys, counts = np.unique(stream, return_counts=True)
        assert set(keys[counts >= least]) <= set(whole.keys) and whole.off < least
        assert whole.capacity == mass // least + 1 and len(whole.keys) <= whole.capacity  # no doubling at this capacity
        small = phrases.Summary(least, 16)
        for piece in np.array_split(stream, 30):
            small.merge(*np.unique(piece, return_counts=True))
        assert set(keys[counts >= least]) <= set(small.survivors()) <= set(small.keys) and small.off < least


# ---- 12: fingerprints

def slow_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def brute_prints(rows, near=2):
    prints = [slow_print(t) for _, t, _ in rows]
    label = list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= near:
                label[top(i)] = top(j)
    least = {}
    for i, (one, _, _) in enumerate(rows):
        if one is not None:
            least[top(i)] = min(one, least.get(top(i), one))
    return sorted(((one, f"{p:016x}", least.get(top(i))) for i, ((one, _, _), p) in enumerate(zip(rows, prints))), key=str)


def variants(seed, n):
    rng = random.Random(seed)
    rows = []
    for family in range(n):
        words = [f"v{rng.randrange(400)}" for _ in range(rng.choice([4, 60, 300]))]
        for _ in range(rng.randrange(1, 7)):
            own = list(words)
            for _ in range(rng.randrange(3)):
                own[rng.randrange(len(own))] = f"v{rng.randrange(400)}"
            rows.append((len(rows), " ".join(own), "en"))
    return rows


def print_rows(frame):
    return sorted(((r.id, r.fingerprint, r.component_id) for r in frame.collect()), key=str)


@pytest.mark.parametrize("cell, block", [(2048, 4096), (4, 4096), (1000, 7), (2, 3)])
def test_prints_equal_brute_force(spark, cell, block):
    rows = variants(11, 40) + [(500, None, "en"), (501, "", "en"), (502, " \t", None), (503, "Two words", "en"), (504, "two  WORDS", "en"), (505, "ÄÖ", "en")]
    rows += [(506, "a b c", "en")] * 3 + [(None, "a b c", "en"), (None, "alone in its class", "en")]
    got = print_rows(simhash.simhash_components(docs_of(spark, rows), cell=cell, block=block))
    assert got == brute_prints(rows)


def test_prints_of_an_empty_table(spark):
    assert simhash.simhash_components(docs_of(spark, [])).count() == 0


def test_pairs_by_distance_tables_lose_none():
    rng = np.random.default_rng(4)
    heads = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (40, 30), dtype=np.uint64)) | (np.uint64(1) << rng.integers(0, 64, (40, 30), dtype=np.uint64))
    prints = np.unique(np.concatenate([heads, (heads[:, None] ^ flips).ravel()]))
    table = np.bitwise_count(prints[:, None] ^ simhash.PIVOTS[None, :]).astype(np.uint8)
    want = {(i, j) for i in range(len(prints)) for j in range(i) if int(prints[i] ^ prints[j]).bit_count() <= 2}
    got = {(max(i, j), min(i, j)) for a, b in simhash.close_pairs((prints, table), None, 2) for i, j in zip(a.tolist(), b.tolist())}
    assert got == want
    half = len(prints) // 2
    across = {(i + half, j) for a, b in simhash.close_pairs((prints[:half], table[:half]), (prints[half:], table[half:]), 2) for j, i in zip(a.tolist(), b.tolist())}
    assert across == {(i, j) for i, j in want if i >= half > j}


def test_reference_fingerprints_are_far_apart():
    apart = np.bitwise_count(simhash.PIVOTS[:, None] ^ simhash.PIVOTS[None, :])
    assert (apart[~np.eye(64, dtype=bool)] == 32).all()


def test_long_texts_are_counted_whole(monkeypatch):
    text = " ".join(f"w{i % 977}" for i in range(5000))
    whole = simhash.simhash(text.encode())
    monkeypatch.setattr(simhash, "HASHES", 64)
    assert simhash.simhash(text.encode()) == whole == slow_print(text)


# ---- 13: ranked search

def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low(text))


def brute_ranks(rows, items, top=50):
    counts = [(one, collections.Counter(terms_of(t))) for one, t, _ in rows]
    counts = [(one, c) for one, c in counts if c]
    docs, total = len(counts), sum(sum(c.values()) for _, c in counts)
    df = collections.Counter(w for _, c in counts for w in c)
    asked = collections.defaultdict(set)
    for item, text in items:
        asked[item].update(terms_of(text))
    out = []
    for item, words in asked.items():
        scored = []
        for one, c in counts:
            m = 50 + 50 * sum(c.values()) * docs // total
            score = sum(math.floor(1000 * math.log((2 * docs + 2) / (2 * df[w] + 1))) * (10 ** 9 * c[w] // (1000 * c[w] + 20 * m)) for w in words if c[w])
            if score > 0:
                scored.append((-score, one is not None, one or 0, one))
        out.extend((item, i + 1, one, -score) for i, (score, _, _, one) in enumerate(sorted(scored)[:top]))
    return sorted(out, key=str)


def rank_rows(frame):
    return sorted(((r["item"], r["rank"], r.id, r.score) for r in frame.collect()), key=str)


def letters(seed, n, size):
    rng = random.Random(seed)
    return [(i, " ".join(f"t{int(rng.paretovariate(0.6)) % 80}" for _ in range(rng.randrange(1, size))) + rng.choice(["", ".", " É1", "_t3-t4"]), "en") for i in range(n)]


@pytest.mark.parametrize("bound, pairs, part", [(1 << 20, 1 << 19, 8192), (1, 1 << 19, 4), (1 << 20, 7, 3)])
def test_ranks_equal_brute_force(spark, tmp_path, monkeypatch, bound, pairs, part):
    rows = letters(2, 150, 25) + [(900, None, "en"), (901, "", "en"), (902, "._-", None), (903, "t5 t5 T5", "en"), (903, "t5 t5 T5", "en"), (None, "t5 t5 t5", "en")]
    rows += [(1000 + i, "copied text t7 t9", "en") for i in range(70)]
    items = [(1, "t1 t2 T3 t3"), (2, None), (3, ""), (4, "unknown"), (5, "t5"), (6, "copied"), (6, "t7 É1"), (None, "t9 t11"), (7, "t0 t1 t2 t3 t4 t5 t6 t7 t8 t9")]
    asked = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, score int, term string")
    got = rank_rows(ranked.ranked_search(docs_of(spark, rows), asked, str(tmp_path / "index"), vocabulary_bound=bound, block_pairs=pairs, part_rows=part))
    assert got == brute_ranks(rows, items)
    assert sum(r[0] == 6 for r in got) == 50


def test_ranks_of_nothing(spark, tmp_path):
    items = spark.createDataFrame([("a", "t1")], "item_id string, text string")
    assert ranked.ranked_search(docs_of(spark, []), items, str(tmp_path / "a")).count() == 0
    assert ranked.ranked_search(docs_of(spark, [(1, "t1", "en")]), items.limit(0), str(tmp_path / "b")).count() == 0
    assert rank_rows(ranked.ranked_search(docs_of(spark, [(1, "t1", "en"), (2, "t2", "en")]), items, str(tmp_path / "c")))[0][:3] == ("a", 1, 1)


def test_visits_by_bounds_change_no_rank_and_leave_parts_out(spark, tmp_path):
    rows = letters(8, 400, 60)
    items = spark.createDataFrame([(1, "t3 t9 t17"), (2, "t40 t2")], "item_id long, text string")
    path = str(tmp_path / "x")
    ranked.ranked_search(docs_of(spark, rows), items, path, part_rows=5)
    parts = [r.asDict() for r in spark.read.parquet(f"{path}/index").collect()]
    words = sorted({w for _, t, _ in rows for w in terms_of(t)} & {"t3", "t9", "t17"})
    data = np.frombuffer("".join(words).encode(), np.uint8)
    bounds = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    hashes = np.sort(ranked.K.span_hashes(data, bounds[:-1], bounds[1:], ranked.K.byte_codes(lower=True)))
    chunk = ranked.Chunk(parts, hashes)
    place, weight, none = np.arange(len(hashes)), np.array([3000, 2000, 1000])[:len(hashes)], np.zeros(0, np.int64)
    every = chunk.best(place, weight, 10, none, none, first_rows=1 << 40)
    step = chunk.best(place, weight, 10, none, none, first_rows=1)
    assert all((a == b).all() for a, b in zip(every, step))
    met = []
    chunk.docs = type("Seen", (), {"__getitem__": lambda self, at, own=chunk.docs: met.append(len(at)) or own[at]})()
    chunk.best(place, weight, 10, none, none, first_rows=1)
    assert sum(met) < len(parts) * 5


@pytest.mark.parametrize("name, key, rows", [("op11_phrase_collocations", ["lang", "rank"], None), ("op12_simhash_near_dedup", ["doc_id"], 200), ("op13_ranked_search", ["item_id", "rank"], None)])
def test_queries_run_over_whole_tables(spark, name, key, rows):
    found = QUERIES[name](spark, SF)
    assert found.count() == found.select(*key).distinct().count() > 0
    assert rows is None or found.count() == table(spark, SF, "documents").count() == rows

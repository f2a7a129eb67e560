"""Operators 3, 5, 6, 9, 10 and the pipeline against brute force, ties, nulls and repeated rows."""

import base64
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brickyard.llm import ann, ngram_join, warc
from brickyard.llm.ann import search
from brickyard.llm.decontam import contamination, match_windows
from brickyard.llm.graph import connected_components
from brickyard.llm.queries import QUERIES, SHARDS, table
from brickyard.llm.sharding import shard_rows

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, id string, n int"


def docs_of(spark, pairs):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in pairs], DOC)


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- 3: Jaccard join

def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", low(text))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(texts, near=75, of=100):
    sets = {i: shingles(t) for i, t in texts.items()}
    above = {i: i for i in texts}

    def top(i):
        while above[i] != i:
            i = above[i]
        return i

    ids = sorted(i for i in texts if sets[i])
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            same = len(sets[a] & sets[b])
            if of * same >= near * (len(sets[a]) + len(sets[b]) - same):
                u, v = top(a), top(b)
                above[max(u, v)] = min(u, v)
    return {i: (len(sets[i]), top(i)) for i in texts}


def near_copies(seed, groups=12, words=60):
    rng, texts = random.Random(seed), {}
    for g in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(words)]
        for _ in range(rng.randrange(1, 14)):
            own = [f"e{rng.randrange(60)}" if rng.random() < 0.03 else w for w in base]
            texts[len(texts)] = " ".join(own[:rng.randrange(45, words + 1)])
    texts |= {len(texts) + i: t for i, t in enumerate(["", None, " \t", "one two", "ONE  two", "one two three", "a b c d e", "a b c d e a b c d e", "É a b c d", "é a b c d"])}
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed, monkeypatch):
    if seed == 2:  # force groups through several blocks
        monkeypatch.setattr(ngram_join, "TREE_SHINGLES", 150)
    texts = near_copies(seed)
    got = ngram_join.jaccard_components(docs_of(spark, texts.items())).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == brute_components(texts)


def test_join_query_on_given_documents(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op3_ngram_jaccard_join"](spark, SF).collect()}
    assert got == brute_components(texts)


def test_join_edges(spark):
    rows = [(7, "a b c d e f"), (7, "a b c d e f"), (3, "A B C D E F"), (None, "a b c d e f"), (9, None)]
    got = sorted(tuple(r) for r in ngram_join.jaccard_components(docs_of(spark, rows)).select("id", "n_shingles", "component_id").collect())
    assert got == [(3, 2, 3), (7, 2, 3), (7, 2, 3), (9, 0, 9)]
    assert ngram_join.jaccard_components(docs_of(spark, rows).limit(0)).count() == 0


def test_tree_walk_equals_all_pairs():
    rng = random.Random(4)
    base = sorted(rng.sample(range(1000), 80))
    texts = []
    for i in range(40):
        own = sorted(set(x for x in base if rng.random() > 0.12) | set(rng.sample(range(1000), rng.randrange(0, 12))))
        texts.append((i, len(own) + rng.randrange(0, 5), np.array(own, np.uint64)))
    above = list(range(40))
    for a in range(40):
        for b in range(a):
            same = len(np.intersect1d(texts[a][2], texts[b][2]))
            if 175 * same >= 75 * (texts[a][1] + texts[b][1]):
                u, v = above[a], above[b]
                above = [min(u, v) if x in (u, v) else x for x in above]
    links = dict(ngram_join.group_links(texts, None, 75, 100))
    assert [links.get(i, i) for i in range(40)] == above


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 200)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


# ---- 5: decontamination

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))


def brute_hits(docs, items, k=10):
    windows = collections.defaultdict(set)
    for item, text in items:
        w = words_of(text)
        for i in range(max(1, len(w) - k + 1) if w else 0):
            windows[tuple(w[i:i + k])].add(str(item))
    out = {}
    for i, text in docs.items():
        w, hit, found = words_of(text), set(), set()
        for size in {len(x) for x in windows}:
            for at in range(len(w) - size + 1):
                if own := windows.get(tuple(w[at:at + size])):
                    found |= own
                    hit |= set(range(at, at + size))
        out[i] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def result(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


def test_hits_match_brute_force(spark, monkeypatch):
    items = [(1, "one two three four five six seven eight nine ten eleven"), (10, "Short item"), (2, "a a a a a a a a a a a a"), (3, None), (4, "--"), (10, "Short item"), (5, "É1 ß")]
    docs = {0: "x one two three four five six seven eight nine ten eleven y", 1: "short, ITEM! short item", 2: "a " * 30, 3: "", 4: None, 5: "é1 ß É1 ß", 6: "ten nine", 7: "!short item",
            8: "two three four five six seven eight nine ten eleven short item"}
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
    expected = brute_hits(docs, items)
    frame = docs_of(spark, docs.items())
    assert result(contamination(frame, bench)) == expected
    monkeypatch.setattr("brickyard.llm.decontam.SENT_ROWS", 3)  # nothing is broadcast
    assert result(contamination(frame, bench)) == expected
    assert {r.contaminated for r in contamination(frame, bench.limit(0)).collect()} == {False}
    assert contamination(frame.limit(0), bench).count() == 0


def test_decontamination_query(spark):
    docs = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    query = QUERIES["op5_decontamination"](spark, SF)
    assert result(query) == brute_hits(docs, items)
    assert "Python" not in query._jdf.queryExecution().toString() and "Arrow" not in query._jdf.queryExecution().toString()


def test_proximity_matches(spark):
    bench = spark.createDataFrame([(1, "red fox runs")], "item_id long, text string")
    docs = docs_of(spark, [(1, "a fox that runs is red today"), (2, "red fox runs"), (3, "red one two three four five six seven fox runs")])
    kinds = {(r.id, r.kind) for r in match_windows(docs, bench, slop=3).filter("kind <> 'count'").collect()}
    assert kinds == {(1, "proximity"), (2, "phrase")}


# ---- 6: nearest neighbours

def test_recall_and_scores(spark):
    e = table(spark, "/root/testdata/sf0.1", "embeddings").toPandas().sort_values("vec_id")
    x, ids = np.stack(e.embedding.to_list()).astype(float), e.vec_id.to_numpy()
    found = QUERIES["op6_nearest_neighbours"](spark, "/root/testdata/sf0.1").toPandas()
    hits = total = 0
    for q, own in found.groupby("query_id"):
        i = int(np.searchsorted(ids, q))
        exact = x @ x[i]
        assert own["rank"].tolist() != [] and sorted(own["rank"]) == list(range(1, 21)) and q not in set(own.vec_id)
        assert np.allclose(own.score, exact[np.searchsorted(ids, own.vec_id)], atol=1e-12)
        exact[i] = -9
        hits += len(set(own.vec_id) & set(ids[np.lexsort((ids, -exact))[:20]]))
        total += 20
    assert hits / total >= 0.9 and found.query_id.nunique() == sum(ids % 20 == 0)


def test_neighbour_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (9, [-1.0, 2.0]), (20, [2.0, 1.0]), (20, [2.0, 1.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, id string")
    got = [tuple(r) for r in search(frame, F.pmod("id", F.lit(20)) == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 2.0), (0, 2, 1, 1.0), (0, 3, 2, 1.0), (0, 4, 9, -1.0), (20, 1, 0, 2.0), (20, 2, 1, 2.0), (20, 3, 2, 2.0), (20, 4, 9, 0.0)]
    assert search(frame.limit(0), F.lit(True)).count() == 0 and search(frame, F.lit(False)).count() == 0


def test_many_equal_vectors_rank_by_id(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(900)]
    got = search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [3 * i for i in range(1, 21)]


def test_lists_of_heavy_cells_and_query_blocks_equal_brute_force(spark, monkeypatch):
    """All queries calibrate and all their neighbours are to be kept, so the result must be exact."""
    for name, value in (("KEEP", 1.0), ("CALIBRATE", 10_000), ("SHARD_ROWS", 16), ("VISITS", 8)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(3)
    x = np.where(rng.random((400, 1)) < 0.3, 1.0, rng.normal(size=(400, 6)))
    frame = spark.createDataFrame([(i, v.tolist(), 7) for i, v in enumerate(x)], "vec_id long, embedding array<double>, shard int")
    got = collections.defaultdict(list)
    for r in search(frame, F.pmod("id", F.lit(4)) == 0, top=5, centroids=4).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    for q in range(0, 400, 4):
        exact = (x * x[q]).sum(1)
        exact[q] = -np.inf
        assert got[q] == np.lexsort((np.arange(400), -exact))[:5].tolist()


def test_a_query_goes_to_shards_of_taken_cells_only(monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 50)
    rng = np.random.default_rng(5)
    x = np.repeat(rng.normal(size=(16, 8)) * 5, 100, 0) + rng.normal(size=(1600, 8)) * 0.01
    index = ann.MultiIndex(x, 5, 16)
    cells = index.cells(x)
    index.counts.flat[:] = np.bincount(cells, minlength=index.counts.size)
    index.place()
    held = index.shards(cells, np.arange(1600))
    assert np.bincount(held).max() < 80 and set(held) <= set(range(index.n_shards))
    for q in x[::100]:
        stop, shards = index.traverse(q, 100)
        taken = index.sums(q[None], cells)[0] >= stop - ann.SLACK
        assert set(held[taken]) <= set(shards) and len(shards) < index.n_shards / 3


def test_one_component_and_repeated_ids_with_different_vectors(spark):
    rows = [(0, [2.0]), (1, [-1.0]), (2, [3.0]), (20, [5.0]), (20, [1.0])]
    got = [tuple(r) for r in search(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.pmod("id", F.lit(20)) == 0, top=2).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 20, 10.0), (0, 2, 2, 6.0), (20, 1, 2, 3.0), (20, 2, 0, 2.0)]


# ---- 9: sharding

def test_sharding(spark):
    texts = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}
    query = QUERIES["op9_sharding"](spark, SF)
    rows = query.collect()
    assert "Python" not in query._jdf.queryExecution().toString()
    assert {r.doc_id for r in rows} == texts.keys() and len(rows) == len(texts)
    slots = collections.defaultdict(list)
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 8, zlib.crc32(raw)) and r.grown_shard in (r.shard, SHARDS)
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    odd = docs_of(spark, [(1, None), (1, "é"), (None, ""), (1, "é")])
    got = shard_rows(odd, [1.0, 1.0]).collect()
    assert sorted(r.size for r in got) == [8, 8, 10, 10] and len({(r.shard, r.slot) for r in got}) == 4
    assert shard_rows(odd.limit(0), [1.0]).count() == 0
    keys = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    n = collections.Counter(r.shard for r in shard_rows(keys, [1.0, 3.0]).select("shard").collect())
    assert abs(n[1] / 20000 - 0.75) < 0.02


# ---- 10: ARC to WARC

def test_arc_round_trip_of_both_versions():
    records = [("http://a b/é", "20240102030405", b"HTTP/1.1 200 OK\r\n\r\nbody\n\n"), ("u", "2024", b""), ("v", "x", b"\r\n\r\n1 0 \n")]
    for version in (1, 2):
        data = warc.arc_archive("t.arc", records, version)
        got = list(warc.arc_records(data))
        assert [c for _, _, c in got] == [r[2] for r in records] and got[0][1]["URL"] == "http://a%20b/é"
        assert [c for _, _, c in warc.arc_records(data[:-5])][-1] is None
        assert list(warc.arc_records(b"")) == []
    assert warc.iso_date("20240102030405") == "2024-01-02T03:04:05Z" and warc.iso_date("2024") == "2024-01-01T00:00:00Z"


def warc_rows(spark, pages, min_bytes):
    from brickyard.llm.token_output import fresh_folder
    path = fresh_folder(spark, "test-warc")
    warc.write_warc(warc.convert(warc.pages_to_arc(pages)), path, min_bytes)
    return [(r.key, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_warc(spark, path).collect()]


def digest(data):
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_pages_as_warc(spark):
    pages = {r.page_id: (r.html or "").encode() for r in table(spark, SF, "pages").collect()}
    got = {r.page_id: r for r in QUERIES["op10_arc_to_warc"](spark, SF).collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    assert got.keys() == pages.keys()
    for i, raw in pages.items():
        again = first[raw] != i
        assert (got[i].payload_bytes, got[i].payload_digest, got[i].record_type, got[i].refers_to) == (len(raw), digest(raw), "revisit" if again else "response", first[raw] if again else None)


def test_warc_edges(spark):
    rows = [(4, "u", "x\r\n\r\ny"), (2, None, None), (3, "http://é", ""), (1, "a b\n", "x\r\n\r\ny"), (9, "q", "HTTP/1.1\r\n\r\nhi"), (5, "q", "x\r\n\r\ny")]
    frame = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string")
    same, none = digest(b"x\r\n\r\ny"), digest(b"")
    assert sorted(warc_rows(spark, frame, 0)) == [(1, 6, same, "response", None), (2, 0, none, "response", None), (3, 0, none, "revisit", 2), (4, 6, same, "revisit", 1), (5, 6, same, "revisit", 1),
                                                 (9, 14, digest(b"HTTP/1.1\r\n\r\nhi"), "response", None)]
    assert {r[3] for r in warc_rows(spark, frame, 7)} == {"response"}
    assert len(warc_rows(spark, frame.union(frame), 0)) == 12
    assert warc_rows(spark, frame.limit(0), 0) == []


# ---- the pipeline

def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents").withColumn("text", F.expr("case when doc_id = 3 then null when doc_id = 5 then '12 34' else text end"))
    docs = docs.withColumn("lang", F.expr("case when doc_id = 7 then null else lang end")).checkpoint()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "toxicity", "ngram_jaccard", "decontamination", "byte_bpe"]
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = corpus_pipeline.language_id(spark, docs, SF)
    assert kept.columns == corpus_pipeline.COLUMNS and {r.doc_id for r in kept.collect()} == texts.keys() - {3, 5}
    one = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert one.columns == corpus_pipeline.COLUMNS
    assert {r.doc_id for r in one.collect()} == {i for i, (_, c) in brute_components(texts).items() if c == i}
    clean = corpus_pipeline.decontamination(spark, docs, SF)
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert {r.doc_id for r in clean.collect()} == {i for i, r in brute_hits(texts, items).items() if not r[-1]}
    civil = corpus_pipeline.toxic(spark, docs, SF)
    assert civil.columns == corpus_pipeline.COLUMNS and civil.count() <= docs.count()
    ids = corpus_pipeline.byte_bpe(spark, docs, SF)
    assert ids.count() == docs.count() and ids.filter("n_tokens <> size(token_ids)").count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_whole_pipeline_runs(spark):
    out = QUERIES["pipeline"](spark, SF)
    assert 0 < out.count() < table(spark, SF, "documents").count()

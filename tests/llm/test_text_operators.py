"""Operators 1, 2, 4, 7, 8 against brute force, the public libraries, and held-out labels."""

import base64
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brickyard.llm import byte_bpe, langid, textkit, token_output, toxicity
from brickyard.llm.html_extract import extract, main_text
from brickyard.llm.queries import QUERIES, remainder, table, vocabulary

SF = "/root/testdata/sf0.001"
EDGE = ["", " \n ", "a", "it's  we'll 'tis ''s", "x" * 5000, " " * 700 + "y", "é中 १२ <|endoftext|>", "the the the the the", None]


def docs_of(spark, texts, **extra):
    rows = [(i, t, "en", "s", 0, "clash", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, id string, n_tokens int")


def empty(df):
    return df.limit(0)


# ---- 1: language identification

def reference_ranks(text, letters):
    """Rank-ordered n-grams by plain counting."""
    import unicodedata
    words, word = [], ""
    for ch in text + " ":
        if unicodedata.category(ch)[0] == "L":
            word += ch.lower() if len(ch.lower()) == 1 else ch
        elif word:
            words.append(word)
            word = ""
    place = {c: i + 2 for i, c in enumerate(letters)}
    counts = {}

    def add(seq):
        code = 0
        for x in seq:
            code = code << 6 | x
        counts[code] = counts.get(code, 0) + 1

    line = [1]
    for w in words:
        line += [place.get(ord(c), 63) for c in w] + [1]
    for n in range(1, 6):
        for i in range(len(line) - n + 1):
            part = line[i:i + n]
            if 1 in part[1:-1] or n == 1 and part == [1]:
                continue
            add(part)
    return [c for c, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0]))][:langid.RANKS]


def test_ngram_ranks_match_plain_counting():
    letters = np.array([ord(c) for c in "etaoinshrdlué"])
    table_ = langid.Profiles(letters, {}).classes()
    for text in ["The cat, the cat. THE END", "é e É zz9zz", "a", "  x  y  ", "ab" * 400, "ß日本 x"]:
        codes = langid.gram_codes(np.frombuffer(text.encode("utf-32-le"), np.uint32), table_)
        assert langid.profile(codes).tolist() == reference_ranks(text, letters.tolist())


def test_language_held_out_and_edges(spark):
    got = QUERIES["op1_language_id"](spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    held = got.filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert held > 0.9
    assert got.count() == table(spark, SF, "documents").count()
    docs = table(spark, SF, "documents")
    profiles = langid.train(langid.training_rows(docs, F.lit(True), "lang", "text", "doc_id"))
    rows = langid.identify(docs_of(spark, [*EDGE, "12 34 !!"]).drop("id"), profiles, carry=["n_tokens"]).collect()
    by = {r.id: r for r in rows}
    assert [by[i].lang_pred for i in (0, 1, 8, 9)] == ["und"] * 4 and by[0].score == 0 and 0 <= by[7].score <= 1
    assert langid.identify(empty(docs), profiles).count() == 0
    untrained = langid.train(langid.training_rows(empty(docs), F.lit(True), "lang", "text", "doc_id"))
    assert {r.lang_pred for r in langid.identify(docs_of(spark, ["the"]), untrained).collect()} == {"und"}


# ---- 2: HTML extraction

ARTICLE = """<html><body class="has-sidebar"><header><h1>Site</h1><p>Welcome, dear reader.</p></header><div id="nav-menu"><a href=x>Home</a></div>
<div class="layout"><div class="post-body"><h2>Head</h2><p>First   paragraph, with text; and more of it. It is long, isn't it?<p>Short.</p>
<form><p>Sign up</p></form><script>var a = "<p>no</p>"</script><p>Last &eacute;&amp;&lt;b&gt;<br>line, and so on.</div>
<div class="sidebar-right"><p>Other things, that you may like. A lot.</p></div><section id="comments"><p>Nice article, thanks!</p></section></div>
<div class="cookie-notice">We use cookies.</div><footer>(c)</footer></body>"""


def test_main_text_of_a_layout_without_article_tags():
    assert main_text(ARTICLE) == "Head\n\nFirst paragraph, with text; and more of it. It is long, isn't it?\n\nShort.\n\nLast é&<b> line, and so on."


@pytest.mark.parametrize(("page", "text"), [("", ""), ("plain, a < b & c", "plain, a < b & c"), ("<p>a<p>b<script>x</p>", "a\n\nb"), ("<p>a <!-- x", "a"),
                                            ("<div><p>Hi <a href='>'>x</a>, you", "Hi x, you"), ("<nav>menu</nav>", ""),
                                            ("<article><p><b>T<br><p>One.</p></article><footer>f</footer>", "T\n\nOne.")])
def test_main_text_edges(page, text):
    assert main_text(page) == text


STORY = "A long sentence, with commas, tells the story; it goes on, and on. " * 6


def test_content_paths_choose_the_root_and_judge_inner_articles():
    story = STORY.strip()
    teasers = "<section><h2>More</h2>" + "<article><a href=x>Teaser card</a></article>" * 3 + "</section>"
    assert main_text(f"<main><div class=story>{STORY}</div><section><h2>More</h2><article>teaser card</article></section></main>") == story
    assert main_text(f"<body><main><h1>T</h1><p>{STORY}<p>{STORY}<ul><li>one<li>two</ul>{teasers}</main>") == f"T\n\n{story}\n\n{story}\n\none\n\ntwo"
    assert main_text(f"<article><h1>T</h1><p>{STORY}</p><section><h2>Steps</h2><ol><li>one<li>two</ol></section>{teasers}</article>") == f"T\n\n{story}\n\nSteps\n\none\n\ntwo"
    # a teaser beside the article that holds the text; several articles of one page; no such tag
    assert main_text(f"<div><article><h1>T</h1><p>{STORY}<p>{STORY}</article><article><p>Teaser.</p></article></div>") == f"T\n\n{story}\n\n{story}"
    for top in ("main", "div"):
        assert main_text(f"<{top}><article><h2>A</h2><p>{STORY}</article><article><h2>B</h2><p>{STORY}</article></{top}>") == f"A\n\n{story}\n\nB\n\n{story}"
    assert main_text(f"<body><div><h1>T</h1><p>{STORY}<p>{STORY}</div>") == f"T\n\n{story}\n\n{story}"


LAYOUTS = ['<div class="content-sidebar-wrap">', '<div class="site has-sidebar">', '<div class="post no-comments">', '<div class="layout no-sidebar">', '<div class="with-nav">',
           '<div class="widget-area-off">', '<section id="social-policy">', '<form id="aspnetForm">', '<div class="widget"><form class="subscribe">', '<div class="hidden sidebar">']
BESIDE = ('<nav><a href=x>Home</a></nav>', '<div class="ad">Buy this, now. It is good, cheap, and new.</div><div class="sidebar"><p>Other stories, that you may like, too.</p></div>')


@pytest.mark.parametrize("layout", LAYOUTS)
@pytest.mark.parametrize("before", ["", *BESIDE])
@pytest.mark.parametrize("tags", [("", ""), ("<article>", "</article>"), ("<main>", "</main>")])
def test_class_words_lose_no_article(layout, before, tags):
    story = STORY.strip()
    inside = f'<h1>T</h1><p>{STORY}</p><p class="register-of-works">{STORY}</p><div class="alert-free">{STORY}</div><p>{STORY}</p>'
    page = f"<html><body>{before}{layout}{tags[0]}{inside}{tags[1]}</body></html>"
    assert main_text(page) == "\n\n".join(["T", *[story] * 4])


def test_ratios_and_doubt_decide_what_is_dropped(monkeypatch):
    story = STORY.strip()
    noise = '<div class="ad-banner"><p>Buy this, now.</p></div>', '<form><label>Mail</label><p>Sign up, please.</p></form>', f'<div id="comments"><p>{STORY}</p></div>'
    inside = f"<article><p>{STORY}</p>{noise[0]}<p>{STORY}</p>{noise[1]}<p>{STORY}</p>{noise[2]}</article>"
    bare = f"<div><div class=post><p>{STORY}</p>{noise[0]}<p>{STORY}</p><p>{STORY}</p></div>{noise[2]}</div>"
    want = "\n\n".join([story] * 3)
    assert main_text(inside) == main_text(bare) == want
    monkeypatch.setattr("brickyard.llm.html_extract.content_mask", lambda blocks: [True] * len(blocks))
    assert main_text(inside) != want and main_text(bare) != want


@pytest.mark.parametrize("tag", ["video", "audio", "object", "canvas", "select", "svg", "template", "noscript"])
def test_embedded_elements_lose_no_text_behind_them(tag):
    assert main_text(f"<article><p>One, <{tag} id=x> two.<p>Three.</p></article><div class=ad>x</div>") == "One, two.\n\nThree."
    assert main_text(f"<article><p>One <{tag}>a<{tag}><p>b</p></{tag}>c</{tag}> two.<p>Three.</p></article>") == "One two.\n\nThree."
    # an end tag behind the parent is another element's
    assert main_text(f"<article><p>One.</p><div><{tag}></div><p>Two.</p></{tag}><p>Three.</article>") == "One.\n\nTwo.\n\nThree."


def test_formulas_are_text_and_open_choices_end_at_the_next_block():
    formula = "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow><annotation encoding=tex>x=1</annotation></semantics></math>"
    assert main_text(f"<article><p>So {formula} holds.<p>Next.</article>") == "So x=1 holds.\n\nNext."
    assert main_text("<article><div>One. <select><option>a<option>b<p>Two.</p></div><p>Three.</article>") == "One.\n\nTwo.\n\nThree."


def test_pages_give_their_articles(spark):
    import html
    import re
    pages = {r.page_id: r.html for r in table(spark, SF, "pages").collect()}
    got = {r.page_id: r for r in QUERIES["op2_html_extraction"](spark, SF).collect()}
    assert got.keys() == pages.keys()
    for i, page in pages.items():
        m = re.search(r"<article>(.*?)(</article>|\Z)", page, re.S)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", m[1]))
        assert got[i].text == "\n\n".join(p for p in parts if p) and got[i].n_chars == len(got[i].text)
    odd = spark.createDataFrame([(1, None, None, "x"), (1, None, None, "x"), (None, "u", "<p>a</p>", "y")], "page_id long, url string, html string, text string")
    assert sorted((r.id or 0, r.text) for r in extract(odd).collect()) == [(0, "a"), (1, ""), (1, "")]
    assert extract(empty(odd)).count() == 0


# ---- 4: byte-level BPE

@pytest.fixture(scope="module")
def tiktoken_of():
    import public_tokenizers as P
    import tiktoken
    path = P.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_matches_the_library(tiktoken_of):
    random.seed(3)
    alphabet = [*"abstreldvm'' \n\t.!1२é中’𝕏 　", "'s", "'re", " 's", "  x"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 50))) for _ in range(3000)] + EDGE + ["ab" * 900 + "é" * 900]
    bpe = byte_bpe.encoder(vocabulary("byte_bpe_multi_50k.tiktoken"))
    ids, bounds = bpe.encode(*textkit.text_buffer(pa.array(texts)))
    for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        own = ids[a:b].tolist()
        assert own == tiktoken_of.encode_ordinary(t or "")
        assert bpe.decode(own) == (t or "").encode()


def test_scan_equals_stepping_through_the_automaton():
    step, start = byte_bpe.automaton()
    rng = np.random.default_rng(1)
    for n in (0, 1, 255, 256, 257, 5000):
        sym = rng.integers(0, 16, n).astype(np.uint8)
        state, marks = byte_bpe.FRESH, []
        for x in sym.tolist():
            marks.append(bool(start[8 * x + state]))
            state = int(step[8 * x + state])
        assert byte_bpe.token_starts(sym).tolist() == marks


def test_bpe_query_and_offsets(spark, tiktoken_of):
    import hashlib
    docs = table(spark, SF, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in QUERIES["op4_byte_bpe"](spark, SF).collect():
        ids = tiktoken_of.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    path = vocabulary("byte_bpe_multi_50k.tiktoken")
    rows = byte_bpe.encode_texts(docs_of(spark, EDGE), path, offsets=True)
    for r in rows.collect():
        raw, at = (EDGE[r.id] or "").encode(), 0
        for t, end in zip(r.token_ids, r.token_ends, strict=True):
            assert tiktoken_of.decode_single_token_bytes(t) == raw[at:end]
            at = end
        assert at == len(raw)
    assert {r.id: r.text for r in byte_bpe.decode_ids(rows, path).collect()} == {i: t or "" for i, t in enumerate(EDGE)}
    assert byte_bpe.encode_digests(empty(docs), path).count() == 0


# ---- 7: token files

def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    tokenizer.encode_special_tokens = True
    texts, at = {r.doc_id: r.text for r in table(spark, SF, "documents").collect()}, 0
    got = {r.doc_id: r for r in QUERIES["op7_token_output"](spark, SF).collect()}
    assert got.keys() == texts.keys()
    for i in sorted(texts):
        ids = [*tokenizer.encode(texts[i], add_special_tokens=False).ids, 2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    docs = docs_of(spark, [*EDGE, None, "the the"]).union(docs_of(spark, ["twice"]))
    path = token_output.fresh_folder(spark, "test-tokens")
    token_output.write_token_files(docs, path, vocabulary("word_bpe_49k.json"), 2)
    rows = token_output.read_blocks(spark, path).collect()
    assert sorted((r.start, r.n_tokens) for r in rows)[0][0] == 0 and len(rows) == len(EDGE) + 3
    for r in rows:
        if r.id > 0:
            text = [*EDGE, None, "the the"][r.id] or ""
            assert np.frombuffer(r.ids, np.uint16).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
    path = token_output.fresh_folder(spark, "test-tokens")
    token_output.write_token_files(empty(docs), path, vocabulary("word_bpe_49k.json"), 2)
    assert token_output.read_blocks(spark, path).count() == 0


def test_code_lengths_are_optimal_and_limited():
    import heapq
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 50, 300):
        counts = {i: int(x) for i, x in enumerate(rng.zipf(1.4, n) % 100000 + 1)}
        free = token_output.code_lengths(counts, 40 if n <= 50 else 30)
        heap = [(c, i) for i, c in counts.items()]
        heapq.heapify(heap)
        cost = 0
        while len(heap) > 1:
            a, b = heapq.heappop(heap), heapq.heappop(heap)
            cost += a[0] + b[0]
            heapq.heappush(heap, (a[0] + b[0], -1))
        assert sum(counts[i] * x for i, x in free.items()) == (cost or counts[0])
        tight = token_output.code_lengths(counts, max(1, (n - 1).bit_length()))
        assert max(tight.values()) <= max(1, (n - 1).bit_length()) and sum(2.0 ** -x for x in tight.values()) <= 1
        code = token_output.Canonical(free)
        ids = rng.choice(n, 1000).astype(np.uint16)
        bits, marks = code.pack(ids)
        assert code.unpack(bits, marks, len(ids)).tolist() == ids.tolist()


# ---- 8: toxicity

def test_toxicity_learns_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    model = toxicity.train(docs, table(spark, sf, "labels"), remainder(docs, 3) != 1)
    scored = toxicity.score(docs, model).withColumnRenamed("id", "doc_id")
    held = scored.filter(remainder(scored, 3) == 1).join(table(spark, sf, "labels"), "doc_id").toPandas()
    said = held.score >= toxicity.AT
    assert said[held.toxic == 1].mean() > 0.75 and said[held.toxic == 0].mean() < 0.03
    assert held.score.between(0, 1).all()
    edge = toxicity.score(docs_of(spark, [*EDGE, "idiot idiot"]).drop("id"), model, carry=["n_tokens"]).collect()
    assert len(edge) == len(EDGE) + 1 and len({r.score for r in edge if r.id in (0, 1, 8)}) == 1
    assert toxicity.score(empty(docs), model).count() == 0
    blank = toxicity.train(docs, empty(table(spark, sf, "labels")), F.lit(True))
    assert {r.score for r in toxicity.score(docs_of(spark, ["a", None]), blank).collect()} <= {r.score for r in toxicity.score(docs_of(spark, [None]), blank).collect()}


def test_toxicity_keeps_its_measured_rates_by_language(spark):
    sf = "/root/testdata/sf0.1"
    labels = table(spark, sf, "labels")
    docs = table(spark, sf, "documents").join(labels.select("doc_id"), "doc_id", "left_semi")
    scored = toxicity.score(docs, toxicity.train(docs, labels, remainder(docs, 3) != 1), carry=["lang"]).withColumnRenamed("id", "doc_id")
    held = scored.filter(remainder(scored, 3) == 1).join(labels, "doc_id").toPandas()
    said = held[held.score >= toxicity.AT]
    found, wrong = (said[said.toxic == y].lang.value_counts() for y in (1, 0))
    # as README gives them: of 20, 82, 12 and 30 toxic documents, and of 186, 712, 121 and 181 others
    for lang, least, most in (("de", 17, 3), ("en", 75, 0), ("es", 8, 1), ("fr", 13, 0)):
        assert found.get(lang, 0) >= least and wrong.get(lang, 0) <= most, lang


def test_toxicity_learns_from_every_labelled_text(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 64)
    monkeypatch.setattr(toxicity, "SHARD_LEAST", 8)
    monkeypatch.setattr(toxicity, "STEPS", 8)
    # texts of 70,000 bytes whose last word tells
    rows = [(i, f"word{i % 7} plain " + "x" * 70000 + (" idiot" if i % 4 == 0 else " friend"), "en", int(i % 4 == 0)) for i in range(160)]
    every = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int")
    model = toxicity.train(every.drop("toxic"), every.select("doc_id", "toxic"), F.col("doc_id") < 150)
    got = {r.id: r.score >= toxicity.AT for r in toxicity.score(every, model).collect()}
    assert [got[i] for i in range(160)] == [i % 4 == 0 for i in range(160)]
    # all rows are counted, whatever their number
    marked = every.select(F.lit(1).alias("label"), "lang", F.lit("idiot you").alias("text")).crossJoin(spark.range(50))
    assert toxicity.counts(marked)[1].tolist() == [0, 8000]


def test_pooling_takes_the_maximum_over_whole_texts():
    rng = np.random.default_rng(2)
    tables = rng.normal(size=(50, sum(toxicity.WIDTHS) * toxicity.FILTERS)).astype(np.float32)
    bias = rng.normal(size=len(toxicity.WIDTHS) * toxicity.FILTERS).astype(np.float32)
    feats, bounds = rng.integers(0, 50, (40, 3)), np.array([0, 0, 1, 3, 20, 40])
    got = toxicity._pool(tables, bias, feats, bounds)[0]
    for r, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
        at = 0
        for k, w in enumerate(toxicity.WIDTHS):
            best = np.zeros(toxicity.FILTERS)
            for i in range(a, b - w + 1):
                x = sum(tables[feats[i + j]].sum(0)[at + j * toxicity.FILTERS:at + (j + 1) * toxicity.FILTERS] for j in range(w))
                best = np.maximum(best, x + bias[k * toxicity.FILTERS:(k + 1) * toxicity.FILTERS])
            assert np.allclose(got[r, k * toxicity.FILTERS:(k + 1) * toxicity.FILTERS], best, atol=1e-4)
            at += w * toxicity.FILTERS


def test_pieces_encode_apart_as_whole_texts_do():
    words = token_output.word_ids(vocabulary("word_bpe_49k.json"))
    random.seed(5)
    alphabet = [*"abSTrelvmd019.,!'\"’…-_ \n\t", "é", "é", "Σ", "ς", "'s", "'S", "n't", "<|endoftext|>", " ", "中", "²", "İ", "ﬁ", "\x1c"]
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 30))) for _ in range(5000)] + EDGE
    ids, bounds = words.encode(*textkit.text_buffer(pa.array(texts)))
    whole = words.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [e.ids for e in whole]


def test_literals_of_added_tokens_become_their_ids(spark, tmp_path):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    random.seed(6)
    alphabet = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", "don", "'t", "'", " ", "\n", "é", "\u0301", "Σ", "1", "B", ".", "<"]
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "x <|endof", "text|> y", *EDGE]
    texts += ["".join(random.choice(alphabet) for _ in range(random.randint(0, 12))) for _ in range(3000)]
    whole = [[*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for t in texts]
    assert whole[0] == [3306, 49407, 1002, 2]
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op7_token_output"](spark, str(tmp_path)).orderBy("doc_id").collect()
    at = 0
    for r, ids in zip(rows, whole, strict=True):
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)

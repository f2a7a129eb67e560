"""Registered queries of the operators: ``opN_<name>`` over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard.llm import toxicity
from brickyard.llm.ann import search
from brickyard.llm.byte_bpe import encode_digests
from brickyard.llm.decontam import contamination
from brickyard.llm.html_extract import extract
from brickyard.llm.langid import identify, train, training_rows
from brickyard.llm.ngram_join import jaccard_components
from brickyard.llm.phrases import collocations
from brickyard.llm.ranked import ranked_search
from brickyard.llm.sharding import shard_rows
from brickyard.llm.simhash import simhash_components
from brickyard.llm.warc import convert, pages_to_arc, read_warc, write_warc
from brickyard.llm.token_output import fresh_folder, read_blocks, write_token_files

#: Shards of the sharding query.
SHARDS = 24
#: The id that ends every document in the token files.
END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers  # installed beside Spark, never copied here

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def remainder(documents: DataFrame, n: int):
    """crc32 of the id's text, modulo n."""
    return F.pmod(F.crc32(documents["doc_id"].cast("string").cast("binary")), F.lit(n))


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = remainder(documents, 4) == 2
    profiles = train(training_rows(documents, ~held_out, "lang", "text", "doc_id"))
    placed = identify(documents, profiles).withColumnRenamed("id", "doc_id")
    return placed.select("doc_id", (remainder(placed, 4) == 2).alias("held_out"), "lang_pred", "score")


@query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard_components(table(spark, sf_dir, "documents"))
    return joined.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "class_id")


@query
def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))
    return coded.withColumnRenamed("id", "doc_id")


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


@query
def op7_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), END_ID, added_tokens=True)
    return read_blocks(spark, path, crc32=True).withColumnRenamed("id", "doc_id")


@query
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = shard_rows(table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return sharded.select(F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


@query
def op10_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_folder(spark, "warc")
    write_warc(convert(pages_to_arc(table(spark, sf_dir, "pages"))), path, min_bytes=0)
    return read_warc(spark, path).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), remainder(documents, 3) != 1)
    scored = toxicity.score(documents, model).withColumnRenamed("id", "doc_id")
    return scored.select("doc_id", (remainder(scored, 3) == 1).alias("held_out"), "score", (F.col("score") >= toxicity.AT).cast("int").alias("predicted"))


@query
def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.pmod(F.col("id"), F.lit(20)) == 0)


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@query
def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), fresh_folder(spark, "ranked"))
    return found.withColumnsRenamed({"item": "item_id", "id": "doc_id"})


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it stands on these operators, so it can't be imported before them

    return corpus_pipeline.run(spark, sf_dir)


# --- the same results in SQL, for the operators that it can express ---------------------------

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _rows_of_words(table: str, key: str, word: str, ahead: int) -> str:
    """(key, i, n, l): every word with those after it, ``ahead`` in all."""
    words = f"regexp_extract_all({_LOW.format("COALESCE(text, '')")}, '{word}')"
    later = ", ".join(f"lead(w, {j}) OVER x" for j in range(1, ahead))
    return (f"SELECT {key}, i, n, [w, {later}] AS l FROM (SELECT {key}, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i, len(ws) AS n "
            f"FROM (SELECT {key}, {words} AS ws FROM {table})) WINDOW x AS (PARTITION BY {key} ORDER BY i)")


ORACLE["op3_ngram_jaccard_join"] = f"""
WITH RECURSIVE e AS ({_rows_of_words("documents", "doc_id", "[^\\x20\\x09-\\x0D]+", 5)}),
s AS (SELECT DISTINCT doc_id, array_to_string(l, ' ') AS sh FROM e WHERE i = 1 OR i + 4 <= n),
n AS (SELECT d.doc_id, COALESCE(x.n, 0) AS n, COALESCE(x.sig, 'none ' || d.doc_id) AS sig FROM documents d
      LEFT JOIN (SELECT doc_id, COUNT(*) AS n, md5(string_agg(sh, chr(10) ORDER BY sh)) AS sig FROM s GROUP BY doc_id) x USING (doc_id)),
c AS (SELECT sig, MIN(doc_id) AS class_id FROM n GROUP BY sig),
o AS (SELECT a.doc_id AS u, b.doc_id AS v, COUNT(*) AS same FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT u, v FROM o JOIN n p ON p.doc_id = u JOIN n q ON q.doc_id = v WHERE 100 * same >= 75 * (p.n + q.n - same)),
r AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT r.node, l.v FROM r JOIN l ON l.u = r.seen),
m AS (SELECT node, MIN(seen) AS component_id FROM r GROUP BY node)
SELECT n.doc_id, n.n AS n_shingles, m.component_id, c.class_id FROM n JOIN c USING (sig) JOIN m ON m.node = n.doc_id"""

_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
ORACLE["op5_decontamination"] = f"""
WITH e AS ({_rows_of_words("documents", "doc_id", _WORD, 10)}),
b AS ({_rows_of_words("benchmark", "item_id", _WORD, 10)}),
win AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, n) AS k, array_to_string(l, ' ') AS t FROM b WHERE i = 1 OR i + 9 <= n),
spots AS (SELECT doc_id, i, k, array_to_string(list_slice(l, 1, k), ' ') AS t FROM e, (SELECT DISTINCT k FROM win) WHERE i + k - 1 <= n),
hits AS (SELECT DISTINCT spots.doc_id, spots.i, spots.k, win.item FROM spots JOIN win ON win.k = spots.k AND win.t = spots.t),
words AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS list FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, COALESCE(z.n_words, 0) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
       sha256(COALESCE(list, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN (SELECT doc_id, COUNT(*) AS n_words FROM e GROUP BY doc_id) z USING (doc_id)
LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_GROUPS = ", ".join(f"substr(h, {5 * g + 1}, 5)" for g in range(8))
ORACLE["op10_arc_to_warc"] = f"""
WITH p AS (SELECT page_id, COALESCE(html, '') AS html, sha1(COALESCE(html, '')) AS h FROM pages),
g AS (SELECT *, list_transform([{_GROUPS}], lambda x: CAST('0x' || x AS BIGINT)) AS v, MIN(page_id) OVER (PARTITION BY h, strlen(html)) AS first FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(v, lambda x: array_to_string(list_transform([15, 10, 5, 0], lambda b: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((x >> b) & 31 AS INTEGER) + 1, 1)), '')), '') AS payload_digest,
       CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to
FROM g"""

ORACLE["op11_phrase_collocations"] = f"""
WITH p AS (SELECT doc_id, COALESCE(lang, 'und') AS lang, unnest(string_split_regex({_LOW.format("COALESCE(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
t AS (SELECT lang, CAST(SUM(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, unnest(list_transform(range(1, len(ws) + 1), lambda i: ws[i:i])) AS g FROM w
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: ws[i:i + 1])) FROM w
      UNION ALL SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i:i + 2])) FROM w),
c AS (SELECT lang, g, COUNT(*) AS f FROM g GROUP BY ALL HAVING COUNT(*) >= 10),
h AS (SELECT lang, g, f, 1 AS cut, g[1:1] AS head, g[2:3] AS tail FROM c WHERE len(g) > 1 UNION ALL SELECT lang, g, f, 2, g[1:2], g[3:3] FROM c WHERE len(g) > 2),
k AS (SELECT h.lang, h.g, h.f AS a, cut, x.f AS l, y.f AS r, 1000000::HUGEINT * h.f * h.f // (x.f::HUGEINT * y.f) AS s
      FROM h JOIN c x ON x.lang = h.lang AND x.g = h.head JOIN c y ON y.lang = h.lang AND y.g = h.tail),
b AS (SELECT lang, g, a, l, r, s FROM k QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY s, cut) = 1),
o AS (SELECT lang, g, MAX(f) AS f FROM (SELECT lang, g[1:2] AS g, f FROM c WHERE len(g) = 3 UNION ALL SELECT lang, g[2:3], f FROM c WHERE len(g) = 3) GROUP BY ALL),
z AS (SELECT b.lang, array_to_string(b.g, ' ') AS phrase, a, l, r, CAST(s AS BIGINT) AS score FROM b LEFT JOIN o ON o.lang = b.lang AND o.g = b.g WHERE o.f IS NULL OR 100 * o.f < 50 * a),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z)
SELECT q.lang, rank, phrase, a, l, r, t.n, score FROM q JOIN t USING (lang) WHERE rank <= 2000"""

_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
ORACLE["op13_ranked_search"] = f"""
WITH e AS (SELECT doc_id, unnest(regexp_extract_all({_LOW.format("COALESCE(text, '')")}, '{_TERM}')) AS w FROM documents),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOW.format("COALESCE(text, '')")}, '{_TERM}')) AS w FROM benchmark),
d AS (SELECT doc_id, COUNT(*) AS n FROM e GROUP BY doc_id),
g AS (SELECT COUNT(*) AS docs, CAST(SUM(n) AS BIGINT) AS terms FROM d),
p AS (SELECT w, doc_id, COUNT(*) AS tf FROM e WHERE w IN (SELECT w FROM q) GROUP BY ALL),
f AS (SELECT w, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * COUNT(*) + 1)::DOUBLE)) AS BIGINT) AS weight FROM p, g GROUP BY w, docs),
s AS (SELECT item_id, doc_id, CAST(SUM(weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
      FROM q JOIN f USING (w) JOIN p USING (w) JOIN d USING (doc_id) CROSS JOIN g GROUP BY ALL),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM r WHERE rank <= 50"""

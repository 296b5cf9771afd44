"""Registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basalt.llm import langid, quality, toxicity
from basalt.llm.exact_dedup import exact_dedup
from basalt.llm.hard_negatives import mine
from basalt.llm.html_text import extract
from basalt.llm.near_dedup import near_duplicates
from basalt.llm.packing import pack
from basalt.llm.phrases import collocations
from basalt.llm.registry import ORACLES, QUERIES, query
from basalt.llm.sampling import id_crc
from basalt.llm.sentencepieces import encode_decode
from basalt.llm.suffix_dedup import dedup_substrings
from basalt.llm.tokenfiles import read_token_files, write_token_files
from basalt.llm.topk import top_k
from basalt.session import scratch_path
from basalt.sources.tables import read_table

__all__ = ["ORACLES", "QUERIES"]


def bpe_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), bpe_path(), window=1024, end_id=0)


@query("op5_token_files")
def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    folder = scratch_path(spark, "token-files")
    write_token_files(docs, folder, bpe_path(), end_id=2)
    return read_token_files(spark, folder, docs.schema["doc_id"].dataType)


@query("op9_exact_dedup", """
WITH t AS (
    SELECT doc_id, coalesce(length(text), 0) AS n,
           sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) AS text_sha256
    FROM documents)
SELECT doc_id, first(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""")
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(read_table(spark, sf_dir, "documents"))


@query("op3_near_dedup", """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' ')) END) AS sh
    FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i
    FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
    SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
    WHERE 100 * i >= 85 * (nx.n + ny.n - i)),
r(root, doc_id) AS (
    SELECT doc_id, doc_id FROM w
    UNION
    SELECT r.root, e.y FROM r JOIN e ON e.x = r.doc_id),
c AS (SELECT doc_id, min(root) AS component_id FROM r GROUP BY doc_id)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w JOIN c ON c.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id
""")
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), words=3, percent=85)


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Fitted to the labelled documents outside the held-out fifth."""
    train = labels.filter(id_crc(F.col("doc_id")) % 5 != 0).select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    return toxicity.fit(docs, train)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity_model(docs, read_table(spark, sf_dir, "labels")))
    return scored.select("doc_id", (id_crc(F.col("doc_id")) % 5 == 0).alias("held_out"), "score", "predicted", "clauses", "top_clause")


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    crc = id_crc(F.col("doc_id")) % 3
    model = quality.fit(docs, labels.filter(crc != 1).select(F.col("doc_id").alias("id"), F.col("quality").alias("label")))
    return quality.score(docs, model).select("doc_id", (crc == 1).alias("held_out"), "score", "predicted")


def language_model(docs: DataFrame) -> langid.Model:
    """Fitted to the documents outside the held-out quarter."""
    return langid.fit(docs, docs.filter(id_crc(F.col("doc_id")) % 4 != 2).select(F.col("doc_id").alias("id"), F.col("lang").alias("label")))


@query("op10_language_id")
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = langid.identify(docs, language_model(docs))
    return found.select("doc_id", (id_crc(F.col("doc_id")) % 4 == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query("op4_html_text")
def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


@query("op7_top_k", """
WITH e AS (
    SELECT vec_id, row_number() OVER () AS uid, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.uid AS q_uid, q.vec_id AS query_id, e.uid, e.vec_id, list_inner_product(q.v, e.v)::BIGINT AS score
    FROM e q JOIN e ON e.uid <> q.uid AND len(e.v) = len(q.v) WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY q_uid ORDER BY score DESC, vec_id, uid)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""")
def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64.0)


@query("op6_sentencepiece")
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_decode(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query("op11_phrases", """
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+')) AS piece
    FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
g AS (
    SELECT lang, m, unnest(list_transform(range(1, len(ws) - m + 2), lambda i: array_to_string(ws[i:i + m - 1], ' '))) AS phrase
    FROM w, (VALUES (1), (2), (3), (4)) AS v(m)),
f AS (SELECT lang, m, phrase, count(*) AS a, string_split(phrase, ' ') AS ws FROM g GROUP BY lang, m, phrase HAVING count(*) >= 30),
k AS (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m >= 2),
d AS (
    SELECT k.lang, k.phrase, k.a, l.a AS l, r.a AS r, k.k, ((2000000::HUGEINT * k.a) // (l.a + r.a))::BIGINT AS score
    FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.ws[1:k.k], ' ')
           JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.ws[k.k + 1:k.m], ' ')),
b AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
s AS (SELECT lang, m, a, ws, unnest(range(1, m)) AS i FROM f WHERE m >= 3),
x AS (SELECT lang, a, array_to_string(ws[i:i + c - 1], ' ') AS phrase FROM s, (VALUES (2), (3)) AS v(c) WHERE c < m AND i + c - 1 <= m),
i AS (SELECT DISTINCT f.lang, f.phrase FROM x JOIN f ON f.lang = x.lang AND f.phrase = x.phrase WHERE 100 * x.a >= 80 * f.a),
o AS (
    SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
    FROM b WHERE NOT EXISTS (SELECT 1 FROM i WHERE i.lang = b.lang AND i.phrase = b.phrase))
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN t ON t.lang = o.lang WHERE rank <= 2000
""")
def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"), least=30, longest=4, top=2000, inside=80, scale=2_000_000)


@query("op12_suffix_dedup", """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n_bytes, row_number() OVER (ORDER BY doc_id, text) AS o
    FROM documents),
w AS (SELECT o, unnest(range(0, n_bytes - 99)) AS i, h FROM d),
k AS (SELECT o, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM w),
f AS (SELECT o, i, row_number() OVER (PARTITION BY s ORDER BY o, i) > 1 AS again FROM k),
b AS (SELECT o, i, i > lag(i) OVER (PARTITION BY o ORDER BY i) + 100 AS gap FROM f WHERE again),
g AS (SELECT o, i, coalesce(sum(gap::INTEGER) OVER (PARTITION BY o ORDER BY i), 0) AS run FROM b),
r AS (SELECT o, min(i) AS a, max(i) + 100 AS z FROM g GROUP BY o, run),
l AS (SELECT o, list(a ORDER BY a) AS aa, list(z ORDER BY a) AS zz, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM r GROUP BY o),
t AS (
    SELECT d.*, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           list_concat([0], coalesce(zz, [])) AS kept_from, list_concat(coalesce(aa, []), [n_bytes]) AS kept_to
    FROM d LEFT JOIN l ON l.o = d.o)
SELECT doc_id, n_bytes, n_removed, n_spans,
       sha256(unhex(array_to_string(list_transform(range(1, len(kept_from) + 1), lambda j: substr(h, 2 * kept_from[j] + 1, 2 * (kept_to[j] - kept_from[j]))), ''))) AS kept_sha256
FROM t
""")
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(read_table(spark, sf_dir, "documents"), length=100)
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return found.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_hard_negatives", """
WITH e AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, row_number() OVER () AS uid,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.uid AS a_uid, a.vec_id AS anchor_id, a.label = e.label AS same, e.uid, e.vec_id, list_inner_product(a.v, e.v)::BIGINT AS score
    FROM e a JOIN e ON e.uid <> a.uid AND len(e.v) = len(a.v) WHERE a.vec_id % 50 = 0),
p AS (SELECT *, row_number() OVER (PARTITION BY a_uid ORDER BY score DESC, vec_id, uid) AS place FROM s WHERE same),
w AS (
    SELECT p.a_uid, p.place, p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
           row_number() OVER (PARTITION BY p.a_uid, p.place ORDER BY s.score DESC, s.vec_id, s.uid)::INTEGER AS rank
    FROM p JOIN s ON s.a_uid = p.a_uid AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
    WHERE p.place <= 5)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 3
""")
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label, positives=5, negatives=3, lowest=(50, 100), highest=(95, 100), scale=256.0)

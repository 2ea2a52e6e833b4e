"""The query of each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, hard_negatives, lm, mips, nbsvm, ngram_join, packing, piece_bpe, source_audit, syncmers, toxicity, warc
from .common import id_remainder, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f
    return keep


@query("op1_ngram_jaccard_join", """
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
t AS (SELECT doc_id, unnest(s) AS g FROM s),
n AS (SELECT doc_id, len(s) AS n FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (
  WITH RECURSIVE c(doc_id, root) AS (
    SELECT doc_id, doc_id FROM n UNION SELECT f.b, c.root FROM c JOIN f ON f.a = c.doc_id AND c.root < f.b)
  SELECT doc_id, min(root) AS component_id FROM c GROUP BY doc_id)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, component_id FROM n JOIN r USING (doc_id)""")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"),
                             public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op3_elias_fano_lm")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), lm.ORDER)


@query("op4_warc_capture_index", """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND p.payload_bytes >= 100""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.resolved(warc.archive_and_index(table(spark, sf_dir, "pages")))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op5_exact_top_k", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.c, d.c) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id AND len(q.c) = len(d.c)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 5""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mips.top_k(table(spark, sf_dir, "embeddings"), k=5, query_every=50)


@query("op6_chat_formatting")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql("""SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]')
                       AS t(conv_id, turn, role, text)""")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.format_conversations(rows.unionByName(own)))


@query("op7_closed_syncmers")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprint_edits(table(spark, sf_dir, "documents"))


def quality_model(spark: SparkSession, sf_dir: str) -> nbsvm.Model | None:
    sample = nbsvm.labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "quality",
                                   id_remainder("doc_id", 4) != 2, nbsvm.SAMPLE)
    return nbsvm.train(sample)


@query("op8_nb_svm_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = nbsvm.score(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir), threshold=0.7)
    return scored.select("doc_id", (id_remainder("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query("op9_best_fit_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"),
                        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)


def toxicity_model(spark: SparkSession, sf_dir: str) -> toxicity.Model:
    sample = nbsvm.labelled_sample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), "toxic",
                                   id_remainder("doc_id", 5) != 0, toxicity.SAMPLE)
    return toxicity.train(sample)


@query("op10_toxicity_grammar")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), toxicity_model(spark, sf_dir), threshold=0.5)
    return scored.select("doc_id", (id_remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query("op11_source_audit", r"""
WITH d AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
t AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT d) >= 30),
l AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(v, 0) AS v, CAST(coalesce(sum(c), 0) AS BIGINT) AS n
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN l USING (lang) GROUP BY lang, source, v),
p AS (SELECT g.lang, g.source, k.term, coalesce(c, 0) AS c,
             CAST(1 + (1000000000::HUGEINT * (coalesce(c, 0) + 5)) // (g.n + 5 * g.v) AS BIGINT) AS p,
             CAST(1 + (1000000000::HUGEINT * (k.n + 5)) // (l.n + 5 * l.v) AS BIGINT) AS q
      FROM g JOIN k USING (lang) JOIN l USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
f AS (SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS f
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(f, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE c > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r
QUALIFY part = 'pair' OR rank <= 50""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit(table(spark, sf_dir, "documents"))


@query("op12_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS c
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_dot_product(a.c, r.c) AS BIGINT) AS score
  FROM v a JOIN v r ON a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id AND len(a.c) = len(r.c)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
QUALIFY rank <= 10""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), label=label)


@query("op13_sentencepiece_bpe")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))

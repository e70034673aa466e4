"""Registered queries of this subpackage, each beside its SQL where SQL can state the same result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import lm_scoring, quality_classifier
from tidemark.llm.bpe import encode_decode
from tidemark.llm.common import fold
from tidemark.llm.hard_negatives import hard_negatives
from tidemark.llm.language_id import train_and_identify
from tidemark.llm.line_dedup import line_classes
from tidemark.llm.mixing import mix
from tidemark.llm.near_dedup import near_duplicates
from tidemark.llm.page_templates import main_texts
from tidemark.llm.phrases import phrases
from tidemark.llm.quality_rules import judge
from tidemark.llm.topk_search import top_k
from tidemark.llm.warc import round_trip

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"


@query("op7_minhash_near_dedup", rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+') AS ws
  FROM documents WHERE doc_id IS NOT NULL),
s AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct([array_to_string(ws[i:i+2], ' ') FOR i IN range(1, len(ws) - 1)]) END AS sh FROM w),
e AS MATERIALIZED (SELECT doc_id, len(sh) AS n, unnest(sh) AS sh FROM s),
p AS MATERIALIZED (
  SELECT x.doc_id AS a, y.doc_id AS b FROM e x JOIN e y ON x.sh = y.sh AND x.doc_id <> y.doc_id
  WHERE least(x.n, y.n) * 100 >= 85 * greatest(x.n, y.n)
  GROUP BY 1, 2 HAVING 100 * count(*) >= 85 * (min(x.n) + min(y.n) - count(*))),
r AS (SELECT a, least(a, min(b)) AS c FROM p GROUP BY a UNION SELECT p.b, r.c FROM r JOIN p ON p.a = r.a WHERE r.c < p.b),
t AS (SELECT a, min(c) AS c FROM r GROUP BY a)
SELECT s.doc_id, len(s.sh) AS n_shingles, coalesce(t.c, s.doc_id) AS component_id, coalesce(t.c, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN t ON t.a = s.doc_id
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents linked at 85 of 100 shared 3-word shingles."""
    return near_duplicates(_table(spark, sf_dir, "documents"), k=3, similar=(85, 100))


@query("op5_bpe")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded; digests of ids and of the decoded text."""
    coded = encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))


@query("op9_warc")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to seekable archives and read back."""
    rows = round_trip(_table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_mixing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by the mix of its source."""
    mixed = mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", "rate", "source")


@query("op6_topk_search", """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * x::DOUBLE) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v))
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 20
""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 largest integer inner products of every twentieth vector."""
    return top_k(_table(spark, sf_dir, "embeddings"))


@query("op2_language_id")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text, learned from two of three folds."""
    docs = _table(spark, sf_dir, "documents")
    found = train_and_identify(docs, fold("doc_id", 3) != 1)
    return found.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op4_quality_rules")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the rules' verdict on every text."""
    return judge(_table(spark, sf_dir, "documents"))


@query("op1_lm_scoring")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's loss under a model of the texts labelled good, against that of all texts."""
    good = _table(spark, sf_dir, "labels").where("quality = 1")
    return lm_scoring.difference(_table(spark, sf_dir, "documents"), good)


@query("op8_quality_classifier")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text by its nearest labelled texts of three of four folds."""
    docs = _table(spark, sf_dir, "documents")
    model = quality_classifier.train(docs, _table(spark, sf_dir, "labels"), fold("doc_id", 4) != 2)
    found = quality_classifier.score(docs, model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", "predicted")


@query("op3_line_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every line, and whether it is the one kept."""
    found = line_classes(_table(spark, sf_dir, "documents"), fold_case=True)
    return found.select("doc_id", "line_no", "class_doc_id", "class_line_no", "kept")

@query("op11_hard_negatives", """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [CAST(floor(256 * x::DOUBLE) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    CAST(list_sum([a.v[i] * c.v[i] FOR i IN range(1, len(a.v) + 1)]) AS BIGINT) AS score
  FROM e a JOIN e c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.v) = len(c.v)),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of another label that score nearly as high as an anchor's best rows of its own."""
    rows = _table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved))


@query("op13_phrases", r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM t),
f1 AS MATERIALIZED (SELECT lang, phrase, count(*) AS f FROM (SELECT lang, unnest(w) AS phrase FROM p) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
f2 AS MATERIALIZED (
  SELECT lang, phrase, count(*) AS f FROM (SELECT lang, unnest([w[i] || ' ' || w[i+1] FOR i IN range(1, len(w))]) AS phrase FROM p WHERE len(w) > 1)
  GROUP BY ALL HAVING count(*) >= 10),
f3 AS MATERIALIZED (
  SELECT lang, phrase, count(*) AS f
  FROM (SELECT lang, unnest([w[i] || ' ' || w[i+1] || ' ' || w[i+2] FOR i IN range(1, len(w) - 1)]) AS phrase FROM p WHERE len(w) > 2)
  GROUP BY ALL HAVING count(*) >= 10),
f AS MATERIALIZED (SELECT * FROM f1 UNION ALL SELECT * FROM f2 UNION ALL SELECT * FROM f3),
c AS MATERIALIZED (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM f2 UNION ALL SELECT lang, phrase, f, string_split(phrase, ' ') FROM f3),
k AS (SELECT lang, phrase, a, w, unnest(range(1, len(w))) AS k FROM c),
s AS (
  SELECT k.lang, k.phrase, a, k, l.f AS l, r.f AS r, CAST(1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(w[1:k], ' ') JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(w[k+1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
x AS (SELECT lang, phrase, max(f) AS longer FROM (
  SELECT lang, f, unnest([string_split(phrase, ' ')[1] || ' ' || string_split(phrase, ' ')[2],
    string_split(phrase, ' ')[2] || ' ' || string_split(phrase, ' ')[3]]) AS phrase FROM f3) GROUP BY ALL)
SELECT b.lang, row_number() OVER o AS rank, b.phrase, a, l, r, n, score
FROM b JOIN n ON n.lang = b.lang LEFT JOIN x ON x.lang = b.lang AND x.phrase = b.phrase
WHERE 100 * coalesce(longer, 0) < 50 * a
WINDOW o AS (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) QUALIFY row_number() OVER o <= 2000
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's best phrases of two and three words."""
    return phrases(_table(spark, sf_dir, "documents"))


@query("op12_html_extraction")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_texts(_table(spark, sf_dir, "pages"))

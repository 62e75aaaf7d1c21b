"""One thin query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm import exact_dedup, html_text, language, lexical, licences, media, mixing, near_dedup, packing, token_files, top_k, toxicity, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.fair_mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_digests(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = _table(spark, sf_dir, "documents"), language.fold("doc_id", 5) == 0
    model = toxicity.train(docs, _table(spark, sf_dir, "labels").select("doc_id", "toxic"), ~held)
    scores = toxicity.score(docs, model)
    return scores.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20, scale=64)


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = _table(spark, sf_dir, "documents"), language.fold("doc_id", 3) == 1
    model = language.train(docs, ~held)
    return language.identify(docs, model).select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(_table(spark, sf_dir, "pages"))


def op8_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(_table(spark, sf_dir, "documents")).drop("places")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.count_tokens(_table(spark, sf_dir, "documents")).select("doc_id", "n_tokens")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(_table(spark, sf_dir, "documents"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"), components=16)


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_mixing": op2_mixing,
    "op3_media": op3_media,
    "op4_toxicity": op4_toxicity,
    "op5_top_k": op5_top_k,
    "op6_language": op6_language,
    "op7_html": op7_html,
    "op8_licences": op8_licences,
    "op9_token_counts": op9_token_counts,
    "op10_packing": op10_packing,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_lexical": op12_lexical,
    "op13_whitening": op13_whitening,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL = {
    "op1_near_dedup": rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) END) AS sh FROM w),
n AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n_shingles FROM s),
u AS MATERIALIZED (SELECT doc_id, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n_shingles + y.n_shingles - shared)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT n.doc_id, n_shingles, min(r.b) AS component_id, n.doc_id = min(r.b) AS kept
FROM n JOIN r ON r.a = n.doc_id GROUP BY n.doc_id, n_shingles
""",
    "op2_mixing": r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(CAST(doc_id AS VARCHAR)) AS o FROM documents),
t AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
k AS (
  SELECT source, source_size, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight,
    2.0::DOUBLE * source_size AS most, 1.5::DOUBLE * sum(source_size) OVER () AS budget FROM t),
v AS (SELECT *, most / weight AS level FROM k),
f AS (
  SELECT *, sum(most) OVER x + level * (sum(weight) OVER () - sum(weight) OVER x) <= budget AS is_full FROM v
  WINDOW x AS (ORDER BY level, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
c AS (SELECT any_value(budget) AS budget, (any_value(budget) - coalesce(sum(most) FILTER (is_full), 0)) / sum(weight) FILTER (NOT is_full) AS level FROM f),
g AS (SELECT f.source, source_size, CASE WHEN is_full THEN most ELSE weight * c.level END AS target, c.budget FROM f, c),
p AS (
  SELECT d.*, source_size, target, budget, sum(size) OVER (PARTITION BY d.source ORDER BY o, doc_id, size ROWS UNBOUNDED PRECEDING) AS e
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
q AS (SELECT p.*, copy, (copy * source_size + e)::DOUBLE / target AS finish FROM p, (VALUES (0), (1)) x(copy) WHERE size > 0 AND target > 0),
z AS (SELECT doc_id, size, sum(size) OVER (ORDER BY finish, source NULLS LAST, copy, o, doc_id ROWS UNBOUNDED PRECEDING) <= budget AS got FROM q),
m AS (SELECT doc_id, sum(size) FILTER (got) AS taken FROM z GROUP BY doc_id)
SELECT p.doc_id, p.size, p.source_size, p.target, CAST(coalesce(m.taken, 0) AS BIGINT) AS taken FROM p LEFT JOIN m USING (doc_id)
""",
    "op5_top_k": r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64.0 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op11_exact_dedup": f"""
WITH d AS (SELECT doc_id, {_LOWER} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER x AS keep_id, count(*) OVER x AS group_size, doc_id = max(doc_id) OVER x AS kept, sha256(t) AS text_sha256
FROM d WINDOW x AS (PARTITION BY t)
""",
    "op12_lexical": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
n AS (SELECT doc_id, CAST(len(ts) AS BIGINT) AS n FROM d WHERE len(ts) > 0),
c AS (SELECT CAST(count(*) AS BIGINT) AS all_docs, CAST(sum(n) AS BIGINT) AS all_terms FROM n),
p AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(ts) AS t FROM d) GROUP BY doc_id, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * any_value(all_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE)) AS BIGINT) AS w FROM p, c GROUP BY t),
q AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
s AS (
  SELECT q.item_id, p.doc_id, CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n.n * all_docs) // all_terms)))) AS BIGINT) AS score
  FROM q JOIN p ON p.t = q.t JOIN w ON w.t = q.t JOIN n ON n.doc_id = p.doc_id, c GROUP BY q.item_id, p.doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
""",
}

"""The registered queries of this subpackage and their SQL.

Each ``opN_`` query applies one operator with its production parameters to its
whole table and derives the columns that its contract names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from . import html, langid, licenses, lm, negatives, pieces, pii, prefixes, secrets, setsketch, tiling, topk, toxicity
from .common import in_fold, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 5, 0)
    model = langid.train(documents, ~held_out)
    return langid.identify(documents, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    held_out = in_fold("doc_id", 5, 0)
    model = toxicity.train(documents, table(spark, sf_dir, "labels"), ~held_out)
    return toxicity.score(documents, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "offending")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html.main_text(pages, html.train(pages)).withColumn("n_chars", F.length("text").cast("long"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantized(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"), threshold=0.85)


def _listed(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _digest(spans: DataFrame, base: dict[str, str]) -> DataFrame:
    """Counts of the base kinds, the digest of their spans, and all spans."""
    kinds = F.transform("spans", lambda s: s["kind"])
    counts = [F.size(F.array_remove(F.transform(kinds, lambda k: F.when(k == kind, 1).otherwise(0)), 0)).cast("long").alias(column) for kind, column in base.items()]
    of_base = F.filter("spans", lambda s: s["kind"].isin(*base))
    return spans.select("doc_id", *counts, F.sha2(_listed(of_base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"), in_fold("doc_id", 7, 2))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(secrets.find_secrets(table(spark, sf_dir, "documents")), {"assign": "n_assign", "access": "n_access", "hex": "n_hex"})


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.with_pieces(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "ids", "round_trip")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(pii.find_pii(table(spark, sf_dir, "documents")), {k: f"n_{k}" for k in ("email", "ip", "card", "phone")})


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(negatives.labelled(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)


def _labels(detections: Column) -> Column:
    """Distinct labels of detections, sorted, comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda d: d["label"]))), ",")


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.find_licenses(table(spark, sf_dir, "documents")).withColumn("places", F.filter("detections", lambda d: d["base"]))
    starts = F.transform("places", lambda d: d["start"].cast("long"))
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _labels(F.col("places")).alias("base_labels"), _labels(F.col("detections")).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["confidence"])), F.lit(0.0)).alias("score"),
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    rebuilt, lengths = prefixes.rebuilt_turns(prefixes.ordered_turns(table(spark, sf_dir, "conversations")))
    nodes = prefixes.prefix_trie(rebuilt, lengths)
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256")


QUERIES: dict[str, Query] = {
    "op1_language_id": op1_language_id,
    "op2_decontamination": op2_decontamination,
    "op3_toxicity": op3_toxicity,
    "op4_html_text": op4_html_text,
    "op5_top_k": op5_top_k,
    "op6_near_duplicates": op6_near_duplicates,
    "op7_language_model": op7_language_model,
    "op8_secrets": op8_secrets,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_pii": op10_pii,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_license_scan": op12_license_scan,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES: dict[str, str] = {
    "op5_top_k": r"""
WITH vectors AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 50 = 0
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scores
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
""",
    "op11_hard_negatives": r"""
WITH vectors AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, a.v AS av, a.label AS al, c.vec_id, c.label = a.label AS same,
         CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM vectors a JOIN vectors c ON len(a.v) = len(c.v) AND (a.vec_id <> c.vec_id OR a.label <> c.label OR a.v <> c.v)
  WHERE a.vec_id % 100 = 0
),
positives AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY anchor_id, av, al ORDER BY score DESC, vec_id) AS place FROM scores WHERE same)
  WHERE place <= 5
),
ranked AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.av, p.al, p.place ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND s.av = p.av AND s.al = p.al AND NOT s.same
   AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
""",
    "op13_prefix_trie": r"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(md5(coalesce(role, '')) || coalesce(text, ''))) - 1 AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT c, count(*) AS n FROM turns GROUP BY c),
-- crc32 of the decimal id: bytes go in, then eight shifts each.
steps AS (
  SELECT c, n, list_concat([4294967295], flatten(list_transform(string_split(CAST(c AS VARCHAR), ''),
    lambda x: [CAST(ascii(x) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))) AS s
  FROM convs
),
plan AS (
  SELECT c, n, c - c % 5 AS first,
         xor(list_reduce(s, lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN (a & 1) = 1 THEN xor((a >> 1), 3988292384) ELSE (a >> 1) END), 4294967295) % 9 AS h
  FROM steps
),
planned AS (
  SELECT p.*, least(p.h, coalesce(b.n, 0)) AS taken FROM plan p LEFT JOIN convs b ON b.c = p.first
),
rebuilt AS (
  SELECT p.c, t.place + 1 AS d, t.role, t.text FROM planned p JOIN turns t ON t.c = p.first AND t.place < p.taken
  UNION ALL
  SELECT p.c, t.place - p.h + p.taken + 1, t.role, t.text FROM planned p JOIN turns t ON t.c = p.c AND t.place >= p.h
),
sequences AS (
  SELECT c, d, strlen(text) AS bytes, list(md5(md5(role) || text)) OVER (PARTITION BY c ORDER BY d) AS so_far FROM rebuilt
),
rows AS (
  SELECT c, d, bytes, md5(array_to_string(so_far, ',')) AS node, CASE WHEN d = 1 THEN 'root' ELSE md5(array_to_string(so_far[:d - 1], ',')) END AS parent
  FROM sequences
  UNION ALL
  SELECT c, 0, 0, 'root', NULL FROM convs
),
lengths AS (SELECT c, max(d) AS length FROM rows GROUP BY c),
nodes AS (
  SELECT node, any_value(parent) AS parent, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own
  FROM rows GROUP BY node
),
children AS (SELECT parent AS node, count(*) AS n FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
ends AS (
  SELECT node, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest FROM rows JOIN lengths USING (c) WHERE d = length GROUP BY node
),
below AS (
  SELECT r.node, count(*) FILTER (children.n IS NULL) AS leaves, sum(v.own) AS saved
  FROM nodes v LEFT JOIN children ON children.node = v.node JOIN rows r ON r.c = v.conv_id AND r.d <= v.depth
  GROUP BY r.node
)
SELECT v.conv_id, CAST(v.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(children.n, 0) AS n_children,
       below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, coalesce(ends.digest, sha256('')) AS ends_sha256
FROM nodes v JOIN below ON below.node = v.node LEFT JOIN nodes p ON p.node = v.parent
LEFT JOIN children ON children.node = v.node LEFT JOIN ends ON ends.node = v.node
""",
    "op6_near_duplicates": r"""
WITH RECURSIVE words AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
),
shingles AS (SELECT doc_id, unnest(s) AS shingle FROM sets),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y USING (shingle) WHERE x.doc_id < y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)
),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM sets
  UNION
  SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other
),
components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN components USING (doc_id)
""",
}

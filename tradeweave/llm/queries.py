"""The registered queries of this subpackage: thin readers around the operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.llm.common import table


def op1_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.substring_dedup import substring_dedup

    docs = table(spark, sf, "documents").select("doc_id", "text")
    return substring_dedup(docs, 20, with_text=False).select("row.doc_id", "n_words", "n_removed", "kept_sha256")


def op2_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.jaccard_join import jaccard_join

    found = jaccard_join(table(spark, sf, "documents").select("doc_id", "text"), n=5, threshold=0.8)
    return found.drop("key", "content")


def op3_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.toxicity import toxicity

    return toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op4_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.decontamination import contamination

    found = contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    ids = F.sha2(F.array_join("items", ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", ids.alias("items_sha256"), "contaminated")


def op5_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from tradeweave.llm.byte_bpe import encode

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = encode(table(spark, sf, "documents"), path, public_tokenizers.PATTERN, digests=True)
    return found.select("row.doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


def op6_quality_model(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.quality_model import quality

    found = quality(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.select("row.doc_id", "row.lang", "perplexity", "highest", "keep")


def op7_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    from tradeweave.llm.token_counts import token_counts

    return token_counts(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048)


def op8_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.exact_topk import exact_topk

    return exact_topk(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


#: The listed rules.
URL_RULES = [
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"),
]


def op9_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.url_filters import judge_urls

    return judge_urls(table(spark, sf, "pages"), URL_RULES)


def op10_license_scans(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.license_scans import license_scan

    return license_scan(table(spark, sf, "documents"))


def op11_hard_negatives(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.hard_negatives import hard_negatives

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, label)


def op12_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.simhash_dedup import simhash_dedup

    return simhash_dedup(table(spark, sf, "documents"), size=4, seed=42, within=4)


def op13_importance_resampling(spark: SparkSession, sf: str) -> DataFrame:
    from tradeweave.llm.importance_resampling import resample

    found = resample(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_jaccard_join": op2_jaccard_join,
        "op3_toxicity": op3_toxicity,
        "op4_decontamination": op4_decontamination,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_quality_model": op6_quality_model,
        "op7_token_counts": op7_token_counts,
        "op8_exact_topk": op8_exact_topk,
        "op9_url_filters": op9_url_filters,
        "op10_license_scans": op10_license_scans,
        "op11_hard_negatives": op11_hard_negatives,
        "op12_simhash_dedup": op12_simhash_dedup,
        "op13_importance_resampling": op13_importance_resampling,
        "pipeline": pipeline,
    }


_PLAIN = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
win AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS nth FROM (
    SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20))
),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM win WHERE nth > 1),
kept AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.i) AS text, count(*) AS n
  FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i WHERE gone.i IS NULL GROUP BY word.doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(len(d.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON k.doc_id = d.doc_id"""

OP4_SQL = f"""
WITH it AS (SELECT CAST(item_id AS VARCHAR) AS item, {_PLAIN} AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item, size, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win
  FROM (SELECT item, w, least(13, len(w)) AS size, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM it WHERE len(w) > 0)
),
d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
place AS (
  SELECT doc_id, size, i, array_to_string(list_slice(w, i, i + size - 1), ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM d CROSS JOIN (SELECT DISTINCT size FROM win) s WHERE len(w) >= size)
),
hit AS (SELECT p.doc_id, p.i, p.size, x.item FROM place p JOIN win x ON x.win = p.win AND x.size = p.size),
covered AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS i FROM hit) c GROUP BY doc_id),
owned AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) o GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(o.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(o.items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AND 20 * coalesce(c.n, 0) >= len(d.w) AS contaminated
FROM d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN owned o ON o.doc_id = d.doc_id"""

OP8_SQL = """
WITH part AS (
  SELECT vec_id, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS i, len(embedding) AS size
  FROM embeddings WHERE vec_id IS NOT NULL
),
usable AS (SELECT vec_id FROM part GROUP BY vec_id HAVING count(x) = count(*) AND bool_and(isfinite(x))),
whole AS (
  SELECT p.vec_id, p.i, p.size, CAST(floor(64 * CAST(p.x AS DOUBLE)) AS BIGINT) AS v FROM part p JOIN usable u ON u.vec_id = p.vec_id
),
score AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.v * c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON c.i = q.i AND c.size = q.size AND c.vec_id <> q.vec_id
  WHERE q.vec_id % 20 = 0 GROUP BY q.vec_id, c.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM score) r
WHERE rank <= 20"""


OP11_SQL = """
WITH given AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding,
    row_number() OVER () AS row
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
),
part AS (
  SELECT row, unnest(embedding) AS x, unnest(range(1, len(embedding) + 1)) AS i, len(embedding) AS size FROM given
),
usable AS (SELECT row FROM part GROUP BY row HAVING count(x) = count(*) AND bool_and(isfinite(x))),
whole AS (
  SELECT g.row, g.vec_id, g.label, p.i, p.size, CAST(floor(256 * CAST(p.x AS DOUBLE)) AS BIGINT) AS v
  FROM part p JOIN usable u ON u.row = p.row JOIN given g ON g.row = p.row
),
score AS (
  SELECT a.row, a.vec_id AS anchor_id, a.label AS own, c.row AS other, c.vec_id, c.label, CAST(sum(a.v * c.v) AS BIGINT) AS score
  FROM whole a JOIN whole c ON c.i = a.i AND c.size = a.size
  WHERE a.vec_id % 100 = 0 GROUP BY ALL
),
near AS (
  SELECT *, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id) AS nth
  FROM score WHERE label = own AND vec_id <> anchor_id
),
far AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    CAST(row_number() OVER (PARTITION BY p.row, p.nth ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank
  FROM near p JOIN score n ON n.row = p.row AND n.label <> n.own
    AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
  WHERE p.nth <= 5
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM far WHERE rank <= 10"""

# CRC-32 bit by bit and byte by byte: a table made from the rule, applied to the bytes of each different word.
OP13_SQL = rf"""
WITH RECURSIVE step(value, crc, n) AS (
  SELECT range, CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL
  SELECT value, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, CAST(3988292384 AS BIGINT)) ELSE crc >> 1 END, n + 1 FROM step WHERE n < 8
),
crcs AS (SELECT list(crc ORDER BY value) AS steps FROM step WHERE n = 8),
d AS (SELECT doc_id, row_number() OVER () AS row, {_PLAIN} AS w FROM documents),
dw AS (SELECT row, unnest(w) AS word FROM d),
bw AS (SELECT unnest({_PLAIN}) AS word FROM benchmark),
word AS (SELECT word, hex(encode(word)) AS h FROM (SELECT word FROM dw UNION SELECT word FROM bw) u),
bucket AS (
  SELECT word, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
      list_transform(range(1, len(h), 2), lambda i: CAST(16 * (instr('0123456789ABCDEF', h[i]) - 1) + instr('0123456789ABCDEF', h[i + 1]) - 1 AS BIGINT))),
      lambda c, b: xor(c >> 8, steps[xor(c & 255, b) + 1])), CAST(4294967295 AS BIGINT)) % 10000 AS bucket
  FROM word, crcs
),
s AS (SELECT bucket, count(*) AS n FROM dw JOIN bucket USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM bw JOIN bucket USING (word) GROUP BY bucket),
gain AS (
  SELECT b.bucket, CAST(floor(1000 * ln(((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE)
    / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM bucket) b LEFT JOIN s ON s.bucket = b.bucket LEFT JOIN t ON t.bucket = b.bucket
),
weighed AS (
  SELECT row, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM dw JOIN bucket USING (word) JOIN gain USING (bucket) GROUP BY row
),
drawn AS (
  SELECT d.doc_id, d.row, CAST(len(d.w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(range(1, 9),
      lambda i: CAST(instr('0123456789abcdef', sha256('2024:' || coalesce(CAST(d.doc_id AS VARCHAR), ''))[i]) - 1 AS BIGINT))), lambda a, b: a * 16 + b) AS h
  FROM d LEFT JOIN weighed w ON w.row = d.row
),
scored AS (SELECT *, CAST(weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM drawn),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
    count(*) OVER (PARTITION BY n_features >= 20) AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND place <= 10 * n // 100 THEN place END AS rank FROM ranked"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": OP1_SQL, "op4_decontamination": OP4_SQL, "op8_exact_topk": OP8_SQL,
        "op11_hard_negatives": OP11_SQL, "op13_importance_resampling": OP13_SQL,
    }

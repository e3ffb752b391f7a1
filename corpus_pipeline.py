"""From raw documents to encoded training text: five stages, each written as Parquet before the next reads it.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with all their columns; the last
one adds the encoding. An empty table passes through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.llm.byte_bpe import encode
from tradeweave.llm.common import key_of, scratch, settle, table
from tradeweave.llm.decontamination import contamination
from tradeweave.llm.jaccard_join import jaccard_join
from tradeweave.llm.quality_model import quality
from tradeweave.llm.substring_dedup import substring_dedup

#: No SQL: perplexity under a model, MinHash groups and byte-pair merges are beyond it.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the language model of trusted text finds unlikely for their language."""
    judged = quality(docs, table(spark, sf_dir, "labels"), columns=docs.columns)
    return judged.where("keep").select("row.*")


def _named(docs: DataFrame) -> DataFrame:
    """Each row as a struct, so that its columns may have any name, beside its id and a hash of its text."""
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), key_of().alias("key"), F.xxhash64("text").alias("content"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep of each group of copies and near copies the document with the smallest doc_id, once.

    A document is its doc_id and text; one without doc_id is each row's own, and without words it has no copies.
    """
    named, document = _named(docs), ["key", "content"]
    alone = F.col("row.doc_id").isNull() & ~F.coalesce(F.col("row.text").rlike(r"[^\x09-\x0D\x20]"), F.lit(False))
    first = jaccard_join(docs.select("doc_id", "text")).where("is_first").select(*document).distinct()
    kept = named.where(~alone).join(first, document, "left_semi").dropDuplicates(document)
    return kept.unionByName(named.where(alone)).select("row.*")


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut passages of 20 words or more that stand in an earlier place; drop documents of which nothing is left."""
    cut = substring_dedup(docs).where("n_removed < n_words OR n_words = 0")
    made = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return cut.select(*[made[c].alias(c) if c in made else F.col("row").getField(c).alias(c) for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of whose words a twentieth or more stands in passages of the benchmark."""
    found = contamination(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark")).where("contaminated")
    bad = found.select("key", "content").distinct()
    return _named(docs).join(bad, ["key", "content"], "left_anti").select("row.*")


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every text and what they decode to, as digests; they replace columns of the same names."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    found = encode(docs, path, public_tokenizers.PATTERN, digests=True, keep=docs.columns)
    made = {"n_tokens": "n_tokens", "ids_sha256": "ids", "decoded_sha256": "decoded"}
    kept = [F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in made]
    return found.select(*kept, *[F.col(c).alias(name) for name, c in made.items()])


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("substring dedup", substring_stage),
    ("benchmark decontamination", decontamination_stage),
    ("byte-level BPE", encoding_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir; each is stored and read again."""
    tmp = scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = tmp.store(stage(spark, docs, sf_dir), f"stage{i}")
        settle(spark)
    return docs

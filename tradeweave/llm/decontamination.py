"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

A benchmark window is contained in a document only if its rarest word is. So each window is filed under
that word (counted over all documents) and its place in the window; documents meet windows by a join of
their words with these few. Of a candidate place, the bounds (the window must lie within the document)
are checked first and then the words themselves, which makes the answer exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.common import key_of, scratch, settle

# Words are runs of letters a-z, digits and non-ASCII after A-Z are lower-cased. Texts are cut at what
# stands between words, which takes a tenth of the time of extracting each word.
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words under which windows are filed, and characters of the windows, that one broadcast holds at most.
PROBES, PROBE_CHARS = 100_000, 16_000_000


def words(text: str = "text") -> Column:
    return _cut(F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER))


def _cut(text: Column) -> Column:
    return F.array_remove(F.split(text, _GAP, -1), "")  # empty only ahead of a first and behind a last gap


def count_words(text: str = "text") -> Column:
    return F.size(_cut(F.coalesce(F.col(text), F.lit(""))))


def windows_of(items: DataFrame, size: int) -> DataFrame:
    """(item, window) of every run of `size` words; an item of fewer words, but not none, is one window."""
    runs = F.transform(F.sequence(F.lit(1), F.size("w") - (size - 1)), lambda i: F.slice("w", i, size))
    windows = F.when(F.size("w") >= size, runs).otherwise(F.array("w"))
    return (
        items.where("item_id IS NOT NULL").select(F.col("item_id").cast("string").alias("item"), words().alias("w")).where(F.size("w") > 0)
        .select("item", F.explode(F.array_distinct(windows)).alias("window"))
    )


def _blocks(probes: DataFrame) -> list[DataFrame]:
    """Parts of the filed windows, each small enough to be broadcast."""
    n, chars = probes.agg(F.count("*"), F.coalesce(F.sum(F.length(F.array_join("window", " "))), F.lit(0))).first()
    parts = max(-(-n // PROBES), -(-chars // PROBE_CHARS), 1)
    return [probes.where(F.pmod(F.xxhash64("word", "window"), F.lit(parts)) == i) if parts > 1 else probes for i in range(parts)]


def _word_counts(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """How often each word of the benchmark occurs in all documents."""
    n = vocabulary.count()
    parts = -(-n // PROBES) or 1
    found = []
    for i in range(parts):
        part = vocabulary.where(F.pmod(F.xxhash64("word"), F.lit(parts)) == i) if parts > 1 else vocabulary
        found.append(docs.select(F.explode(words()).alias("word")).join(F.broadcast(part), "word"))
    return reduce(DataFrame.unionByName, found).groupBy("word").agg(F.count("*").alias("n"))


def contamination(docs: DataFrame, items: DataFrame, size: int = 13, share: int = 20) -> DataFrame:
    """How much of each document stands in windows of the benchmark.

    docs: doc_id, text; items: item_id, text. Per row of docs: doc_id, n_words, n_hit (words inside an
    occurrence of a window), n_items (items with an occurring window), items (their ids as strings, sorted)
    and contaminated (n_hit > 0 and share * n_hit >= n_words). A null text has no words; an item without id
    or words takes no part; items that share an id are one. Rows that repeat or share a doc_id are each
    answered for their own text.

    Windows are filed in blocks of PROBES; each block is broadcast and met by all documents in one pass.
    """
    spark = docs.sparkSession
    tmp = scratch(spark, "benchmark")
    filed = tmp.store(windows_of(items, size), "windows")
    distinct = filed.select("window").distinct()
    vocabulary = tmp.store(distinct.select(F.explode("window").alias("word")).distinct(), "vocabulary")
    counts = tmp.store(_word_counts(docs, vocabulary), "counts")
    rarest = (
        distinct.select("window", F.posexplode("window").alias("place", "word")).join(counts, "word", "left")
        .groupBy("window").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("least"))
        .where("least.n > 0")  # a word that no document has
        .select("window", "least.word", "least.place", F.size("window").alias("len"))
    )
    probes = tmp.store(rarest, "probes")
    rows = docs.select(key_of().alias("key"), F.xxhash64("text").alias("content"), words().alias("w"))
    places = rows.select("key", "content", "w", F.posexplode("w").alias("at", "word"))
    start = F.col("at") - F.col("place")
    met = [
        places.join(F.broadcast(block), "word")
        .where((start >= 0) & (start + F.col("len") <= F.size("w")))
        .where(F.slice("w", start + 1, F.col("len")) == F.col("window"))
        .select("key", "content", start.alias("start"), "len", "window")
        for block in _blocks(probes)
    ]
    hits = tmp.store(reduce(DataFrame.unionByName, met).distinct(), "hits")
    settle(spark)
    positions = hits.select("key", "content", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("at")).distinct()
    covered = positions.groupBy("key", "content").agg(F.count("*").alias("n_hit"))
    owned = hits.select("key", "content", "window").distinct().join(filed, "window").groupBy("key", "content").agg(
        F.array_sort(F.collect_set("item")).alias("items"))
    found = covered.join(owned, ["key", "content"])
    answer = docs.select("doc_id", key_of().alias("key"), F.xxhash64("text").alias("content"), count_words().cast("long").alias("n_words"))
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return answer.join(found, ["key", "content"], "left").select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (F.lit(share) * n_hit >= F.col("n_words"))).alias("contaminated"), "key", "content")

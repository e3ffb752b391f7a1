"""Target-distribution importance resampling over hashed word n-grams, whose hashes come from prefix CRCs.

A document's words, each with one blank before it, are scanned once; the running CRC-32 at every word end is
kept. The CRC of a run of words then follows from two of these prefixes: appending n bytes multiplies a CRC by
x^(8n) in GF(2) modulo the CRC's polynomial, so the prefix before the run, shifted by the run's length, is
cancelled from the prefix at its end. No run is cut out or hashed by itself, whatever its length.

Buckets of all documents and of the target texts are counted; a bucket's gain is the logarithm of how much more
frequent it is in the target; a document's weight is the mean gain of its runs. Documents are drawn without
replacement by adding a Gumbel variable, a function of the seed and doc_id, and taking the largest sums.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.common import in_arrow, scratch, steps
from tradeweave.operators.numbering import number_rows

#: Lower-cases A-Z and turns every separator into a blank.
_PLAIN = bytes(c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256))


class _Shift:
    """Multiplication of CRC registers by x^(8n) for many n at once: one table of four bytes by 256 for each power of two."""

    def __init__(self):
        step = np.arange(256, dtype=np.uint32)
        for _ in range(8):
            step = np.where(step & np.uint32(1), (step >> np.uint32(1)) ^ np.uint32(0xEDB88320), step >> np.uint32(1))
        self.step = step
        values = np.arange(256, dtype=np.uint32)
        one = np.stack([self.zero_byte(values << np.uint32(8 * b)) for b in range(4)])
        self.tables = [one]
        while len(self.tables) < 32:
            last = self.tables[-1]
            self.tables.append(np.stack([self._apply(last, row) for row in last]))

    def zero_byte(self, crc: np.ndarray) -> np.ndarray:
        return self.step[crc & np.uint32(255)] ^ (crc >> np.uint32(8))

    def blank(self, crc: np.ndarray) -> np.ndarray:
        """CRC of the bytes so far and one blank."""
        return ~self.zero_byte(~crc ^ np.uint32(0x20))

    @staticmethod
    def _apply(table: np.ndarray, crc: np.ndarray) -> np.ndarray:
        out = table[0][crc & np.uint32(255)]
        for b in range(1, 4):
            out = out ^ table[b][(crc >> np.uint32(8 * b)) & np.uint32(255)]
        return out

    def __call__(self, crc: np.ndarray, size: np.ndarray) -> np.ndarray:
        out = crc.copy()
        for k in range(int(size.max(initial=0)).bit_length()):
            some = np.flatnonzero((size >> k) & 1)
            out[some] = self._apply(self.tables[k], out[some])
        return out


_shift = _Shift()


class PrefixCrcs:
    """Running CRCs of a few documents, and from them the CRC of every run of their words.

    words: the number of words of each document; end[i]: CRC of its document up to word i, a blank before each word.
    """

    def __init__(self, texts: list[bytes]):
        split = [t.translate(_PLAIN).split() for t in texts]
        self.words = np.array([len(w) for w in split], np.int64)
        self.size = np.array([len(w) for words in split for w in words], np.int64)
        ends: list[int] = []
        for words in split:
            crc = 0
            ends.extend([crc := crc32(b" " + w, crc) for w in words])
        self.end = np.array(ends, np.uint32)
        self.doc = np.repeat(np.arange(len(texts)), self.words)
        first = np.zeros(len(self.end), bool)
        first[(np.cumsum(self.words) - self.words)[self.words > 0]] = True
        before = np.concatenate([np.zeros(1, np.uint32), self.end[:-1]]) if len(self.end) else self.end
        self.before = _shift.blank(np.where(first, np.uint32(0), before))  # up to the blank before each word
        self.total = np.concatenate([[0], np.cumsum(self.size + 1)])  # bytes up to each word, blanks included

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(document, CRC-32) of each run of n words joined by one blank."""
        at = np.arange(max(0, len(self.end) - n + 1))
        at = at[self.doc[at] == self.doc[at + n - 1]]
        size = self.total[at + n] - self.total[at] - 1
        return self.doc[at], self.end[at + n - 1] ^ _shift(self.before[at], size)


def _buckets(found: PrefixCrcs, longest: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for n in range(1, longest + 1):
        doc, crc = found.runs(n)
        yield doc, (crc % np.uint32(buckets)).astype(np.int64)


def _count(longest: int, buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for _, texts in steps(batches, "text"):
            for _, bucket in _buckets(PrefixCrcs(texts), longest, buckets):
                counts += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(some, pa.int64()), pa.array(counts[some])], ["bucket", "n"])

    return work


def bucket_counts(texts: DataFrame, longest: int, buckets: int) -> np.ndarray:
    """How many runs of all texts fall into each bucket; one row a bucket and task, one array in the driver."""
    found = in_arrow(texts.select("text"), _count(longest, buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(buckets, np.int64)
    out[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole thousandths of the logarithm of how much more frequent each bucket is in the target; one is added to each."""
    wide_s, wide_t = float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1.0) * wide_s / ((s + 1.0) * wide_t))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def _weigh(longest: int, shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = shared.value
        for batch, texts in steps(batches, "text"):
            crcs = PrefixCrcs(texts)
            total, n = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for doc, bucket in _buckets(crcs, longest, len(gain)):
                np.add.at(total, doc, gain[bucket])
                n += np.bincount(doc, minlength=len(texts))
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(crcs.words), pa.array(n), pa.array(total // np.maximum(n, 1))],
                ["doc_id", "n_words", "n_features", "weight"])

    return work


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, percent: int = 10,
             least_words: int = 20, seed: int = 2024) -> DataFrame:
    """For every row of docs (doc_id, text): doc_id, n_features, weight, score, rank and n_words, all long.

    target (text): texts whose distribution is wanted. Words are runs of digits, a-z (A-Z lower-cased) and whatever
    is not ASCII; features are all runs of 1 to `longest` consecutive words, repeats counted, hashed by CRC-32 modulo
    `buckets`. weight: floored mean gain (no features: 0). score: weight and a Gumbel variable of `seed` and doc_id, in
    thousandths. rank: 1, 2, 3... for the floor(percent * N / 100) highest scores of the N documents with least_words
    words or more, ties to the smaller doc_id; null for the others.

    A null or empty text has no words. A null doc_id stays null, draws with the empty id and stands before the others
    in ties. Repeated rows count as often as they stand there, each with a rank of its own. An empty target only
    spreads its counts evenly; an empty docs gives no rows.

    Texts are scanned twice, to count and to weigh; only doc_id and five numbers a row are stored. The histogram of
    scores in the driver has one entry per whole thousandth between the least and the greatest sum of a gain and a
    Gumbel variable, some 60,000 in all, whatever the number of rows.
    """
    spark = docs.sparkSession
    tmp = scratch(spark, "resample")
    gain = gains(bucket_counts(docs, longest, buckets), bucket_counts(target, longest, buckets))
    shared = spark.sparkContext.broadcast(gain)  # one number a bucket
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = T.StructType().add("doc_id", "long").add("n_words", "long").add("n_features", "long").add("weight", "long")
    text_id = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), text_id), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = in_arrow(slim, _weigh(longest, shared), out).withColumn("score", F.col("weight") + noise)
    scored = tmp.store(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    eligible = F.col("n_words") >= least_words
    heights = sorted(((r["score"], r["n"]) for r in scored.where(eligible).groupBy("score").agg(F.count("*").alias("n")).collect()), reverse=True)
    wanted, least, seen = percent * sum(n for _, n in heights) // 100, None, 0
    for score, n in heights:
        if seen >= wanted:
            break
        least, seen = score, seen + n
    reached = (eligible & (F.col("score") >= least)) if least is not None else F.lit(False)
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    below = scored.where(~reached).withColumn("rank", F.lit(None).cast("long")).select(*columns)
    if least is None:
        return below
    drawn = scored.where(reached).withColumn("_all", F.lit(0))
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), "_row"]
    placed = number_rows(drawn, "_all", order, "place", tmp, "ranked")
    return placed.withColumn("rank", F.when(F.col("place") <= wanted, F.col("place"))).select(*columns).unionByName(below)

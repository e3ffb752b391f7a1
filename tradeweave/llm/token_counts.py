"""Token counts by a two-tier lookup: a broadcast table of frequent pre-tokens, then worker caches.

The count of a text is the sum of the counts of its pre-tokens. One pass gathers in each task the most
frequent pre-tokens (a bounded table, thinned as it fills), a small aggregation keeps the most frequent
of all, and their counts go to every task. Whatever is not in that table is encoded by the tokenizer's
own library once per worker and remembered. No pre-token is shuffled; the table decides only speed.
"""

from __future__ import annotations

import functools
import os
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.byte_bpe import WHITE
from tradeweave.llm.common import in_arrow, steps

#: Entries: of the broadcast table, that one task reports, that it holds while counting, of a worker's cache.
FREQUENT, REPORTED, HELD, REMEMBERED = 1 << 16, 1 << 14, 1 << 18, 200_000

# The pre-token pattern of the vocabulary file, in general and for text below U+0250.
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
_GENERAL = regex.compile(rf"{_ENDINGS}|[\p{{L}}]+|[\p{{N}}]|[^{WHITE}\p{{L}}\p{{N}}]+")
_LATIN = re.compile(
    _ENDINGS + r"|[a-z\xAA\xB5\xBA\xDF-\xF6\xF8-ɏ]+|[0-9\xB2\xB3\xB9\xBC-\xBE]"
    r"|[^\t-\r \x85\xA0a-z\xAA\xB5\xBA\xDF-\xF6\xF8-ɏ0-9\xB2\xB3\xB9\xBC-\xBE]+")
#: Text whose normal form and lower case need the library.
_ODD = re.compile(r"[^\x00-įı-ɏ]")


@functools.lru_cache(maxsize=2)
def _library(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, re.compile("|".join(map(re.escape, special)) or r"(?!)")


class PreTokens:
    """Pre-tokens of a text as the vocabulary file's own normalizer and splitter give them."""

    def __init__(self, path: str):
        self.tokenizer, self.special = _library(path)

    def split(self, text: str) -> list[str]:
        if _ODD.search(text):
            return _GENERAL.findall(self.tokenizer.normalizer.normalize_str(text))
        return _LATIN.findall(text.lower())

    def of(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens, and the number of special strings, which stand for themselves."""
        if "<|" not in text:
            return self.split(text), 0
        parts = self.special.split(text)
        return [p for part in parts for p in self.split(part)], len(parts) - 1


class _Lengths(dict):
    """Cache over the frequent table; a miss is encoded by the library."""

    def __init__(self, frequent: dict[str, int], tokenizer):
        super().__init__(frequent)
        self.frequent, self.tokenizer = frequent, tokenizer

    def __missing__(self, piece: str) -> int:
        if len(self) >= len(self.frequent) + REMEMBERED:
            self.clear()
            self.update(self.frequent)
        n = self[piece] = len(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        return n


def _frequent_in_task(path: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, seen = PreTokens(path), Counter()
        for _, texts in steps(batches, "text"):
            for text in texts:
                seen.update(pieces.of(text.decode())[0])
            if len(seen) > HELD:
                seen = Counter(dict(seen.most_common(HELD // 4)))
        top = seen.most_common(REPORTED)
        yield pa.record_batch([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["piece", "n"])

    return work


def frequent_lengths(docs: DataFrame, path: str) -> dict[str, int]:
    """Token counts of the FREQUENT most frequent pre-tokens; a bounded table, so it may be broadcast."""
    found = in_arrow(docs.select("text"), _frequent_in_task(path), "piece string, n long")
    top = found.groupBy("piece").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "piece").limit(FREQUENT)
    tokenizer, _ = _library(path)
    return {r.piece: len(tokenizer.encode(r.piece, add_special_tokens=False).ids) for r in top.select("piece").toLocalIterator()}


def _count(path: str, shared):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = PreTokens(path)
        lengths = _lengths(path, shared)
        for batch, texts in steps(batches, "text"):
            counts = []
            for text in texts:
                found, special = pieces.of(text.decode())
                counts.append(sum(map(lengths.__getitem__, found)) + special)
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"])

    return work


_workers: dict[str, _Lengths] = {}


def _lengths(path: str, shared) -> _Lengths:
    """One cache for each worker and broadcast table."""
    table = shared.value
    if path not in _workers or _workers[path].frequent is not table:
        _workers[path] = _Lengths(table, _library(path)[0])
    return _workers[path]


def token_counts(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every whole text.

    A null text is empty; special strings inside a text count as the library's default has them, once each;
    no begin, end, truncation or padding. Repeated rows give repeated rows; a null doc_id is kept.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(frequent_lengths(docs, path))
    out = T.StructType([docs.schema["doc_id"]]).add("n_bytes", "long").add("n_tokens", "long")
    counted = in_arrow(docs.select("doc_id", "text"), _count(path, shared), out)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)

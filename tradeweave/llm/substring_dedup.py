"""Substring deduplication by relative Lempel-Ziv factors against the corpus itself.

The reference is every earlier stretch of the corpus, cut into blocks: consecutive windows that share the same anchor (the
smallest hash among the six-word runs of a window), so that equal passages are cut alike wherever they stand. Blocks are indexed by
their anchor and content, and the windows of blocks that differ in part by themselves; each entry names its first place (document
and word). A document looks up its blocks and then its windows, and is parsed from left to right: a window
that the index knows starts a factor, which grows word by word as long as its source goes on at the next place; words that no entry
covers are literals. Factors are thus at least one window long, and become duplicate spans. Windows across the end of a factor,
which the parse steps over, are checked by themselves and add to the spans. The result equals comparing every window with every earlier window.

A factor is the longest one from the first place of its first window, not the longest from any place: that one would need
every place of a common passage in one task. The words covered are the same.

What moves: one anchor per seven words, then only blocks whose anchor occurs in two documents. All
tables are grouped by hashes of content, so copies and common passages are reduced in each task
before they meet; joins whose anchor is frequent are split by adaptive execution.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.common import Words, in_arrow, key_of, lists, longs, mix, scratch, settle, span_hashes, steps

#: Windows that one block holds at most.
BLOCK = 16


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum) of each run of width values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


class _Blocks:
    """Windows of a few documents and the blocks they form."""

    def __init__(self, words: Words, window: int):
        run = max(1, window // 3)
        self.words, self.window = words, window
        self.at = words.windows(window)
        if not len(self.at):
            self.anchor = self.block = self.code = np.zeros(0, np.uint64)
            self.head = self.size = self.of = np.zeros(0, np.int64)
            return
        n = len(words)
        i = np.arange(n - run + 1)
        runs = span_hashes(words.hash, i, i + run, 1)
        smallest = _slide(runs, window - run + 1, np.minimum)
        anchor = smallest[self.at]
        new = np.ones(len(self.at), bool)
        doc = words.doc[self.at]
        new[1:] = (anchor[1:] != anchor[:-1]) | (self.at[1:] != self.at[:-1] + 1) | (doc[1:] != doc[:-1])
        starts = np.flatnonzero(new)
        nth = np.arange(len(new)) - np.repeat(starts, np.diff([*starts, len(new)]))
        new |= nth % BLOCK == 0
        self.head = np.flatnonzero(new)
        self.size = np.diff([*self.head, len(new)])
        self.of = np.repeat(np.arange(len(self.head)), self.size)
        self.anchor = anchor[self.head]
        first = self.at[self.head]
        self.block = span_hashes(words.hash, first, first + self.size - 1 + window, 2)
        self.code = span_hashes(words.hash, self.at, self.at + window, 3)

    def place(self) -> np.ndarray:
        """Word of its document that each block begins with."""
        return self.at[self.head] - self.words.first[self.doc()] if len(self.head) else np.zeros(0, np.int64)

    def doc(self) -> np.ndarray:
        return self.words.doc[self.at[self.head]] if len(self.head) else np.zeros(0, np.int64)


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Places of the first of each distinct row."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    return order[new]


def _anchors(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, "text"):
            b = _Blocks(Words(texts), window)
            doc = b.doc()
            keep = _distinct(doc, b.anchor)
            key, content = batch.column("_key").to_numpy(), batch.column("_content").to_numpy()
            yield pa.record_batch([longs(key[doc[keep]]), longs(content[doc[keep]]), longs(b.anchor[keep])], ["_key", "_content", "anchor"])

    return work


def _known_blocks(window: int):
    """Blocks whose anchor occurs in another document too."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, "text"):
            b = _Blocks(Words(texts), window)
            doc, key, content = b.doc(), batch.column("_key").to_numpy(), batch.column("_content").to_numpy()
            known = batch.column("known")
            size = np.asarray(known.value_lengths())
            doc_of = np.repeat(np.arange(len(size)), size)
            have = mix(known.flatten().to_numpy().view(np.uint64), 5) ^ mix(doc_of.astype(np.uint64), 6)
            mine = np.isin(mix(b.anchor, 5) ^ mix(doc.astype(np.uint64), 6), have)
            pick = np.flatnonzero(mine)
            pick = pick[_distinct(doc[pick], b.anchor[pick], b.block[pick])]
            n = b.size[pick]
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(b.head[pick], n)
            yield pa.record_batch(
                [longs(key[doc[pick]]), longs(content[doc[pick]]), longs(b.anchor[pick]), longs(b.block[pick]), longs(b.place()[pick]), lists(b.code[inner], n)],
                ["_key", "_content", "anchor", "block", "place", "codes"])

    return work


class _Index:
    """What the index told of the documents of one step: the first place of blocks and windows."""

    def __init__(self, told: pa.ListArray):
        size = np.asarray(told.value_lengths().fill_null(0))
        entry = told.flatten()
        key = self._key(entry.field("code").to_numpy().view(np.uint64), np.repeat(np.arange(len(size)), size))
        order = np.argsort(key)
        self.key = key[order]
        self.source, self.place = (entry.field(c).to_numpy()[order] for c in ("source", "place"))

    @staticmethod
    def _key(code: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return mix(code, 5) ^ mix(doc.astype(np.uint64), 6)

    def find(self, code: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each code of a document, whether it has an entry, and which."""
        if not len(self.key):
            return np.zeros(len(code), bool), np.zeros(len(code), np.int64)
        key = self._key(code, doc)
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return self.key[at] == key, at


def _seeds(b: _Blocks, index: _Index, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows that occur earlier (indices into b.at, ascending), with document and word of that occurrence."""
    doc = b.words.doc[b.at]
    # a window that comes again in its own document
    _, first, which = np.unique(index._key(b.code, doc), return_index=True, return_inverse=True)
    again = first[which] != np.arange(len(which))
    source, place = key[doc], b.at[first[which]] - b.words.first[doc]
    for found, at, shift in (
        (*index.find(b.code, doc), 0),
        (*(x[b.of] for x in index.find(b.block, b.doc())), np.arange(len(b.at)) - b.head[b.of]),
    ):
        source, place = np.where(found, index.source[at], source) if len(index.key) else source, (
            np.where(found, index.place[at] + shift, place) if len(index.key) else place)
        again = again | found
    seed = np.flatnonzero(again)
    return seed, source[seed], place[seed]


def _parse(at: np.ndarray, doc: np.ndarray, source: np.ndarray, place: np.ndarray, window: int) -> tuple[list, list]:
    """Greedy parse: (factors, checked).

    Factors (index of the seed, first word, end) follow each other without overlap; checked are spans of windows that
    begin inside a factor, reach over its end and occur earlier too.
    """
    if not len(at):
        return [], []
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (doc[1:] != doc[:-1]) | (source[1:] != source[:-1]) | (place[1:] != place[:-1] + 1)
    head = np.flatnonzero(new)
    last = at[np.append(head[1:], len(at)) - 1]
    factors, checked, end = [], [], 0
    for i, lo, hi in zip(head.tolist(), at[head].tolist(), last.tolist()):
        if lo < end:  # windows do not reach into the next document, so neither do factors
            checked.append((lo, min(hi, end - 1) + window))
            i, lo = i + end - lo, end
        if lo <= hi:
            end = hi + window
            factors.append((i, lo, end))
    return factors, checked


FACTORS = T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "source", "place")]))


def _factor_lists(words: Words, factors: list, source: np.ndarray, place: np.ndarray) -> pa.Array:
    i, lo, end = np.array(factors, np.int64).reshape(-1, 3).T
    doc = words.doc[lo]
    fields = {"start": lo - words.first[doc], "length": end - lo, "source": source[i], "place": place[i]}
    offsets = np.searchsorted(doc, np.arange(len(words.first) + 1)).astype(np.int32)
    entries = pa.StructArray.from_arrays([longs(v) for v in fields.values()], list(fields))
    return pa.ListArray.from_arrays(pa.array(offsets), entries)


def _cut(window: int, with_text: bool, with_factors: bool):
    """Per document: parse it, and put together what no factor and no window across a factor's end covers."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, "text"):
            words = Words(texts)
            b = _Blocks(words, window)
            covered = np.zeros(len(words) + 1, np.int32)
            factors, source, place = [], np.zeros(0, np.int64), np.zeros(0, np.int64)
            if len(b.at):
                seed, source, place = _seeds(b, _Index(batch.column("known")), batch.column("_key").to_numpy())
                factors, checked = _parse(b.at[seed], words.doc[b.at[seed]], source, place, window)
                spans = np.array([f[1:] for f in factors] + checked, np.int64).reshape(-1, 2)
                np.add.at(covered, spans[:, 0], 1)
                np.add.at(covered, spans[:, 1], -1)
            keep = np.cumsum(covered)[:-1] == 0
            removed = (words.last - words.first) - np.add.reduceat(
                np.append(keep, False).astype(np.int64), words.first) * (words.last > words.first)
            shas, rest = [], []
            for d, text in enumerate(texts):
                lo, hi = words.first[d], words.last[d]
                if not removed[d]:
                    left, pieces = text.split(), [text]
                else:
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], keep[lo:hi].astype(np.int8), [0]]))) + lo
                    pieces = [words.data[words.start[i]:words.end[j - 1]] for i, j in zip(edge[0::2], edge[1::2])]
                    left = b" ".join(pieces).split()
                shas.append(hashlib.sha256(b" ".join(left)).hexdigest())
                rest.append(b" ".join(pieces).decode())
            cols = {"n_words": longs(words.last - words.first), "n_removed": longs(removed), "kept_sha256": pa.array(shas, pa.string())}
            if with_text:
                cols["kept_text"] = pa.array(rest, pa.string())
            if with_factors:
                cols["factors"] = _factor_lists(words, factors, source, place)
            yield pa.record_batch([batch.column("row"), *cols.values()], ["row", *cols])

    return work


def substring_dedup(docs: DataFrame, window: int = 20, with_text: bool = True, with_factors: bool = False) -> DataFrame:
    """Remove every word of a window of `window` words that starts earlier in the corpus.

    docs needs doc_id and text; its columns but text come back under the struct `row`, with n_words,
    n_removed, kept_sha256 (kept words joined by one blank) and, if asked for, kept_text (kept stretches
    as they stood, joined by one blank) and factors: from left to right and without overlap, the stretches
    (start, length) of the document that go on like the words from word `place` of document `source`
    (-2^63: the one without id; of several rows with that id, one of them). Words between factors are literals,
    which go as well where a window across the end of a factor occurs earlier.

    Earlier means a smaller doc_id, or an earlier start in the same document; judged on the input. Words
    are runs of anything but blank and \\t\\n\\v\\f\\r. A null text has no words, a null doc_id is the smallest.
    Rows that share a doc_id are each judged alone and never remove from each other. Documents shorter
    than the window are kept whole. Equality is by 64-bit word hashes and 128 bits per window.
    """
    if window < 1:
        raise ValueError("window must be positive")
    spark = docs.sparkSession
    tmp = scratch(spark, "substrings")
    content = F.xxhash64("text").alias("_content")  # rows that share an id, or have none, keep lists of their own
    rows = docs.select(key_of().alias("_key"), content, F.col("text"), F.struct(*[docs[c] for c in docs.columns if c != "text"]).alias("row"))
    slim = docs.select(key_of().alias("_key"), content, F.col("text"))
    anchors = tmp.store(in_arrow(slim, _anchors(window), "_key long, _content long, anchor long"), "anchors")
    shared = tmp.store(anchors.groupBy("anchor").count().where("count > 1").select("anchor"), "shared")
    known = tmp.store(anchors.join(shared, "anchor").groupBy("_key", "_content").agg(F.collect_set("anchor").alias("known")), "known")
    settle(spark)
    blocks = tmp.store(
        in_arrow(slim.join(known, ["_key", "_content"]), _known_blocks(window), "_key long, _content long, anchor long, block long, place long, codes array<long>"),
        "blocks")
    tmp.forget("anchors", "shared", "known")
    settle(spark)

    earliest = [F.min("_key").alias("source"), F.min_by("place", "_key").alias("source_place")]
    first = tmp.store(blocks.groupBy("anchor", "block").agg(*earliest), "first")
    # stored, so that adaptive execution can split a frequent anchor in the join with it
    several = tmp.store(first.groupBy("anchor").count().where("count > 1").select("anchor"), "several")
    placed = blocks.join(first, ["anchor", "block"])
    entry = ["_key", "_content", "code", "source", "source_place"]
    later = placed.where("_key > source").withColumnRenamed("block", "code").select(*entry)
    owners = placed.where("_key = source").join(several, "anchor", "left_semi").select(
        "_key", "_content", "anchor", "place", F.posexplode("codes").alias("nth", "code"))
    owners = tmp.store(owners.withColumn("place", F.col("place") + F.col("nth")).drop("nth"), "owners")
    window_first = owners.groupBy("anchor", "code").agg(*earliest, F.count("*").alias("n")).where("n > 1")
    boundary = owners.join(window_first, ["anchor", "code"]).where("_key > source").select(*entry)
    told = F.collect_set(F.struct("code", "source", F.col("source_place").alias("place"))).alias("known")
    marks = tmp.store(later.unionByName(boundary).groupBy("_key", "_content").agg(told), "marks")
    tmp.forget("blocks", "first", "several", "owners")
    settle(spark)
    out = T.StructType([rows.schema["row"]]).add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    if with_text:
        out = out.add("kept_text", "string")
    if with_factors:
        out = out.add("factors", FACTORS)
    return in_arrow(rows.join(marks, ["_key", "_content"], "left"), _cut(window, with_text, with_factors), out)

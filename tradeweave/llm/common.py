"""What the operators of this subpackage share: reading, Arrow passes, word and window hashes."""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.session import Scratch

#: Bytes of text that one vectorised step holds; a longer document is a step of its own.
STEP_BYTES = 1 << 20

# The separators of the two word definitions in use.
BLANKS = b"\t\n\x0b\x0c\r "
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: A null document id takes part as the smallest one.
NO_ID = -(1 << 63)

_is_blank = np.zeros(256, dtype=bool)
_is_blank[list(BLANKS)] = True
_MULT = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_of(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def scratch(spark: SparkSession, label: str) -> Scratch:
    return Scratch(spark, label)


def settle(spark: SparkSession) -> None:
    """Let the driver drop what it no longer refers to, so shuffle files of finished steps go.

    Spark removes them when the driver collects its garbage, which may otherwise be never during a run.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def rows_with_text(docs: DataFrame, columns: list[str], *beside: Column) -> tuple[DataFrame, str]:
    """The columns as one struct `row`, and where in it or beside it the text stands; a text travels once."""
    row = F.struct(*[docs[c] for c in columns]).alias("row")
    return (docs.select(*beside, row), "row.text") if "text" in columns else (docs.select(*beside, row, docs["text"].alias("text")), "text")


def steps(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of at most STEP_BYTES of text (or one row), with their texts as bytes; null is empty.

    column may name a field of a struct (`row.text`).
    """
    outer, _, inner = column.partition(".")
    for batch in batches:
        found = batch.column(outer).field(inner) if inner else batch.column(outer)
        texts = [t or b"" for t in found.cast(pa.binary()).to_pylist()]
        start = size = 0
        for i, t in enumerate(texts):
            if i > start and size + len(t) > STEP_BYTES:
                yield batch.slice(start, i - start), texts[start:i]
                start, size = i, 0
            size += len(t)
        if texts:
            yield batch.slice(start), texts[start:]


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x + np.uint64(salt * 0xD1B54A32D192ED03 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
    """64-bit hashes of values[start:end] for many spans at once.

    Hashes of 1, 2, 4... values from each place are made by doubling, and a span takes the ones its length is the sum
    of. Every step mixes all bits, so no texts collide by construction, as they do under sums of powers.
    """
    size = ends - starts
    out = mix(size.astype(np.uint64), salt)
    level, at, step = mix(values.astype(np.uint64), 31), starts.copy(), 1
    while True:
        some = np.flatnonzero(size & step)
        out[some] = mix(out[some] * _MULT + level[at[some]], salt)
        at[some] += step
        if not (size >> step.bit_length()).any():
            return mix(out, salt)
        level = mix(level[:-step] * _MULT + level[step:], 37)
        step *= 2


#: A number for each byte value at each of the first places of a word; later places are mixed one by one.
_PLACES = 64
_placed = mix(np.arange(_PLACES * 256, dtype=np.uint64) + np.uint64(1), 41)


def _word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte stretches, which do not overlap and ascend: sums of numbers for (place, byte), mixed."""
    size = ends - starts
    first = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(first, size)
    inside = buf[place + np.repeat(starts, size)]
    number = _placed[(np.minimum(place, _PLACES - 1) << 8) | inside]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        number[far] = mix((place[far].astype(np.uint64) << np.uint64(8)) | inside[far], 43)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(number, dtype=np.uint64)])
    return mix(total[first + size] - total[first] + size.astype(np.uint64) * _MULT, 47)


class Words:
    """The blank-separated words of a few documents, side by side.

    start, end: byte places in data; doc: index of the document; hash: 64 bits of the word;
    first, last: for each document the range of its words.
    """

    def __init__(self, texts: list[bytes]):
        self.data = b"\n".join(texts)
        buf = np.frombuffer(self.data, np.uint8)
        self.begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        starts, ends, hashes = [], [], []
        for lo, hi in self._pieces(buf):
            inside = np.zeros(hi - lo + 2, np.int8)
            inside[1:-1] = ~_is_blank[buf[lo:hi]]
            edges = np.flatnonzero(np.diff(inside))
            s, e = edges[0::2], edges[1::2]
            hashes.append(_word_hashes(buf[lo:hi], s, e))
            starts.append(s + lo)
            ends.append(e + lo)
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.start, self.end, self.hash = join(starts, np.int64), join(ends, np.int64), join(hashes, np.uint64)
        bounds = np.searchsorted(self.start, self.begins)
        self.first, self.last = bounds[:-1], bounds[1:]
        self.doc = np.repeat(np.arange(len(texts)), self.last - self.first)

    @staticmethod
    def _pieces(buf: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches that end at a blank, so that a very long document needs no more memory."""
        lo, n = 0, len(buf)
        while lo < n:
            hi = min(n, lo + STEP_BYTES)
            while hi < n and not _is_blank[buf[hi - 1]]:
                hi += 1
            yield lo, hi
            lo = hi

    def __len__(self) -> int:
        return len(self.start)

    def windows(self, size: int) -> np.ndarray:
        """Start words of the windows of so many words that lie within one document."""
        if len(self) < size:
            return np.zeros(0, np.int64)
        at = np.arange(len(self) - size + 1)
        return at[self.doc[at] == self.doc[at + size - 1]]


def longs(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """list<long> column: consecutive runs of values."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), longs(values))


def in_arrow(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow whose workers can import this package where it lies at the same path as here.

    A cluster that has it elsewhere ships it as usual (--py-files).
    """
    env, root = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))
    return df.mapInArrow(work, schema)


_plain = re.compile(PLAIN_WORD)


def plain_words(text: str | None) -> list[str]:
    """Lower-cased (A-Z only) words of letters, digits and whatever is not ASCII."""
    return _plain.findall((text or "").translate(_LOWER))


_LOWER = {c: c + 32 for c in range(65, 91)}

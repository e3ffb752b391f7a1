"""Toxicity classifier that is trained to give the same score when identity terms are swapped.

Features are the words of a text and their beginnings of four, five and seven letters. Which of them are used, and with
what weight, is learned from labelled documents. For each labelled text that names a group, further
copies name other groups of the same kind instead; training penalises the squared difference of their
scores, so that a group's name itself moves no score. Only what is relatively more frequent in toxic documents
may be a feature, so that a long or unusual text is not excused by its other words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.common import in_arrow, key_of, rows_with_text, scratch, settle, steps

#: Labelled documents used at most, features kept, documents that must have a feature, other groups put in for one.
SAMPLE, FEATURES, SUPPORT, SWAPS = 20_000, 4096, 4, 3
#: Letters of the beginnings that are features.
BEGINNINGS = (4, 5, 7)
#: Training: steps, ridge penalty and weight of the counterfactual penalty.
STEPS, RIDGE, SAME = 400, 1e-4, 1.0

# Terms that name groups, by kind; each may stand for any other of its row.
IDENTITY = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"),
    ("women", "men"), ("woman", "man"), ("female", "male", "nonbinary", "transgender"), ("girls", "boys"), ("girl", "boy"),
    ("gay", "lesbian", "straight", "bisexual", "queer", "heterosexual", "homosexual"),
    ("black", "white", "asian", "latino", "hispanic", "african", "european", "arab", "indigenous"),
    ("immigrant", "refugee", "native", "foreigner"), ("immigrants", "refugees", "natives", "foreigners"),
    ("deaf", "blind", "disabled", "paralyzed"), ("young", "old", "elderly", "teenage"),
    ("mexican", "american", "chinese", "indian", "german", "french", "spanish", "canadian", "japanese", "russian"),
    ("frauen", "männer"), ("christen", "muslime", "juden"), ("schwarze", "weiße"), ("mujeres", "hombres"),
    ("cristianos", "musulmanes", "judíos"), ("femmes", "hommes"), ("chrétiens", "musulmans", "juifs"),
)
_KIND = {t: row for row in IDENTITY for t in row}

_word = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> set[str]:
    return set(_word.findall(text.lower()))


def features_of(words: set[str]) -> set[str]:
    """The words, and the beginnings of longer ones (marked, so that they differ from words)."""
    return words.union(*({w[:n] + "~" for w in words if len(w) > n} for n in BEGINNINGS))


def swapped(words: set[str]) -> list[set[str]]:
    """The same words with other groups: the n-th copy puts for each term the n-th other one of its row."""
    named = [w for w in words if w in _KIND]
    out = []
    for n in range(1, SWAPS + 1) if named else ():
        new = set(words)
        for w in named:
            new.discard(w)
        for w in named:
            row = _KIND[w]
            new.add(row[(row.index(w) + 1 + (n - 1) % (len(row) - 1)) % len(row)])
        if new != words and new not in out:
            out.append(new)
    return out


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per step: how many toxic and other documents have each feature."""
    for batch, texts in steps(batches, "text"):
        toxic = batch.column("toxic").to_pylist()
        seen: dict[str, list[int]] = {}
        for text, label in zip(texts, toxic):
            for f in features_of(words_of(text.decode())):
                seen.setdefault(f, [0, 0])[label] += 1
        yield pa.record_batch(
            [pa.array(list(seen), pa.string()), pa.array([n[1] for n in seen.values()], pa.int64()), pa.array([n[0] for n in seen.values()], pa.int64())],
            ["feature", "toxic", "other"])


def _examples(place: dict[str, int]):
    """Feature numbers of each document and of its counterfactual copies."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = lambda words: sorted(place[f] for f in features_of(words) & place.keys())
        for batch, texts in steps(batches, "text"):
            own, others = [], []
            for text in texts:
                words = words_of(text.decode())
                own.append(numbers(words))
                others.append([numbers(x) for x in swapped(words)])
            yield pa.record_batch(
                [batch.column("toxic"), pa.array(own, pa.list_(pa.int32())), pa.array(others, pa.list_(pa.list_(pa.int32())))],
                ["toxic", "own", "others"])

    return work


class _Rows:
    """Sparse 0/1 rows."""

    def __init__(self, rows: list[list[int]], columns: int):
        self.n, self.columns = len(rows), columns
        self.row = np.repeat(np.arange(self.n), [len(r) for r in rows])
        self.column = np.concatenate([np.asarray(r, np.int64) for r in rows]) if rows else np.zeros(0, np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, weights=w[self.column], minlength=self.n)

    def back(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, weights=x[self.row], minlength=self.columns)


def fit(labels: np.ndarray, own: list[list[int]], others: list[list[list[int]]], columns: int,
        same: float = SAME, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic model; both labels weigh the same in all."""
    x = _Rows(own, columns)
    pairs = [(a, b) for a, bs in zip(own, others) for b in bs]
    left, right = _Rows([p[0] for p in pairs], columns), _Rows([p[1] for p in pairs], columns)
    share = max(labels.mean(), 1 / (len(labels) + 1)), max(1 - labels.mean(), 1 / (len(labels) + 1))
    weight = np.where(labels == 1, 0.5 / share[0], 0.5 / share[1])
    w, bias, seen, seen_bias = np.zeros(columns), 0.0, np.full(columns, 1e-8), 1e-8
    for _ in range(STEPS):
        z = x.dot(w) + bias
        miss = weight * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        slope = x.back(miss) / len(labels) + ridge * w
        if pairs:
            gap = left.dot(w) - right.dot(w)
            slope += 2 * same * (left.back(gap) - right.back(gap)) / len(pairs)
        slope_bias = miss.sum() / len(labels)
        seen, seen_bias = seen + slope ** 2, seen_bias + slope_bias ** 2
        w = w - 0.5 * slope / np.sqrt(seen)
        bias = bias - 0.5 * slope_bias / np.sqrt(seen_bias)
    return w, float(bias)


def train(labelled: DataFrame, tmp, same: float = SAME) -> tuple[dict[str, float], float]:
    """Weights by feature and the bias, from rows (text, toxic 0/1); few enough rows to fit here (see SAMPLE)."""
    counts = in_arrow(labelled, _tally, "feature string, toxic long, other long").groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    totals = {r.toxic: r.n for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:  # nothing to tell apart
        return {}, 0.0 if not totals else 4.0 * (2 * next(iter(totals)) - 1)
    a, b = F.col("toxic") / totals[1], F.col("other") / totals[0]
    tells = F.pow(F.sqrt(a) - F.sqrt(b), F.lit(2.0))
    best = counts.where((F.col("toxic") + F.col("other") >= SUPPORT) & (a > b)).orderBy(F.desc(tells), "feature").limit(FEATURES)
    chosen = [r.feature for r in best.select("feature").collect()]
    names = list(dict.fromkeys([*chosen, *_KIND]))
    place = {f: i for i, f in enumerate(names)}
    schema = T.StructType().add("toxic", "integer").add("own", T.ArrayType(T.IntegerType())).add("others", T.ArrayType(T.ArrayType(T.IntegerType())))
    rows = in_arrow(labelled, _examples(place), schema).toArrow()
    w, bias = fit(rows.column("toxic").to_numpy(), rows.column("own").to_pylist(), rows.column("others").to_pylist(), len(names), same)
    return {f: float(v) for f, v in zip(names, w) if v}, bias


def _score(shared, column: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, bias = shared.value
        lead = {n: {f[:-1] for f in weights if len(f) == n + 1 and f[-1] == "~"} for n in BEGINNINGS}
        known = weights.keys()
        for batch, texts in steps(batches, column):
            z = []
            for text in texts:
                words = words_of(text.decode())
                found = words & known
                for n, some in lead.items():
                    found |= {f + "~" for f in {w[:n] for w in words if len(w) > n} & some}
                z.append(bias + sum(sorted(weights[f] for f in found)))
            yield pa.record_batch([batch.column("row"), pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], ["row", "score"])

    return work


def score(docs: DataFrame, weights: dict[str, float], bias: float, columns: list[str] | None = None) -> DataFrame:
    """The struct `row` (columns, default doc_id) and the score of every whole text; null counts as empty."""
    shared = docs.sparkSession.sparkContext.broadcast((weights, bias))
    rows, column = rows_with_text(docs, columns or ["doc_id"])
    return in_arrow(rows, _score(shared, column), T.StructType([rows.schema["row"]]).add("score", "double"))


def held_out() -> F.Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame, cut: float = 0.7, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: more likely toxic) and predicted (score >= cut) of every document.

    Learned from labels (doc_id, toxic) whose documents are not held out: at most `sample` of them, the ones
    with the smallest hash of doc_id; equal texts count once, with the label that is larger. Null labels and
    ids are left out, a doc_id labelled both ways is toxic. With one label only, or none, all scores are alike.
    Only the text decides a score; a null or empty text is scored by the bias.
    """
    spark = docs.sparkSession
    tmp = scratch(spark, "toxicity")
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").where(~held_out()).groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max("toxic").cast("int").alias("toxic"))
    picked = known.orderBy(F.xxhash64("key"), "key").limit(sample)
    texts = docs.select(key_of().alias("key"), "text").where("text IS NOT NULL").join(F.broadcast(picked), "key")
    once = texts.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(F.max("toxic").alias("toxic"), F.min("key").alias("key"))
    rows = tmp.store(texts.select("key", "text").join(F.broadcast(once.select("key", "toxic")), "key").dropDuplicates(["key"]).select("text", "toxic"), "labelled")
    settle(spark)
    weights, bias = train(rows, tmp)
    out = score(docs, weights, bias).select("row.doc_id", "score")
    return out.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= cut).cast("int").alias("predicted"))

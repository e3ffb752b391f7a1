"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters as they stand, in every script, four UTF-16 units at a time (a character beyond
the first plane is two of them). Counts come from all trusted texts, are summed in each task and meet in
tables sharded by n-gram; every order's probabilities are made by joining its counts with those of their
contexts and with the order below. The tables grow with what the trusted texts hold, so they stay tables:
documents are dealt into chunks of some megabytes, each chunk's distinct n-grams are joined with them, and
the logs come back to the chunk, where they are summed for each document. A document is rejected if its
perplexity lies outside quantiles that trusted documents of its language set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.common import in_arrow, key_of, longs, rows_with_text, scratch, settle, steps

#: Length of an n-gram and bits of each of its symbols; symbols that the base distribution spreads over at least.
ORDER, BITS, LEAST = 4, 16, 64
#: Bytes of text in a chunk, on average; n-grams that a task holds before it sums them up.
CHUNK, HELD = 16 << 20, 2_000_000

#: Symbol of each character below U+0251: every one is its own.
_CLASS = np.arange(0x251)


def _codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram code ending at each UTF-16 unit, and the numbers of units and of characters of each text."""
    plain = [t.decode() for t in texts]
    units = [t.encode("utf-16-le", "surrogatepass") for t in plain]
    size = np.array([len(u) // 2 for u in units], np.int64)
    pad = b"\0" * 2 * (ORDER - 1)
    code = np.frombuffer(pad + pad.join(units), np.uint16).astype(np.uint64)
    kind = code.copy()
    for back in range(1, ORDER):
        code[back:] |= kind[:-back] << np.uint64(BITS * back)
    begins = np.cumsum(size + ORDER - 1) - size
    keep = np.zeros(len(code) + 1, np.int32)
    np.add.at(keep, begins, 1)
    np.add.at(keep, begins + size, -1)
    return code[np.cumsum(keep)[:-1] > 0], size, np.array([len(t) for t in plain], np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codes, counts, held = [], [], 0

    def merged() -> tuple[np.ndarray, np.ndarray]:
        every, n = np.concatenate(codes), np.concatenate(counts)
        one, where = np.unique(every, return_inverse=True)
        return one, np.bincount(where, weights=n, minlength=len(one)).astype(np.int64)

    for _, texts in steps(batches, "text"):
        found, n = np.unique(_codes(texts)[0], return_counts=True)
        codes.append(found)
        counts.append(n)
        held += len(found)
        if held > HELD:
            one, n = merged()
            yield pa.record_batch([longs(one), pa.array(n, pa.int64())], ["code", "n"])
            codes, counts, held = [], [], 0
    if codes:
        one, n = merged()
        yield pa.record_batch([longs(one), pa.array(n, pa.int64())], ["code", "n"])


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct n-grams of each chunk; the rows of a chunk stand together."""
    chunk, codes, held = None, [], 0

    def out() -> pa.RecordBatch:
        one = np.unique(np.concatenate(codes))
        return pa.record_batch([pa.array(np.full(len(one), chunk), pa.int32()), longs(one)], ["chunk", "code"])

    for batch in batches:
        for lo, hi in _runs(batch.column("chunk").to_numpy()):
            here = batch.column("chunk")[lo].as_py()
            if codes and (here != chunk or held > HELD):
                yield out()
                codes, held = [], 0
            chunk = here
            for _, texts in steps(iter([batch.slice(lo, hi - lo)]), "text"):
                codes.append(np.unique(_codes(texts)[0]))
                held += len(codes[-1])
                if held > HELD:
                    yield out()
                    codes, held = [], 0
    if codes:
        yield out()


def _runs(values: np.ndarray) -> list[tuple[int, int]]:
    """Stretches of equal values."""
    if not len(values):
        return []
    edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(edges[:-1], edges[1:]))


def discounts(counts: DataFrame) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and 3 or more, from the counts of counts."""
    n = {r.n: r.c for r in counts.where("n <= 4").groupBy("n").agg(F.count("*").alias("c")).collect()}
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    raw = [i + 1 - (i + 2) * y * b / a if a and b else 0.5 + 0.25 * i for i, (a, b) in enumerate(((n1, n2), (n2, n3), (n3, n4)))]
    return tuple(min(max(d, 0.1), i + 0.95) for i, d in enumerate(raw))


def _suffix(size: int) -> Column:
    """The last so many symbols of a code."""
    return F.col("code").bitwiseAND(F.lit((1 << (BITS * size)) - 1))


def train(trusted: DataFrame, tmp) -> tuple[dict[int, tuple[DataFrame, DataFrame]], float]:
    """By order 1 to 4 (code, p) and (context, g: what is left for unseen symbols), and the base probability."""
    counts = tmp.store(in_arrow(trusted.select("text"), _count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")), "counts4")
    tables = {ORDER: counts}
    for size in range(ORDER - 1, 0, -1):  # how many different characters go before
        shorter = tables[size + 1].groupBy(_suffix(size).alias("code")).agg(F.count("*").alias("n"))
        tables[size] = tmp.store(shorter, f"counts{size}")
    base = 1 / max(LEAST, tables[1].count() + 1)
    found: dict[int, tuple[DataFrame, DataFrame]] = {}
    for size in range(1, ORDER + 1):
        table = tables[size].withColumn("context", F.shiftrightunsigned("code", BITS))
        d1, d2, d3 = discounts(table)
        n = F.col("n")
        off = F.when(n == 1, d1).when(n == 2, d2).otherwise(d3)
        contexts = tmp.store(table.groupBy("context").agg(F.sum("n").alias("total"), (F.sum(off) / F.sum("n")).alias("g")), f"g{size}")
        joined = table.join(contexts, "context")
        own = (n - off) / F.col("total")
        if size == 1:
            here = joined.select("code", (own + F.col("g") * base).alias("p"))
        else:
            below = found[size - 1][0].select(F.col("code").alias("suffix"), F.col("p").alias("q"))
            here = joined.withColumn("suffix", _suffix(size - 1)).join(below, "suffix").select("code", (own + F.col("g") * F.col("q")).alias("p"))
        found[size] = tmp.store(here, f"p{size}"), contexts.select("context", "g")
        tmp.forget(f"counts{size}")
    return found, base


def _chunked(docs: DataFrame, columns: list[str], chunks: int) -> tuple[DataFrame, str]:
    """Rows as rows_with_text gives them, with their chunk: equal rows are in the same one wherever they are read."""
    return rows_with_text(docs, columns, F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"))


def logs_of(docs: DataFrame, model: dict[int, tuple[DataFrame, DataFrame]], base: float, chunks: int, tmp) -> DataFrame:
    """(chunk, code, log): log probability of every n-gram of the full order that a chunk of the documents holds.

    Tables, those of the model too, are deleted once what reads them is stored.
    """
    texts = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int").alias("chunk"), "text").where("text <> ''")
    dealt = texts.repartition("chunk").sortWithinPartitions("chunk")
    asked = tmp.store(in_arrow(dealt, _asked, "chunk int, code long").distinct(), "asked")
    want = {ORDER: tmp.store(asked.select("code").distinct(), f"want{ORDER}")}
    for size in range(ORDER - 1, 0, -1):
        want[size] = tmp.store(want[size + 1].select(_suffix(size).alias("code")).distinct(), f"want{size}")
    lower = None
    for size in range(1, ORDER + 1):
        table, rest = model[size]
        here = want[size].join(table, "code", "left").withColumn("context", F.shiftrightunsigned("code", BITS)).join(rest, "context", "left")
        if lower is None:
            here = here.withColumn("q", F.lit(base))
        else:
            here = here.withColumn("suffix", _suffix(size - 1)).join(lower.select(F.col("code").alias("suffix"), F.col("p").alias("q")), "suffix")
        lower = tmp.store(here.select("code", F.coalesce("p", F.coalesce("g", F.lit(1.0)) * F.col("q")).alias("p")), f"all{size}")
        tmp.forget(f"want{size}", f"p{size}", f"g{size}", f"all{size - 1}")
    settle(docs.sparkSession)
    logs = tmp.store(asked.join(lower, "code").select("chunk", "code", F.log("p").alias("log")), "logs")
    tmp.forget("asked", f"all{ORDER}")
    return logs


def _score(column: str):
    """Rows of a chunk: first its n-grams with their logs, then its documents."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, parts, codes, logs = None, [], np.zeros(0, np.uint64), np.zeros(0)
        for batch in batches:
            at, gram = batch.column("chunk").to_numpy(), batch.column("code").is_valid().to_numpy(zero_copy_only=False)
            for lo, hi in _runs(at.astype(np.int64) * 2 + ~gram):
                if at[lo] != chunk:
                    chunk, parts, codes, logs = at[lo], [], np.zeros(0, np.uint64), np.zeros(0)
                part = batch.slice(lo, hi - lo)
                if gram[lo]:
                    parts.append((part.column("code").to_numpy().view(np.uint64), part.column("log").to_numpy()))
                    continue
                if parts:
                    codes, logs = (np.concatenate(x) for x in zip(*parts))
                    order = np.argsort(codes)
                    parts, codes, logs = [], codes[order], logs[order]
                for rows, texts in steps(iter([part]), column):
                    found, size, chars = _codes(texts)
                    total = np.concatenate([[0.0], np.cumsum(logs[np.searchsorted(codes, found)] if len(found) else [])])
                    ends = np.cumsum(size)
                    mean = (total[ends] - total[ends - size]) / np.maximum(chars, 1)
                    yield pa.record_batch([rows.column("row"), pa.array(np.exp(-mean), mask=chars == 0), pa.array(chars)], ["row", "perplexity", "chars"])

    return work


def _scored(docs: DataFrame, logs: DataFrame, chunks: int, columns: list[str]) -> DataFrame:
    rows, column = _chunked(docs, columns, chunks)
    kind = rows.schema["row"].dataType
    both = rows.unionByName(logs.withColumn("row", F.lit(None).cast(kind)), allowMissingColumns=True)
    dealt = both.repartition("chunk").sortWithinPartitions("chunk", F.col("code").isNull())
    return in_arrow(dealt, _score(column), T.StructType().add("row", kind).add("perplexity", "double").add("chars", "long"))


def quality(docs: DataFrame, labels: DataFrame, low: float = 0.01, high: float = 0.99, spread: float = 4.0,
            columns: list[str] | None = None) -> DataFrame:
    """Perplexity of every document, the bounds for its language, and whether it is kept.

    docs: doc_id, text, lang; labels: doc_id, quality. Documents labelled 1 are the trusted text; all of
    them are counted. Gives the struct `row` (the columns asked for, default doc_id and lang), perplexity,
    lowest, highest and keep. Bounds are the low (0: none) and high quantiles of trusted documents of the
    same lang, widened by the factor exp(spread / sqrt(characters)), as short texts stray further; a
    language without trusted documents has the quantiles of all of them.

    A null or empty text has no perplexity and is kept, as is everything if nothing is trusted: the model
    has nothing against it. Null lang is a language of its own. Repeated rows and labels do no harm beyond
    counting a text again per repeated row; a doc_id labelled both ways is trusted.
    """
    spark = docs.sparkSession
    tmp = scratch(spark, "quality")
    columns = columns or ["doc_id", "lang"]
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("key")).distinct()
    # a shuffle at every size: the labels grow with the documents, so they are never broadcast
    trusted = docs.select(key_of().alias("key"), "text").where("text IS NOT NULL").join(good.hint("merge"), "key", "left_semi")
    model, base = train(trusted, tmp)
    chunks = max(1, -(-(docs.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0) // CHUNK))
    settle(spark)
    logs = logs_of(docs, model, base, chunks, tmp)
    settle(spark)
    scores = tmp.store(_scored(docs, logs, chunks, ["doc_id", "lang"]), "scores")
    known = scores.where("perplexity IS NOT NULL").select(key_of("row.doc_id").alias("key"), "row.lang", "perplexity").join(good, "key", "left_semi")
    at = [F.expr(f"percentile_approx(perplexity, {q}, 100000)").alias(n) for q, n in ((low, "_low"), (high, "_high"))]
    bounds = tmp.store(known.groupBy(F.col("lang").alias("_lang")).agg(*at), "bounds")
    anywhere = known.agg(*at).first()
    again = columns != ["doc_id", "lang"]
    out = _scored(docs, logs, chunks, list(dict.fromkeys([*columns, "lang"]))) if again else scores
    tmp.forget("scores" if again else "logs")
    wider = F.exp(F.lit(spread) / F.sqrt(F.greatest("chars", F.lit(1))))
    lowest = F.coalesce("_low", F.lit(anywhere["_low"]).cast("double")) / wider if low > 0 else F.lit(0.0)
    highest = F.coalesce("_high", F.lit(anywhere["_high"]).cast("double")) * wider
    out = out.join(bounds, F.col("row.lang").eqNullSafe(F.col("_lang")), "left").select("row", "perplexity", lowest.alias("lowest"), highest.alias("highest"))
    inside = (F.col("perplexity") >= F.col("lowest")) & (F.col("perplexity") <= F.col("highest"))
    return out.withColumn("keep", F.coalesce(inside, F.lit(True)))

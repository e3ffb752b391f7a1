"""Exact top-k search by distributed histogram selection.

Rows are dealt into slices of bounded size; a task holds one slice and all queries stream past it, a tile at a
time. A first pass counts the scores of each query in equal bins over all scores it can have; the bin that holds
the k-th largest is divided again, until it is one score wide. The range under search of each query is a row of
a table, joined to the queries for the next pass. Then each query's k-th score is known, rows below it are
dropped where they are scored, and of those above or level with it a task passes on its best k, ties to the
smaller id. No vector, histogram or score passes through the driver, and one plan a pass serves all queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.llm.common import in_arrow, scratch

#: Components of one slice, rows below which a slice is not cut further, scores held at once, bins of a histogram.
HELD, ROWS, TILE, BINS = 1 << 23, 512, 1 << 22, 1024
#: Products of Euclidean norms below this leave float sums of whole numbers exact.
EXACT = float(1 << 52)

_ENDS = np.iinfo(np.int64)
RESULT = "query_id long, rank int, vec_id long, score long"


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two float64 matrices of whole numbers, as int64, held at its ends where they pass them."""
    with np.errstate(over="ignore", invalid="ignore"):
        norm_a, norm_b = (np.sqrt((x * x).sum(1)) for x in (a, b))
        most_a, most_b = (n.max(initial=0.0) for n in (norm_a, norm_b))
        if most_a * most_b < EXACT:
            return (a @ b.T).astype(np.int64)
    half = EXACT ** 0.5
    large_a, large_b = np.flatnonzero(~(norm_a < half)), np.flatnonzero(~(norm_b < half))
    plain_a, plain_b = a.copy(), b.copy()
    plain_a[large_a], plain_b[large_b] = 0, 0
    out = (plain_a @ plain_b.T).astype(np.int64)
    for large, whole, other, put in ((large_a, a, b, out), (large_b, b, a, out.T)):
        if len(large):  # Python's integers, for such rows alone
            x, y = ([[int(v) for v in row] for row in m.tolist()] for m in (whole[large], other))
            put[large] = [[max(_ENDS.min, min(_ENDS.max, sum(map(int.__mul__, r, q)))) for q in y] for r in x]
    return out


def _matrix(column) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _streamed(batches: Iterator[pa.RecordBatch], meet) -> Iterator[pa.RecordBatch]:
    """meet(queries, ids, scores) for every tile of queries of every (dims, slice), whose rows come first."""
    key, parts, ids, rows = None, [], None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("dims", "slice", "kind")], 1)
        edges = (np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1).tolist()
        for lo, hi in zip([0, *edges], [*edges, len(at)]):
            here, part = tuple(at[lo, :2].tolist()), batch.slice(lo, hi - lo)
            if here != key:
                key, parts, rows = here, [], None
            if at[lo, 2] == 0:
                parts.append((part.column("vec_id").to_numpy(), _matrix(part.column("whole"))))
                continue
            if rows is None:
                if not parts:
                    continue  # queries of a slice without rows of their length
                ids, rows = (np.concatenate(x) for x in zip(*parts))
                parts = []
            step = max(1, TILE // len(ids))
            for i in range(0, part.num_rows, step):
                some = part.slice(i, step)
                yield from meet(some, ids, scores(_matrix(some.column("whole")), rows))


def _others(some: pa.RecordBatch, ids: np.ndarray) -> np.ndarray:
    """Whether a row has another id than the query."""
    return some.column("vec_id").to_numpy()[:, None] != ids


def _histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(q, bin, n): scores per bin of the range under search; bin BINS counts what lies beyond it."""
    def meet(some: pa.RecordBatch, ids, part) -> Iterator[pa.RecordBatch]:
        low, width = (some.column(c).to_numpy() for c in ("low", "width"))
        query, row = np.nonzero(_others(some, ids) & (part >= low[:, None]))
        # as unsigned numbers the distance from the low end cannot overflow
        far = part[query, row].view(np.uint64) - low.view(np.uint64)[query]
        found = np.minimum(far // width.astype(np.uint64)[query], np.uint64(BINS)).astype(np.int64)
        counts = np.bincount(query * (BINS + 1) + found, minlength=1)
        some_bins = np.flatnonzero(counts)
        yield pa.record_batch(
            [pa.array(some.column("q").to_numpy()[some_bins // (BINS + 1)]), pa.array(some_bins % (BINS + 1)), pa.array(counts[some_bins])],
            ["q", "bin", "n"])

    return _streamed(batches, meet)


def _best(k: int):
    def meet(some: pa.RecordBatch, ids, part) -> Iterator[pa.RecordBatch]:
        query, row = np.nonzero(_others(some, ids) & (part >= some.column("least").to_numpy()[:, None]))
        score, found = part[query, row], ids[row]
        order = np.lexsort([found, ~score, query])  # ~ turns the order round and, unlike -, has no overflow
        query, score, found = query[order], score[order], found[order]
        first = np.arange(len(query)) - np.searchsorted(query, query) < k
        query, score, found = query[first], score[first], found[first]
        own = (some.column(c).to_numpy()[query] for c in ("q", "vec_id"))
        yield pa.record_batch([*map(pa.array, own), pa.array(found), pa.array(score)], ["q", "query_id", "vec_id", "score"])

    return lambda batches: _streamed(batches, meet)


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, floor(scale * x) of each component x as double, dims and norm; leaves out what takes no part."""
    unusable = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    whole = lambda v: F.when(F.abs(v) < float(1 << 53), F.floor(v).cast("double")).otherwise(v)
    return (
        vectors.where("vec_id IS NOT NULL AND embedding IS NOT NULL")
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: v.cast("double") * scale).alias("x"))
        .where((F.size("x") > 0) & ~F.exists("x", unusable))
        .select("vec_id", F.transform("x", whole).alias("whole"), F.size("x").alias("dims"))
        .withColumn("norm", F.sqrt(F.aggregate("whole", F.lit(0.0), lambda a, v: a + v * v)))
    )


def exact_topk(vectors: DataFrame, is_query, k: int = 20, scale: int = 64) -> DataFrame:
    """The k best rows of `vectors` for each query row: query_id, rank (from 1), vec_id, score.

    vectors: vec_id long, embedding array of numbers. is_query: a condition on vec_id. A score is the inner
    product of the floor(scale * x) components; rows with the query's vec_id are left out, as are vectors of
    another length, null, empty or holding null or non-finite components (also once scaled), and rows without
    vec_id. Ties go to the smaller vec_id; if several rows share an id, each of them takes part, as row and as
    query. Scores are exact whatever the components; beyond 64 bits they are held at the nearest end.
    """
    spark = vectors.sparkSession
    tmp = scratch(spark, "topk")
    rows = whole_vectors(vectors, scale)
    size = rows.agg(F.count("*").alias("n"), F.sum("dims").alias("parts"), F.max("norm").alias("norm")).first()
    if not size["n"]:
        return spark.createDataFrame([], RESULT)
    slices = max(-(-size["parts"] // HELD), min(-(-size["n"] // ROWS), spark.sparkContext.defaultParallelism * 2))
    nth = F.monotonically_increasing_id()  # deals rows that share an id to different slices
    held = rows.select("vec_id", "whole", "dims", F.pmod(nth, F.lit(slices)).cast("int").alias("slice"), F.lit(0).alias("kind"))
    queries = tmp.store(rows.where(is_query).withColumn("q", F.monotonically_increasing_id()), "queries")

    def met(asked: DataFrame, work, schema: str) -> DataFrame:
        placed = asked.drop("norm").withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).withColumn("kind", F.lit(1))
        key = ["dims", "slice"]
        both = held.unionByName(placed, allowMissingColumns=True)
        return in_arrow(both.repartition(*key).sortWithinPartitions(*key, "kind"), work, schema)

    # no product exceeds that of the norms; wider ranges than 64 bits are cut to them
    most = F.col("norm") * F.lit(size["norm"]) * (1 + 1e-9) + 1
    fits = most < float(1 << 62)
    state = queries.select(
        "q", F.when(fits, -F.ceil(F.when(fits, most))).otherwise(F.lit(int(_ENDS.min))).alias("low"),
        F.when(fits, F.ceil(F.when(fits, (2 * most + 3) / BINS))).otherwise(F.lit((1 << 64) // BINS)).alias("width"),
        F.lit(None).cast("long").alias("least"))
    state, turn = tmp.store(state, "state0"), 0
    by_score = Window.partitionBy("q").orderBy(F.desc("bin"))  # at most BINS + 1 rows of a query
    while not state.where("least IS NULL").isEmpty():
        turn += 1
        counts = met(queries.join(state.where("least IS NULL").drop("least"), "q"), _histogram, "q long, bin long, n long")
        counts = counts.groupBy("q", "bin").agg(F.sum("n").alias("n")).withColumn("from_top", F.sum("n").over(by_score))
        kth = counts.where(F.col("from_top") >= k).groupBy("q").agg(F.max("bin").alias("bin"))
        low = F.expr("CAST(CAST(low AS DECIMAL(20,0)) + CAST(bin AS DECIMAL(5,0)) * CAST(width AS DECIMAL(19,0)) AS BIGINT)")
        least = (F.when(F.col("least").isNotNull(), F.col("least"))
                 .when(F.col("bin").isNull(), F.lit(int(_ENDS.min)))  # no more than k rows
                 .when(F.col("width") == 1, low))
        narrower = F.ceil(F.col("width") / BINS).cast("long")
        state = state.join(kth, "q", "left").select(
            "q", F.coalesce(low, F.col("low")).alias("low"), narrower.alias("width"), least.alias("least"))
        state = tmp.store(state, f"state{turn}")
        tmp.forget(f"state{turn - 1}")
    found = met(queries.join(state.select("q", "least"), "q"), _best(k), "q long, query_id long, vec_id long, score long")
    w = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Hard-negative mining with Strassen products of anchor and candidate tiles.

Anchors are dealt into blocks, candidates into slices; a task holds one block of anchors and streams one slice past
it, a tile at a time. The scores of a tile are a Strassen product of whole numbers: seven products of quarter size in
place of eight, down to a small one, odd sizes padded with zeros. Sums and products are 64-bit and wrap around, which is exact
for every score that 64 bits hold. A first pass keeps in each task the best positives of each anchor, a second one
the best different rows inside the window of each positive; both are bounded heaps that merge across slices. No
vector, score or pair passes through the driver, and one plan serves all blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeweave.llm.common import in_arrow, scratch

#: Anchors of one block, candidates of one slice and of one tile, side up to which a product is not divided further.
ANCHORS, SLICE, TILE, SMALL = 4096, 1 << 16, 512, 24
#: Components below this bound (in amount) of up to 2**12 dimensions give scores that 64 bits hold.
SAFE = float(1 << 25)


def strassen(a: np.ndarray, b: np.ndarray, small: int = SMALL) -> np.ndarray:
    """a @ b of int64 matrices modulo 2**64."""
    n, k, m = a.shape[0], a.shape[1], b.shape[1]
    if min(n, k, m) <= small:
        return a @ b
    a = np.pad(a, ((0, n % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, m % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    p1 = strassen(a11 + a22, b11 + b22, small)
    p2 = strassen(a21 + a22, b11, small)
    p3 = strassen(a11, b12 - b22, small)
    p4 = strassen(a22, b21 - b11, small)
    p5 = strassen(a11 + a12, b22, small)
    p6 = strassen(a21 - a11, b11 + b12, small)
    p7 = strassen(a12 - a22, b21 + b22, small)
    out = np.empty((2 * r, 2 * t), np.int64)
    out[:r, :t] = p1 + p4 - p5 + p7
    out[:r, t:] = p3 + p5
    out[r:, :t] = p2 + p4
    out[r:, t:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of the rows of two float64 matrices of whole numbers, as int64, held at its ends where they pass them."""
    large_a, large_b = (np.flatnonzero((np.abs(x) >= SAFE).any(1)) if x.shape[1] <= 1 << 12 else np.arange(len(x)) for x in (a, b))
    with np.errstate(invalid="ignore"):
        out = strassen(a.astype(np.int64), np.ascontiguousarray(b.astype(np.int64).T))
    for large, whole, other, put in ((large_a, a, b, out), (large_b, b, a, out.T)):
        if len(large):  # Python's integers, for such rows alone
            x, y = ([[int(v) for v in row] for row in m.tolist()] for m in (whole[large], other))
            top = (1 << 63) - 1
            put[large] = [[max(-top - 1, min(top, sum(map(int.__mul__, r, q)))) for q in y] for r in x]
    return out


class _Heap:
    """The best `k` of each owner: higher scores first, ties to the smaller id; thinned whenever it has grown."""

    def __init__(self, k: int, room: int = 1 << 19):
        self.k, self.room, self.held = k, room, 0
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def push(self, owner: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if len(owner):
            self.parts.append((owner, score, ids))
            self.held += len(owner)
            if self.held > self.room:
                self.thin()
                self.held = 0

    def thin(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3
        owner, score, ids = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort([ids, ~score, owner])  # ~ turns the order round and, unlike -, has no overflow
        owner, score, ids = owner[order], score[order], ids[order]
        first = np.arange(len(owner)) - np.searchsorted(owner, owner) < self.k
        self.parts = [(owner[first], score[first], ids[first])]
        return self.parts[0]


def _kth(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the allowed entries of each row that are among its k best or level with the last of them."""
    low = np.iinfo(np.int64).min
    shown = np.where(allowed, scores, low)
    if scores.shape[1] > k:
        least = np.partition(shown, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        allowed = allowed & (shown >= least[:, None])
    return np.nonzero(allowed)


class _Block:
    """Anchors that a task holds: row numbers, ids, labels, vectors and, in the second pass, their positives."""

    def __init__(self, parts: list[pa.RecordBatch]):
        whole = pa.Table.from_batches(parts).combine_chunks()
        take = lambda c: whole.column(c).combine_chunks()
        self.row, self.ids, self.labels = (take(c).to_numpy() for c in ("row", "vec_id", "label"))
        self.vectors = _matrix(take("whole"))
        if "positives" in whole.column_names:
            lists = take("positives")
            self.anchor = np.repeat(np.arange(len(lists)), np.asarray(lists.value_lengths().fill_null(0)))
            flat = lists.flatten()
            self.pos_id, self.pos_score, self.pos_no = (flat.field(i).to_numpy() for i in range(3))


def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _streamed(batches: Iterator[pa.RecordBatch], meet: Callable, close: Callable) -> Iterator[pa.RecordBatch]:
    """Call meet(block, ids, labels, scores) for every tile of every (dims, block, slice), and yield close(block) after each."""
    key, parts, block = None, [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        at = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("dims", "block", "slice", "kind")], 1)
        edges = (np.flatnonzero((at[1:] != at[:-1]).any(1)) + 1).tolist()
        for lo, hi in zip([0, *edges], [*edges, len(at)]):
            here, part = tuple(at[lo, :3].tolist()), batch.slice(lo, hi - lo)
            if here != key:
                if block is not None:
                    yield close(block)
                key, parts, block = here, [], None
            if at[lo, 3] == 0:
                parts.append(part)
                continue
            if block is None:
                if not parts:
                    continue
                block, parts = _Block(parts), []
            ids, labels, vectors = part.column("vec_id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("whole"))
            for i in range(0, len(ids), TILE):
                for j in range(0, len(block.ids), TILE):
                    meet(block, slice(j, j + TILE), ids[i:i + TILE], labels[i:i + TILE], _scores(block.vectors[j:j + TILE], vectors[i:i + TILE]))
    if block is not None:
        yield close(block)


def _best_positives(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap = _Heap(k)

        def meet(block: _Block, some: slice, ids, labels, scores) -> None:
            row, col = _kth(scores, (block.labels[some, None] == labels) & (block.ids[some, None] != ids), k)
            heap.push(row + some.start, scores[row, col], ids[col])

        def close(block: _Block) -> pa.RecordBatch:
            owner, score, ids = heap.thin()
            heap.parts, heap.held = [], 0
            return pa.record_batch([pa.array(block.row[owner]), pa.array(ids, pa.int64()), pa.array(score)], ["row", "vec_id", "score"])

        yield from _streamed(batches, meet, close)

    return work


def _best_negatives(k: int, low: int, high: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heap = _Heap(k)

        def meet(block: _Block, some: slice, ids, labels, scores) -> None:
            a, b = np.searchsorted(block.anchor, [some.start, some.stop])
            at = block.anchor[a:b] - some.start
            if not len(at):
                return
            least, most = _window(block.pos_score[a:b], low, high)
            found = scores[at]
            inside = (block.labels[some][at, None] != labels) & (found >= least[:, None]) & (found <= most[:, None])
            row, col = _kth(found, inside, k)
            heap.push(row + a, found[row, col], ids[col])

        def close(block: _Block) -> pa.RecordBatch:
            owner, score, ids = heap.thin()
            heap.parts, heap.held = [], 0
            return pa.record_batch(
                [pa.array(block.row[block.anchor[owner]]), pa.array(block.ids[block.anchor[owner]]), pa.array(block.pos_no[owner]),
                 pa.array(block.pos_id[owner]), pa.array(block.pos_score[owner]), pa.array(ids, pa.int64()), pa.array(score)],
                ["row", "anchor_id", "nth", "positive_id", "positive_score", "negative_id", "negative_score"])

        yield from _streamed(batches, meet, close)

    return work


def _window(score: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score s with low * score <= 100 * s <= high * score."""
    exact = [(-(-low * s // 100), high * s // 100) for s in score.tolist()]  # Python's integers: no overflow
    ends = np.iinfo(np.int64)
    held = [(max(a, ends.min), min(b, ends.max)) if a <= ends.max and b >= ends.min else (ends.max, ends.min) for a, b in exact]
    return tuple(np.array(x, np.int64) for x in zip(*held))


def usable_vectors(vectors: DataFrame, scale: int, label: Column) -> DataFrame:
    """vec_id, label and floor(scale * x) of each component x as double; leaves out rows that take no part."""
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    whole = lambda v: F.when(F.abs(v) < float(1 << 53), F.floor(v).cast("double")).otherwise(v)
    return (
        vectors.where("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL")
        .select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
                F.transform("embedding", lambda v: v.cast("double") * scale).alias("x"))
        .where((F.size("x") > 0) & ~F.exists("x", bad) & F.col("label").isNotNull())
        .select("vec_id", "label", F.transform("x", whole).alias("whole"), F.size("x").alias("dims"))
    )


def _best(found: DataFrame, owner: list[str], score: str, ids: str, k: int, rank: str) -> DataFrame:
    """Merge what the tasks kept."""
    w = Window.partitionBy(*owner).orderBy(F.desc(score), ids)
    return found.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, scale: int = 256, positives: int = 5,
                   negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """For each anchor and each of its positives the hard negatives: anchor_id, positive_id, rank, negative_id and both scores.

    vectors: vec_id, embedding (array of numbers), label. is_anchor is a condition on vec_id, label the label to use.
    A score is the inner product of the floor(scale * x) components with the anchor's; higher scores come first, ties
    by smaller vec_id. An anchor's positives are its best `positives` rows of the same label and another vec_id; the
    negatives of a pair are the best `negatives` rows of another label with low * positive_score <= 100 * score <=
    high * positive_score; all, if fewer. rank counts from 1.

    Rows without vec_id, label or vector, with an empty vector, or with a component that is null or not finite (also
    once scaled) take no part; vectors of different lengths do not meet. Repeated rows each take part, as candidates
    and as anchors. Scores beyond 64 bits are held at the nearest end. No anchors, or no rows, give no rows.
    """
    spark = vectors.sparkSession
    tmp = scratch(spark, "negatives")
    rows = usable_vectors(vectors, scale, label)
    anchors = tmp.store(rows.where(is_anchor).withColumn("row", F.monotonically_increasing_id()), "anchors")
    blocks = max(1, -(-anchors.count() // ANCHORS))
    n = rows.count()
    slices = max(-(-n // SLICE), min(-(-n // TILE), spark.sparkContext.defaultParallelism * 2 // blocks), 1)
    every = lambda size: F.explode(F.sequence(F.lit(0), F.lit(size - 1)))
    nth = F.monotonically_increasing_id()  # deals rows that share an id to different slices
    candidates = rows.withColumn("slice", F.pmod(nth, F.lit(slices)).cast("int")).withColumn("block", every(blocks))

    def met(held: DataFrame, work, schema: str) -> DataFrame:
        placed = held.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("slice", every(slices))
        both = placed.withColumn("kind", F.lit(0)).unionByName(candidates.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        key = ["dims", "block", "slice"]
        return in_arrow(both.repartition(*key).sortWithinPartitions(*key, "kind"), work, schema)

    near = met(anchors, _best_positives(positives), "row long, vec_id long, score long")
    near = _best(near, ["row"], "score", "vec_id", positives, "nth")
    entry = F.struct(F.col("vec_id").alias("id"), "score", F.col("nth").cast("long").alias("nth"))
    near = near.groupBy("row").agg(F.sort_array(F.collect_list(entry)).alias("positives"))
    armed = tmp.store(anchors.join(near, "row"), "armed")
    far = met(armed, _best_negatives(negatives, low, high),
              "row long, anchor_id long, nth long, positive_id long, positive_score long, negative_id long, negative_score long")
    found = _best(far, ["row", "nth"], "negative_score", "negative_id", negatives, "rank")
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

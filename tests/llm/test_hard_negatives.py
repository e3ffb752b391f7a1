import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeweave.llm import hard_negatives as H

VECTORS = "vec_id long, embedding array<double>, label int, row long, block string, slice int, whole int, nth long"


def relabelled():
    return F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))


def made():
    rnd = np.random.default_rng(4)
    centre = rnd.uniform(-1, 1, 6)
    near = lambda: [float(x) for x in centre + rnd.uniform(-.6, .6, 6)]
    rows = [(i, near(), int(rnd.integers(0, 3))) for i in range(450)]
    rows += [(i, rows[100][1], i % 3) for i in range(450, 520)]  # ties
    rows += [(600 + 100 * i, e, 1) for i, e in enumerate([None, [], [1.0, None] * 3, [math.nan] * 6, [math.inf] * 6, [0.5] * 3, [0.6] * 3])]
    rows += [(None, rows[1][1], 1), (1400, rows[1][1], None), rows[200], rows[200], rows[300], (1, [0.7, 0.1, 0.2], 2)]
    rows += [(1500, [3e6, -2e5, 1.0, 0.0, 4e6, 1.0], 0), (1501, [3e6, -2e5, 1.5, 0.0, 4e6, 1.0], 0), (1502, [2e6, 1.0, 1.0, 1.0, 1.0, 1.0], 1)]
    return [(*r, 1, "b", 2, 3, 4) for r in rows]


def brute(rows):
    usable = []
    for i, v, label, *_ in rows:
        if i is not None and label is not None and v and all(x is not None and math.isfinite(x) for x in v):
            usable.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if i % 7 == 0 else label))
    out = Counter()
    for i, v, label in usable:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, own) for j, w, own in usable if len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2] == label and x[1] != i][:5]:
            p = -s
            inside = [x for x in scored if x[2] != label and 30 * p <= -100 * x[0] <= 90 * p][:10]
            out.update((i, j, n + 1, k, p, -t) for n, (t, k, _) in enumerate(inside))
    return out


@pytest.mark.parametrize("anchors,piece,tile", [(4096, 1 << 16, 512), (2, 60, 7)])
def test_equals_brute_force(spark, anchors, piece, tile, monkeypatch):
    monkeypatch.setattr(H, "ANCHORS", anchors)
    monkeypatch.setattr(H, "SLICE", piece)
    monkeypatch.setattr(H, "TILE", tile)
    rows = made()
    got = H.hard_negatives(spark.createDataFrame(rows, VECTORS).repartition(5), F.col("vec_id") % 100 == 0, relabelled())
    want = brute(rows)
    assert Counter(map(tuple, got.collect())) == want
    assert len(want) > 100 and max(want.values()) > 1 and any(k[0] == 1500 for k in want)


def test_no_rows_and_no_anchors(spark):
    assert H.hard_negatives(spark.createDataFrame([], VECTORS), F.col("vec_id") % 100 == 0, relabelled()).count() == 0
    some = spark.createDataFrame(made(), VECTORS)
    assert H.hard_negatives(some, F.col("vec_id") == -5, relabelled()).count() == 0


def test_beyond_64_bits(spark):
    rows = [(0, [1e30, 1e30], 1), (1, [2e30, 1.0], 1), (2, [1.0, 1.0], 2), (3, [-1e300, 1e306], 2)]
    got = H.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), F.col("vec_id") == 0, F.col("label"))
    assert got.count() == 0  # the positive is at the upper end, the only finite negative's score too


@pytest.mark.parametrize("shape", [(1, 1, 1), (33, 17, 5), (70, 65, 129), (64, 64, 64)])
@pytest.mark.parametrize("small", [1, 3, 24])
def test_strassen(shape, small):
    rnd = np.random.default_rng(1)
    n, k, m = shape
    a, b = rnd.integers(-2**62, 2**62, (n, k)), rnd.integers(-2**62, 2**62, (k, m))
    assert (H.strassen(a, b, small) == a @ b).all()  # both wrap around

import hashlib
import math
from collections import Counter
from zlib import crc32

import pytest

from tradeweave.llm import importance_resampling as R
from tradeweave.llm.common import plain_words


def features(text, longest):
    words = plain_words(text)
    return len(words), [crc32(" ".join(words[i:i + n]).encode()) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def brute(rows, target, longest=1, buckets=10_000, percent=10, least=20, seed=2024):
    found = [(r[0], *features(r[1], longest)) for r in rows]
    s = Counter(h % buckets for _, _, f in found for h in f)
    t = Counter(h % buckets for x in target for h in features(x, longest)[1])
    size_s, size_t = s.total() + buckets, t.total() + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * size_s / ((s[b] + 1.0) * size_t))) for b in range(buckets)]
    scored = []
    for i, n, f in found:
        weight = sum(gain[h % buckets] for h in f) // max(len(f), 1)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        scored.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    order = sorted((k for k in range(len(scored)) if scored[k][4] >= least),
                   key=lambda k: (-scored[k][3], scored[k][0] is not None, scored[k][0] or 0))
    rank = {k: n + 1 for n, k in enumerate(order[:percent * len(order) // 100])}
    return Counter((i, n, w, score, rank.get(k), words) for k, (i, n, w, score, words) in enumerate(scored))


TARGET = ["And then the beni of the ZEto", "", None, "alra beto GAmi", "alra beto"]


@pytest.mark.parametrize("setting", [{}, {"longest": 3, "percent": 50, "buckets": 97}, {"percent": 100, "least": 0}, {"percent": 0}])
def test_equals_brute_force(spark, docs, rows, setting):
    named = {"least_words" if k == "least" else k: v for k, v in setting.items()}
    target = spark.createDataFrame([(t,) for t in TARGET], "text string")
    got = R.resample(docs, target, **named)
    repeated = [r for r in rows if r[0] is not None]  # ranks of rows with one id and one score may be exchanged
    assert len(repeated) < len(rows)
    assert Counter(map(tuple, got.collect())) == brute(rows, TARGET, **setting)


def test_empty_tables(spark, docs, no_docs, rows):
    none = spark.createDataFrame([], "text string")
    assert R.resample(no_docs, none).count() == 0
    assert Counter(map(tuple, R.resample(docs, none).collect())) == brute(rows, [])
    short = docs.where("text IN ('', 'one')")
    assert {r["rank"] for r in R.resample(short, none).collect()} == {None}


def test_crcs_of_runs():
    texts = ["Hello  World, it's a été day".encode(), b"", b"one", b"a b c d e f " + b"x" * 70_000 + b" y", b"..", b"z y"]
    crcs = R.PrefixCrcs(texts)
    for n in range(1, 9):
        doc, crc = crcs.runs(n)
        want = []
        for d, text in enumerate(texts):
            words = plain_words(text.decode())
            want += [(d, crc32(" ".join(words[i:i + n]).encode())) for i in range(len(words) - n + 1)]
        assert list(zip(doc.tolist(), crc.tolist())) == want

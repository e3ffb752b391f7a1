import itertools
from collections import Counter
from fractions import Fraction

import pytest

from tradeweave.llm import jaccard_join as J
from tradeweave.llm.substring_dedup import substring_dedup


def brute(rows, n, threshold):
    t = Fraction(str(threshold))
    known, sets = {}, {}
    for r in rows:
        words = (r[1] or "").encode().split()
        s = frozenset(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else None
        known[r[0]] = s
        if s:
            sets[s] = min(sets.get(s, r[0]), r[0])
    group = {v: v for v in sets.values()}
    links = Counter()
    for (a, i), (b, j) in itertools.combinations(sets.items(), 2):
        if len(a & b) >= t * len(a | b):
            links[i] += 1
            links[j] += 1
            x, y = group[i], group[j]
            group = {k: min(x, y) if v in (x, y) else v for k, v in group.items()}
    return {i: (group[sets[s]], sets[s], links[sets[s]]) if s else (i, i, 0) for i, s in known.items()}


@pytest.mark.parametrize("block,grams", [(512, 1 << 21), (3, 1 << 21), (512, 300)])
def test_equals_brute_force(docs, rows, block, grams, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", block)  # small blocks: sets go to their buckets and meet in several tasks
    monkeypatch.setattr(J, "GRAMS", grams)
    rows = [r for r in rows if r[0] is not None]
    got = J.jaccard_join(docs.where("doc_id IS NOT NULL"), 5, 0.8).collect()
    want = brute(rows, 5, 0.8)
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    assert {r.doc_id: (r.class_id, r.text_id, r.n_links) for r in got} == want
    assert all(r.is_first == (r.class_id == r.doc_id) for r in got)
    assert any(v[2] for v in want.values())


def test_bands_reach_the_recall():
    bands, rows = J.bands_for(0.8, 0.9995)
    assert bands * rows <= J.HASHES and 1 - (1 - 0.8 ** rows) ** bands >= 0.9995
    with pytest.raises(ValueError):
        J.bands_for(0.01, 0.9999999)


def test_null_id_and_empty(docs, no_docs):
    assert J.jaccard_join(docs).where("doc_id IS NULL").count() == 1
    assert J.jaccard_join(no_docs).count() == 0


@pytest.mark.parametrize("block", [512, 64])
def test_large_group_of_near_copies(spark, block, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", block)
    base = [f"w{i}" for i in range(120)]
    texts = [" ".join([*base[:k % 100], f"x{k}", *base[k % 100:]]) for k in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = J.jaccard_join(docs).collect()
    assert {r.class_id for r in got} == {0} and {r.n_links for r in got} == {299}


def test_texts_made_to_collide(spark):
    """A word and its complement whose sums of powers agree modulo 2**64 are different words."""
    odd = [bin(i).count("1") & 1 for i in range(1024)]
    a, b = "".join("ab"[x] for x in odd), "".join("ba"[x] for x in odd)
    texts = [" ".join([f"w{i}" for i in range(19)] + [w]) for w in (a, b)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = J.jaccard_join(docs).collect()
    assert sorted((r.doc_id, r.text_id) for r in got) == [(0, 0), (1, 1)]
    assert [r.n_removed for r in substring_dedup(docs).collect()] == [0, 0]


@pytest.mark.parametrize("block", [512, 7])
def test_chain_of_links(spark, block, monkeypatch):
    """A long chain is one component although its ends share nothing."""
    monkeypatch.setattr(J, "BLOCK", block)
    words = [f"w{i}" for i in range(2000)]
    texts = [" ".join(words[10 * k:10 * k + 150]) for k in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = J.jaccard_join(docs).collect()
    assert {r.class_id for r in got} == {0} and max(r.n_links for r in got) <= 4


def test_repeated_head_is_no_link(spark):
    """A document that stands there several times is one text class to its near copy; so are rows without an id."""
    base = [f"w{i}" for i in range(100)]
    text, near = " ".join(base), " ".join([*base[:-1], "other"])
    docs = spark.createDataFrame([(1, text)] * 4 + [(2, near)], "doc_id long, text string")
    got = J.jaccard_join(docs).collect()
    assert len(got) == 5 and {(r.class_id, r.n_links) for r in got} == {(1, 1)}
    assert sorted((r.doc_id, r.text_id) for r in got) == [(1, 1)] * 4 + [(2, 2)]
    far = " ".join(f"v{i}" for i in range(100))
    docs = spark.createDataFrame([(None, text), (None, far), (None, near), (7, near), (8, far), (8, "x y z")], "doc_id long, text string")
    got = J.jaccard_join(docs).collect()
    assert sum(r.is_first for r in got) == 3 and {r.n_links for r in got if r.doc_id == 7} == {1}
    assert [r.class_id for r in got if r.doc_id == 8 and r.is_first] == [8]


def test_bands_are_long_enough_that_unlike_texts_seldom_meet():
    bands, rows = J.bands_for(0.8, 0.999999)
    assert rows >= 4 and 1 - (1 - 0.1 ** rows) ** bands < 0.003 and 1 - (1 - 0.8 ** rows) ** bands >= 0.999999

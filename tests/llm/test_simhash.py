import itertools
import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from tradeweave.llm import simhash_dedup as S


def plain_print(text, size=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows, within=4):
    """Component of every fingerprint by comparing all pairs."""
    prints = {}
    for r in rows:
        prints.setdefault(plain_print(r[1]), []).append(r[0])
    group = {p: p for p in prints}
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= within and group[a] != group[b]:
            x, y = group[a], group[b]
            group = {k: x if v == y else v for k, v in group.items()}
    least = {}
    for p, ids in prints.items():
        known = [i for i in ids if i is not None]
        least[group[p]] = min([*known, *([least[group[p]]] if least.get(group[p]) is not None else [])], default=None)
    return Counter((r[0], f"{plain_print(r[1]):016x}", least[group[plain_print(r[1])]]) for r in rows)


@pytest.fixture(scope="module")
def near_rows():
    """Long texts of which a few words are changed, so that fingerprints differ in some bits."""
    rnd = random.Random(8)
    out = []
    for base in range(12):
        words = [f"w{rnd.randint(0, 10**6)}" for _ in range(400)]
        for _ in range(12):
            copy = list(words)
            for _ in range(rnd.randint(0, 8)):
                copy[rnd.randrange(400)] = f"x{rnd.randint(0, 999)}"
            out.append(" ".join(copy).title() if base % 2 else "\t".join(copy))
    ids = list(range(100, 100 + len(out)))
    rnd.shuffle(ids)
    return list(zip(ids, out)) + [(None, out[3]), (None, None), (5, ""), (6, None), (6, " "), (7, "one"), (7, "one"), (8, "ONE"), (None, "lone words")]


@pytest.mark.parametrize("block,pairs", [(1 << 15, 1 << 22), (3, 16)])
def test_equals_brute_force(spark, near_rows, block, pairs, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", block)
    monkeypatch.setattr(S, "PAIRS", pairs)
    docs = spark.createDataFrame([(*r, "n", 1, 2) for r in near_rows], "doc_id long, text string, node string, home int, shard int")
    got = S.simhash_dedup(docs.repartition(3))
    want = brute(near_rows)
    assert Counter(map(tuple, got.collect())) == want
    sizes = Counter(k[2] for k in want)
    assert len(sizes) < len({k[1] for k in want}) and max(sizes.values()) > 3


def test_words_of_all_kinds(docs, rows):
    got = S.simhash_dedup(docs)
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_empty(no_docs):
    assert S.simhash_dedup(no_docs).count() == 0


def test_tree_loses_no_pair():
    tree = S.VantageTree(8, 5)
    for within in range(3):
        first, number, leaf = tree.routes(within)
        asked = [set(leaf[f:f + n].tolist()) for f, n in zip(first, number)]
        visits = np.bincount(tree.reached(np.arange(256), within)[0])
        assert (visits >= number).all() and (within or (visits == 1).all())
        for a, b in itertools.product(range(256), repeat=2):
            assert tree.home[a] == leaf[first[a]]
            if (a ^ b).bit_count() <= within:
                assert tree.home[b] in asked[a] or tree.home[a] in asked[b]
    assert visits.mean() < 32  # branches are pruned


def test_group_that_fills_a_shard(spark, monkeypatch):
    """Fingerprints of one part value: a shard cut into blocks still finds every link."""
    rnd = random.Random(3)
    prints = [rnd.getrandbits(16) << 20 | 5 for _ in range(300)]
    home = np.ones(len(prints), bool)
    node, root = next(S._forest(np.array(prints, np.uint64), home, 4))
    parent = {p: p for p in prints}
    for a, b in itertools.combinations(prints, 2):
        if (a ^ b).bit_count() <= 4 and parent[a] != parent[b]:
            x, y = parent[a], parent[b]
            parent = {k: x if v == y else v for k, v in parent.items()}
    classes = {}
    for n, r in zip(node.tolist(), root.tolist()):
        classes.setdefault(r, set()).add(n)
    want = {}
    for p, r in parent.items():
        want.setdefault(r, set()).add(p)
    assert sorted(map(sorted, classes.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)

"""The trained models on small made-up and on given labelled text."""

import math
import random

import numpy as np
import pytest
from conftest import SF

from tradeweave.llm import quality_model as Q
from tradeweave.llm import toxicity as X
from tradeweave.session import Scratch


def auc(score, label):
    pairs = [(a > b) + 0.5 * (a == b) for a, x in zip(score, label) for b, y in zip(score, label) if x == 1 and y == 0]
    return sum(pairs) / len(pairs)


# --- quality


def brute_logs(texts, ask):
    """Interpolated modified Kneser-Ney in plain dictionaries."""
    grams = {}
    for t in texts:
        kinds = [0] * 3 + [int(Q._CLASS[min(ord(c), 0x250)]) for c in t]
        for i in range(3, len(kinds)):
            g = tuple(kinds[i - 3:i + 1])
            grams[g] = grams.get(g, 0) + 1
    orders = {4: grams}
    for n in (3, 2, 1):
        orders[n] = {}
        for g in orders[n + 1]:
            orders[n][g[1:]] = orders[n].get(g[1:], 0) + 1

    def off(counts):
        n = [sum(c == k for c in counts.values()) for k in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.5
        out = []
        for i in range(3):
            d = i + 1 - (i + 2) * y * n[i + 1] / n[i] if n[i] and n[i + 1] else 0.5 + 0.25 * i
            out.append(min(max(d, 0.1), i + 0.95))
        return lambda c: out[min(c, 3) - 1]

    cut = {n: off(c) for n, c in orders.items()}

    def p(g):
        if not g:
            return 1 / 64
        same = {h: c for h, c in orders[len(g)].items() if h[:-1] == g[:-1]}
        low = p(g[1:])
        if not same:
            return low
        total, d = sum(same.values()), cut[len(g)]
        own = (same[g] - d(same[g])) / total if g in same else 0
        return own + sum(map(d, same.values())) / total * low

    kinds = [0] * 3 + [int(Q._CLASS[min(ord(c), 0x250)]) for c in ask]
    return [math.log(p(tuple(kinds[i - 3:i + 1]))) for i in range(3, len(kinds))]


def test_perplexity_equals_plain_version(spark):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice("abcé .,A9\n") for _ in range(rnd.randint(1, 80))) for _ in range(12)] + ["abc abc", ""]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(8)], "doc_id long, quality int")
    got = {r.doc_id: r.perplexity for r in Q.quality(docs, labels).select("row.doc_id", "perplexity").collect()}
    for i, t in enumerate(texts):
        logs = brute_logs(texts[:8], t)
        assert got[i] is None if not t else got[i] == pytest.approx(math.exp(-sum(logs) / len(logs)), rel=1e-4)


def test_scripts_and_capitals_are_not_collapsed(spark):
    """Scrambled letters are unlikely in any script."""
    rnd = random.Random(8)
    rows = []
    for lang, words in (("ru", "мама мыла раму вечером папа читал книгу утром дети играли около дома".split()),
                        ("el", "καλημερα κοσμε σημερα εχει ηλιο αυριο βροχη παιδια παιζουν στο παρκο".split()),
                        ("EN", "THE HOUSE STANDS NEAR RIVER WHERE OLD PEOPLE WALK EVERY MORNING".split())):
        scrambled = ["".join(rnd.sample(w, len(w))) for w in words]
        text = lambda source, seed: " ".join(random.Random(seed).choices(source, k=400))
        rows += [(len(rows) + i, text(words, i), lang) for i in range(30)]
        rows.append((len(rows), text(scrambled, 1), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i, _, _ in rows if i % 31 < 30], "doc_id long, quality int")
    got = {r.doc_id: r for r in Q.quality(docs, labels).select("row.doc_id", "perplexity", "keep").collect()}
    for start in (0, 31, 62):
        assert all(got[start + i].keep for i in range(30))
        assert got[start + 30].perplexity > 2 * got[start + 1].perplexity and not got[start + 30].keep


def test_quality_odd_cases(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([(i, 1, "k") for i in range(0, 90)] + [(3, 0, "k"), (3, 1, "k"), (None, 1, "k"), (4, None, "k")], "doc_id long, quality int, key string")
    found = Q.quality(docs, labels, columns=docs.columns).select("row.*", "perplexity", "highest", "keep").collect()
    assert len(found) == len(rows) and all(r.keep for r in found if not r.text)
    assert all((r.perplexity is None) == (not r.text) for r in found)
    assert Q.quality(docs, labels.limit(0)).where("keep").count() == len(rows)  # nothing trusted, nothing rejected
    assert Q.quality(no_docs, labels).count() == 0


def test_quality_tells_junk_from_prose(spark):
    sf = SF.replace("sf0.001", "sf0.01")  # sf0.001 has 23 trusted texts
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    train = labels.where("doc_id % 2 = 0")
    found = Q.quality(docs, train).select("row.doc_id", "perplexity", "keep").toPandas()
    rest = found.merge(labels.where("doc_id % 2 = 1").toPandas())
    assert auc(-rest.perplexity, rest.quality) > 0.9
    assert found.merge(train.where("quality = 1").toPandas()).keep.mean() >= 0.98


# --- toxicity


def test_swaps_stay_within_a_kind():
    new = X.swapped({"the", "women", "muslim"})
    assert new and all("the" in s and "women" not in s and "muslim" not in s for s in new)
    assert X.swapped({"plain", "words"}) == []


def sentences(seed=1):
    rnd = random.Random(seed)
    plain, bad = ["walk", "tree", "house", "sing", "green", "river", "table"], ["rotten", "vile"]
    rows = []
    for i in range(400):
        words, toxic = [rnd.choice(plain) for _ in range(6)], i % 2
        if toxic:
            words[rnd.randint(0, 5)] = rnd.choice(bad)
            if i % 4 == 1:
                words.append("muslim")  # the group is named mostly in toxic text
        elif i % 40 == 0:
            words.append("christian")
        rows.append((" ".join(words), toxic))
    return rows


def test_penalty_takes_the_weight_from_identity_terms(spark):
    data = spark.createDataFrame(sentences(), "text string, toxic int")
    gap = {}
    for same in (0.0, 20.0):
        weights, bias = X.train(data, Scratch(spark, "t"), same=same)
        score = lambda t: bias + sum(weights.get(f, 0) for f in X.features_of(X.words_of(t)))
        gap[same] = score("a muslim walk") - score("a christian walk")
        assert score("a rotten tree") > score("a green tree") + 1
    assert abs(gap[20.0]) < 0.3 * abs(gap[0.0])


def test_toxicity_on_held_out_documents(spark):
    sf = SF.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = X.toxicity(docs, labels).toPandas()
    assert got.score.between(0, 1).all() and ((got.score >= 0.7).astype(int) == got.predicted).all()
    rest = got[got.held_out].merge(labels.toPandas())
    assert auc(rest.score, rest.toxic) > 0.85


def test_toxicity_odd_cases(spark, docs, no_docs, rows):
    labels = spark.createDataFrame([(i, i % 2, 1) for i in range(80)] + [(None, 1, 1), (2, None, 1), (3, 0, 1)], "doc_id long, toxic int, key int")
    first = X.toxicity(docs, labels)
    assert first.count() == len(rows) and first.where("score IS NULL OR held_out IS NULL").count() == 0
    for known in (labels.limit(0), labels.where("toxic = 1")):
        assert X.toxicity(docs, known).select("score").distinct().count() == 1
    assert X.toxicity(no_docs, labels).count() == 0


def test_equal_texts_have_equal_scores(spark, docs):
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    scores = X.toxicity(docs, labels).select("doc_id", "score").distinct().toPandas().set_index("doc_id").score
    texts = docs.select("doc_id", "text").where("doc_id IS NOT NULL").distinct().toPandas()
    assert all(len(np.unique(scores[g])) == 1 for g in texts.groupby("text").doc_id.apply(list))

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradeweave.llm import exact_topk as K
from tradeweave.llm.queries import URL_RULES
from tradeweave.llm.url_filters import judge_urls, mine

VECTORS = "vec_id long, embedding array<float>, q long, counts string, whole int"


def vectors(seed=2):
    rnd = np.random.default_rng(seed)
    rows = [(i, [float(x) for x in rnd.uniform(-1, 1, 8)], 1, "c", 2) for i in range(300)]
    rows += [(i, rows[40][1], 1, "c", 2) for i in range(300, 400)]  # many ties
    odd = [None, [], [1.0, None] * 4, [math.nan] * 8, [math.inf] * 8, [0.5] * 3, [0.5] * 3]
    rows += [(400 + 20 * i, e, None, None, None) for i, e in enumerate(odd)]
    return rows + [(None, rows[1][1], 1, "c", 2), rows[7]]


def brute(rows, k, scale):
    usable = [(r[0], [math.floor(scale * x) for x in r[1]]) for r in rows
              if r[0] is not None and r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    out = []
    for q, v in usable:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return Counter(out)


@pytest.mark.parametrize("held,rows,tile,bins,k", [(1 << 23, 512, 1 << 22, 1024, 20), (400, 50, 200, 16, 3), (1 << 23, 512, 1 << 22, 1024, 1000)])
def test_equals_brute_force(spark, held, rows, tile, bins, k, monkeypatch):
    for name, value in (("HELD", held), ("ROWS", rows), ("TILE", tile), ("BINS", bins)):
        monkeypatch.setattr(K, name, value)
    rows = vectors()
    got = K.exact_topk(spark.createDataFrame(rows, VECTORS).repartition(5), F.col("vec_id") % 20 == 0, k=k)
    assert Counter(map(tuple, got.collect())) == brute(rows, k, 64)


def test_components_of_any_size(spark):
    """Scores beyond 2**53 are exact, those beyond 64 bits are held at the nearest end."""
    rows = [(i, [float(i), 1.0 + i % 3]) for i in range(40)] + [(40, [3e6, 0.0]), (41, [-4.3e8, 1.0]), (60, [3e6, 0.25]), (61, [1e200, -1e200]), (62, [1e308, 0.0])]
    got = K.exact_topk(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") % 20 == 0, k=50)
    end = 1 << 63
    want = Counter((q, n, i, max(-end, min(end - 1, s))) for (q, n, i, s), c in brute([r for r in rows if r[0] < 61], 50, 64).items() for _ in range(c))
    got = [tuple(r) for r in got.collect()]
    assert {r[2] for r in got} == set(range(42)) | {60, 61}  # 62 is not finite once scaled
    plain = Counter((q, i, s) for q, _, i, s in got if i != 61)
    assert plain == Counter({(q, i, s): c for (q, _, i, s), c in want.items()})
    assert {s for *_, i, s in got if i == 61} <= {-end, 0, end - 1}


def test_scores_equal_whole_numbers():
    rnd = np.random.default_rng(4)
    a, b = (np.floor(rnd.uniform(-1, 1, (9, 5)) * 10.0 ** rnd.integers(0, 9, (9, 1))) for _ in range(2))
    assert K.scores(a, b).tolist() == [[sum(int(x) * int(y) for x, y in zip(r, q)) for q in b] for r in a]


def test_no_vectors_and_no_queries(spark):
    none = spark.createDataFrame([], VECTORS)
    assert K.exact_topk(none, F.col("vec_id") % 20 == 0).count() == 0
    some = spark.createDataFrame(vectors(), VECTORS)
    assert K.exact_topk(some, F.col("vec_id") < 0).count() == 0


# --- urls

PAGES = "page_id long, url string, html string, tokens string, rule string"


def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host, path = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
    path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for kind, text in URL_RULES:
        name, _, rest = text.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(text) > len(best[1])):
            best = kind, text
    return host, path, *(reversed(best) if best else (None, None))


def pages():
    urls = [f"https://{w}.{d}/{lang}/{i}{e}" for i, (w, d, lang, e) in enumerate(
        (w, d, lang, e) for w in ("www", "blog", "m.x") for d in ("example.com", "a.example.net", "b.org") for lang in ("en", "es", "fr", "de") for e in ("", ".html?q=1", "/#top"))]
    urls += [None, "", "no scheme", "://", "http://", "HTTP://WWW.Example.COM/en/1", "x://com", "x://com/", "x://example.com?y=/en/", "x://example.com/en",
             "a\n://net/es/x", "http://example.com:80/en/", "http://é.net/fr/ü#", "http://a://net/es/", "x://" + "l." * 300 + "net/es/" + "p/" * 500]
    return [(i, u, "<html>", "t", "r") for i, u in enumerate(urls)] + [(None, urls[0], None, None, None), (3, urls[3], "", "", "")]


def test_rules_and_verdicts(spark):
    rows = pages()
    got = judge_urls(spark.createDataFrame(rows, PAGES), URL_RULES).collect()
    assert Counter((r.page_id, r.host, r.path, r.rule) for r in got) == Counter((r[0], *plain_rule(r[1])[:3]) for r in rows)
    listed = {r[1]: plain_rule(r[1]) for r in rows}
    known = {(v[0], v[1]): v[3] for v in listed.values() if v[3]}
    for r in got:
        assert r.verdict in ("allow", "block")
        if r.rule:
            assert r.verdict == known[r.host, r.path] and r.because is None


def test_mined_rules_equal_a_plain_count(spark):
    rows = [(["a", "b", "c"], "block")] * 6 + [(["a", "b"], "allow")] * 2 + [(["a", "c", "d"], "block")] * 5 + [(["d", "e"], "allow")] * 7
    got = {tuple(r.tokens): (r.verdict, r.n, round(r.confidence, 6)) for r in mine(spark.createDataFrame(rows, "tokens array<string>, verdict string"), 0.2, 0.9, 2).collect()}
    assert got == {("c",): ("block", 11, 1.0), ("e",): ("allow", 7, 1.0), ("a", "d"): ("block", 5, 1.0)}


def test_urls_without_lists_or_rows(spark):
    rows = spark.createDataFrame([(1, "http://x.org/"), (2, None)], "page_id long, url string")
    assert [r.verdict for r in judge_urls(rows, URL_RULES).collect()] == ["allow", "allow"]
    assert judge_urls(rows.limit(0), URL_RULES).count() == 0

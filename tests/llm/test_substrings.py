import hashlib
from collections import Counter

from tradeweave.llm.substring_dedup import substring_dedup


def brute(rows, window):
    """Every window against every earlier one; rows that share an id never remove from each other."""
    first, out = {}, []
    key = lambda r: -(1 << 63) if r[0] is None else r[0]
    for r in rows:
        words = (r[1] or "").encode().split()
        for s in range(len(words) - window + 1):
            w = tuple(words[s:s + window])
            first[w] = min(first.get(w, key(r)), key(r))
    for r in rows:
        words = (r[1] or "").encode().split()
        keep, seen = [True] * len(words), set()
        for s in range(len(words) - window + 1):
            w = tuple(words[s:s + window])
            if w in seen or first[w] < key(r):
                keep[s:s + window] = [False] * window
            seen.add(w)
        kept = b" ".join(w for w, k in zip(words, keep) if k)
        out.append((r[0], len(words), keep.count(False), hashlib.sha256(kept).hexdigest(), kept))
    return out


def check(docs, rows, window):
    got = substring_dedup(docs, window).select("row.doc_id", "n_words", "n_removed", "kept_sha256", "kept_text", "row.code").collect()
    want = brute(rows, window)
    assert Counter(tuple(r)[:4] for r in got) == Counter(w[:4] for w in want)
    assert Counter(b" ".join(r.kept_text.encode().split()) for r in got) == Counter(w[4] for w in want)
    assert sum(w[2] for w in want) > 0


def test_equals_brute_force(docs, rows):
    check(docs, rows, 20)


def test_short_windows(docs, rows):
    check(docs, rows, 4)
    check(docs, rows, 1)


def test_text_without_repeats_stays_as_it_is(spark):
    text = "some  spaced\n\nout text "
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert substring_dedup(docs).first().kept_text == text


def test_empty(no_docs):
    assert substring_dedup(no_docs).count() == 0


def test_factors_stand_at_their_source_and_leave_no_seed_out(docs, rows):
    """Every factor equals its source word by word, ends where the source goes on otherwise, and the next one
    starts at the first window after it that occurs earlier."""
    window = 4
    key = lambda i: -(1 << 63) if i is None else i
    words, first = {}, {}
    for i, text, *_ in rows:
        w = (text or "").encode().split()
        words.setdefault(key(i), []).append(w)
        for s in range(len(w) - window + 1):
            first[tuple(w[s:s + window])] = min(first.get(tuple(w[s:s + window]), key(i)), key(i))
    seen = 0
    found = substring_dedup(docs, window, with_factors=True).select("row.doc_id", "factors", "n_words").collect()
    for r in found:
        mine = [w for w in words[key(r.doc_id)] if len(w) == r.n_words and all(
            any(w[f.start:f.start + f.length] == o[f.place:f.place + f.length] for o in words[f.source]) for f in r.factors)]
        assert mine
        end = 0
        for f in r.factors:
            assert f.start >= end and f.length >= window and (f.source, f.place) < (key(r.doc_id), f.start)
            end, seen = f.start + f.length, seen + 1
        if len(mine) == 1 and len(words[key(r.doc_id)]) == 1:  # starts of windows that occur earlier, outside the factors
            w, inside, before = mine[0], set(), set()
            for f in r.factors:
                inside.update(range(f.start, f.start + f.length))
            for s in range(len(w) - window + 1):
                t = tuple(w[s:s + window])
                assert s in inside or (t not in before and first[t] == key(r.doc_id))
                before.add(t)
    assert seen > 0


def test_boundary_windows_are_checked(spark):
    """The factor from document 1 ends at its end; the window across that end stands in document 2."""
    docs = spark.createDataFrame(
        [(1, "a b c d"), (2, "x c d e f y"), (3, "a b c d e f")], "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup(docs, 4, with_factors=True).select("row.doc_id", "n_removed", "factors").collect()}
    assert [tuple(f) for f in got[3].factors] == [(0, 4, 1, 0)]
    assert got[3].n_removed == 6 and got[1].n_removed == got[2].n_removed == 0

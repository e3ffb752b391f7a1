"""Decontamination, encoding, counting and licences against plain Python versions."""

import base64
import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tradeweave.llm import decontamination as D
from tradeweave.llm.byte_bpe import ByteBpe, encode, load, piece_pattern
from tradeweave.llm.common import plain_words
from tradeweave.llm.license_scans import labels_of, license_scan, postfix
from tradeweave.llm.token_counts import token_counts

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def sha(b):
    return hashlib.sha256(b).hexdigest()


# --- decontamination

ITEM = "item_id long, text string, word string"


def items_from(rows):
    texts = [r[1] for r in rows if r[1] and len(r[1].split()) > 40][:4]
    cut = [" ".join(t.split()[5:5 + n]) for t, n in zip(texts, (13, 20, 30, 6))]
    return [(7, cut[0], "w"), (10, cut[1].upper(), "w"), (9, cut[2], None), (3, cut[3], "w"), (3, "one", "w"), (None, cut[0], "w"), (4, None, "w"),
            (5, "", "w"), (6, "no such words here", "w"), (7, cut[0], "w"), (8, "X x x x x x x x x x x x x x", "w")]


def brute_contamination(rows, items, size=13, share=20):
    windows = {}
    for i, text, _ in items:
        w = plain_words(text)
        if i is None or not w:
            continue
        for k in range(max(1, len(w) - size + 1)):
            windows.setdefault(tuple(w[k:k + size]), set()).add(str(i))
    out = []
    for r in rows:
        w, hit, found = plain_words(r[1]), set(), set()
        for n in set(map(len, windows)):
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((r[0], len(w), len(hit), len(found), tuple(sorted(found)), bool(hit) and share * len(hit) >= len(w)))
    return Counter(out)


@pytest.mark.parametrize("probes", [100_000, 7])
def test_contamination_equals_brute_force(spark, docs, rows, probes, monkeypatch):
    monkeypatch.setattr(D, "PROBES", probes)  # few: the benchmark is met in several blocks
    items = items_from(rows)
    got = D.contamination(docs, spark.createDataFrame(items, ITEM)).collect()
    found = Counter((r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated) for r in got)
    assert found == brute_contamination(rows, items)
    assert sum(r.contaminated for r in got) > 3


def test_contamination_of_empty_tables(spark, docs, no_docs, rows):
    none = spark.createDataFrame([], ITEM)
    assert D.contamination(no_docs, spark.createDataFrame(items_from(rows), ITEM)).count() == 0
    got = D.contamination(docs, none)
    assert got.where("n_hit > 0 OR n_items > 0 OR contaminated").count() == 0 and got.count() == len(rows)


def test_contamination_runs_without_python(spark, docs, rows):
    plan = D.contamination(docs, spark.createDataFrame(items_from(rows), ITEM))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# --- byte-level BPE


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_encoding_equals_the_library(docs, rows, library):
    got = encode(docs, RANKS, public_tokenizers.PATTERN, digests=True).select("row.doc_id", "n_tokens", "ids", "decoded")
    want = []
    for r in rows:
        ids = library.encode_ordinary(r[1] or "")
        want.append((r[0], len(ids), sha(",".join(map(str, ids)).encode()), sha((r[1] or "").encode())))
    assert Counter(map(tuple, got.collect())) == Counter(want)


def test_ids_and_bytes(docs, rows, library):
    got = encode(docs, RANKS, public_tokenizers.PATTERN, keep=docs.columns).select("row.text", "row.code", "ids", "decoded").collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded).decode() == (r.text or "")


def test_random_strings_and_long_pieces(library):
    bpe, split = load(RANKS), piece_pattern(public_tokenizers.PATTERN).findall
    rnd = random.Random(1)
    signs = "abcdeéèüñß  \n\t\r\x1c\x1f\x85\xa0\u1680\u3000'strevmld019½²٣字漢😀-_!?.,\u0301\u200b"
    for _ in range(3000):
        text = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 40)))
        assert [i for p in split(text) for i in bpe.encode(p.encode())] == library.encode_ordinary(text), repr(text)
    for text in ("a" * 30_000, "".join(rnd.choice("abcdefgh") for _ in range(20_000))):
        assert bpe.encode(text.encode()) == library.encode_ordinary(text)


def test_vocabulary_with_tokens_that_no_merge_reaches():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"abcd": 258, b"cd": 259}
    bpe = ByteBpe(ranks)
    own = tiktoken.Encoding("own", pat_str=r"[a-z]+", mergeable_ranks=ranks, special_tokens={})
    for text in ("abcd", "abcdabcd", "xabcd", "bcd", "abcabc"):
        assert bpe.encode(text.encode()) == own.encode_ordinary(text)


def test_encoding_nothing(no_docs):
    assert encode(no_docs, RANKS, public_tokenizers.PATTERN).count() == 0


# --- token counts


def test_counts_equal_the_library(spark, docs, rows):
    tokenizer = Tokenizer.from_file(WORDS)
    odd = ["Straße <|endoftext|>ÉCOLE's", "ΣΑΣ İstanbul \u0301e ǅ", "<|startoftext|><|endoftext|>", "½²٣ 字 😀😀 _-!'s", "<|x|>", "\x1c\x85\xa0"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    got = token_counts(docs.select("doc_id", "text").unionByName(more), WORDS, 100).collect()
    texts = [(r[0], r[1] or "") for r in rows] + [(1000 + i, t) for i, t in enumerate(odd)]
    n = [len(tokenizer.encode(t, add_special_tokens=False).ids) for _, t in texts]
    assert Counter(map(tuple, got)) == Counter((i, len(t.encode()), c, c > 100) for (i, t), c in zip(texts, n))
    assert any(c > 100 for c in n)


def test_counting_nothing(no_docs):
    assert token_counts(no_docs, WORDS).count() == 0


# --- licences


def test_expressions():
    assert postfix("MIT OR Apache-2.0 AND BSD-3-Clause") == ["mit", "apache-2.0", "bsd-3-clause", "and", "or"]
    assert postfix("GPL-2.0-only WITH Classpath-exception-2.0 AND MIT")[-1] == "and"
    assert labels_of(postfix("(MIT OR LGPL-2.1+) AND GPL-2.0 WITH x")) == {"mit", "lgpl", "gpl"}
    for bad in ("MIT AND", "AND MIT", "(MIT", "MIT)", "MIT ISC", "()", "MIT !"):
        assert postfix(bad) is None


def test_license_places(spark, docs, rows):
    phrases = {("gnu", "general", "public", "license"): "gpl", ("apache", "license"): "apache", ("cc", "by"): "cc-by", ("mit", "license"): "mit"}
    odd = ["MIT-License, mit/LICENSE and the MIT licenses", "cc by cc by", "Apache\nLicense é apache license", "gnu general public license",
           "GNU Lesser General Public License", "SPDX-License-Identifier: (MIT OR ISC) */", "spdx-license-identifier: AND\nmit license", None, ""]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan(docs.select("doc_id", "text").where("doc_id IS NOT NULL").unionByName(more)).collect()}
    for i, text in [(r[0], r[1]) for r in rows if r[0] is not None] + [(1000 + i, t) for i, t in enumerate(odd)]:
        w = plain_words(text)
        places = [(k, label) for p, label in phrases.items() for k in range(len(w)) if tuple(w[k:k + len(p)]) == p]
        r, starts = got[i], [k for k, _ in places]
        assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min(starts, default=None), max(starts, default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and 0 <= r.score <= 1
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    assert got[1005].labels == "isc,mit" and got[1005].score == 1.0 and got[1004].labels == "lgpl" and got[1006].labels == "mit"
    assert license_scan(docs.limit(0)).count() == 0


def test_license_tags(spark):
    """Tags in any case; expressions of any length; texts without line ends."""
    long = " AND ".join(f"(L{i} OR M{i})" for i in range(13))
    many = "x SPDX-License-Identifier: MIT; " * 3000
    texts = ["SPDX-LicENSE-Identifier: MIT", f"// License-Expression: {long}", many, "é License-Expression:\tISC\nOR MIT", "SPDX-License-Identifier:\nMIT"]
    got = [r for r in license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()]
    assert (got[0].labels, got[0].score) == ("mit", 1.0)
    assert got[1].postfix == [" ".join(postfix(long))] and len(got[1].labels.split(",")) == 26
    assert got[2].labels == "mit" and len(got[2].expressions) == 3000
    assert got[3].labels == "isc" and got[3].expressions == ["isc"]
    assert (got[4].labels, got[4].score, got[4].postfix) == ("", 0.0, [])

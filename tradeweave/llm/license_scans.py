"""Licence scan: notice phrases and identifier tags by Aho-Corasick automata, expressions by shunting-yard.

Phrases are sought in the sequence of words, so any separators may stand between them. Tags such as
SPDX-License-Identifier are sought in the lower-cased text; the expression behind a tag is read with
WITH before AND before OR, and evaluated to the licences it asks for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave.llm.common import in_arrow, steps

# Phrases of the base labels, further notice phrases, tags, and families of identifiers.
BASE_PHRASES = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit",
}
MORE_PHRASES = {
    "gnu lesser general public license": "lgpl", "gnu affero general public license": "agpl",
    "mozilla public license": "mpl", "eclipse public license": "epl", "bsd license": "bsd",
    "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by sa": "cc-by-sa", "cc0 1 0 universal": "cc0",
    "all rights reserved": "reserved", "boost software license": "bsl", "isc license": "isc", "the unlicense": "unlicense",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
}
TAGS = ("spdx-license-identifier:", "license-expression:")
FAMILIES = (
    "agpl", "lgpl", "gpl", "apache", "mit", "bsd", "mpl", "epl", "isc", "cc0", "cc-by-nc", "cc-by-sa", "cc-by-nd", "cc-by",
    "unlicense", "bsl", "zlib", "artistic", "cddl", "ofl",
)
#: How sure a find is.
TAG, PHRASE, OWN_PHRASE = 1.0, 0.8, 0.6

_to_words = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_token = re.compile(r"[^\S\n]*(\(|\)|[a-z0-9][a-z0-9.+:-]*)", re.ASCII)
_STRENGTH = {"or": 1, "and": 2, "with": 3}


def expression_end(text: str, at: int = 0) -> int:
    """Where the stretch from there on this line ends that can be an expression; read token by token."""
    depth = 0
    want_name = True
    while m := _token.match(text, at):
        word = m[1]
        if word == "(" and want_name:
            depth += 1
        elif word == ")" and not want_name and depth:
            depth -= 1
        elif (word in _STRENGTH) == want_name or word in "()":
            break
        else:
            want_name = word in _STRENGTH
        at = m.end()
    return at


def postfix(text: str) -> list[str] | None:
    """The expression in postfix order by shunting-yard; None if it isn't one."""
    out: list[str] = []
    waiting: list[str] = []
    at, want_name = 0, True
    text = text.strip().lower()
    while at < len(text):
        m = _token.match(text, at)
        if not m:
            return None
        word, at = m[1], m.end()
        if word == "(":
            if not want_name:
                return None
            waiting.append(word)
        elif word == ")":
            if want_name:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif word in _STRENGTH:
            if want_name:
                return None
            while waiting and _STRENGTH.get(waiting[-1], 0) >= _STRENGTH[word]:
                out.append(waiting.pop())
            waiting.append(word)
            want_name = True
        else:
            if not want_name:
                return None
            out.append(word)
            want_name = False
    if want_name or "(" in waiting:
        return None
    return out + waiting[::-1]


def family(name: str) -> str:
    """Label of a licence identifier: its family, or the identifier itself."""
    return next((f for f in FAMILIES if name == f or name.startswith(f + "-") or name.startswith(f + "+")), name)


def labels_of(post: list[str]) -> set[str]:
    """Families of all identifiers; what follows WITH is an exception, not a licence."""
    found: set[str] = set()
    stack: list[set[str]] = []
    for word in post:
        if word in _STRENGTH:
            b, a = stack.pop(), stack.pop()
            stack.append(a if word == "with" else a | b)
        else:
            stack.append({family(word)})
    for names in stack:
        found |= names
    return found


def _tags() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for tag in TAGS:
        found.add_word(tag, tag)
    found.make_automaton()
    return found


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrases, own in ((MORE_PHRASES, True), (BASE_PHRASES, False)):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (len(phrase), label, own))
    found.make_automaton()
    return found


def scan(text: bytes, phrases: ahocorasick.Automaton, tags: ahocorasick.Automaton) -> dict:
    """Finds of one text."""
    words = b" ".join(text.translate(_to_words).split())
    line = f" {words.decode('latin-1')} "
    starts, base, own, expressions, posts = [], set(), set(), [], []
    score = 0.0
    for end, (size, label, extra) in phrases.iter(line):
        if extra:
            own.add(label)
            score = max(score, OWN_PHRASE)
        else:
            starts.append(end - size - 1)  # place of the phrase in words
            base.add(label)
            score = max(score, PHRASE)
    low = text.translate(_lower).decode("latin-1")
    for end, _ in tags.iter(low):
        whole = low[end + 1:expression_end(low, end + 1)].strip()
        post = postfix(whole) if whole else None
        if post:
            own |= labels_of(post)
            expressions.append(whole)
            posts.append(" ".join(post))
            score = TAG
    first = last = None
    if starts:
        first, last = line.count(" ", 0, min(starts) + 1) - 1, line.count(" ", 0, max(starts) + 1) - 1
    return {
        "n_words": words.count(b" ") + 1 if words else 0, "n_base": len(starts), "first_word": first, "last_word": last,
        "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(base | own)), "score": score, "expressions": expressions,
        "postfix": posts,
    }


_COLUMNS = {
    "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(),
    "labels": pa.string(), "score": pa.float64(), "expressions": pa.list_(pa.string()),
    "postfix": pa.list_(pa.string()),
}

_SPARK = {
    pa.int64(): T.LongType(), pa.string(): T.StringType(), pa.float64(): T.DoubleType(),
    pa.list_(pa.string()): T.ArrayType(T.StringType()),
}


def _work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    phrases, tags = _automaton(), _tags()
    for batch, texts in steps(batches, "text"):
        found = [scan(t, phrases, tags) for t in texts]
        yield pa.record_batch(
            [batch.column("doc_id"), *(pa.array([x[c] for x in found], kind) for c, kind in _COLUMNS.items())], ["doc_id", *_COLUMNS])


def license_scan(docs: DataFrame) -> DataFrame:
    """Licence finds of every whole text.

    doc_id, n_words, n_base (places of base phrases), first_word and last_word (smallest and largest start,
    words from 0; null without a place), base_labels, labels (with those of further phrases and of tag
    expressions; sorted, comma-joined), score (1 a tag with a sound expression, 0.8 a base phrase, 0.6 another
    phrase, else 0), expressions (as they stand behind tags, lower-cased) and postfix (each of them in postfix
    order, parted by blanks). Tags count in any case, anywhere in a text; an expression ends with its line.

    Words are runs of letters, digits and non-ASCII, A-Z lower-cased. A null text is empty. A tag without a
    sound expression adds nothing. Rows stay where they are read.
    """
    out = T.StructType([docs.schema["doc_id"]])
    for name, kind in _COLUMNS.items():
        out = out.add(name, _SPARK[kind])
    return in_arrow(docs.select("doc_id", F.col("text")), _work, out)

"""Byte-level BPE in linear time: longest matches, backtracking and adjacent-token compatibility.

Bytes are read as Latin-1 characters, so one Aho-Corasick automaton over the vocabulary yields the
longest token at every byte. Tokens are taken longest first; a token may follow another only if
merging their joined bytes gives back just the two (memoised per pair). Where nothing fits, the last
token is given up and its end is closed for good, so every byte is left at most once per token length.
A token sequence whose neighbours are all compatible is the one that the merges by rank produce.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradeweave.llm.common import in_arrow, rows_with_text, steps

#: Pieces, and pairs of tokens, that a worker remembers, twice over; characters of a piece worth remembering.
REMEMBERED, SHORT = 200_000, 64

# Fixed value: what counts as white space in the rank files' own library.
WHITE = r"\t-\r \x85\xA0  -     　"


_BEYOND = re.compile("[^\x00-\u024f]")


def piece_pattern(pattern: str) -> regex.Pattern:
    r"""The pattern with \s and \S spelled out, which differ between libraries for a few control characters."""
    return regex.compile(pattern.replace(r"\s\p", WHITE + r"\p").replace(r"\s", f"[{WHITE}]").replace(r"\S", f"[^{WHITE}]"))


def latin_pattern(pattern: str) -> re.Pattern:
    """The same pattern for text below U+0250, with \\p{L} and \\p{N} spelled out, for the faster built-in engine."""
    def members(kind: str) -> str:
        codes = [c for c in range(0x250) if unicodedata.category(chr(c))[0] == kind]
        starts = [c for c in codes if c - 1 not in codes]
        return "".join(rf"\u{a:04x}-\u{next(b for b in codes if b >= a and b + 1 not in codes):04x}" for a in starts)

    spelled = {r"\p{L}": members("L"), r"\p{N}": members("N"), r"\s": WHITE}
    outside = re.compile(r"\[[^]]*\]|\\p\{[LN]\}|\\[sS]")

    def put(found: re.Match) -> str:
        part = found.group()
        if part[0] == "[":
            return re.sub(r"\\p\{[LN]\}|\\s", lambda m: spelled[m.group()], part)
        return f"[^{WHITE}]" if part == r"\S" else f"[{spelled[part]}]"

    return re.compile(outside.sub(put, pattern))


class _Memo(dict):
    """What make(key) gives, remembered for short keys; when full, the entries not asked for since the last time go."""

    def __init__(self, make):
        super().__init__()
        self.make, self.old = make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
            if len(key) > SHORT:
                return value
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class ByteBpe:
    """Encoder and decoder for one rank table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.matcher = ahocorasick.Automaton()
        self.split: dict[int, tuple[int, int] | None] = {}  # usable token to the two it is merged from; None for a byte
        for piece, i in ranks.items():
            last = self._last_merge(piece)
            if last is not False:  # others never come out of merging
                self.split[i] = last
                if len(piece) > 1:
                    self.matcher.add_word(piece.decode("latin-1"), (i, len(piece)))
        self.matcher.make_automaton()
        self.byte = [ranks.get(bytes([c])) for c in range(256)]
        self._fits = _Memo(lambda pair: self._compatible(*pair))
        self._shorter: dict[int, int | None] = {}

    def _last_merge(self, piece: bytes) -> tuple[int, int] | None | bool:
        """The two tokens that plain merging by rank joins last to give the piece; None for a byte, False if it does not."""
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if rank == 1 << 60:
                return False
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None

    def fits(self, a: int, b: int) -> bool:
        return self._fits[a, b]

    def _compatible(self, a: int, b: int) -> bool:
        """Whether merging the joined bytes of two usable tokens gives back just the two.

        Merges are undone from the last one, so that a and b become the symbols that stood at their common edge
        before. A merge across the edge would have come first if its rank is below that of the merge undone last; of
        equal ranks the one further left comes first.
        """
        ranks, token, split = self.ranks, self.token, self.split
        limit = 1 << 60
        while True:
            if ranks.get(token[a] + token[b], 1 << 60) < limit:
                return False
            left, right = split[a], split[b]
            if left is not None and (right is None or a > b):
                limit, a = a, left[1]
            elif right is not None:
                limit, b = b + 1, right[0]
            else:
                return True

    def shorter(self, i: int) -> int | None:
        """The longest usable token that is a proper prefix of this one."""
        if i not in self._shorter:
            piece = self.token[i]
            found = (self.ranks.get(piece[:n]) for n in range(len(piece) - 1, 0, -1))
            self._shorter[i] = next((j for j in found if j is not None and j in self.split), None)
        return self._shorter[i]

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [self.byte[c] for c in piece]
        for end, (i, size) in self.matcher.iter(piece.decode("latin-1")):
            longest[end - size + 1] = i  # ends only grow, so the longest comes last
        taken: list[int] = []
        closed = bytearray(n + 1)
        at, token = 0, longest[0] if n else None
        while at < n:
            end = at + len(self.token[token])
            if not closed[end] and (not taken or self.fits(taken[-1], token)):
                taken.append(token)
                at = end
                token = longest[at] if at < n else None
                continue
            token = self.shorter(token)
            while token is None:
                closed[at] = 1
                last = taken.pop()
                at -= len(self.token[last])
                token = self.shorter(last)
        return taken

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(self.token[i] for i in ids)


@functools.lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    with open(path, "rb") as f:
        return ByteBpe({base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())})


@functools.lru_cache(maxsize=2)
def _memo(path: str) -> _Memo:
    """Piece to its ids as text and what they decode to."""
    bpe = load(path)

    def make(piece: str) -> tuple[str, bytes]:
        ids = bpe.encode(piece.encode())
        return ",".join(map(str, ids)), bpe.decode(ids)

    return _Memo(make)


def _work(path: str, pattern: str, digests: bool, column: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        general, latin = piece_pattern(pattern).findall, latin_pattern(pattern).findall
        known = _memo(path)
        for batch, texts in steps(batches, column):
            counts, ids, back = [], [], []
            for text in texts:
                plain = text.decode()
                pieces = [known[p] for p in (general if _BEYOND.search(plain) else latin)(plain)]
                joined, decoded = ",".join([p[0] for p in pieces]), b"".join([p[1] for p in pieces])
                counts.append(joined.count(",") + 1 if joined else 0)
                if digests:
                    ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    back.append(hashlib.sha256(decoded).hexdigest())
                else:
                    ids.append([int(i) for i in joined.split(",")] if joined else [])
                    back.append(decoded)
            kinds = (pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.binary())
            yield pa.record_batch(
                [batch.column("row"), pa.array(counts, pa.int64()), pa.array(ids, kinds[0]), pa.array(back, kinds[1])],
                ["row", "n_tokens", "ids", "decoded"])

    return work


def encode(docs: DataFrame, path: str, pattern: str, digests: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Encode every text by the ranks at path, each match of pattern separately, and decode the ids again.

    Gives the struct `row` (the columns named by keep, default doc_id), n_tokens, ids array<int> and decoded
    binary; with digests, ids and decoded are the lowercase hex SHA-256 of the ids joined by commas and of
    the bytes. A null or empty text has no tokens. Special tokens are ordinary text. No shuffle: rows stay
    where they are read, whatever their lengths, repeats and order.
    """
    rows, column = rows_with_text(docs, keep or ["doc_id"])
    out = T.StructType([rows.schema["row"]]).add("n_tokens", "long")
    out = out.add("ids", "string").add("decoded", "string") if digests else out.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "binary")
    return in_arrow(rows, _work(path, pattern, digests, column), out)

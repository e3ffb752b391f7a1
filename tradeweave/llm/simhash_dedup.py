"""SimHash near duplicates: exact pairs within a Hamming distance, found through vantage-point trees.

A fingerprint is cut into parts of 16 bits; of two fingerprints that differ in at most d bits some part differs in
at most d // parts. The values of a part are partitioned by a vantage-point tree: at every node by their Hamming
distance from the node's vantage point, near ones to one side, far ones to the other. A leaf of a part's tree is a
shard. A fingerprint is at home in one shard of each part and asks every shard that its neighbourhood overlaps:
branches whose triangle bound excludes the neighbourhood are pruned, and of the leaves then left those that hold
no value within reach. Of two shards only the later one is asked, so a pair is not looked for twice in a part.

The tree is over all values a part can have, so it is the same for every input, needs no sample and loses nothing.
A shard passes on the edges of a spanning forest, never the pairs of a group; a shard that near copies of one text
fill is cut into blocks that meet pairwise in separate tasks.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.common import in_arrow, longs, scratch, steps
from tradeweave.llm.jaccard_join import components

#: Bits of a part and levels of its tree; fingerprints of one block of a shard; shingles and pairs of one vectorised step.
BITS, DEPTH, BLOCK, SHINGLES, PAIRS = 16, 12, 1 << 15, 1 << 16, 1 << 22

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How often each bit of 64 is set, lowest first."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)


def fingerprint(text: bytes, size: int, seed: int) -> int:
    """Majority of the bits of the hashes of all shingles; 0 without words."""
    words = text.translate(_LOWER).split()  # blank and \t\n\v\f\r
    if not words:
        return 0
    size = min(size, len(words))
    shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, np.int64), 0
    while part := [digest(s, seed) for s in islice(shingles, SHINGLES)]:
        ones += _bit_counts(np.array(part, np.uint64))
        n += len(part)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(size: int, seed: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, "text"):
            prints = np.array([fingerprint(t, size, seed) for t in texts], np.uint64)
            yield pa.record_batch([batch.column("doc_id"), longs(prints)], ["doc_id", "node"])

    return work


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class VantageTree:
    """Vantage-point tree over all values of so many bits; node i has the children 2i (near) and 2i + 1 (far)."""

    def __init__(self, bits: int = BITS, depth: int = DEPTH):
        self.bits, self.depth = bits, depth
        self.vantage = np.zeros(1 << depth, np.int64)
        self.radius = np.full(1 << depth, bits, np.int64)
        groups = {1: np.arange(1 << bits)}
        for _ in range(depth):
            below = {}
            for node, values in groups.items():
                near = self._split(node, values)
                below[2 * node], below[2 * node + 1] = values[near], values[~near]
            groups = below
        self.home = np.zeros(1 << bits, np.int64)  # leaf of every value
        for node, values in groups.items():
            self.home[values] = node - (1 << depth)

    def _split(self, node: int, values: np.ndarray) -> np.ndarray:
        """Choose the vantage point and radius with the fewest visits of values to values; where the near ones are."""
        best, near = 2.0, np.ones(len(values), bool)
        if len(values) < 2:
            return near
        for vantage in {int(values[0]), int(values[-1]), int(values[len(values) // 2]), int(values[0]) ^ ((1 << self.bits) - 1)}:
            distance = _distance(values, vantage)
            within = np.cumsum(np.bincount(distance, minlength=self.bits + 2)) / len(values)  # share of them up to each distance
            inner = within[:-2]
            visits = within[1:-1] * inner + (1 - np.concatenate([[0.0], inner[:-1]])) * (1 - inner)
            visits[(inner <= 0) | (inner >= 1)] = 2.0
            radius = int(visits.argmin())
            if visits[radius] < best:
                best, near = visits[radius], distance <= radius
                self.vantage[node], self.radius[node] = vantage, radius
        return near

    def reached(self, values: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of value, leaf) for every leaf that the triangle bounds do not exclude for that distance."""
        at, node = np.arange(len(values)), np.ones(len(values), np.int64)
        for _ in range(self.depth):
            distance, radius = _distance(values[at], self.vantage[node]), self.radius[node]
            near, far = distance - within <= radius, distance + within > radius
            at, node = np.concatenate([at[near], at[far]]), np.concatenate([2 * node[near], 2 * node[far] + 1])
        return at, node - (1 << self.depth)

    def routes(self, within: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first, number, leaves): for every value the leaves it goes to, its home first, then later ones it must ask."""
        leaves = 1 << self.depth
        values = np.arange(1 << self.bits)
        held = [values]  # values within reach of each value, by flipping up to so many bits
        for _ in range(within):
            held = [v ^ (1 << b) for v in held for b in range(self.bits)] + held
        holds = np.sort(np.stack([values * leaves + self.home[v] for v in held]), axis=None)
        found = []
        for part in np.array_split(values, max(1, len(values) >> 12)):
            at, leaf = self.reached(part, within)
            found.append(part[at] * leaves + leaf)
        pairs = np.sort(np.concatenate(found))  # a leaf is reached once at most
        pairs = pairs[holds[np.minimum(np.searchsorted(holds, pairs), len(holds) - 1)] == pairs]
        value, leaf = pairs // leaves, pairs % leaves
        later = leaf >= self.home[value]  # leaves ascend within a value, so the home is its first
        value, leaf = value[later], leaf[later]
        number = np.bincount(value, minlength=len(values))
        return np.cumsum(number) - number, number, leaf


@functools.lru_cache(maxsize=4)
def _routes(depth: int, within: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return VantageTree(BITS, depth).routes(within)


def _parts(prints: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    for part in range(64 // BITS):
        yield part, ((prints >> np.uint64(BITS * part)) & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many fingerprints have each value of each part."""
    counts = np.zeros(64 // BITS << BITS, np.int64)
    for batch in batches:
        for part, value in _parts(batch.column("node").to_numpy().view(np.uint64)):
            counts += np.bincount(value + (part << BITS), minlength=len(counts))
    some = np.flatnonzero(counts)
    yield pa.record_batch([pa.array(some, pa.int64()), pa.array(counts[some])], ["value", "n"])


def shard_blocks(prints: DataFrame, routes: tuple[np.ndarray, np.ndarray, np.ndarray], leaves: int) -> np.ndarray:
    """Blocks that each shard is cut into, from the number of fingerprints by value of a part (65,536 a part)."""
    found = in_arrow(prints.select("node"), _values, "value long, n long").groupBy("value").agg(F.sum("n").alias("n")).toArrow()
    value, n = found.column("value").to_numpy(), found.column("n").to_numpy()
    first, number, leaf = routes
    part, code = value >> BITS, value & ((1 << BITS) - 1)
    row = np.repeat(np.arange(len(value)), number[code])
    nth = np.arange(len(row)) - np.repeat(np.cumsum(number[code]) - number[code], number[code])
    shard = part[row] * leaves + leaf[first[code[row]] + nth]
    size = np.bincount(shard, weights=n[row], minlength=64 // BITS * leaves)
    return np.maximum(1, -(-size.astype(np.int64) // BLOCK))


def _deal(shared):
    """Rows (shard, low, high, home, node): blocks low and high of the shard meet there."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (first, number, leaf), blocks, leaves = shared.value
        for whole in batches:
            for start in range(0, whole.num_rows, 8192):
                prints = whole.slice(start, 8192).column("node").to_numpy().view(np.uint64)
                for part, code in _parts(prints):
                    row = np.repeat(np.arange(len(code)), number[code])
                    nth = np.arange(len(row)) - np.repeat(np.cumsum(number[code]) - number[code], number[code])
                    shard = part * leaves + leaf[first[code[row]] + nth]
                    many = blocks[shard]
                    block = ((prints[row] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)).astype(np.int64) % many
                    copy = np.repeat(np.arange(len(row)), many)  # one for each block that its own one meets
                    other = np.arange(len(copy)) - np.repeat(np.cumsum(many) - many, many)
                    low, high = np.minimum(block[copy], other), np.maximum(block[copy], other)
                    yield pa.record_batch(
                        [pa.array(shard[copy].astype(np.int32)), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
                         pa.array(nth[copy] == 0), longs(prints[row[copy]])],
                        ["shard", "low", "high", "home", "node"])

    return work


def _forest(prints: np.ndarray, home: np.ndarray, within: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(node, root) of those that are joined to another one, the root being one of them."""
    parent = np.arange(len(prints))
    own = np.flatnonzero(home)
    rows = max(1, PAIRS // max(1, len(prints)))
    for lo in range(0, len(own), rows):
        some = own[lo:lo + rows]
        a, b = np.nonzero(np.bitwise_count(prints[some, None] ^ prints[None, :]) <= within)
        a = some[a]
        while True:
            x, y = parent[a], parent[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))
            while (parent[parent] != parent).any():
                parent = parent[parent]
    joined = np.bincount(parent, minlength=len(prints))[parent] > 1
    if joined.any():
        yield prints[joined], prints[parent[joined]]


def _compare(within: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def close() -> None:
            prints, home = (np.concatenate(x) for x in zip(*held))
            if len(prints) > 1:
                out.extend(_forest(prints, home, within))

        def batch_of() -> pa.RecordBatch:
            node, hub = (np.concatenate(x) if out else np.zeros(0, np.uint64) for x in (zip(*out) if out else ((), ())))
            return pa.record_batch([longs(node), longs(hub)], ["node", "hub"])

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "low", "high")], 1)
            prints = batch.column("node").to_numpy().view(np.uint64)
            home = batch.column("home").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(keys)]):
                if hi == lo:
                    continue
                here = tuple(keys[lo].tolist())
                if held and here != key:
                    close()
                    held.clear()
                key = here
                held.append((prints[lo:hi], home[lo:hi]))
            if sum(len(x[0]) for x in out) > 1 << 18:
                yield batch_of()
                out.clear()
        if held:
            close()
        yield batch_of()

    return work


def simhash_dedup(docs: DataFrame, size: int = 4, seed: int = 42, within: int = 4) -> DataFrame:
    """For every row of docs (doc_id, text): doc_id, fingerprint (16 hex digits) and component_id.

    Words are runs of anything but blank and \\t\\n\\v\\f\\r, A-Z lower-cased; shingles are `size` consecutive words
    joined by a blank, repeats included (fewer words: all of them; none, or null: fingerprint zero). A bit of the
    fingerprint is set if over half of the shingles' XXH64 hashes have it. Fingerprints that differ in `within` bits
    or less are linked; component_id is the smallest doc_id reached by links, its own row's included. A null doc_id
    takes no part in that minimum: it is null only where no row of the component has an id. Repeated rows, and
    different texts with one fingerprint, are one node; empty documents are linked like any others.
    """
    spark = docs.sparkSession
    tmp = scratch(spark, "simhash")
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = tmp.store(in_arrow(slim, _fingerprints(size, seed), "doc_id long, node long"), "prints")
    firsts = tmp.store(prints.groupBy("node").agg(F.min("doc_id").alias("first")), "firsts")
    leaves = 1 << DEPTH
    routes = _routes(DEPTH, within * BITS // 64)
    # a table over the values of a part: its size does not depend on the documents
    shared = spark.sparkContext.broadcast((routes, shard_blocks(firsts, routes, leaves), leaves))
    dealt = in_arrow(firsts.select("node"), _deal(shared), "shard int, low int, high int, home boolean, node long")
    ordered = dealt.repartition("shard", "low", "high").sortWithinPartitions("shard", "low", "high")
    edges = tmp.store(in_arrow(ordered, _compare(within), "node long, hub long").distinct(), "edges")
    groups = components(edges, tmp, "group")
    led = groups.join(firsts, "node")
    leads = led.groupBy("comp").agg(F.min("first").alias("lead"))
    # stored, so that the join of a fingerprint with many copies can be split
    named = tmp.store(led.join(leads, "comp").select("node", "lead"), "named")
    every = tmp.store(firsts.join(named, "node", "left").select("node", F.coalesce("lead", "first").alias("component_id")), "every")
    shown = F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint")
    return prints.join(every, "node").select("doc_id", shown, "component_id")

"""N-gram Jaccard self-join by MinHash banding, verified on full n-gram sets, with its groups.

Documents with the same set of n-grams are one text class; only classes are compared. Signatures are cut into
bands whose number and size follow from the recall wanted at the threshold, and band hashes are shuffled. A pair is
a candidate if it shares a band, and candidates alone are compared, by their full sets.

Where classes that meet directly or through others are few, their sets travel once and meet in one task. Where
common passages chain many classes together, sets go to each of their band buckets instead, and a pair is
counted in the bucket of its first shared band. A bucket that holds more classes or n-grams than a task should is
cut into blocks that meet pairwise in separate tasks. Tasks pass on counts of links and the edges of a spanning
forest, never the pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.llm.common import Words, in_arrow, key_of, longs, mix, scratch, settle, span_hashes, steps

#: Hash functions of a signature; classes and n-grams in one block of a group; distinct n-grams of one dense step.
HASHES, BLOCK, GRAMS, DENSE = 108, 512, 1 << 21, 4096


def bands_for(threshold: float, recall: float, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows): the longest bands with which a pair at the threshold still meets with that probability."""
    for rows in range(hashes, 0, -1):
        bands = hashes // rows
        if 1 - (1 - threshold ** rows) ** bands >= recall:
            return bands, rows
    raise ValueError("too few hashes for this recall")


class _Sets:
    """Distinct n-gram hashes of a few documents, sorted within each."""

    def __init__(self, texts: list[bytes], n: int):
        words = Words(texts)
        count = words.last - words.first
        size = np.maximum(np.minimum(count, 1), count - n + 1)  # fewer words than n: all of them are the one n-gram
        start = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(words.first, size)
        doc = np.repeat(np.arange(len(texts)), size)
        end = np.minimum(start + n, words.last[doc])
        grams = span_hashes(words.hash, start, end, 7)
        order = np.lexsort([grams, doc])
        grams, doc = grams[order], doc[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (doc[1:] != doc[:-1])
        self.grams = grams[new]
        self.size = np.bincount(doc[new], minlength=len(texts))
        self.first = np.cumsum(self.size) - self.size


def _signatures(n: int, bands: int, rows: int):
    salts = [int(x) for x in mix(np.arange(bands * rows, dtype=np.uint64), 11)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, "text"):
            s = _Sets(texts, n)
            some = np.flatnonzero(s.size)
            out = np.zeros((len(some), bands), np.uint64)
            if len(some):
                for b in range(bands):
                    for r in range(rows):
                        value = s.grams ^ np.uint64(salts[b * rows + r])
                        value = (value ^ (value >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
                        out[:, b] = mix(out[:, b] + np.minimum.reduceat(value, s.first[some]), 13)
                    out[:, b] = mix(out[:, b], 17 + b)  # bands do not meet each other
            whole = np.zeros((2, len(texts)), np.uint64)
            total = np.concatenate([[np.uint64(0)], np.cumsum(mix(s.grams, 19), dtype=np.uint64)])
            other = np.concatenate([[np.uint64(0)], np.cumsum(mix(s.grams, 23), dtype=np.uint64)])
            for x, t in zip(whole, (total, other)):
                x[:] = mix(t[s.first + s.size] - t[s.first], 29)
            key, content = batch.column("_key").to_numpy(), batch.column("_content").to_numpy()
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(some) + 1, dtype=np.int32) * bands), longs(out.ravel()))
            yield pa.record_batch(
                [longs(key[some]), longs(content[some]), longs(whole[0][some]), longs(whole[1][some]), longs(s.size[some]), flat],
                ["_key", "_content", "h1", "h2", "n", "bands"])

    return work


def _grams(n: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in steps(batches, "text"):
            s = _Sets(texts, n)
            ends = s.first + s.size
            yield pa.record_batch(
                [*(batch.column(c) for c in ("node", "bands", "groups")),
                 pa.array([s.grams[a:b].tobytes() for a, b in zip(s.first, ends)], pa.binary())],
                ["node", "bands", "groups", "grams"])

    return work


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs."""
    if len(sets) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), both], [both, len(sets[1])]])
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, gram, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1
    place = np.cumsum(shared) - 1
    keep = shared[gram]
    doc, gram = doc[keep], place[gram[keep]]
    order = np.argsort(gram, kind="stable")
    doc, gram = doc[order], gram[order]
    out = np.zeros((len(sets), len(sets)), np.float64)
    for lo in range(0, int(shared.sum()), DENSE):
        a, b = np.searchsorted(gram, [lo, lo + DENSE])
        dense = np.zeros((len(sets), DENSE), np.float32)
        dense[doc[a:b], gram[a:b] - lo] = 1
        out += dense @ dense.T
    return out.astype(np.int64)


def _share(bands: np.ndarray, kind: int) -> np.ndarray:
    """Pairs that share a band at all (kind below 0), or none before that band, which all of them share."""
    n, last = len(bands), bands.shape[1] if kind < 0 else kind
    found = np.zeros((n, n), bool)
    for j in range(last):
        found |= bands[:, j, None] == bands[None, :, j]
    return found if kind < 0 else ~found


def _compare(threshold: float):
    t = Fraction(str(threshold))

    def links(rows: list[tuple], kind: int, cross: bool) -> Iterator[tuple[int, int, int]]:
        """(class, links, smallest class it is joined to here) of one block or two that meet."""
        if len(rows) < 2:
            return
        alike = _share(np.array([r[2] for r in rows], np.int64), kind)
        np.fill_diagonal(alike, False)
        if cross:
            block = np.array([r[1] for r in rows])
            alike &= block[:, None] != block[None, :]
        if not alike.any():
            return
        key = np.array([r[0] for r in rows], np.int64)
        sets = [np.frombuffer(r[3], np.uint64) for r in rows]
        size = np.array([len(s) for s in sets], np.int64)
        alike &= _overlaps(sets) * (t.denominator + t.numerator) >= t.numerator * (size[:, None] + size[None, :])
        count = alike.sum(1)
        some = np.flatnonzero(count)
        root = key.copy()
        while len(some):  # smallest key within reach
            least = np.minimum(root[some], np.where(alike[some], root[None, :], np.iinfo(np.int64).max).min(1))
            if (least == root[some]).all():
                break
            root[some] = least
        for i in some:
            yield int(key[i]), int(count[i]), int(root[i])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int, int]] = []
        group, rows = None, []
        for batch in batches:
            names = ["kind", "group", "low", "high", "node", "block", "bands", "grams"]
            for kind, name, low, high, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if (kind, name, low, high) != group:
                    if group:
                        out.extend(links(rows, group[0], group[2] != group[3]))
                    group, rows = (kind, name, low, high), []
                rows.append(row)
            if len(out) > 10_000:
                yield _links(out)
                out = []
        if group:
            out.extend(links(rows, group[0], group[2] != group[3]))
        yield _links(out)

    return work


def _links(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[], [], []]
    return pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["node", "links", "root"])


def components(members: DataFrame, tmp, label: str) -> DataFrame:
    """(node, comp): the smallest node that each node of members (node, hub) reaches through shared hubs.

    Each round takes minima over hubs and nodes and then jumps to the label's own label; every round is
    stored, so nothing long is recomputed. Rounds grow with the logarithm of the longest chain.
    """
    members = tmp.store(members.distinct(), f"{label}-members")
    labels = tmp.store(members.select("node", F.col("node").alias("comp")).distinct(), f"{label}-0")
    step = 0
    while True:
        hubs = members.join(labels, "node").groupBy("hub").agg(F.min("comp").alias("comp"))
        least = members.join(hubs, "hub").groupBy("node").agg(F.min("comp").alias("next"))
        jump = labels.select(F.col("node").alias("next"), F.col("comp").alias("far"))
        new = labels.join(least, "node").join(jump, "next").select("node", F.least("next", "far").alias("comp"), (F.least("next", "far") < F.col("comp")).alias("moved"))
        step += 1
        stored = tmp.store(new, f"{label}-{step}")
        moved = not stored.where("moved").isEmpty()
        labels = stored.select("node", "comp")
        if not moved:
            return labels
        tmp.forget(f"{label}-{step - 1}")


def _placed(heads: DataFrame, tmp) -> DataFrame:
    """Classes that share a band with another one, with the groups in which they are compared.

    heads: node, n (n-grams), bands, head. A group is a whole component (kind -1) where it fits one block, otherwise
    a bucket (kind: its band), cut into as many parts as its classes and n-grams ask for.
    """
    buckets = heads.select("node", "n", F.posexplode("bands").alias("kind", "hub"))
    size = [F.count("*").alias("c"), F.sum("n").alias("g")]
    meeting = tmp.store(buckets.groupBy("hub").agg(*size).where("c > 1"), "meeting")
    members = tmp.store(buckets.join(meeting, "hub").select("node", "n", "kind", "hub", "c", "g"), "shared")
    clusters = components(members.select("node", "hub"), tmp, "meet")
    fits = (F.col("c") <= BLOCK) & (F.col("g") <= GRAMS)
    sized = clusters.join(heads.select("node", "n"), "node").groupBy("comp").agg(*size).select("comp", fits.alias("fits"))
    located = tmp.store(clusters.join(sized, "comp").select("node", "comp", "fits"), "located")
    parts = F.greatest(F.ceil(F.col("c") / BLOCK), F.ceil(F.col("g") / GRAMS)).cast("int")
    whole = located.where("fits").select("node", F.lit(-1).alias("kind"), F.col("comp").alias("group"), F.lit(1).alias("parts"))
    split = members.join(located.where("NOT fits").select("node"), "node").select("node", "kind", F.col("hub").alias("group"), parts.alias("parts"))
    groups = whole.unionByName(split).groupBy("node").agg(F.collect_list(F.struct("kind", "group", "parts")).alias("groups"))
    return groups.join(heads, "node").select("node", "head._key", "head._content", "bands", "groups")


def jaccard_join(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999999) -> DataFrame:
    """For every row of docs (doc_id, text): its class, its text class and its links.

    doc_id; class_id: smallest doc_id of all rows joined to it by links or equality, directly or through
    others; text_id: smallest doc_id with the same set of n-grams; n_links: how many other text classes have
    a similarity of threshold or more to it (Jaccard index of the sets of n-grams); is_first: whether it is
    the document, that is doc_id and text, that names the class; key, content: doc_id and text as hashes.

    Words are runs of anything but blank and \\t\\n\\v\\f\\r. A document of fewer words than n, but not none, has
    one n-gram. Documents without words, or null, are alone in their class and have no links. A null doc_id
    counts as the smallest and gives null classes. Each row is judged by its own text, also where rows share
    a doc_id or have none; rows with equal doc_id and text (by 64 bits) are one document.

    A pair of text classes at the threshold is found with probability recall or more; whatever is found is
    verified. Equality of sets is by 128 bits, n-grams are compared by 64.
    """
    spark = docs.sparkSession
    tmp = scratch(spark, "jaccard")
    bands, rows = bands_for(threshold, recall)
    content = F.xxhash64("text").alias("_content")
    slim = docs.select(key_of().alias("_key"), content, "text")
    signed = tmp.store(in_arrow(slim, _signatures(n, bands, rows), "_key long, _content long, h1 long, h2 long, n long, bands array<long>"), "signed")
    # stored, so that nodes keep their numbers, and adaptive execution can split a text with many copies in the join below
    first = F.min(F.struct("_key", "_content")).alias("head")
    firsts = tmp.store(signed.groupBy("h1", "h2").agg(first).withColumn("node", F.monotonically_increasing_id()), "firsts")
    own = (F.col("_key") == F.col("head._key")) & (F.col("_content") == F.col("head._content"))
    joined = signed.join(firsts, ["h1", "h2"]).select("_key", "_content", "head", "node", "n", F.when(own, F.col("bands")).alias("bands"))
    classes = tmp.store(joined, "classes")
    tmp.forget("signed")
    near = scratch(spark, "jaccard-meet")
    heads = near.store(classes.where("bands IS NOT NULL").dropDuplicates(["node"]).select("node", "n", "bands", "head"), "heads")
    placed = tmp.store(_placed(heads, near), "placed")
    near.drop()
    settle(spark)
    # a shuffle at every size, as classes that meet another grow with the documents; a repeated row is no other text class
    wanted = slim.join(placed.hint("shuffle_hash"), ["_key", "_content"]).dropDuplicates(["node"])
    groups = "array<struct<kind: int, group: long, parts: int>>"
    sets = in_arrow(wanted, _grams(n), f"node long, bands array<long>, groups {groups}, grams binary")
    met = sets.select("node", "bands", "grams", F.explode("groups").alias("g")).select("node", "bands", "grams", "g.*")
    block = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    met = met.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    key = ["kind", "group", "low", "high"]
    met = met.select(*key[:2], F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "node", "block", "bands", "grams")
    found = tmp.store(in_arrow(met.repartition(*key).sortWithinPartitions(*key), _compare(threshold), "node long, links long, root long"), "links")
    tmp.forget("placed")
    settle(spark)
    counts = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    edges = found.select("node", F.col("root").alias("hub")).unionByName(found.select(F.col("root").alias("node"), F.col("root").alias("hub")))
    joined = scratch(spark, "jaccard-group")
    groups = tmp.store(components(edges, joined, "group").join(firsts.select("node", "head"), "node"), "groups")
    joined.drop()
    names = groups.groupBy("comp").agg(F.min("head").alias("lead"))
    by_text = groups.join(names, "comp").join(counts, "node").select("node", "n_links", "lead")
    by_text = tmp.store(by_text, "by-text")  # as above: a text with many copies is split in the next join
    judged = classes.select("_key", "_content", "head", "node").join(by_text, "node", "left")
    # rows of one id and text have one class; stored, so that the join with repeated rows can be split
    answer = tmp.store(
        judged.groupBy("_key", "_content").agg(F.min(F.struct(F.coalesce("lead", "head").alias("lead"), "head", "n_links")).alias("a"))
        .select("_key", "_content", "a.lead", "a.head", "a.n_links"), "answer")
    tmp.forget("classes", "firsts", "links", "groups", "by-text")
    shown = lambda c: F.nullif(F.coalesce(c, F.col("doc_id").cast("long")), F.lit(-(1 << 63)))
    lead = F.col("lead")
    is_first = lead.isNull() | ((lead["_key"] == F.col("_key")) & (lead["_content"] == F.col("_content")))
    return docs.select("doc_id", key_of().alias("_key"), content).join(answer, ["_key", "_content"], "left").select(
        "doc_id", shown(F.col("lead._key")).alias("class_id"), shown(F.col("head._key")).alias("text_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), is_first.alias("is_first"),
        F.col("_key").alias("key"), F.col("_content").alias("content"))

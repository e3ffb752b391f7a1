"""Run the turnarounds of groups that share references inside one task.

Groups are joined by the references of their open rows. What such a component links depends on nothing outside
it, so a component of bounded size runs to its fixpoint in one task, from the same state and with the same turnaround
numbers as all others; many components share a task. The number of Spark jobs then does not depend on how many
turnarounds the longest chain of instructions takes. Components above the bound, and those whose extent a fixed
number of rounds does not find, are left to the loop over all of them.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeweave.operators.matching import with_exact_quantity
from tradeweave.session import Scratch, import_in_workers

_REF = "PSMSMatchedReference"


def _keys(df: DataFrame) -> DataFrame:
    """`_g` and `_h`: the group and the reference as 64-bit hashes; two that collide only make a component larger."""
    group = F.when(F.col("Code_CDP").isNotNull(), F.xxhash64("SettlementDate", "Code_CDP"))
    return df.withColumn("_g", group).withColumn("_h", F.xxhash64("SettlementDate", F.col(_REF).isNull(), _REF))


def component_labels(rows: DataFrame, scratch: Scratch, rounds: int) -> tuple[DataFrame, DataFrame | None]:
    """(labels, unfinished): `_g` to the least group `comp` it reaches, for groups that share a reference with another.

    In each round a class of groups joins the least class that any of its references touches, and that one's own
    choice and the next one's are followed at once, so classes fall by a factor a round. References all of whose
    groups are in one class stay so and leave the rounds, and so do classes without any other reference: a round keeps
    only which class each of its classes joined, and groups get their label from these steps at the end. After so many
    rounds the labels of components not yet found whole are listed as unfinished.
    """
    pairs = rows.where("_g IS NOT NULL").select("_g", "_h").distinct()
    shared = pairs.groupBy("_h").agg(F.count("*").alias("_n")).where("_n > 1").select("_h")
    pairs = scratch.store(pairs.join(shared, "_h"), "pairs").select("_h", F.col("_g").alias("comp"))
    steps: list[DataFrame] = []
    for step in range(1, rounds + 1):
        touched = scratch.store(_spanning(pairs), f"pairs{step}")
        if touched.isEmpty():
            return _followed(steps, pairs, scratch), None
        hooks = scratch.store(touched.groupBy("comp").agg(F.min("next").alias("next")), f"hooks{step}")
        for _ in range(2):  # the next class shares the reference, so it is among the hooks
            hooks = hooks.join(hooks.select(F.col("comp").alias("next"), F.col("next").alias("far")), "next").select("comp", F.col("far").alias("next"))
        steps.append(scratch.store(hooks, f"joined{step}"))
        pairs = touched.select("_h", "comp").join(steps[-1], "comp").select("_h", F.col("next").alias("comp")).distinct()
    unfinished = scratch.store(_spanning(pairs).select("comp").distinct(), "unfinished")
    return _followed(steps, pairs, scratch), unfinished


def _followed(steps: list[DataFrame], pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """Every group that shares a reference, all of which are in the first step, with the class that the steps lead it to."""
    if not steps:
        return scratch.store(pairs.select(F.col("comp").alias("_g"), "comp").distinct(), "labels")
    last = steps[-1]
    for step in reversed(steps[:-1]):  # the last steps are the smallest
        last = step.join(last.select(F.col("comp").alias("next"), F.col("next").alias("far")), "next", "left").select("comp", F.coalesce("far", "next").alias("next"))
    return scratch.store(last.select(F.col("comp").alias("_g"), F.col("next").alias("comp")), "labels")


def _spanning(pairs: DataFrame) -> DataFrame:
    """Pairs of the references that are in more than one class, with the least of them as `next`."""
    span = pairs.groupBy("_h").agg(F.min("comp").alias("next"), F.max("comp").alias("_last")).where("next < _last")
    return pairs.join(span.drop("_last"), "_h").select("_h", "comp", "next")


def split_components(rows: DataFrame, cells: DataFrame, scratch: Scratch, most: int, rounds: int,
                     few: int) -> tuple[DataFrame, ...]:
    """(small rows, small cells, large rows, large cells): with `comp`, where it has at most so many rows and cells.

    Rows outside quantity linking follow the groups that hold their reference; one that no open row of a
    group shares can no longer be linked and is left out. Large components are listed; up to ``few`` are broadcast.
    """
    keyed = _keys(rows)
    labels, unfinished = component_labels(keyed, scratch, rounds)
    own = F.coalesce("comp", "_g").alias("comp")
    labels = labels.where("comp <> _g")
    grouped = keyed.where("_g IS NOT NULL").join(labels, "_g", "left").select(*keyed.columns, own)
    outside = keyed.where("_g IS NULL")
    if not outside.isEmpty():
        hubs = grouped.groupBy("_h").agg(F.min("comp").alias("comp"))
        grouped = grouped.unionByName(outside.join(hubs, "_h").select(*keyed.columns, "comp"))
    placed = scratch.store(grouped.select(*rows.columns, "comp"), "placed")
    of_cells = _keys(cells.withColumn(_REF, F.lit(""))).join(labels, "_g", "left").select(*cells.columns, own)
    of_cells = scratch.store(of_cells, "placed-cells")
    size = placed.select("comp").unionByName(of_cells.select("comp")).groupBy("comp").agg(F.count("*").alias("_n"))
    large = size.where(F.col("_n") > most).select("comp")
    if unfinished is not None:
        large = large.unionByName(unfinished).distinct()
    large = scratch.store(large, "large")  # stored, so that a component with many rows is split in these joins
    n = large.count()
    if not n:
        return placed, of_cells, placed.limit(0), of_cells.limit(0)
    if n <= few:
        large = F.broadcast(large)
    part = lambda df, how: df.join(large, "comp", how)
    return part(placed, "left_anti"), part(of_cells, "left_anti"), part(placed, "left_semi"), part(of_cells, "left_semi")


class _Side:
    """One side of one group: open rows by quantity, and what is supplied against them."""

    def __init__(self):
        self.rows: dict[int, list[tuple[int, int]]] = defaultdict(list)   # quantity: (row id, index), ascending
        self.want: dict[int, int] = defaultdict(int)
        self.have: dict[int, int] = defaultdict(int)

    def takes(self) -> tuple[bool, dict[int, int]] | None:
        """(whether the supply covers all, how many of each quantity are linked)."""
        want = {q: n for q, n in self.want.items() if n}
        if not want or not any(self.have.values()):
            return None
        supply, demand = (sum(q * n for q, n in x.items()) for x in (self.have, want))
        if supply >= demand:
            return True, want
        out = {q: min(n, self.have.get(q, 0)) for q, n in want.items()}
        left = supply - sum(q * n for q, n in out.items())
        if any(n > out.get(q, 0) for q, n in self.have.items()):
            for q in sorted(want, reverse=True):
                rest = want[q] - out[q]
                more = rest if left >= q * rest else left // q
                out[q] += more
                left -= q * more
        return False, {q: n for q, n in out.items() if n}


def settle(rows: list[tuple], supply: list[tuple], labels, max_rounds: int) -> list[tuple[int, int, str]]:
    """(index, turnaround, comment) of the rows that one component links.

    rows: (row id, group, side, quantity in whole units, reference), supply: (group, side, quantity, instructions).
    A group of None, a side other than B and S, or a missing quantity take no part in quantity linking. Stops
    after a turnaround beyond max_rounds that still linked something.
    """
    sides: dict[tuple, _Side] = defaultdict(_Side)
    by_ref: dict[tuple, list[int]] = defaultdict(list)
    for i, (row_id, group, side, quantity, ref) in enumerate(rows):
        by_ref[ref].append(i)
        if group is not None and side is not None and quantity is not None:
            sides[group, side].rows[quantity].append((row_id, i))
            sides[group, side].want[quantity] += 1
    for group, side, quantity, n in supply:
        sides[group, side].have[quantity] += n
    for s in sides.values():
        for cell in s.rows.values():
            cell.sort()
    is_open = [True] * len(rows)
    opposite = {"B": "S", "S": "B"}
    found: list[tuple[int, int, str]] = []

    def mark(i: int, turn: int, comment: str) -> None:
        is_open[i] = False
        found.append((i, turn, comment))
        _, group, side, quantity, _ = rows[i]
        if group is not None and quantity is not None:
            changed.add(group)
            if side is not None:
                sides[group, side].want[quantity] -= 1
            if side in opposite:
                sides[group, opposite[side]].have[quantity] += 1

    due, turn = list(sides), 1
    while True:
        turn += 1
        total, single, by_reference = labels(turn)
        picked = []
        for key in due:
            answer = sides[key].takes()
            for quantity, n in answer[1].items() if answer else ():
                cell = sides[key].rows[quantity] = [x for x in sides[key].rows[quantity] if is_open[x[1]]]
                picked += [(i, total if answer[0] else single) for _, i in cell[:n]]
        if not picked:
            return found
        changed: set = set()
        for i, comment in picked:
            mark(i, turn, comment)
        for ref in {rows[i][4] for i, _ in picked}:
            for i in by_ref.pop(ref, ()):
                if is_open[i]:
                    mark(i, turn, by_reference)
        if turn > max_rounds:
            return found
        due = [(g, s) for g in changed for s in ("B", "S") if (g, s) in sides]


_MOVED = ["comp", "SettlementDate", "row_id", "Code_CDP", "side", "Quantity", _REF, "have", "q"]
_FOUND = pa.schema([("SettlementDate", pa.int32()), ("row_id", pa.int64()), ("Code_CDP", pa.string()), ("side", pa.string()),
                    ("Quantity", pa.float64()), (_REF, pa.string()), ("comments", pa.string()), ("turn", pa.int32())])


def _whole(column: pa.Array) -> list[int | None]:
    """Whole decimals as integers; where all of them fit 64 bits, none is made one by one."""
    try:
        return column.cast(pa.int64()).to_pylist()
    except pa.ArrowInvalid:
        return [None if q is None else int(q) for q in column.to_pylist()]


def _settled(labels, max_rounds: int):
    def links(part: list[tuple]) -> Iterator[tuple]:
        rows, supply, own = [], [], []
        for x in part:
            _, day, row_id, code, side, _, ref, have, units = x
            group = None if code is None else (day, code)
            if have is None:
                rows.append((row_id, group, side, units, (day, ref)))
                own.append(x)
            else:
                supply.append((group, side, units, have))
        for i, turn, comment in settle(rows, supply, labels, max_rounds):
            yield (*own[i][1:7], comment, turn)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comp, part = None, []  # rows of the last component, which may go on in the next batch
        for batch in batches:
            columns = [_whole(batch.column(n)) if n == "q" else batch.column(n).to_pylist() for n in _MOVED]
            found: list[tuple] = []
            for here, some in groupby(zip(*columns), key=itemgetter(0)):
                if here != comp:
                    found += links(part)
                    comp, part = here, []
                part += some
            if found:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found), _FOUND)], schema=_FOUND)
        if found := [*links(part)]:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*found), _FOUND)], schema=_FOUND)

    return work


def settle_components(rows: DataFrame, cells: DataFrame, labels, max_rounds: int) -> DataFrame:
    """Links of small components: the open rows they link, with comment and turnaround.

    rows: open rows, cells: have per cell, both with `comp`; labels(turn) gives the three comments of a turnaround.
    """
    supply = cells.where("have > 0").select("comp", "SettlementDate", "Code_CDP", "side", "Quantity", F.col("have").cast("long").alias("have"))
    asked = rows.select("comp", "SettlementDate", "row_id", "Code_CDP", "side", "Quantity", _REF)
    both = asked.unionByName(supply, allowMissingColumns=True).repartition("comp")
    both = with_exact_quantity(both, "Code_CDP IS NOT NULL AND Quantity IS NOT NULL")  # not moved, as it is made from the quantity
    of = W.partitionBy("comp")  # of bounded size; without supply nothing is linked, and without rows there is nothing to link
    both = both.withColumn("_cells", F.count("have").over(of)).withColumn("_all", F.count("*").over(of))
    both = both.where("_cells > 0 AND _cells < _all").drop("_cells", "_all")
    import_in_workers(rows.sparkSession)
    schema = ("SettlementDate int, row_id long, Code_CDP string, side string, Quantity double, "
              f"{_REF} string, comments string, turn int")
    return both.sortWithinPartitions("comp").mapInArrow(_settled(labels, max_rounds), schema)

"""Decide which subsequent settlements are linked to an on-exchange trade.

Stages, per settlement date:

1. total-amount and individual linking against first settlements of the same group and opposite side;
2. one pass of reference matching (a linked instruction pulls in open ones sharing its reference);
3. turnarounds: linked subsequent rows act as supply for open ones of the opposite side in their
   group, followed by reference matching, until a turnaround links nothing.

The loop state is narrow and lives in Parquet under the shared folder: open rows, a histogram of the
groups that still have open rows, and the links of each step. A turnaround decides on the histogram,
not on rows, and only for groups in which the previous step linked something: any other group would
answer as before, with nothing. References are propagated from the new links only. While steps link
many rows, open rows are rewritten; once they link few, open rows and histogram stay as stored and the
recent links are subtracted on the fly, so a long tail of turnarounds costs scans but no shuffle of
the rows that will never be linked. All dates advance together; a date that links nothing has no
touched group and drops out by itself.

Before that loop, groups joined by references are cut into components; those of bounded size run to their
fixpoint inside one task (see components.py), so that the loop is left with the large ones, if any.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave import schemas as S
from tradeweave.operators import matching as M
from tradeweave.operators.components import settle_components, split_components
from tradeweave.operators.prepare import has_account, may_be_linked, not_market_transfer
from tradeweave.session import Scratch, path_exists

_REF = "PSMSMatchedReference"
_STATE = ["SettlementDate", "row_id", "Code_CDP", "side", "Quantity", _REF]


def _opposite(side: str | Column) -> Column:
    c = F.col(side) if isinstance(side, str) else side
    return F.when(c == "B", "S").when(c == "S", "B")


def by_quantity() -> Column:
    return not_market_transfer() & F.col("Quantity").isNotNull()


def open_rows(prepared: DataFrame) -> DataFrame:
    """Subsequent rows without a verdict.

    Rows outside quantity linking get no group, and in place of the side a value that spreads them
    over tasks; only their reference can link them.
    """
    return prepared.where((F.col("subsequent") == "1") & (F.col("flag") == "0")).select(
        "SettlementDate",
        "row_id",
        F.when(by_quantity(), F.col("Code_CDP")).alias("Code_CDP"),
        F.when(by_quantity(), F.col("BuySellIndicator"))
        .otherwise(F.pmod("row_id", F.lit(4096)).cast("string")).alias("side"),
        "Quantity",
        _REF,
    )


def base_cells(prepared: DataFrame) -> DataFrame:
    """Instructions per group, side of the open row, and quantity; ``named`` = has an account."""
    later = F.col("subsequent") == "1"
    return (
        prepared.where((F.col("subsequent") != S.OTC_BOND) & by_quantity())
        .select(
            "SettlementDate",
            "Code_CDP",
            F.when(later, F.col("BuySellIndicator")).otherwise(_opposite("BuySellIndicator")).alias("side"),
            "Quantity",
            has_account().alias("named"),
            later.cast("int").alias("later"),
        )
        .groupBy(*M.CELL, "named")
        .agg(
            F.sum(1 - F.col("later")).alias("first_rows"),
            F.sum("later").alias("later_rows"),
        )
    )


@dataclass
class Shape:
    """What the histogram says about skew; decided once, before any group is collected."""

    wide_groups: bool
    hot_cells: bool


def measure_shape(cells: DataFrame, limits: M.Limits) -> Shape:
    per_group = cells.groupBy("SettlementDate", "Code_CDP").agg(
        F.count("*").alias("n"), F.max("later_rows").alias("m")
    )
    top = per_group.agg(F.max("n").alias("n"), F.max("m").alias("m")).first()
    return Shape((top.n or 0) > limits.max_cells, (top.m or 0) > (1 << limits.block_rows_log2))


def decide(cells: DataFrame, wide: DataFrame | None, need_supply: bool, limits: M.Limits,
           scratch: Scratch, name: str) -> DataFrame:
    """Takes per cell; groups listed in ``wide`` go through the block-wise walk."""
    if wide is None:
        return M.small_groups(cells, need_supply)
    keys = ["SettlementDate", "Code_CDP"]
    stored = scratch.store(cells, f"{name}-cells")
    # semi and anti joins stream the cells, so a skewed group is split by adaptive execution
    small = M.small_groups(stored.join(wide, keys, "left_anti"), need_supply)
    large = M.large_groups(stored.join(wide, keys, "left_semi"), need_supply, limits, scratch, name)
    return small.unionByName(large.select(*small.columns))


def first_pass_cells(cells: DataFrame) -> DataFrame:
    return cells.where("named").select(
        *M.CELL, F.col("first_rows").alias("have"), F.col("later_rows").alias("want")
    )


def moved_cells(linked: DataFrame) -> DataFrame:
    """Histogram changes: a linked row stops asking and supplies the opposite side of its group."""
    sides = F.array(
        F.struct(F.col("side").alias("side"), F.lit(0).alias("have"), F.lit(-1).alias("want")),
        F.struct(_opposite("side").alias("side"), F.lit(1).alias("have"), F.lit(0).alias("want")),
    )
    return (
        linked.where("Code_CDP IS NOT NULL AND Quantity IS NOT NULL")
        .select("SettlementDate", "Code_CDP", "Quantity", F.explode(sides).alias("m"))
        .select("SettlementDate", "Code_CDP", "m.side", "Quantity",
                F.col("m.have").cast("bigint").alias("have"), F.col("m.want").cast("bigint").alias("want"))
    )


def later_cells(cells: DataFrame) -> DataFrame:
    return cells.where("later_rows > 0").select(
        *M.CELL, F.lit(0).cast("bigint").alias("have"), F.col("later_rows").alias("want")
    )


def supplied_cells(linked: DataFrame) -> DataFrame:
    """What linked rows supply to their groups; nothing else supplies after the first pass."""
    return moved_cells(linked).where("have > 0").groupBy(*M.CELL).agg(
        F.sum("have").alias("have"), F.lit(0).cast("bigint").alias("want"))


def _label(total: str, single: str) -> Column:
    return F.when(F.col("covered"), total).when(~F.col("covered"), single)


class LinkState:
    """Open rows, histogram and links so far, each a stored table."""

    schema = T.StructType([
        T.StructField("SettlementDate", T.IntegerType()),
        T.StructField("row_id", T.LongType()),
        T.StructField("Code_CDP", T.StringType()),
        T.StructField("side", T.StringType()),
        T.StructField("Quantity", T.DoubleType()),
        T.StructField(_REF, T.StringType()),
        T.StructField("comments", T.StringType()),
    ])

    def __init__(self, scratch: Scratch, limits: M.Limits, rows: DataFrame):
        self.scratch, self.limits = scratch, limits
        self.rows = rows          # open rows as last written
        self.rows_at = 0          # number of link tables already taken out of them
        self.cells: DataFrame | None = None   # have/want of groups that were open when written
        self.cells_at = 0
        self.links: list[str] = []
        self.sizes: list[int] = []

    def _read(self, *paths: str) -> DataFrame:
        spark = self.scratch.spark
        return spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)

    def linked(self, since: int = 0) -> DataFrame:
        return self._read(*self.links[since:])

    def few(self, since: int) -> bool:
        """Whether the links since then are few enough to broadcast (counted, not estimated)."""
        return sum(self.sizes[since:]) <= self.limits.small_list

    def open(self) -> DataFrame:
        if self.rows_at == len(self.links):
            return self.rows
        gone = self.linked(self.rows_at).select("SettlementDate", "row_id")
        if self.few(self.rows_at):
            gone = F.broadcast(gone)
        return self.rows.join(gone, ["SettlementDate", "row_id"], "left_anti")

    def store(self, tagged: DataFrame, name: str, rewrite: bool) -> bool:
        """Store the rows that got a comment, and on ``rewrite`` the others as the new open rows.

        True if any row was linked.
        """
        spark, path = self.scratch.spark, self.scratch.at(name)
        rows = tagged.select(*self.schema.names).withColumn("is_linked", F.col("comments").isNotNull())
        if not rewrite:
            rows = rows.where("is_linked")
        rows.write.partitionBy("is_linked").option("compression", "zstd").parquet(path)
        # a partition folder exists exactly when some row fell into it
        rest, hits = (f"{path}/is_linked={v}" for v in ("false", "true"))
        found = path_exists(spark, hits)
        if found:
            self.links.append(hits)
            self.sizes.append(self._read(hits).count())  # from Parquet footers
        if rewrite:
            self.rows = self._read(*[p for p in (rest,) if path_exists(spark, p)]).drop("comments")
            self.rows_at = len(self.links)
        return found

    def waiting(self, since: int) -> bool:
        """Whether so many link tables came since then that reading them each time costs more than a rewrite."""
        return len(self.links) - since >= self.limits.pending

    def rewrite_rows(self, name: str) -> None:
        self.rows = self.scratch.store(self.open(), name)
        self.rows_at = len(self.links)

    def histogram(self, near=lambda df: df) -> DataFrame:
        """Current have/want per cell of the groups that ``near`` keeps."""
        cells = near(self.cells)
        if self.cells_at == len(self.links):
            return cells
        return (
            cells.unionByName(moved_cells(near(self.linked(self.cells_at))))
            .groupBy(*M.CELL).agg(F.sum("have").alias("have"), F.sum("want").alias("want"))
        )

    def compact(self, name: str) -> None:
        """Rewrite the histogram, keeping only groups that still have an open row."""
        keys = ["SettlementDate", "Code_CDP"]
        # stored first: adaptive execution splits a skewed join only between plain shuffles
        alive = self.scratch.store(
            self.open().where("Code_CDP IS NOT NULL").select(*keys).distinct(), f"{name}-alive"
        )
        kept = self.histogram().join(alive, keys, "left_semi").where("have > 0 OR want > 0")
        self.cells = self.scratch.store(kept, name)
        self.cells_at = len(self.links)


def tag_by_quantity(rows: DataFrame, takes: DataFrame, shape: Shape, limits: M.Limits,
                    total: str, single: str) -> DataFrame:
    picked = M.select_rows(rows.select(*_STATE), takes, shape.hot_cells, limits)
    return picked.withColumn("comments", _label(total, single)).select(*_STATE, "comments")


def tag_by_reference(rows: DataFrame, refs: DataFrame, label: str) -> DataFrame:
    """Open rows, marked where their reference (null matching null) is among ``refs`` of the same date."""
    r = refs.select(
        F.col("SettlementDate").alias("_d"), F.col(_REF).alias("_r")
    ).distinct().withColumn("comments", F.lit(label))
    o = rows.select(*_STATE)
    # at most one partner per row, so this left join streams the rows and adaptive execution can
    # split a reference that holds a large share of them
    return o.join(r, _same_reference(o, r), "left").select(*_STATE, "comments")


def only_by_reference(rows: DataFrame, refs: DataFrame, label: str) -> DataFrame:
    """Just the marked rows, for ``refs`` counted to be few enough to broadcast."""
    r = F.broadcast(refs.select(F.col("SettlementDate").alias("_d"), F.col(_REF).alias("_r")))
    o = rows.select(*_STATE)
    return o.join(r, _same_reference(o, r), "left_semi").withColumn("comments", F.lit(label))


def _same_reference(o: DataFrame, r: DataFrame) -> Column:
    return (o["SettlementDate"] == r["_d"]) & o[_REF].eqNullSafe(r["_r"])


def _turn(text: str, n: int) -> str:
    return f"{text} at Turnaround {n} "


def _labels(n: int) -> tuple[str, str, str]:
    return _turn(S.TOTAL_LINK, n), _turn(S.INDIVIDUAL_LINK, n), _turn(S.REFERENCE_LINK, n)


def _unsettled(max_rounds: int) -> RuntimeError:
    return RuntimeError(f"linking did not settle within {max_rounds} rounds")


def settle_small_components(state: LinkState, limits: M.Limits, max_rounds: int) -> bool:
    """Link what bounded components link, and leave the others in the state; True if there are any.

    What is asked for is in the open rows themselves, so only what is supplied is counted beforehand.
    """
    inner = Scratch(state.scratch.spark, "components")
    rows, cells, rest, rest_cells = split_components(
        state.open(), supplied_cells(state.linked()), inner, limits.component_rows, limits.component_rounds, limits.small_list)
    scratch = state.scratch
    found = scratch.store(settle_components(rows, cells, _labels, max_rounds), "local")
    last = found.agg(F.count("*").alias("n"), F.max("turn").alias("turn")).first()
    if last.n and last.turn > max_rounds:
        raise _unsettled(max_rounds)
    state.rows = scratch.store(rest.drop("comp"), "open-large")
    asked = state.rows.where("Code_CDP IS NOT NULL").select(
        *M.CELL, F.lit(0).cast("bigint").alias("have"), F.lit(1).cast("bigint").alias("want"))
    state.cells = scratch.store(
        rest_cells.drop("comp").unionByName(asked).groupBy(*M.CELL).agg(F.sum("have").alias("have"), F.sum("want").alias("want")),
        "cells-large")
    if last.n:
        state.links.append(scratch.at("local"))
        state.sizes.append(last.n)
    state.rows_at = state.cells_at = len(state.links)
    inner.drop()
    return not state.rows.isEmpty()


def link(prepared: DataFrame, scratch: Scratch, limits: M.Limits = M.Limits(),
         upto: str = "turnaround", max_rounds: int = S.MAX_ROUNDS) -> DataFrame:
    """Links (SettlementDate, row_id, comments) for every instruction the rules can link.

    ``upto`` stops after ``total``, ``individual``, ``reference`` or (default) ``turnaround``.
    """
    cells = scratch.store(base_cells(prepared), "cells")
    shape = measure_shape(cells, limits)
    wide = None
    if shape.wide_groups:
        wide = scratch.store(
            cells.groupBy("SettlementDate", "Code_CDP").count()
            .where(F.col("count") > limits.max_cells).drop("count"),
            "wide",
        )

    state = LinkState(scratch, limits, open_rows(prepared))
    takes = decide(first_pass_cells(cells), wide, False, limits, scratch, "first")
    if upto == "total":
        takes = takes.where("covered")
    tagged = tag_by_quantity(state.open(), takes, shape, limits, S.TOTAL_LINK, S.INDIVIDUAL_LINK)
    if not state.store(tagged, "q1", rewrite=True) or upto in ("total", "individual"):
        return _finish(state)
    tagged = tag_by_reference(state.open(), state.linked(), S.REFERENCE_LINK)
    state.store(tagged, "r1", rewrite=True)
    if upto == "reference":
        return _finish(state)

    if limits.component_rows:
        if not settle_small_components(state, limits, max_rounds):
            return _finish(state)
    else:
        state.cells = later_cells(cells)
        state.compact("cells1")
    turn, before = 1, 0
    while True:
        if turn > max_rounds:
            raise _unsettled(max_rounds)
        turn += 1
        total, single, by_reference = _labels(turn)
        few = state.few(before)
        near = touched_groups(state.linked(before), scratch, f"touched{turn}", few)
        takes = decide(state.histogram(near), wide, True, limits, scratch, f"t{turn}")
        before = len(state.links)
        tagged = tag_by_quantity(
            near(state.open()) if few else state.open(), takes, shape, limits, total, single
        )
        if not state.store(tagged, f"q{turn}", rewrite=not few):
            break
        keep = state.few(min(before, state.rows_at))
        tag = only_by_reference if keep else tag_by_reference
        tagged = tag(state.open(), state.linked(before), by_reference)
        state.store(tagged, f"r{turn}", rewrite=not keep)
        if state.waiting(state.rows_at):
            state.rewrite_rows(f"open{turn}")
        if state.waiting(state.cells_at) or not state.few(state.cells_at):
            state.compact(f"cells{turn}")
    return _finish(state)


def touched_groups(new_links: DataFrame, scratch: Scratch, name: str, few: bool):
    """A filter that keeps rows of groups in which ``new_links`` changed something; broadcast where counted to be few."""
    keys = ["SettlementDate", "Code_CDP"]
    groups = new_links.where("Code_CDP IS NOT NULL").select(*keys)
    groups = F.broadcast(groups) if few else scratch.store(groups.distinct(), name)
    return lambda df: df.join(groups, keys, "left_semi")


def _finish(state: LinkState) -> DataFrame:
    return state.linked().select("SettlementDate", "row_id", "comments")


def mark(rows: DataFrame, links: DataFrame) -> DataFrame:
    """Instructions as loaded with the comment of their link as ``_why``. Only rows that may be linked are joined."""
    is_open = may_be_linked()
    marks = links.select("SettlementDate", "row_id", F.col("comments").alias("_why"))
    others = rows.where(~is_open).withColumn("_why", F.lit(None).cast("string"))
    return others.unionByName(rows.where(is_open).join(marks, ["SettlementDate", "row_id"], "left"))


def judged(marked: DataFrame, looked_at: bool = True) -> DataFrame:
    """Prepared instructions with their verdict in place of the mark."""
    is_open = F.coalesce((F.col("subsequent") == "1") & (F.col("flag") == "0"), F.lit(False))
    residual = F.lit(S.NOT_LINKED if looked_at else S.NOT_LOOKED_AT)
    return (
        marked.withColumn("comments", F.when(is_open, F.coalesce("_why", residual)).otherwise(F.col("comments")))
        .withColumn("flag", F.when(is_open & F.col("_why").isNotNull(), "1").otherwise(F.col("flag")))
        .drop("_why")
    )


def apply_links(prepared: DataFrame, links: DataFrame, looked_at: bool = True) -> DataFrame:
    """Write verdicts back. Only open subsequent rows can change, so only they are joined."""
    return judged(mark(prepared, links), looked_at).select(*prepared.columns)

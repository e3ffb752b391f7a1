"""Link open instructions of a group against the quantities that stand against them.

Only quantities matter for the rule, so a group is reduced to *cells*: per distinct quantity, how
many instructions supply it (``have``) and how many open ones ask for it (``want``). If the supply
covers the demand in total, every open instruction is linked. Otherwise equal quantities pair off
one to one, and what is left of the supply is handed out from the largest unpaired quantity down,
skipping those that no longer fit.

Handing out walks distinct quantities, not rows. Groups of up to ``max_cells`` distinct quantities
are walked in one array expression. Larger ones are cut into ordered blocks (see ``large_groups``),
so no group is ever held whole in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeweave.session import Scratch

GROUP = ["SettlementDate", "Code_CDP", "side"]
CELL = [*GROUP, "Quantity"]

# Quantities are summed and handed out in whole units of 1e-10, so results are exact and do not depend
# on partitioning. What has no such form (more decimals, 1e18 and more, below zero) raises an error.
_AMOUNT = "decimal(38,0)"
_UNITS = """CASE WHEN Quantity >= 0 AND CAST(CAST(Quantity AS DECIMAL(28,10)) AS DOUBLE) = Quantity
    THEN CAST(CAST(Quantity AS DECIMAL(28,10)) * 10000000000BD AS DECIMAL(38,0))
    ELSE CAST(raise_error(concat('quantity cannot be linked exactly: ', CAST(Quantity AS STRING))) AS DECIMAL(38,0)) END"""


@dataclass(frozen=True)
class Limits:
    """Bounds on what one task may hold; beyond them work is split, never dropped."""

    max_cells: int = 2048        # distinct quantities walked in one array
    block_rows_log2: int = 22    # rows of one equal-quantity cell ordered in one task
    small_list: int = 100_000    # measured row count up to which a key list is broadcast
    component_rows: int = 50_000  # open rows and cells of groups joined by references that one task settles by itself; 0: none
    component_rounds: int = 8    # rounds in which such components are looked for
    pending: int = 16            # link tables taken out of rows and histogram on the fly before these are rewritten


def _amount(count: str) -> str:
    """SQL for a count of instructions times the exact quantity ``q`` of their cell."""
    return f"CAST(q * CAST({count} AS DECIMAL(17,0)) AS {_AMOUNT})"


def with_exact_quantity(cells: DataFrame, where: str = "true") -> DataFrame:
    return cells.withColumn("q", F.expr(f"CASE WHEN {where} THEN {_UNITS} END"))


def walk_sql(cells: str, budget: str) -> str:
    """SQL for one walk: struct(t = budget left, picks = how many of each cell fit).

    ``cells`` is an array of struct(q decimal, n bigint) from the largest quantity down. All ``n``
    are taken when they fit; otherwise as many whole ones as the remainder holds.
    """
    zero = f"named_struct('t', CAST({budget} AS {_AMOUNT}), 'picks', CAST(array() AS ARRAY<BIGINT>))"
    need = f"CAST(x.q * x.n AS {_AMOUNT})"
    k = f"CASE WHEN acc.t >= {need} THEN x.n WHEN acc.t < x.q THEN 0L ELSE acc.t div x.q END"
    used = (
        f"CASE WHEN acc.t >= {need} THEN {need} WHEN acc.t < x.q THEN CAST(0 AS {_AMOUNT})"
        f" ELSE CAST(x.q * (acc.t div x.q) AS {_AMOUNT}) END"
    )
    return (
        f"aggregate({cells}, {zero}, (acc, x) -> named_struct("
        f"'t', CAST(acc.t - ({used}) AS {_AMOUNT}), 'picks', array_append(acc.picks, {k})))"
    )


def small_groups(cells: DataFrame, need_supply: bool) -> DataFrame:
    """Takes per cell for groups whose cells fit one bounded array."""
    packed = F.struct(F.col("Quantity").alias("key"), "q", "have", "want")
    # Cells of a group are few and already summed, so they are brought together directly; partial
    # lists per task would only be serialised twice.
    groups = (
        with_exact_quantity(cells.repartition(*GROUP))
        .groupBy(*GROUP)
        .agg(
            F.sum(F.expr(_amount("have"))).alias("supply"),
            F.sum(F.expr(_amount("want"))).alias("demand"),
            F.sum("have").alias("n_have"),
            F.sum("want").alias("n_want"),
            F.sort_array(F.collect_list(packed), asc=False).alias("cells"),
        )
        .where("n_want > 0")
        .withColumn("covered", F.expr(_covered(need_supply)))
        .where("covered OR n_have > 0")
    )
    left_over = (
        f"aggregate(cells, CAST(0 AS {_AMOUNT}), (s, c) -> CAST(s + c.q * "
        f"CAST(c.have - least(c.have, c.want) AS DECIMAL(17,0)) AS {_AMOUNT}))"
    )
    unpaired = "transform(cells, c -> named_struct('q', c.q, 'n', c.want - least(c.have, c.want)))"
    some_left = "exists(cells, c -> c.have > c.want)"
    walked = groups.withColumn(
        "picks",
        F.expr(f"CASE WHEN NOT covered AND {some_left} THEN ({walk_sql(unpaired, left_over)}).picks END"),
    )
    taken = walked.select(
        *GROUP,
        "covered",
        F.explode(F.expr(
            "filter(transform(cells, (c, i) -> named_struct('Quantity', c.key, 'want', c.want, 'take',"
            " CASE WHEN covered THEN c.want"
            " ELSE least(c.have, c.want) + coalesce(element_at(picks, i + 1), 0L) END)), c -> c.take > 0)"
        )).alias("c"),
    )
    return taken.select(*GROUP, F.col("c.Quantity"), F.col("c.want"), F.col("c.take"), "covered")


def _covered(need_supply: bool) -> str:
    rule = "coalesce(supply, 0) >= demand"
    return f"({rule}) AND n_have > 0" if need_supply else rule


def large_groups(cells: DataFrame, need_supply: bool, limits: Limits, scratch: Scratch,
                 name: str) -> DataFrame:
    """Takes per cell for groups with more distinct quantities than one task should hold.

    The unpaired cells of all such groups are range-sorted and cut into blocks of at most
    ``max_cells``. A block whose whole demand fits is taken, one whose smallest quantity does not fit
    is skipped, both from the block's summary alone; only a block that is neither is opened and
    walked. The remainder at least halves between openings that end a run, so the number of rounds
    grows with the logarithm of the supply, not with the group.
    """
    cells = with_exact_quantity(cells)
    totals = (
        cells.groupBy(*GROUP)
        .agg(
            F.sum(F.expr(_amount("have"))).alias("supply"),
            F.sum(F.expr(_amount("want"))).alias("demand"),
            F.sum("have").alias("n_have"),
            F.sum("want").alias("n_want"),
            F.sum(F.expr(_amount("greatest(have - want, 0)"))).alias("t"),
            F.sum(F.expr("greatest(have - want, 0)")).alias("n_left"),
        )
        .where("n_want > 0")
        .withColumn("covered", F.expr(_covered(need_supply)))
        .where("covered OR n_have > 0")
        .select(*GROUP, "covered", "t", "n_left")
    )
    totals = scratch.store(totals, f"{name}-totals")
    verdicts = cells.join(totals, GROUP)  # adaptive execution splits a skewed group here
    ranked = (
        verdicts.withColumn("n", F.expr("want - least(have, want)"))
        .withColumn("_key", -F.col("Quantity"))
        .repartitionByRange(*GROUP, "_key")
        .sortWithinPartitions(*GROUP, "_key")
        .withColumn("block", F.expr(f"monotonically_increasing_id() div {limits.max_cells}"))
        .drop("_key")
    )
    ranked = scratch.store(ranked, f"{name}-ranked")
    open_cells = ranked.where("NOT covered AND n > 0 AND n_left > 0")
    blocks = scratch.store(
        open_cells.groupBy(*GROUP, "block").agg(
            F.min("q").alias("q_min"), F.sum(F.expr(_amount("n"))).alias("need")
        ),
        f"{name}-blocks",
    )
    state = totals.where("NOT covered AND n_left > 0").select(
        *GROUP, "t", F.lit(-1).cast("bigint").alias("after")
    )
    scan = (
        "aggregate(todo, named_struct('t', t, 'stop', CAST(NULL AS BIGINT), 'on', false,"
        " 'turns', CAST(array() AS ARRAY<BIGINT>)), (a, b) -> CASE"
        " WHEN a.stop IS NOT NULL THEN a"
        f" WHEN a.t >= b.need THEN named_struct('t', CAST(a.t - b.need AS {_AMOUNT}), 'stop', a.stop,"
        "  'on', true, 'turns', IF(a.on, a.turns, array_append(a.turns, b.block)))"
        " ELSE named_struct('t', a.t, 'stop', IF(a.t >= b.q_min, b.block, a.stop), 'on', false,"
        "  'turns', IF(a.on, array_append(a.turns, b.block), a.turns)) END)"
    )
    picked, spans, turn = [], [], 0
    while True:
        # Block summaries only: one entry per max_cells distinct quantities.
        todo = (
            state.join(blocks, GROUP)
            .where("block > after")
            .groupBy(*GROUP, "t", "after")
            .agg(F.sort_array(F.collect_list(F.struct("block", "q_min", "need"))).alias("todo"))
            .withColumn("r", F.expr(scan))
            .select(*GROUP, "after", F.col("r.t").alias("t"), F.col("r.stop").alias("stop"),
                    F.col("r.turns").alias("turns"))
        )
        todo = scratch.store(todo, f"{name}-scan{turn}")
        spans.append(todo)
        opened = todo.where("stop IS NOT NULL")
        if opened.isEmpty():
            break
        walked = (
            opened.join(open_cells.select(*GROUP, "block", "Quantity", "q", "n"),
                        [*[opened[c] == open_cells[c] for c in GROUP], F.col("stop") == F.col("block")])
            .select(*[opened[c] for c in GROUP], "stop", opened["t"], "Quantity", "q", "n")
            .groupBy(*GROUP, "stop", "t")
            .agg(F.sort_array(F.collect_list(F.struct("q", "n", "Quantity")), asc=False).alias("todo"))
            .withColumn("r", F.expr(walk_sql("todo", "t")))
        )
        walked = scratch.store(walked.select(*GROUP, "stop", "todo", "r"), f"{name}-walk{turn}")
        picked.append(
            walked.select(*GROUP, F.explode(F.arrays_zip("todo.Quantity", "r.picks")).alias("z"))
            .select(*GROUP, F.col("z.Quantity"), F.col("z.picks").alias("extra"))
        )
        state = walked.select(*GROUP, F.col("r.t").alias("t"), F.col("stop").alias("after"))
        turn += 1

    whole = None  # blocks taken by their summary
    for todo in spans:
        hit = (
            todo.join(blocks, GROUP)
            .where("block > after AND (stop IS NULL OR block < stop)")
            .where("size(filter(turns, x -> x <= block)) % 2 = 1")
            .select(*GROUP, "block")
        )
        whole = hit if whole is None else whole.unionByName(hit)
    result = (
        ranked.join(whole.withColumn("whole", F.lit(True)), [*GROUP, "block"], "left")
    )
    if picked:
        extra = picked[0]
        for p in picked[1:]:
            extra = extra.unionByName(p)
        result = result.join(extra, CELL, "left")
    else:
        result = result.withColumn("extra", F.lit(None).cast("bigint"))
    return result.select(
        *CELL,
        "want",
        F.expr("CASE WHEN covered THEN want ELSE least(have, want)"
               " + CASE WHEN whole THEN n ELSE coalesce(extra, 0L) END END").alias("take"),
        "covered",
    ).where("take > 0")


def select_rows(rows: DataFrame, takes: DataFrame, hot_cells: bool, limits: Limits) -> DataFrame:
    """Mark the first ``take`` rows of each cell, in row order; other rows get a null ``covered``.

    When some cell holds more rows than one task should order, cells are cut into stretches of row
    ids. A running count over the stretches tells which are wholly in or out, and only the stretch
    that contains the boundary orders its rows.
    """
    cols = rows.columns
    if hot_cells:
        stretch = F.shiftright("row_id", limits.block_rows_log2)
        before = W.partitionBy(*CELL).orderBy("stretch").rowsBetween(W.unboundedPreceding, -1)
        takes = (
            rows.groupBy(*CELL, stretch.alias("stretch")).agg(F.count("*").alias("n"))
            .join(takes, CELL)
            .withColumn("want", F.col("n"))
            .withColumn("take", F.col("take") - F.coalesce(F.sum("n").over(before), F.lit(0)))
            .withColumn("take", F.least("take", "n"))
            .where("take > 0")
            .drop("n")
        )
        rows = rows.withColumn("stretch", stretch)
        keys = [*CELL, "stretch"]
    else:
        keys = CELL
    joined = rows.join(takes, keys, "left")
    # rank only matters inside partly taken cells; other rows get distinct throw-away partitions
    partly = F.col("take") < F.col("want")
    place = F.row_number().over(
        W.partitionBy(*keys, F.when(~F.coalesce(partly, F.lit(False)), F.col("row_id"))).orderBy("row_id")
    )
    chosen = F.coalesce((F.col("take") >= F.col("want")) | (place <= F.col("take")), F.lit(False))
    return joined.withColumn("covered", F.when(chosen, F.col("covered"))).select(*cols, "covered")

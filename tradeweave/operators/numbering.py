"""Row numbers in a stated order, or in the order rows already stand in, without a whole date in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeweave.session import Scratch

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below
SMALL_STARTS = 100_000  # measured rows up to which the starts of splits are broadcast


def number_rows(df: DataFrame, day: str, order: list[Column | str], out: str, scratch: Scratch,
                name: str = "numbered") -> DataFrame:
    """Dense 1..n per ``day`` following ``order``.

    Rows are range-partitioned on (day, order), so a date of any size spreads over many tasks. Each
    task numbers its own stretch; the stretches (at most one per task, plus one per date) are then
    offset by a running count. Only that stretch table is broadcast.
    """
    keys = [F.col(day), *[F.col(c) if isinstance(c, str) else c for c in order]]
    ranged = (
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pos", F.monotonically_increasing_id())
    )
    placed = scratch.store(ranged, name)
    stretch = F.shiftright("_pos", _POSITION_BITS)
    before = W.partitionBy(day).orderBy("_stretch").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(F.col(day).alias("_day"), stretch.alias("_stretch"))
        .agg(F.min("_pos").alias("_first"), F.count("*").alias("_n"))
        .withColumn(day, F.col("_day"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .select("_day", "_stretch", "_first", "_before")
    )
    joined = placed.withColumn("_s", stretch).join(
        F.broadcast(offsets),
        F.col(day).eqNullSafe(F.col("_day")) & (F.col("_s") == F.col("_stretch")),
    )
    number = F.col("_before") + F.col("_pos") - F.col("_first") + 1
    return joined.withColumn(out, number.cast("bigint")).select(out, *df.columns)


def number_in_place(stored: DataFrame, day: str, split: list[str], position: str, out: str, scratch: Scratch,
                    small: int = SMALL_STARTS) -> DataFrame:
    """Dense 1..n per ``day`` for stored rows that already stand in order: by ``split``, then by ``position``.

    ``position`` rises by one from each row of a date and split to the next, so a row's number is its position less that
    of the first one, after a running count of the splits before. Only first positions and counts are gathered; rows are
    neither moved nor sorted while these, one row per split and date, are counted to be few enough to broadcast.
    """
    keys = [day, *split]
    before = W.partitionBy(day).orderBy(*split).rowsBetween(W.unboundedPreceding, -1)
    places = stored.groupBy(*keys).agg(F.min(position).alias("_first"), F.count("*").alias("_n"))
    starts = scratch.store(places.select(
        *[F.col(c).alias(f"_of_{c}") for c in keys],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_first")).alias("_shift")), f"{out}-starts")
    if starts.count() <= small:
        starts = F.broadcast(starts)
    same = [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in keys]
    return stored.join(starts, same).withColumn(out, (F.col(position) + F.col("_shift")).cast("bigint")).select(out, *stored.columns)

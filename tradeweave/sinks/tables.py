"""Date-partitioned Parquet tables: load once, replace a date, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave import commits
from tradeweave import schemas as S
from tradeweave.commits import DAY
from tradeweave.functions.scalar import days_before
from tradeweave.session import child_names, mark_done, path_exists, remove_path


def stored_dates(spark: SparkSession, path: str) -> set[int]:
    """Dates already in a table, from its last commit alone (no scan)."""
    if any(n.startswith(f"{DAY}=") for n in child_names(spark, path)):
        raise ValueError(f"{path} holds dates without commits; load them anew from their files")
    return set(commits.current(spark, path))


def _write(df: DataFrame, path: str) -> None:
    spark = df.sparkSession
    attempt, folder = commits.new_attempt(path)
    df.write.partitionBy(DAY).option("compression", "zstd").parquet(folder)
    commits.commit(spark, path, attempt, commits.written_dates(spark, folder), schema=df.schema)


def append_new_dates(df: DataFrame, path: str, clustered: bool = True) -> None:
    """Append only rows of dates the table does not hold yet; creates the table if absent.

    All dates are added by one commit, so they are there wholly or not at all; what an interrupted run left
    behind is not read and loaded again.

    ``clustered`` says that tasks already hold few dates each; otherwise rows are rebalanced by date
    first (adaptive execution splits large dates), which keeps the number of files low.
    """
    spark = df.sparkSession
    held = sorted(stored_dates(spark, path))
    if held:
        known = spark.createDataFrame([(d,) for d in held], f"{DAY} int")  # one row per calendar day
        df = df.join(F.broadcast(known), DAY, "left_anti")
    if not clustered:
        df = df.hint("rebalance", DAY)
    _write(df, path)
    mark_done(spark, path)


def replace_dates(df: DataFrame, path: str, clustered: bool = False) -> None:
    """Replace exactly the dates present in ``df``, all by one commit; other dates stay untouched.

    ``clustered`` as in ``append_new_dates``. ``df`` may read the table itself. What was replaced stays until ``commits.sweep``, for queries that still read it.
    """
    stored_dates(df.sparkSession, path)
    _write(df if clustered else df.hint("rebalance", DAY), path)
    mark_done(df.sparkSession, path)


def prune(spark: SparkSession, path: str, today: int, days: int = S.RETENTION_DAYS) -> list[int]:
    """Drop dates older than the cut-off, which is kept itself, and sweep left-overs; returns the dropped dates.

    Their commit comes first, so a run that ends before their files are deleted leaves them to the next sweep.
    """
    if not path_exists(spark, path):
        return []
    cutoff = days_before(today, days)
    stored_dates(spark, path)
    held = commits.current(spark, path)
    old = sorted(d for d in held if d < cutoff)
    if old:
        commits.commit(spark, path, drop=old)
    for d in old:
        remove_path(spark, f"{path}/_attempt={held[d]}/{DAY}={d}")
    commits.sweep(spark, path)
    return old

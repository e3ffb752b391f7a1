"""Row-level preparation of instructions: classes, keys and starting verdicts.

All of it is projection over one frame; bond trades stay in the same frame instead of being split
off and appended again, so there is nothing to shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave import schemas as S
from tradeweave.operators.numbering import number_rows
from tradeweave.session import Scratch


def settled(df: DataFrame) -> DataFrame:
    return df.where(F.col("Status") == S.SETTLED)


def latest_business_date(df: DataFrame, today: int) -> DataFrame:
    """One row: the last settlement date strictly before ``today``."""
    return df.agg(
        F.max(F.when(F.col("SettlementDate") < today, F.col("SettlementDate"))).alias("SettlementDate")
    )


def keep_latest(df: DataFrame, today: int) -> DataFrame:
    latest = latest_business_date(df, today)  # a single row by construction
    return df.join(F.broadcast(latest), "SettlementDate", "left_semi")


def is_bond() -> Column:
    return F.coalesce(F.col("TransactionType") == S.OTC_BOND, F.lit(False))


def has_account() -> Column:
    return F.coalesce(F.col("CDPSafeKeepingAccount") != "", F.lit(False))


def not_market_transfer() -> Column:
    return F.coalesce(F.col("TransferType") != S.MARKET_TRANSFER, F.lit(False))


def may_be_linked() -> Column:
    """Subsequent settlements without a verdict of their own, as a condition on instructions as loaded."""
    later = F.coalesce(F.col("TransactionType").isin(S.SUBSEQUENT_TYPES), F.lit(False))
    return later & F.coalesce(F.col("TransferType") != S.MARKET_TRANSFER, F.lit(True))


def prepare(df: DataFrame) -> DataFrame:
    """Add subsequent, Code_CDP, SubsequentBuySell, flag and comments."""
    bond = is_bond()
    later = F.col("TransactionType").isin(S.SUBSEQUENT_TYPES)
    subsequent = F.when(bond, S.OTC_BOND).when(later, "1").otherwise("0")
    return (
        df.withColumn("BuySellIndicator", F.upper("BuySellIndicator"))
        .withColumn("subsequent", subsequent)
        .withColumn(
            "Code_CDP",
            F.when(~bond, F.concat_ws(".", "SGXSecurityCode", "CDPSafeKeepingAccount")),
        )
        .withColumn(
            "SubsequentBuySell",
            F.when(F.col("subsequent") != S.OTC_BOND, F.concat_ws(".", "subsequent", "BuySellIndicator")),
        )
        .withColumn(
            "flag",
            F.when(F.col("subsequent") == S.OTC_BOND, "1")
            .when(F.col("TransferType") == S.MARKET_TRANSFER, S.MARKET_TRANSFER)
            .when(F.col("subsequent") == "0", "1")
            .otherwise("0"),
        )
        .withColumn("comments", F.lit(S.NOT_LOOKED_AT))
    )


def number_bonds_last(df: DataFrame, scratch: Scratch) -> DataFrame:
    """``row_no`` per date: bond trades count on after all other rows, each in row order."""
    return number_rows(df.withColumn("_bond", is_bond()), "SettlementDate", ["_bond", "row_id"],
                       "row_no", scratch, "bonds-last").drop("_bond")


def quantity_totals(prepared: DataFrame) -> DataFrame:
    """Quantity per group and side of the rows that enter the first linking pass."""
    return prepared.where(linkable()).groupBy("SettlementDate", "Code_CDP", "SubsequentBuySell").agg(
        F.sum("Quantity").alias("TotalQuantity")
    )


def linkable() -> Column:
    """Rows that may enter the first linking pass, as a condition on a prepared frame."""
    return (F.col("subsequent") != S.OTC_BOND) & not_market_transfer() & has_account()


def quantity_crosstab(prepared: DataFrame) -> DataFrame:
    """Quantity per group and side, missing sides as zero."""
    sides = list(S.SIDE_LABELS)
    return (
        prepared.where(linkable())
        .groupBy("SettlementDate", "Code_CDP")
        .agg(*[
            F.coalesce(F.sum(F.when(F.col("SubsequentBuySell") == s, F.col("Quantity"))), F.lit(0.0))
            .alias("q_" + s.replace(".", "").lower())
            for s in sorted(sides)
        ])
    )


def final_labels(df: DataFrame) -> DataFrame:
    """Readable verdict and side names; market transfers keep their code."""
    flag = F.col("flag")
    side = F.col("SubsequentBuySell")
    named = F.coalesce(*[F.when(side == code, F.lit(text)) for code, text in S.SIDE_LABELS.items()], side)
    return df.withColumn(
        "flag", F.when(flag == "1", S.ON_EXCHANGE).when(flag == "0", S.OFF_EXCHANGE).otherwise(flag)
    ).withColumn("SubsequentBuySell", named)

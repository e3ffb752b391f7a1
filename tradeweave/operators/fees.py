"""Settlement values and the new and old fee schedules, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave import schemas as S
from tradeweave.functions.scalar import transfer_fee

# The fee schedule in SGD.
CDIS_FEE = 0.5
FOPT_FEE = 0.5
DVPT_ACCOUNT_FEE = 3.5
DVPT_NO_ACCOUNT_FEE = 2.5
FDVP_FEE = 33.0
FDVP_BASE = 3.0
OFF_EXCHANGE_RATE = 0.00015
FDVP_OFF_EXCHANGE_MIN = 78.0
OFOP_OFF_EXCHANGE_MIN = 75.0
BOND_FEE = 2.0


def with_values(df: DataFrame) -> DataFrame:
    """Base-currency and SGD values; free-of-payment transfers are priced at the closing price."""
    free = F.col("TransactionType") == "OFOP"
    priced = F.col("Price") * F.col("Quantity")
    return df.withColumn(
        "SettlementValue_BaseCurrency", F.when(free, priced).otherwise(F.col("SettlementAmt"))
    ).withColumn(
        "SettlementValue_SGD",
        F.when(free, priced * F.col("Rate")).otherwise(F.col("SettlementAmt") * F.col("Rate")),
    )


def _at_least(fee: Column, least: float) -> Column:
    """The fee or its minimum; an unknown fee stays unknown."""
    return F.when(fee.isNull(), F.lit(None).cast("double")).when(fee > least, fee).otherwise(F.lit(least))


def _kind(name: str) -> Column:
    return F.col("TransactionType") == name


def new_fee() -> Column:
    """Before labelling: flag is '0', '1' or the market-transfer code."""
    account = F.col("CDPSafeKeepingAccount")
    ad_valorem = F.col("SettlementValue_SGD") * OFF_EXCHANGE_RATE
    off = F.col("flag") == "0"
    return (
        F.when(_kind("CDIS"), F.when(F.col("Sender").isin(S.CDIS_FEE_SENDERS), CDIS_FEE).otherwise(0.0))
        .when(_kind("FOPT"), F.when(account != "", FOPT_FEE).otherwise(0.0))
        .when(_kind("DVPT"), F.when(account != "", DVPT_ACCOUNT_FEE)
              .when(account == "", DVPT_NO_ACCOUNT_FEE).otherwise(0.0))
        .when(_kind("FDVP"), F.when(F.col("flag") == "1", FDVP_FEE)
              .when(off, _at_least(ad_valorem + FDVP_BASE, FDVP_OFF_EXCHANGE_MIN)).otherwise(0.0))
        .when(_kind("OFOP"), F.when(off, _at_least(ad_valorem, OFOP_OFF_EXCHANGE_MIN))
              .when(F.col("BuySellIndicator") == "S", transfer_fee(F.col("Quantity"))).otherwise(0.0))
        .when(_kind(S.OTC_BOND), BOND_FEE)
        .otherwise(0.0)
    )


def old_fee() -> Column:
    """Needs NewFee; both schedules agree on the types the change did not touch."""
    return (
        F.when(F.col("TransactionType").isin("CDIS", "FOPT", "DVPT"), F.col("NewFee"))
        .when(_kind("FDVP"), FDVP_FEE)
        .when(_kind("OFOP"), F.when(F.col("BuySellIndicator") == "S", transfer_fee(F.col("Quantity")))
              .otherwise(0.0))
        .when(_kind(S.OTC_BOND), BOND_FEE)
        .otherwise(0.0)
    )


def with_fees(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("NewFee", new_fee())
        .withColumn("OldFee", old_fee())
        .withColumn("FeeGain", F.col("NewFee") - F.col("OldFee"))
    )

"""Left joins that add rate, price and names to the instructions.

Joins that move rows by a shuffle come before those with broadcast dimensions, and before any column that can be made
from the others, so that what is moved are the instructions as loaded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave import schemas as S

BROADCAST_ROWS = 500_000  # of at most three short columns, under 100 MB in memory
SALTS = 16
FREQUENT = 1_000  # keys whose rows stay where they are while a large dimension is joined


@dataclass(frozen=True)
class Size:
    rows: int
    most_per_key: int


def measure(dim: DataFrame, keys: list[str]) -> Size:
    """Row count and largest key multiplicity, from one pass over the dimension."""
    r = dim.groupBy(*keys).count().agg(F.sum("count").alias("n"), F.max("count").alias("m")).first()
    return Size(r.n or 0, r.m or 0)


def attach(facts: DataFrame, dim: DataFrame, keys: list[str], name: str, strict: bool = True,
           broadcast_rows: int = BROADCAST_ROWS, salts: int = SALTS, size: Size | None = None) -> DataFrame:
    """``facts`` left join ``dim``, a stored table.

    The dimension is broadcast only when its measured row count is small. Otherwise it is a shuffle
    join, in which adaptive execution splits a key that holds a large share of the facts; where that
    is switched off, facts are salted by row id and the (much smaller) dimension repeated per salt.
    ``strict`` rejects duplicate dimension keys, which would multiply facts; without it the join
    keeps all matches.
    """
    dim = dim.dropna(subset=keys)  # a null key matches nothing
    size = size or measure(dim, keys)
    if strict and size.most_per_key > 1:
        raise ValueError(f"{name}: duplicate key in {keys}")
    if size.rows <= broadcast_rows:
        return facts.join(F.broadcast(dim), keys, "left")
    conf = facts.sparkSession.conf
    splits = [f"spark.sql.adaptive.{k}enabled" for k in ("", "skewJoin.")]
    if all(conf.get(k, "true") == "true" for k in splits):
        return facts.join(dim, keys, "left")
    spread = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salted = facts.withColumn("_salt", F.pmod("row_id", F.lit(salts)).cast("int"))
    return salted.join(spread, [*keys, "_salt"], "left").drop("_salt")


def with_accounts(df: DataFrame, accounts: DataFrame, strict: bool = True, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with the account's name and place; many instructions share few accounts, which are told apart by counting.

    Where the accounts are too many to broadcast, the rows of the ``FREQUENT`` most used ones are joined with these alone, by
    broadcast, and only the others are moved.
    """
    key, name = "CDPSafeKeepingAccount", "Sub_Account"
    names = accounts.select(key, "CDPAccountName", "Location").dropna(subset=[key])
    size = measure(names, [key])
    if size.rows <= broadcast_rows or size.most_per_key > 1:
        return attach(df, names, [key], name, strict, size=size)
    counts = df.groupBy(key).count().where(F.col(key).isNotNull())
    often = [r[0] for r in counts.orderBy(F.desc("count"), key).limit(FREQUENT).collect()]
    stays = F.col(key).isNull() | F.col(key).isin(often)
    few = attach(df.where(stays), names.where(F.col(key).isin(often)), [key], name, strict, size=Size(len(often), 1))
    return few.unionByName(attach(df.where(~stays), names, [key], name, strict, broadcast_rows, size=size))


def with_market(df: DataFrame, rates: DataFrame, prices: DataFrame, agents: DataFrame, strict: bool = True) -> DataFrame:
    """``df`` with price, rate and the agent's name."""
    usable = prices.where("ISIN <> ''")  # a price line without one can belong to no instruction
    df = attach(df, usable.select("SettlementDate", "ISIN", F.col("Price").cast("double").alias("Price")),
                ["SettlementDate", "ISIN"], "Closing_price", strict)
    df = df.withColumn("Currency", F.col("SettlementCcy")).withColumn("Quantity", F.col("Quantity").cast("double"))
    df = attach(df, rates.select("SettlementDate", "Currency", "Rate"),
                ["SettlementDate", "Currency"], "Exchange_rate", strict)
    df = df.withColumn(
        "Rate", F.when(F.col("Currency") == S.HOME_CURRENCY, 1.0).otherwise(F.col("Rate").cast("double"))
    )
    df = attach(df, agents.select("Sender", "DaName"), ["Sender"], "Depository_Agent", strict)
    return df.withColumn("NotReported", F.lit(None).cast("string"))


def enrich(df: DataFrame, rates: DataFrame, prices: DataFrame, agents: DataFrame,
           accounts: DataFrame, strict: bool = True) -> DataFrame:
    return with_market(with_accounts(df, accounts, strict), rates, prices, agents, strict)

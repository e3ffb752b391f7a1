"""The five report measures, exact and independent of partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeweave.functions.scalar import from_micros, micros

# measure name -> column of the daily detail
AMOUNTS = {
    "settlement_value": "SettlementValue_SGD",
    "volume": "Quantity",
    "revenue": "NewFee",
    "net_fee": "FeeGain",
}
MEASURES = ["instructions", *AMOUNTS]


def with_micros(detail: DataFrame) -> DataFrame:
    """Amounts in millionths, computed once per row ahead of any grouping."""
    return detail.withColumns({f"m_{name}": micros(F.col(col)) for name, col in AMOUNTS.items()})


def raw_block() -> list[Column]:
    """Aggregates over ``with_micros`` rows that can be added up again."""
    return [F.count("*").alias("instructions"), *[F.sum(f"m_{n}").alias(f"m_{n}") for n in AMOUNTS]]


def add_up(condition: Column | None = None) -> list[Column]:
    """Combine raw blocks, optionally only those meeting ``condition``."""
    def pick(c: str) -> Column:
        return F.col(c) if condition is None else F.when(condition, F.col(c))

    return [
        F.coalesce(F.sum(pick("instructions")), F.lit(0)).cast("bigint").alias("instructions"),
        *[F.sum(pick(f"m_{n}")).cast("decimal(38,0)").alias(f"m_{n}") for n in AMOUNTS],
    ]


def shown() -> list[Column]:
    """Raw blocks as report columns."""
    return [F.col("instructions").cast("bigint").alias("instructions"),
            *[from_micros(F.col(f"m_{n}")).alias(n) for n in AMOUNTS]]


def measure(detail: DataFrame, *keys: str | Column) -> DataFrame:
    """Measures of ``detail`` per key, or one row for none."""
    grouped = with_micros(detail).groupBy(*keys).agg(*raw_block())
    names = grouped.columns[: len(keys)]
    return grouped.select(*names, *shown())

"""Reads of stored tables; date filters become partition pruning."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave import commits
from tradeweave.commits import DAY

FACTS, RATES, PRICES = "Raw_PSMS", "Exchange_rate", "Closing_price"
AGENTS, ACCOUNTS, DETAIL = "Depository_Agent", "Sub_Account", "output_daily"
BLOCKS, TOP_BLOCKS = "output_blocks", "output_top_blocks"


class Warehouse:
    """The tables of one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def read(self, table: str) -> DataFrame:
        path = self.path(table)
        return commits.read(self.spark, path) if commits.is_committed(self.spark, path) else self.spark.read.parquet(path)

    def on(self, table: str, days: int | list[int] | None) -> DataFrame:
        df = self.read(table)
        if days is None:
            return df
        days = [days] if isinstance(days, int) else days
        return df.where(F.col(DAY).isin(days))

    def between(self, table: str, start: int, end: int) -> DataFrame:
        return self.read(table).where(F.col(DAY).between(start, end))

    def facts(self, days=None) -> DataFrame:
        return self.on(FACTS, days)

    def rates(self, days=None) -> DataFrame:
        return self.on(RATES, days).select(DAY, "Currency", "Rate")

    def prices(self, days=None) -> DataFrame:
        return self.on(PRICES, days).select(DAY, "ISIN", "Price")

    def agents(self) -> DataFrame:
        return self.read(AGENTS).select("Sender", "DaName")

    def accounts(self) -> DataFrame:
        return self.read(ACCOUNTS).select("CDPSafeKeepingAccount", "CDPAccountName", "Location")

    def detail(self, start: int | None = None, end: int | None = None) -> DataFrame:
        if start is None:
            return self.read(DETAIL)
        return self.between(DETAIL, start, end if end is not None else start)

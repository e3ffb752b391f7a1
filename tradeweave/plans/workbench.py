"""Everything a session has built for one folder of source tables, each stored once and shared."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave.operators.linking import apply_links, link
from tradeweave.operators.prepare import prepare, settled
from tradeweave.plans.detailed import charged
from tradeweave.session import Scratch, path_exists
from tradeweave.sinks.tables import append_new_dates
from tradeweave.sources.star_schema import load_prices, load_star
from tradeweave.sources.tables import DETAIL, FACTS, PRICES, Warehouse

LINKS = "links"


class Workbench:
    """Loads the source folder on first use; keeps the linked and detailed tables for the reports."""

    _open: dict[tuple[str, str], Workbench] = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.house = Warehouse(spark, Scratch(spark, "warehouse").path)

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Workbench:
        key = (spark.sparkContext.applicationId, folder.rstrip("/"))
        if key not in cls._open:
            cls._open[key] = cls(spark, folder)
        bench = cls._open[key]
        bench.spark = bench.house.spark = spark
        return bench

    def _done(self, table: str) -> bool:
        return path_exists(self.spark, f"{self.house.path(table)}/_SUCCESS")

    def scratch(self, label: str) -> Scratch:
        return Scratch(self.spark, label)

    def loaded(self) -> Warehouse:
        if not self._done(FACTS):
            load_star(self.spark, self.folder, self.house.root)
        return self.house

    def priced(self) -> Warehouse:
        """The warehouse with its prices in place; the other tables are loaded when they are asked for."""
        if not self._done(PRICES):
            load_prices(self.spark, self.folder, self.house.root)
        return self.house

    def links(self) -> DataFrame:
        """What the rules link of all instructions, stored."""
        path = self.house.path(LINKS)
        if not self._done(LINKS):
            scratch = self.scratch("link")
            prepared = prepare(settled(self.loaded().facts()))
            link(prepared, scratch).write.mode("overwrite").option("compression", "zstd").parquet(path)
            scratch.drop()
        return self.spark.read.parquet(path)

    def linked(self) -> DataFrame:
        """Prepared instructions with their verdict, before enrichment. Only the links are stored."""
        return apply_links(prepare(settled(self.loaded().facts())), self.links())

    def reported(self) -> Warehouse:
        """The warehouse with its daily detail in place; each report makes the blocks of the dates it adds up."""
        if not self._done(DETAIL):
            # written from the last join: bringing the dates together would move every wide row once more, and the join
            # by date and security leaves rows in an order that the writer takes
            append_new_dates(charged(self.loaded(), None, self.links()), self.house.path(DETAIL))
        return self.house

    def detail(self) -> DataFrame:
        return self.reported().detail()

    def whole_range(self) -> tuple[int, int]:
        """First and last stored date."""
        r = self.detail().agg(F.min("SettlementDate"), F.max("SettlementDate")).first()
        return r[0], r[1]

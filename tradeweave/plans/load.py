"""Load the feeds of the latest business day, and prune old days."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tradeweave import schemas as S
from tradeweave.operators.prepare import keep_latest, latest_business_date, settled
from tradeweave.session import Scratch
from tradeweave.sinks.tables import append_new_dates, prune
from tradeweave.sources import files
from tradeweave.sources.tables import BLOCKS, DETAIL, FACTS, PRICES, RATES, TOP_BLOCKS, Warehouse


def load_feeds(house: Warehouse, instructions: str, rates: str, prices: str, today: int,
               rejects: str | None = None) -> int:
    """Append the settled instructions of the last date before ``today`` and its market data.

    ``rates`` and ``prices`` are folders holding the dated files. Malformed records
    stop the load or, given ``rejects``, are put in that folder. Returns the loaded date.
    """
    spark: SparkSession = house.spark
    scratch = Scratch(spark, "load")
    try:
        facts = settled(files.read_instructions(spark, instructions, scratch, rejects))
        day = latest_business_date(facts, today).first()[0]
        if day is None:
            raise ValueError("no settled records in the instruction file")
        append_new_dates(keep_latest(facts, today), house.path(FACTS))
        fx = files.with_default_rate(files.read_rates(spark, files.rate_file(rates, day), scratch))
        append_new_dates(files.stamped(fx), house.path(RATES), clustered=False)
        last = files.read_prices(spark, files.price_file(prices, day), scratch)
        append_new_dates(files.stamped(last), house.path(PRICES), clustered=False)
    finally:
        scratch.drop()
    return day


def cleanup(house: Warehouse, today: int, days: int = S.RETENTION_DAYS) -> dict[str, list[int]]:
    """Drop old days of facts and daily results, with their report blocks; rates and prices are kept."""
    for blocks in (BLOCKS, TOP_BLOCKS):
        prune(house.spark, house.path(blocks), today, days)
    return {t: prune(house.spark, house.path(t), today, days) for t in (FACTS, DETAIL)}

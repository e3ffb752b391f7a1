"""The daily detailed result: link, enrich, value, charge, label, store."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeweave.operators import matching as M
from tradeweave.operators.enrich import with_accounts, with_market
from tradeweave.operators.fees import with_fees, with_values
from tradeweave.operators.linking import apply_links, judged, link, mark
from tradeweave.operators.prepare import final_labels, is_bond, prepare, settled
from tradeweave.plans.blocks import report_blocks
from tradeweave.schemas import MAX_ROUNDS
from tradeweave.session import Scratch
from tradeweave.sinks.exports import write_detail
from tradeweave.sinks.tables import append_new_dates, replace_dates, stored_dates
from tradeweave.sources.files import require_rows
from tradeweave.sources.tables import BLOCKS, DETAIL, FACTS, PRICES, RATES, TOP_BLOCKS, Warehouse


def check_inputs(house: Warehouse, days: int | list[int] | None) -> None:
    """Stop unless every date asked for has what its report needs; the message names dates that lack it."""
    def dates(df: DataFrame) -> set[int]:
        return {r[0] for r in df.select("SettlementDate").distinct().collect()}  # one value per calendar day

    facts = dates(house.facts(days))
    wanted = facts if days is None else {days} if isinstance(days, int) else set(days)
    for what, there in (
        (f"no rows in {FACTS} for the date", facts),
        (f"no rows in {RATES} for the date", dates(house.rates(days))),
        (f"no rows in {PRICES} for the date", dates(house.prices(days))),
        ("only bond trades found for the date", dates(house.facts(days).where(~is_bond()))),
    ):
        if not wanted or wanted - there:
            raise ValueError(f"{what} {', '.join(map(str, sorted(wanted - there)))}".rstrip())
    require_rows(house.agents(), "the agent table is empty")
    require_rows(house.accounts(), "the account table is empty")


def linked(house: Warehouse, days: int | list[int] | None, scratch: Scratch,
           limits: M.Limits = M.Limits(), upto: str = "turnaround", max_rounds: int = MAX_ROUNDS) -> DataFrame:
    prepared = prepare(settled(house.facts(days)))
    links = link(prepared, scratch, limits, upto, max_rounds)
    return apply_links(prepared, links, looked_at=upto in ("reference", "turnaround"))


#: What the detail's columns start with; the loaded ones follow, then those that are made.
_FIRST = ["CDPSafeKeepingAccount", "Sender", "SettlementDate", "ISIN", "Currency"]
_MADE = ["subsequent", "Code_CDP", "SubsequentBuySell", "flag", "comments", "NotReported", "Rate", "Price", "DaName",
         "CDPAccountName", "Location"]


def joined(house: Warehouse, days: int | list[int] | None, links: DataFrame, strict: bool = True) -> DataFrame:
    """Settled instructions with verdict, names, price and rate. What can be made from other columns is made after the joins."""
    facts = settled(house.facts(days))
    rows = mark(with_accounts(facts, house.accounts(), strict), links)
    rows = with_market(rows, house.rates(days), house.prices(days), house.agents(), strict)
    loaded = [c for c in facts.columns if c not in _FIRST]
    return judged(prepare(rows)).select(*_FIRST, *loaded, *_MADE)


def charged(house: Warehouse, days: int | list[int] | None, links: DataFrame, strict: bool = True) -> DataFrame:
    return final_labels(with_fees(with_values(joined(house, days, links, strict))))


def detail(house: Warehouse, days: int | list[int] | None = None, scratch: Scratch | None = None,
           limits: M.Limits = M.Limits(), strict: bool = True, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """All settlements of the dates with verdict, names, values and fees."""
    scratch = scratch or Scratch(house.spark, "link")
    links = link(prepare(settled(house.facts(days))), scratch, limits, max_rounds=max_rounds)
    return charged(house, days, links, strict)


def daily_detailed_report(house: Warehouse, days: int | list[int], folder: str | None = None,
                          manual: bool = False, limits: M.Limits = M.Limits(), strict: bool = True,
                          max_rounds: int = MAX_ROUNDS) -> None:
    """Store the result of the dates and export each as CSV.

    An automatic run keeps dates that are already stored; a manual run replaces them. Duplicate dimension keys
    stop the run, or with strict=False multiply rows. Linking that takes more than max_rounds turnarounds stops it too.
    """
    check_inputs(house, days)
    days = [days] if isinstance(days, int) else list(days)
    scratch = Scratch(house.spark, "link")
    try:
        result = detail(house, days, scratch, limits, strict, max_rounds)
        path = house.path(DETAIL)
        held = set() if manual else stored_dates(house.spark, path)
        if folder and held & set(days):  # read once for each such day and file, so computed once
            result = scratch.store(result, "result")
        if manual:
            replace_dates(result, path)
        elif set(days) - held:
            append_new_dates(result, path, clustered=len(days) == 1)
        for blocks in (BLOCKS, TOP_BLOCKS):
            report_blocks(house, min(days), max(days), blocks)  # for the reports over these dates
        for day in days if folder else []:
            # a stored day is read back; a day kept from an earlier run still exports its fresh result
            rows = result if day in held else house.read(DETAIL).select(*result.columns)
            write_detail(rows.where(F.col("SettlementDate") == day), folder, day, manual)
    finally:
        scratch.drop()

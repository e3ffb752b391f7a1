"""Registered queries: each reads the given tables through the derivation in FIXTURES.md."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import Window as W  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tradeweave import commits  # noqa: E402
from tradeweave.operators.enrich import enrich  # noqa: E402
from tradeweave.operators.fees import with_fees, with_values  # noqa: E402
from tradeweave.operators.measures import measure, raw_block, shown, with_micros  # noqa: E402
from tradeweave.operators.prepare import (  # noqa: E402
    keep_latest, number_bonds_last, prepare, quantity_crosstab, quantity_totals, settled,
)
from tradeweave.plans import detailed as D  # noqa: E402
from tradeweave.plans import summaries as R  # noqa: E402
from tradeweave.plans.blocks import cube  # noqa: E402
from tradeweave.plans.workbench import Workbench  # noqa: E402
from tradeweave.plans.load import cleanup, load_feeds  # noqa: E402
from tradeweave.operators.matching import Limits  # noqa: E402
from tradeweave.sinks.exports import off_exchange_only, write_csv  # noqa: E402
from tradeweave.sinks.tables import append_new_dates, replace_dates  # noqa: E402
from tradeweave.sources.tables import DETAIL, FACTS, PRICES, RATES, Warehouse  # noqa: E402
from tradeweave.schemas import INSTRUCTION_COLUMNS  # noqa: E402
from tradeweave.session import child_names, move_path  # noqa: E402
from tradeweave.sources import files  # noqa: E402
from tradeweave.sources.files import with_default_rate  # noqa: E402
from tradeweave.sources.star_schema import Star  # noqa: E402
import tradeweave_oracle  # noqa: E402

try:
    from tradeweave.llm import queries as _llm  # noqa: E402
except ImportError:  # the subpackage may be left out
    _llm = None

_VERDICT = ["row_id", "SettlementDate", "flag", "comments"]


def entry(spark: SparkSession) -> DataFrame:
    return _detailed(spark, "/root/testdata/sf0.001")


def _prep(spark: SparkSession, sf: str) -> DataFrame:
    facts = Workbench.of(spark, sf).loaded().facts()
    return prepare(settled(facts)).select(
        "row_id", "SettlementDate", "BuySellIndicator", "TransactionType", "subsequent", "Code_CDP",
        "SubsequentBuySell", "flag", "comments",
    )


def _latest_date(spark: SparkSession, sf: str) -> DataFrame:
    facts = Workbench.of(spark, sf).loaded().facts()
    return keep_latest(settled(facts), 20010615).groupBy("SettlementDate").agg(
        F.count("*").alias("instructions")
    )


def _fx_default(spark: SparkSession, sf: str) -> DataFrame:
    return with_default_rate(Star(spark, sf).rates())


def _load_once(spark: SparkSession, sf: str) -> DataFrame:
    bench = Workbench.of(spark, sf)
    facts = bench.loaded().facts().select("SettlementDate", "row_id")
    path = bench.scratch("load-once").at("facts")
    append_new_dates(facts.where("SettlementDate < 19980101"), path)
    append_new_dates(facts, path)  # dates stored by the first load are left alone
    return commits.read(spark, path).groupBy("SettlementDate").agg(
        F.count("*").alias("instructions"), F.sum("row_id").alias("id_sum")
    )


def _replace_date(spark: SparkSession, sf: str) -> DataFrame:
    bench = Workbench.of(spark, sf)
    rates = bench.loaded().rates()
    path = bench.scratch("replace").at("rates")
    append_new_dates(rates, path, clustered=False)
    replace_dates(rates.where("SettlementDate >= 20000101").withColumn("Rate", F.col("Rate") * 2), path)
    return commits.read(spark, path).select("SettlementDate", "Currency", "Rate")


def _retention(spark: SparkSession, sf: str) -> DataFrame:
    """The cleanup job over stored facts."""
    bench = Workbench.of(spark, sf)
    house = Warehouse(spark, bench.scratch("retention").path)
    append_new_dates(bench.loaded().facts().select("SettlementDate", "row_id"), house.path(FACTS), clustered=False)
    cleanup(house, 20000601)
    return house.read(FACTS).groupBy("SettlementDate").agg(F.count("*").alias("instructions"))


def _row_numbers(spark: SparkSession, sf: str) -> DataFrame:
    bench = Workbench.of(spark, sf)
    facts = settled(bench.loaded().facts()).select("SettlementDate", "row_id", "TransactionType")
    return number_bonds_last(facts, bench.scratch("numbers")).select("SettlementDate", "row_id", "row_no")


def _instruction_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Write all instructions as the header-less feed, in row order, and read them back."""
    bench = Workbench.of(spark, sf)
    scratch = bench.scratch("feed")
    _write_csv_feed(bench, scratch.at("csv"))
    return files.read_instructions(spark, scratch.at("csv"), scratch).select(
        "row_id", "SettlementDate", "BuySellIndicator", "TransactionType", "Sender", "ISIN",
        "CDPSafeKeepingAccount", "Quantity", "SettlementAmt", "PSMSMatchedReference", "TransferType",
    )


def _write_feeds(rows: DataFrame, prefix: str, line: str, path: str) -> None:
    """Dated pipe files with a header and a trailer line each, as the providers send them."""
    body = rows.select("SettlementDate", F.lit(1).alias("_kind"), F.expr(line).alias("value"))
    ends = rows.select("SettlementDate").distinct().select(
        "SettlementDate", F.explode(F.array(F.lit(0), F.lit(2))).alias("_kind"), F.lit("END|").alias("value"))
    order = ["feed", "_kind", "value"]  # leads with the partition column, so the writer keeps it
    named = F.concat(F.lit(prefix), "SettlementDate", F.lit(".txt"))
    (
        body.unionByName(ends).withColumn("feed", named)
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .select("value", "feed").write.partitionBy("feed").option("compression", "gzip").text(path)
    )


_RATE_LINE = "concat_ws('|', '19000101', Currency, CAST(Rate AS STRING), 'more')"
_PRICE_LINE = "concat_ws('|', '19000101', Code, SecurityDescription, CAST(Price AS STRING), Currency, ISIN)"


def _rate_files(spark: SparkSession, sf: str) -> DataFrame:
    scratch = Workbench.of(spark, sf).scratch("feed")
    _write_feeds(Star(spark, sf).rates(), "EXCHANGE_RATE_", _RATE_LINE, scratch.at("fx"))
    return files.read_rates(spark, scratch.at("fx"), scratch)


def _price_files(spark: SparkSession, sf: str) -> DataFrame:
    bench = Workbench.of(spark, sf)
    scratch = bench.scratch("feed")
    _write_feeds(bench.priced().read("Closing_price"), "LAST_DONE_PRICE_", _PRICE_LINE, scratch.at("px"))
    return files.read_prices(spark, scratch.at("px"), scratch).select(
        "SettlementDate", "Code", "SecurityDescription", "Price", "ISIN")


def _detail_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Every column through the CSV export and back; a missing text comes back as a blank one."""
    bench = Workbench.of(spark, sf)
    path = bench.scratch("csv").at("detail")
    detail = bench.detail().select(*tradeweave_oracle.DETAIL_COLUMNS)
    write_csv(detail, path, "gzip")
    back = spark.read.schema(detail.schema).option("header", True).csv(path)
    return back.fillna("", subset=[c for c, t in detail.dtypes if t == "string"])


_TODAY = 20010615


def _write_csv_feed(bench: Workbench, path: str) -> None:
    """All instructions as the header-less feed, in row order.

    Stored files hold one stretch of a date's rows each; where no two stretches overlap, each becomes a feed file whose name
    says where it begins, and no row is moved. Only the ends of stretches are gathered, one row per file and split.
    """
    facts = bench.loaded().facts()
    fields = [F.col(c) if c in facts.columns else F.lit("").alias(c) for c in INSTRUCTION_COLUMNS]
    order = ["SettlementDate", "row_id"]
    placed = facts.select("*", F.col("_metadata.file_path").alias("_of"), F.col("_metadata.file_block_start").alias("_at"))
    ends = placed.groupBy("SettlementDate", "_of", "_at").agg(F.min("row_id").alias("_first"), F.max("row_id").alias("_last"))
    ends = bench.scratch("stretches").store(ends, "ends")
    after = F.lead("_first").over(W.partitionBy("SettlementDate").orderBy("_first", "_last"))
    if ends.where("_first IS NULL").isEmpty() and ends.withColumn("_after", after).where("_last >= _after").isEmpty():
        rows = placed.join(F.broadcast(ends), ["SettlementDate", "_of", "_at"], "left")
        begins = F.coalesce(F.col("_first").cast("string"), F.raise_error(F.lit("stored files were split anew")).cast("string"))
        rows = rows.withColumn("feed", F.concat_ws("-", "SettlementDate", F.lpad(begins, 19, "0")))
        rows = rows.sortWithinPartitions("feed", "row_id").select(*fields, F.lit("x").alias("extra"), "feed")
        out = rows.write.partitionBy("feed")
    else:
        out = facts.repartitionByRange(*order).sortWithinPartitions(*order).select(*fields, F.lit("x").alias("extra")).write
    out.option("emptyValue", "").option("compression", "gzip").csv(path)


def _load_job(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """The load job over all three feeds: what it stores of the last business day before _TODAY."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        bench = Workbench.of(spark, sf)
        scratch = bench.scratch("load-job")
        _write_csv_feed(bench, scratch.at("csv"))
        _write_feeds(Star(spark, sf).rates(), "EXCHANGE_RATE_", _RATE_LINE, scratch.at("fx"))
        _write_feeds(bench.priced().read("Closing_price"), "LAST_DONE_PRICE_", _PRICE_LINE, scratch.at("px"))
        for folder in (scratch.at("fx"), scratch.at("px")):
            for name in child_names(spark, folder):
                if name.startswith("feed="):
                    move_path(spark, f"{folder}/{name}", f"{folder}/{name.removeprefix('feed=')}")
        house = Warehouse(spark, scratch.at("house"))
        load_feeds(house, scratch.at("csv"), scratch.at("fx"), scratch.at("px"), _TODAY)
        columns = {
            FACTS: ["row_id", "SettlementDate", "TransactionType", "Sender", "ISIN", "Quantity", "SettlementAmt", "PSMSMatchedReference"],
            RATES: ["SettlementDate", "Currency", "Rate"], PRICES: ["SettlementDate", "ISIN", "Price"],
        }
        return house.read(table).select(*columns[table])

    return run


def _detail_job(spark: SparkSession, sf: str) -> DataFrame:
    """The detailed report of two of the stored days, run by itself, then again by hand over a falsified result."""
    bench = Workbench.of(spark, sf)
    source = bench.loaded()
    house = Warehouse(spark, bench.scratch("detail-job").path)
    for name in (FACTS, RATES, PRICES):
        append_new_dates(source.read(name), house.path(name), clustered=False)
    source.agents().write.parquet(house.path("Depository_Agent"))
    source.accounts().write.parquet(house.path("Sub_Account"))
    D.daily_detailed_report(house, tradeweave_oracle.JOB_DAYS, bench.scratch("out").path)
    held = house.read(DETAIL)
    wrong = bench.scratch("wrong").store(held.where(F.col("SettlementDate") == tradeweave_oracle.JOB_DAYS[0]).withColumn("NewFee", F.lit(-1.0)), "rows")
    replace_dates(wrong, house.path(DETAIL))
    D.daily_detailed_report(house, tradeweave_oracle.JOB_DAYS, manual=True)
    D.daily_detailed_report(house, tradeweave_oracle.JOB_DAYS)  # stored days are left alone
    return house.read(DETAIL).select(*tradeweave_oracle.DETAIL_COLUMNS)


def _summary_file(spark: SparkSession, sf: str) -> DataFrame:
    """The weekly report over part of the stored days, as the job writes it."""
    bench = Workbench.of(spark, sf)
    path = R.weekly_summary_report(bench.reported(), *tradeweave_oracle.JOB_RANGE, bench.scratch("reports").path)
    return spark.read.parquet(path)


def _split_groups(spark: SparkSession, sf: str) -> DataFrame:
    """The whole linking with bounds so low that every large group, cell and list is split."""
    bench = Workbench.of(spark, sf)
    limits = Limits(max_cells=3, block_rows_log2=4, small_list=10, pending=2, component_rows=12)
    return D.linked(bench.loaded(), None, bench.scratch("link"), limits).select(*_VERDICT)


def _quantity_totals(spark: SparkSession, sf: str) -> DataFrame:
    return quantity_totals(prepare(settled(Workbench.of(spark, sf).loaded().facts())))


def _crosstab(spark: SparkSession, sf: str) -> DataFrame:
    return quantity_crosstab(prepare(settled(Workbench.of(spark, sf).loaded().facts())))


def _linking(upto: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        bench = Workbench.of(spark, sf)
        return D.linked(bench.loaded(), None, bench.scratch("link"), upto=upto).select(*_VERDICT)

    return run


def _joined(spark: SparkSession, sf: str) -> DataFrame:
    h = Workbench.of(spark, sf).loaded()
    return prepare(enrich(settled(h.facts()), h.rates(), h.prices(), h.agents(), h.accounts()))


def _enrich(spark: SparkSession, sf: str) -> DataFrame:
    return _joined(spark, sf).select(
        "row_id", "SettlementDate", "Currency", "Rate", "Price", "DaName", "CDPAccountName", "Location"
    )


def _valuation(spark: SparkSession, sf: str) -> DataFrame:
    return with_values(_joined(spark, sf)).select(
        "row_id", "SettlementDate", "SettlementValue_BaseCurrency", "SettlementValue_SGD"
    )


def _fee(column: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        bench = Workbench.of(spark, sf)
        rows = D.joined(bench.loaded(), None, bench.links())
        return with_fees(with_values(rows)).select("row_id", "SettlementDate", column)

    return run


def _detailed(spark: SparkSession, sf: str) -> DataFrame:
    bench = Workbench.of(spark, sf)
    return D.detail(bench.loaded(), None, bench.scratch("link")).select(*tradeweave_oracle.DETAIL_COLUMNS)


def _off_exchange(spark: SparkSession, sf: str) -> DataFrame:
    rows = Workbench.of(spark, sf).detail().select(*tradeweave_oracle.DETAIL_COLUMNS)
    return off_exchange_only(rows)


def _kpi(*keys: str, where: str = "true") -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return measure(Workbench.of(spark, sf).detail().where(where), "SettlementDate", *keys)

    return run


def _kpi_by_client(spark: SparkSession, sf: str) -> DataFrame:
    rows = Workbench.of(spark, sf).detail().where("CDPSafeKeepingAccount <> ''")
    return (
        with_micros(rows).groupBy("SettlementDate", "Sender")
        .agg(*raw_block(), F.min("DaName").alias("DaName"))
        .select("SettlementDate", "Sender", "DaName", *shown())
    )


def _top(dim: str, agent: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        bench = Workbench.of(spark, sf)
        parts = cube(bench.detail(), [], False, [dim])
        return R.ranked(parts, [], [dim]).select(
            "segment", F.col("name").alias(dim), *(["agent"] if agent else []), "ord", *shown()
        )

    return run


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return R.daily_summary(Workbench.of(spark, sf).reported())


def _ranged(report: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        bench = Workbench.of(spark, sf)
        start, end = bench.whole_range()
        return report(bench.reported(), start, end)

    return run


def _part(report: Callable[..., DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: report(Workbench.of(spark, sf).reported(), *tradeweave_oracle.JOB_RANGE)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "prep": _prep,
        "latest_date": _latest_date,
        "fx_default": _fx_default,
        "instruction_csv": _instruction_csv,
        "rate_files": _rate_files,
        "price_files": _price_files,
        "row_numbers": _row_numbers,
        "load_once": _load_once,
        "replace_date": _replace_date,
        "retention": _retention,
        "quantity_totals": _quantity_totals,
        "crosstab": _crosstab,
        "total_link": _linking("total"),
        "individual_link": _linking("individual"),
        "reference_match": _linking("reference"),
        "turnaround": _linking("turnaround"),
        "enrich": _enrich,
        "valuation": _valuation,
        "new_fee": _fee("NewFee"),
        "old_fee": _fee("OldFee"),
        "fee_gain": _fee("FeeGain"),
        "detailed": _detailed,
        "off_exchange_detail": _off_exchange,
        "detail_csv": _detail_csv,
        "kpi_total": _kpi(),
        "kpi_first": _kpi(where="subsequent = '0'"),
        "kpi_subsequent": _kpi(where="subsequent = '1'"),
        "kpi_by_flag": _kpi("flag", where="subsequent = '1'"),
        "kpi_otc_bonds": _kpi(where="subsequent = 'DCSS'"),
        "kpi_by_type_flag": _kpi("TransactionType", "flag", where="TransactionType IN ('FDVP', 'OFOP')"),
        "kpi_by_subsequent_type": _kpi("subsequent", "TransactionType"),
        "kpi_by_participant": _kpi("Sender", "DaName"),
        "kpi_by_client": _kpi_by_client,
        "kpi_client_total": _kpi(where="CDPSafeKeepingAccount <> ''"),
        "kpi_by_member": _kpi("Sender", "DaName", where="CDPSafeKeepingAccount = ''"),
        "kpi_member_total": _kpi(where="CDPSafeKeepingAccount = ''"),
        "top20_security": _top("SecurityDescription"),
        "top20_agent": _top("DaName"),
        "top20_account": _top("CDPAccountName", agent=True),
        "top20_location": _top("Location"),
        "daily_summary": _daily,
        "weekly_summary": _ranged(R.weekly_summary),
        "monthly_summary": _ranged(R.monthly_summary),
        "load_job_facts": _load_job(FACTS),
        "load_job_rates": _load_job(RATES),
        "load_job_prices": _load_job(PRICES),
        "detail_job": _detail_job,
        "weekly_report": _summary_file,
        "monthly_range": _part(R.monthly_summary),
        "split_groups": _split_groups,
        **(_llm.queries() if _llm else {}),
    }


def oracle_sql() -> dict[str, str]:
    return {**tradeweave_oracle.oracle(), **(_llm.oracle_sql() if _llm else {})}

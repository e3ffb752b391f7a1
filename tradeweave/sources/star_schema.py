"""Settlement tables derived from an order/line-item star schema (see FIXTURES.md).

Used to run the engine on the driver's tables: every line item becomes an instruction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeweave import schemas as S
from tradeweave.operators.numbering import number_rows
from tradeweave.session import Scratch, path_exists
from tradeweave.sinks.tables import append_new_dates
from tradeweave.sources import tables as T
from tradeweave.sources.files import stamped, with_default_rate

# Total order of the instructions of a date; exact duplicates are interchangeable.
_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]

# The columns of it that an instruction is made of. Those left out tell apart only line items that make equal
# instructions on the same date, so numbering moves without them.
_USED = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]

_DAY = "CAST(year(l_shipdate) * 10000 + month(l_shipdate) * 100 + 1 AS INT)"

_FIELDS = {
    "SettlementDate": _DAY,
    "BuySellIndicator": "CASE WHEN (l_orderkey + l_linenumber) % 2 = 0 THEN 'B' ELSE 's' END",
    "TransactionType": """CASE (l_orderkey * 7 + l_linenumber * 3 + l_suppkey) % 10
        WHEN 0 THEN 'FDVP' WHEN 1 THEN 'FDVP' WHEN 2 THEN 'FDVP' WHEN 3 THEN 'OFOP' WHEN 4 THEN 'OFOP'
        WHEN 5 THEN 'DVPT' WHEN 8 THEN 'DVPT' WHEN 6 THEN 'FOPT' WHEN 7 THEN 'CDIS' ELSE 'DCSS' END""",
    "TransferType": "CASE WHEN l_orderkey % 17 = 0 THEN 'SBLT' ELSE 'NORM' END",
    "Sender": """CAST(CASE l_suppkey WHEN 0 THEN 561 WHEN 1 THEN 635 WHEN 2 THEN 690
        ELSE 1000 + l_suppkey END AS INT)""",
    "SGXSecurityCode": "concat('S', CAST(l_partkey DIV 300 AS STRING))",
    "ISIN": "concat('I', CAST(l_partkey AS STRING))",
    "SecurityDescription": "concat(p_name, ' ', p_brand)",
    "CDPSafeKeepingAccount": """CASE WHEN o_custkey % 12 = 0 THEN ''
        WHEN o_custkey % 3 = 1 THEN concat('A', CAST(o_custkey AS STRING))
        ELSE concat('A', CAST(o_custkey % 12 AS STRING)) END""",
    "Quantity": "l_quantity * 400",
    "SettlementCcy": """CASE WHEN o_custkey % 11 = 0 THEN 'EUR' WHEN o_custkey % 4 = 0 THEN 'USD'
        WHEN o_custkey % 4 = 1 THEN 'THB' ELSE 'SGD' END""",
    "SettlementAmt": "l_extendedprice * 20",
    "Status": "CASE WHEN l_orderkey % 23 = 0 THEN 'PENDING' ELSE 'SETTLED' END",
    "PSMSMatchedReference":
        "IF(l_orderkey % 97 = 0, '', concat('R', CAST(l_orderkey DIV 50 AS STRING)))",
}


class Star:
    """The driver's tables of one folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _items(self, columns: list[str | Column]) -> DataFrame:
        """Line items with what their order and part add; the texts of an instruction are made from these columns alone."""
        items = self["lineitem"].select(*columns)
        return (
            items
            .join(self["orders"].select("o_orderkey", "o_custkey"), F.expr("l_orderkey = o_orderkey"))
            .join(self["part"].select("p_partkey", "p_name", "p_brand"), F.expr("l_partkey = p_partkey"))
            .select(*items.columns, "o_custkey", "p_name", "p_brand")
        )

    def instructions(self) -> DataFrame:
        """Unnumbered instructions plus the ordering columns."""
        return self._items(_ORDER).select(*[F.expr(e).alias(c) for c, e in _FIELDS.items()], *_ORDER)

    def facts(self, scratch: Scratch) -> DataFrame:
        items = self._items([F.expr(_DAY).alias("SettlementDate"), *_USED])
        numbered = number_rows(items, "SettlementDate", _USED, "row_id", scratch)  # before the texts, which would be moved too
        fields = {**_FIELDS, "SettlementDate": "SettlementDate"}
        return numbered.select("row_id", *[F.expr(e).alias(c) for c, e in fields.items()])

    def days(self) -> DataFrame:
        return self["lineitem"].select(F.expr(_DAY).alias("SettlementDate")).distinct()

    def rates(self) -> DataFrame:
        """Two quoted currencies per date; THB is left to the default, EUR has no rate."""
        quoted = F.array(*[
            F.struct(F.lit(c).alias("Currency"), F.lit(r).alias("Rate"))
            for c, r in (("USD", 1.25), ("HKD", 0.16))
        ])
        return self.days().select("SettlementDate", F.explode(quoted).alias("q")).select(
            "SettlementDate", "q.Currency", "q.Rate"
        )

    def prices(self) -> DataFrame:
        """Price of every security traded on a date; one in nine securities has none.

        Pairs come from the line items, so the size follows the trades, not parts times dates.
        """
        traded = (  # dealt by part, which serves the distinct pairs and the join
            self["lineitem"].where("l_partkey % 9 <> 0")
            .select(F.expr(_DAY).alias("SettlementDate"), "l_partkey").repartition("l_partkey").distinct()
        )
        return traded.join(self["part"], F.expr("l_partkey = p_partkey")).select(
            "SettlementDate",
            F.expr("concat('S', CAST(p_partkey DIV 300 AS STRING))").alias("Code"),
            F.expr("concat(p_name, ' ', p_brand)").alias("SecurityDescription"),
            F.col("p_retailprice").alias("Price"),
            F.lit(S.HOME_CURRENCY).alias("Currency"),
            F.expr("concat('I', CAST(p_partkey AS STRING))").alias("ISIN"),
        )

    def agents(self) -> DataFrame:
        """Every supplier; one in nine has no name on file."""
        return self["supplier"].where("s_suppkey % 9 <> 8").select(
            F.expr("""CAST(CASE s_suppkey WHEN 0 THEN 561 WHEN 1 THEN 635 WHEN 2 THEN 690
                      ELSE 1000 + s_suppkey END AS INT)""").alias("Sender"),
            F.col("s_name").alias("DaName"),
        )

    def accounts(self) -> DataFrame:
        """Every customer; one in eleven has no name on file."""
        return (
            self["customer"].where("c_custkey % 11 <> 0")
            .join(self["nation"], F.expr("c_nationkey = n_nationkey"))
            .select(
                F.expr("concat('A', CAST(c_custkey AS STRING))").alias("CDPSafeKeepingAccount"),
                F.col("c_name").alias("CDPAccountName"),
                F.col("n_name").alias("Location"),
            )
        )


def load_prices(spark: SparkSession, folder: str, root: str) -> None:
    """Load the closing prices; they are written from their join, which leaves each part's prices together."""
    append_new_dates(stamped(Star(spark, folder).prices()), T.Warehouse(spark, root).path(T.PRICES))


def load_star(spark: SparkSession, folder: str, root: str) -> T.Warehouse:
    """Load all derived tables into a warehouse through the regular load-once sinks."""
    star, house = Star(spark, folder), T.Warehouse(spark, root)
    scratch = Scratch(spark, "ingest")
    append_new_dates(stamped(with_default_rate(star.rates())), house.path(T.RATES), clustered=False)
    if not path_exists(spark, f"{house.path(T.PRICES)}/_SUCCESS"):
        load_prices(spark, folder, root)
    star.agents().write.mode("overwrite").parquet(house.path(T.AGENTS))
    star.accounts().write.mode("overwrite").parquet(house.path(T.ACCOUNTS))
    append_new_dates(star.facts(scratch), house.path(T.FACTS))  # last: marks the load as complete
    scratch.drop()
    return house

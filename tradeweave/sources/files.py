"""Readers for the three file feeds."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeweave import schemas as S
from tradeweave.functions.scalar import load_stamp
from tradeweave.operators.numbering import number_in_place
from tradeweave.session import Scratch

_EXTRA = "_extra"  # some deliveries carry a 33rd, unused field
_RECORD = "_record"


def read_instructions(spark: SparkSession, path: str, scratch: Scratch, rejects: str | None = None) -> DataFrame:
    """Header-less comma CSV of 32 or 33 fields, numbered per settlement date in file order.

    A blank field is a missing value, except for the settlement date. A record with a field that its type
    cannot hold, or with another number of fields, is not taken: the records so left out are written to the folder
    ``rejects`` (with the file and the texts of the fields in question; the number of fields as ``fields``),
    or, without one, the first of them is named in an error. Commas inside quoted fields separate nothing; a quote in one is doubled.
    """
    names = [f.name for f in S.INSTRUCTION.fields]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _EXTRA, _RECORD]])
    raw = (
        spark.read.schema(schema)
        .option("header", False).option("sep", ",").option("emptyValue", "").option("nullValue", "\0").option("escape", '"')
        .option("columnNameOfCorruptRecord", _RECORD).option("columnPruning", False)  # a pruned record has no field count
        .csv(path)
    )
    count = _field_count(F.col(_RECORD))  # a record is kept as text where it has not all of the schema's fields
    miscounted = F.col(_RECORD).isNotNull() & ~count.isin(len(names), len(names) + 1)
    fields, faults = [], [("fields", miscounted, count.cast("string"))]
    for f in S.INSTRUCTION.fields:
        if isinstance(f.dataType, T.StringType):
            fields.append(F.coalesce(f.name, F.lit("")).alias(f.name))
            continue
        value = F.trim(f.name).try_cast(f.dataType)
        fields.append(value.alias(f.name))
        blank = F.coalesce(F.trim(f.name), F.lit("")) == ""
        wrong = value.isNull() if f.name == "SettlementDate" else value.isNull() & ~blank
        faults.append((f.name, wrong, F.coalesce(f.name, F.lit(""))))
    rejected = reduce(or_, [wrong for _, wrong, _ in faults])
    bad = [F.when(wrong, F.struct(F.lit(key).alias("key"), text.alias("value"))) for key, wrong, text in faults]
    named = F.when(rejected, F.map_from_entries(F.array_compact(F.array(*bad))))  # made for the few records it is shown of
    placed = raw.select(*fields, named.alias("_bad"), rejected.alias("_rejected"), *[c.alias(n) for n, c in _file_place().items()])
    # One task reads a whole split, so its rows of a date stand one after the other, those left out behind the others.
    placed = placed.sortWithinPartitions("SettlementDate", "_rejected", "_seq").withColumn("_pos", F.monotonically_increasing_id())
    order = ["_file", "_block", "_pos"]
    stored = scratch.store(placed.drop("_seq"), "instructions")
    left_out = stored.where("_rejected").select(*names, F.col("_file").alias("file"), F.col("_bad").alias("malformed"))
    if rejects:
        left_out.write.mode("overwrite").parquet(rejects)
    elif first := left_out.select("file", "malformed").head(1):
        raise ValueError(f"malformed fields in {first[0].file}: {first[0].malformed} (and perhaps more)")
    good = stored.where("NOT _rejected").drop("_bad", "_rejected")  # rejected ones take no numbers of others
    return number_in_place(good, "SettlementDate", ["_file", "_block"], "_pos", "row_id", scratch).drop(*order)


def _field_count(record: Column) -> Column:
    """Fields of a record, whose quoted ones may hold commas."""
    plain = F.regexp_replace(record, r'(^|,)"(?:[^"]|"")*"', "$1")
    return F.size(F.split(plain, ",", -1))


def _file_place() -> dict[str, Column]:
    """Where a record stands: file, split, and a sequence that rises within the split."""
    return {
        "_file": F.col("_metadata.file_path"),
        "_block": F.col("_metadata.file_block_start"),
        "_seq": F.monotonically_increasing_id(),
    }


def _body_lines(spark: SparkSession, paths: str | list[str], scratch: Scratch, name: str) -> DataFrame:
    """Lines of dated feeds without the first and last one of each; the date comes from the path.

    Only two lines per feed are looked for, as aggregates over places; nothing is sorted.
    """
    lines = scratch.store(spark.read.text(paths).select("value", *[
        c.alias(n) for n, c in _file_place().items()
    ]), name)
    day = F.regexp_extract("_file", r"_(\d{8})\.txt", 1).cast("int")
    lines = lines.withColumn("SettlementDate", day)
    place = F.struct("_file", "_block", "_seq")
    ends = lines.groupBy("SettlementDate").agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
    return (
        lines.join(F.broadcast(ends), "SettlementDate")  # one row per calendar day
        .where((place != F.col("_first")) & (place != F.col("_last")))
        .select("value", "SettlementDate")
    )


def _fields(n: int) -> list[Column]:
    parts = F.split("value", r"\|", -1)
    return [F.get(parts, F.lit(i)) for i in range(n)]


def rate_file(folder: str, day: int) -> str:
    return f"{folder}/EXCHANGE_RATE_{day}.txt"


def price_file(folder: str, day: int) -> str:
    return f"{folder}/LAST_DONE_PRICE_{day}.txt"


def read_rates(spark: SparkSession, paths: str | list[str], scratch: Scratch) -> DataFrame:
    """Second and third pipe field of dated rate files; the file's own date field is not used."""
    _, currency, rate = _fields(3)
    return _body_lines(spark, paths, scratch, "rate-lines").select(
        "SettlementDate", F.trim(currency).alias("Currency"), rate.try_cast("double").alias("Rate")
    )


def read_prices(spark: SparkSession, paths: str | list[str], scratch: Scratch) -> DataFrame:
    """Six pipe fields of dated price files; a non-numeric price or missing field is null."""
    _, code, text, price, currency, isin = _fields(6)
    return _body_lines(spark, paths, scratch, "price-lines").select(
        "SettlementDate",
        code.alias("Code"),
        text.alias("SecurityDescription"),
        price.try_cast("double").alias("Price"),
        currency.alias("Currency"),
        isin.alias("ISIN"),
    )


def with_default_rate(rates: DataFrame) -> DataFrame:
    """Append the fixed THB rate on dates that lack one.

    Whether a date has the currency is a conditional maximum per date, so no self-join is needed.
    """
    missing = (
        rates.groupBy("SettlementDate")
        .agg(F.max((F.col("Currency") == S.DEFAULT_CURRENCY).cast("int")).alias("has"))
        .where(F.coalesce(F.col("has"), F.lit(0)) == 0)
        .select("SettlementDate", F.lit(S.DEFAULT_CURRENCY).alias("Currency"),
                F.lit(S.DEFAULT_RATE).alias("Rate"))
    )
    return rates.select("SettlementDate", "Currency", "Rate").unionByName(missing)


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("UpdateTime", load_stamp())


def require_rows(df: DataFrame, message: str) -> DataFrame:
    if df.isEmpty():
        raise ValueError(message)
    return df

"""Preparation, values and fees on hand-made rows, with every boundary of the schedules."""

import pytest
from pyspark.sql import functions as F

from tradeweave.functions.scalar import days_before, from_micros, micros, transfer_fee
from tradeweave.operators.enrich import attach, enrich
from tradeweave.operators.fees import new_fee, with_fees, with_values
from tradeweave.operators.measures import measure
from tradeweave.operators.prepare import (
    final_labels, keep_latest, latest_business_date, prepare, quantity_crosstab,
)


def test_prepare_precedence(spark):
    rows = [
        ("FDVP", "NORM", "b", "A"), ("FDVP", "SBLT", "B", "A"), ("DVPT", "SBLT", "S", ""),
        ("DVPT", "NORM", "s", ""), ("DCSS", "SBLT", "S", "A"), ("OFOP", None, "S", None),
    ]
    df = spark.createDataFrame(
        [(i, 20200101, *r, "C", 1.0) for i, r in enumerate(rows)],
        "row_id bigint, SettlementDate int, TransactionType string, TransferType string, "
        "BuySellIndicator string, CDPSafeKeepingAccount string, SGXSecurityCode string, Quantity double")
    got = [tuple(r) for r in prepare(df).orderBy("row_id").select(
        "subsequent", "Code_CDP", "SubsequentBuySell", "flag", "comments").collect()]
    assert got == [
        ("1", "C.A", "1.B", "0", "null"),
        ("1", "C.A", "1.B", "SBLT", "null"),
        ("0", "C.", "0.S", "SBLT", "null"),
        ("0", "C.", "0.S", "1", "null"),
        ("DCSS", None, None, "1", "null"),
        ("1", "C", "1.S", "0", "null"),
    ]
    labelled = [tuple(r) for r in final_labels(prepare(df)).orderBy("row_id").select(
        "flag", "SubsequentBuySell").collect()]
    assert labelled == [
        ("Off-Exchange", "Buy in Subseqent SI"), ("SBLT", "Buy in Subseqent SI"),
        ("SBLT", "Sell in First SI"), ("On-Exchange", "Sell in First SI"), ("On-Exchange", None),
        ("Off-Exchange", "Sell in Subseqent SI"),
    ]


def test_crosstab_fills_missing_sides(spark):
    df = spark.createDataFrame(
        [(1, 20200101, "FDVP", "NORM", "B", "A", "C", 4.0), (2, 20200101, "FDVP", "NORM", "B", "", "C", 9.0)],
        "row_id bigint, SettlementDate int, TransactionType string, TransferType string, "
        "BuySellIndicator string, CDPSafeKeepingAccount string, SGXSecurityCode string, Quantity double")
    (row,) = quantity_crosstab(prepare(df)).collect()
    assert tuple(row) == (20200101, "C.A", 0.0, 0.0, 4.0, 0.0)


FEE_COLUMNS = ("row_id int, TransactionType string, flag string, BuySellIndicator string, Sender int, "
               "CDPSafeKeepingAccount string, Quantity double, SettlementValue_SGD double")
FEES = [
    # type, flag, side, sender, account, quantity, value -> new, old
    (("CDIS", "1", "B", 561, "A", 1.0, 1.0), 0.5, 0.5),
    (("CDIS", "1", "B", 562, "A", 1.0, 1.0), 0.0, 0.0),
    (("FOPT", "1", "B", 1, "A", 1.0, 1.0), 0.5, 0.5),
    (("FOPT", "1", "B", 1, "", 1.0, 1.0), 0.0, 0.0),
    (("DVPT", "SBLT", "B", 1, "A", 1.0, 1.0), 3.5, 3.5),
    (("DVPT", "1", "B", 1, "", 1.0, 1.0), 2.5, 2.5),
    (("FDVP", "1", "B", 1, "A", 1.0, None), 33.0, 33.0),
    (("FDVP", "0", "B", 1, "A", 1.0, 500000.0), 78.0, 33.0),
    (("FDVP", "0", "B", 1, "A", 1.0, 1000000.0), 153.0, 33.0),
    (("FDVP", "0", "B", 1, "A", 1.0, None), None, 33.0),
    (("FDVP", "SBLT", "B", 1, "A", 1.0, 1e9), 0.0, 33.0),
    (("OFOP", "0", "S", 1, "A", 1001.0, 500000.0), 75.0, 20.0),
    (("OFOP", "0", "B", 1, "A", 1001.0, 1000000.0), 150.0, 0.0),
    (("OFOP", "0", "B", 1, "A", 1001.0, None), None, 0.0),
    (("OFOP", "1", "S", 1, "A", 1000.0, None), 10.0, 10.0),
    (("OFOP", "1", "S", 1, "A", 0.0, None), 0.0, 0.0),
    (("OFOP", "SBLT", "S", 1, "A", 10001.0, 1.0), 100.0, 100.0),
    (("OFOP", "1", "B", 1, "A", 10001.0, 1.0), 0.0, 0.0),
    (("DCSS", "1", "B", 1, "A", 1.0, None), 2.0, 2.0),
    (("XXXX", "1", "B", 1, "A", 1.0, None), 0.0, 0.0),
]


def test_fee_schedules(spark):
    df = spark.createDataFrame([(i, *r) for i, (r, _, _) in enumerate(FEES)], FEE_COLUMNS)
    got = [tuple(r) for r in with_fees(df).orderBy("row_id").select("NewFee", "OldFee", "FeeGain").collect()]
    want = [(n, o, None if n is None else n - o) for _, n, o in FEES]
    assert got == want


def test_values_use_price_only_for_free_transfers(spark):
    df = spark.createDataFrame(
        [(1, "OFOP", 5.0, 2.0, 100.0, 3.0), (2, "OFOP", 5.0, None, 100.0, 3.0), (3, "FDVP", 5.0, 2.0, 100.0, 3.0),
         (4, "FDVP", 5.0, 2.0, 100.0, None)],
        "id int, TransactionType string, Quantity double, Price double, SettlementAmt double, Rate double")
    got = [tuple(r)[-2:] for r in with_values(df).orderBy("id").collect()]
    assert got == [(10.0, 30.0), (None, None), (100.0, 300.0), (100.0, None)]


def test_scalars(spark):
    row = spark.range(1).select(
        transfer_fee(F.lit(999.0)), transfer_fee(F.lit(1000.0)), transfer_fee(F.lit(None).cast("double")),
        from_micros(micros(F.lit(-1.25)).cast("decimal(38,0)")),
    ).first()
    assert tuple(row) == (10.0, 10.0, None, -1.25)
    assert days_before(20200301, 1) == 20200229


def test_latest_business_date_is_before_today(spark):
    df = spark.createDataFrame([(20200101,), (20200102,), (20200102,), (20200103,)], "SettlementDate int")
    assert latest_business_date(df, 20200103).first()[0] == 20200102
    assert keep_latest(df, 20200103).count() == 2
    assert keep_latest(df, 20200101).count() == 0


def facts(spark):
    rows = [(1, 20200101, "SGD", "I1", 1, "A"), (2, 20200101, "USD", "I2", 2, ""), (3, 20200101, "EUR", "I1", 9, "B"),
            (4, 20200102, "USD", "I1", 1, "A")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows],
                               "row_id bigint, SettlementDate int, SettlementCcy string, ISIN string, Sender int, "
                               "CDPSafeKeepingAccount string, Quantity double")
    rates = spark.createDataFrame([(20200101, "USD", 1.3), (20200101, "SGD", 7.0)],
                                  "SettlementDate int, Currency string, Rate double")
    prices = spark.createDataFrame([(20200101, "I1", 2.0)], "SettlementDate int, ISIN string, Price double")
    agents = spark.createDataFrame([(1, "One"), (2, "Two")], "Sender int, DaName string")
    accounts = spark.createDataFrame([("A", "Ann", "Here")],
                                     "CDPSafeKeepingAccount string, CDPAccountName string, Location string")
    return df, rates, prices, agents, accounts


def enriched(df):
    return [tuple(r) for r in df.orderBy("row_id").select(
        "Rate", "Price", "DaName", "CDPAccountName", "Location").collect()]


WANT = [(1.0, 2.0, "One", "Ann", "Here"), (1.3, None, "Two", None, None), (None, 2.0, None, None, None),
        (None, None, "One", "Ann", "Here")]


def test_enrich_left_joins_per_date(spark):
    assert enriched(enrich(*facts(spark))) == WANT


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_enrich_with_large_dimensions(spark, adaptive, monkeypatch):
    import tradeweave.operators.enrich as module

    plain = module.attach
    monkeypatch.setattr(module, "attach", lambda *a, **k: plain(*a, **{**k, "broadcast_rows": 0}))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", adaptive)
    try:
        assert enriched(enrich(*facts(spark))) == WANT
    finally:
        spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_duplicate_dimension_keys(spark):
    df, rates, *_ = facts(spark)
    df = df.withColumnRenamed("SettlementCcy", "Currency")
    twice = rates.unionByName(rates)
    with pytest.raises(ValueError):
        attach(df, twice, ["SettlementDate", "Currency"], "rates")
    assert attach(df, twice, ["SettlementDate", "Currency"], "rates", strict=False).count() == 6


def test_measure_of_nothing(spark):
    df = spark.createDataFrame([], "SettlementValue_SGD double, Quantity double, NewFee double, FeeGain double")
    assert tuple(measure(df).first()) == (0, None, None, None, None)


def test_new_fee_stays_in_codegen(spark):
    df = spark.createDataFrame([], FEE_COLUMNS).withColumn("NewFee", new_fee())
    assert "Python" not in df._jdf.queryExecution().toString()


def amounts(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "v double")


def test_sums_of_very_large_amounts(spark):
    total = lambda *v: amounts(spark, *v).agg(from_micros(F.sum(micros(F.col("v"))))).first()[0]
    assert total(1e13, 5e14) == 5.1e14 and total(1e18, 1e18, -1e18, 0.25) == pytest.approx(1e18)
    assert total(9007199254.740993, -9007199254.740993) == 0.0
    for bad in (float("nan"), float("inf"), 1e36):
        with pytest.raises(Exception, match="out of range"):
            total(bad)

"""Hot keys are split across tasks, and files are read no wider than needed."""

import pytest
from pyspark.sql import functions as F

from tradeweave.operators.enrich import attach
from tradeweave.operators.linking import base_cells, open_rows, tag_by_reference
from tradeweave.operators.prepare import prepare, settled
from tradeweave.plans.summaries import cube, ranked
from tradeweave.plans.workbench import Workbench
from tradeweave.session import Scratch
from conftest import SF

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def hot(spark):
    """Rows of which a third share one reference, under settings that scale skew down to the test."""
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    ref = F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit("R"), F.col("id")))
    rows = spark.range(120000).select(
        F.lit(1).alias("SettlementDate"), F.col("id").alias("row_id"), F.lit("X").alias("Code_CDP"),
        F.lit("B").alias("side"), (F.col("id") % 1000).cast("double").alias("Quantity"),
        ref.alias("PSMSMatchedReference"))
    yield Scratch(spark, "skew").store(rows.repartition(8), "rows")
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def executed(df):
    df._jdf.collectToPython()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_reference_is_split(hot):
    tagged = tag_by_reference(hot, hot.where("row_id % 7 = 0"), "x")
    assert "skew=true" in executed(tagged)
    counts = tagged.groupBy("comments").count().collect()
    by_hand = sum(1 for i in range(120000) if i % 3 == 0 or i % 7 == 0)
    assert {r["comments"]: r["count"] for r in counts} == {"x": by_hand, None: 120000 - by_hand}


def test_hot_dimension_key_is_split(spark, hot):
    dim = hot.select("SettlementDate", "PSMSMatchedReference").distinct().withColumn("v", F.lit(1))
    dim = Scratch(spark, "skew").store(dim, "dim")
    joined = attach(hot, dim, ["SettlementDate", "PSMSMatchedReference"], "dim", broadcast_rows=10)
    assert "skew=true" in executed(joined)
    assert joined.where("v = 1").count() == 120000


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_linking_scans_are_narrow(spark):
    prepared = prepare(settled(Workbench.of(spark, SF).loaded().facts()))
    for df in (base_cells(prepared), open_rows(prepared)):
        text = plan(df)
        assert "SecurityDescription" not in text and "ISIN" not in text
        assert "EqualTo(Status,SETTLED)" in text


def test_top_lists_are_cut_in_each_task(spark):
    detail = Workbench.of(spark, SF).detail()
    text = plan(ranked(cube(detail, [], False, ["SecurityDescription"]), [],
                       ["SecurityDescription"]))
    assert "WindowGroupLimit" in text and "Partial" in text
    assert "CDPAccountName" not in text

"""Files in, tables out: feeds, load-once, replace, retention, exports, the daily job end to end."""

import os

import pytest
from pyspark.sql import functions as F

from tradeweave import commits
from tradeweave import schemas as S
from tradeweave.__main__ import main
from tradeweave.operators.enrich import enrich
from tradeweave.operators.numbering import number_rows
from tradeweave.plans.blocks import TOPS, cube
from tradeweave.plans.detailed import daily_detailed_report
from tradeweave.plans.load import cleanup, load_feeds
from tradeweave.plans.summaries import (
    daily_summary, monthly_summary, summary, weekly_summary, weekly_summary_report,
)
from tradeweave.session import Scratch, shared_root
from tradeweave.sinks import tables
from tradeweave.sinks.tables import append_new_dates, prune, replace_dates, stored_dates
from tradeweave.sources import files
from tradeweave.sources.tables import ACCOUNTS, AGENTS, BLOCKS, DETAIL, FACTS, PRICES, RATES, Warehouse


def instruction(**kw):
    base = {c: "" for c in S.INSTRUCTION_COLUMNS}
    base.update(BuySellIndicator="B", TransactionType="FDVP", Sender="561", SettlementDate="20200102",
                SGXSecurityCode="X", ISIN="I1", SecurityDescription="Sec", Quantity="10",
                CDPSafeKeepingAccount="A1", SettlementCcy="USD", SettlementAmt="100.5", Status="SETTLED",
                TransferType="NORM", PSMSMatchedReference="R1", TradeRef="t")
    base.update(kw)
    return [base[c] for c in S.INSTRUCTION_COLUMNS]


def write(path, lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


@pytest.fixture
def feeds(tmp_path):
    rows = [
        instruction(TransactionType="DVPT", BuySellIndicator="s", Quantity="50", TradeRef="1"),
        instruction(Quantity="20", TradeRef="2"),
        instruction(Quantity="25", TradeRef="3", Status="PENDING"),
        instruction(TransactionType="OFOP", BuySellIndicator="S", Quantity="900", CDPSafeKeepingAccount="",
                    PSMSMatchedReference="R9", TradeRef="4"),
        instruction(TransactionType="DCSS", Quantity="5", SettlementCcy="THB", TradeRef="5"),
        instruction(SettlementDate="20200101", TradeRef="6"),
        instruction(SettlementDate="20200103", TradeRef="7"),
    ]
    root = str(tmp_path)
    write(f"{root}/in/merged.txt", [",".join([*r, "x"]) for r in rows])
    write(f"{root}/fx/EXCHANGE_RATE_20200102.txt",
          ["HEAD|", "20191231|USD|1.25|more|x", "20191231|HKD|bad|more", "TRAIL|2"])
    write(f"{root}/px/LAST_DONE_PRICE_20200102.txt",
          ["HEAD", "d|C1|Sec|2.5|SGD|I1", "d|C2|Other|n.a.|SGD|I2", "d|C3|Third|1|SGD|", "d|C4|Short|3", "TRAIL"])
    return root


@pytest.fixture
def house(spark, feeds):
    h = Warehouse(spark, f"{feeds}/house")
    spark.createDataFrame([(561, "Agent")], S.DEPOSITORY_AGENT).write.parquet(h.path(AGENTS))
    spark.createDataFrame([("A1", "Name", "Here")], S.SUB_ACCOUNT).write.parquet(h.path(ACCOUNTS))
    day = load_feeds(h, f"{feeds}/in/merged.txt", f"{feeds}/fx", f"{feeds}/px", today=20200103)
    assert day == 20200102
    return h


def test_instructions_keep_file_order_and_ignore_the_extra_field(spark, tmp_path):
    wide = [instruction(TradeRef=str(i)) for i in range(50)]
    write(f"{tmp_path}/a/1.txt", [",".join([*r, "x"]) for r in wide[:30]])
    write(f"{tmp_path}/a/2.txt", [",".join(r) for r in wide[30:]])
    got = files.read_instructions(spark, f"{tmp_path}/a", Scratch(spark, "test"))
    assert got.columns == ["row_id", *S.INSTRUCTION_COLUMNS]
    rows = got.orderBy("row_id").select("row_id", "TradeRef", "Receiver", "DealPrice").collect()
    assert [tuple(r) for r in rows] == [(i + 1, str(i), "", None) for i in range(50)]


def test_rows_are_numbered_per_day_across_many_tasks(spark):
    df = spark.range(1000).select(
        (F.lit(1) + (F.col("id") % 3 == 0).cast("int")).alias("d"), F.col("id"), F.lit("x").alias("k"))
    got = number_rows(df.repartition(5), "d", [-F.col("id")], "n", Scratch(spark, "test"))
    for d in (1, 2):
        rows = [tuple(r) for r in got.where(f"d = {d}").orderBy("n").select("n", "id").collect()]
        ids = sorted((i for i in range(1000) if (2 if i % 3 == 0 else 1) == d), reverse=True)
        assert rows == list(enumerate(ids, 1))


def test_rates_and_prices(spark, feeds):
    s = Scratch(spark, "test")
    fx = files.with_default_rate(files.read_rates(spark, files.rate_file(f"{feeds}/fx", 20200102), s))
    assert sorted(map(tuple, fx.collect()), key=str) == [
        (20200102, "HKD", None), (20200102, "THB", S.DEFAULT_RATE), (20200102, "USD", 1.25)]
    quoted = spark.createDataFrame([(1, "THB", 0.5)], "SettlementDate int, Currency string, Rate double")
    assert [tuple(r) for r in files.with_default_rate(quoted).collect()] == [(1, "THB", 0.5)]
    px = files.read_prices(spark, files.price_file(f"{feeds}/px", 20200102), s).orderBy("Code").collect()
    assert [(r.Code, r.Price, r.ISIN) for r in px] == [
        ("C1", 2.5, "I1"), ("C2", None, "I2"), ("C3", 1.0, ""), ("C4", 3.0, None)]


def test_load_keeps_the_latest_settled_day_once(spark, feeds, house):
    assert sorted(r.TradeRef for r in house.facts().collect()) == ["1", "2", "4", "5"]
    load_feeds(house, f"{feeds}/in/merged.txt", f"{feeds}/fx", f"{feeds}/px", today=20200103)
    assert house.facts().count() == 4
    assert house.read(RATES).count() == 3 and house.read(PRICES).count() == 4
    assert "UpdateTime" in house.read(RATES).columns
    plan = house.facts(20200102)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(SettlementDate" in plan


def test_daily_job_end_to_end(spark, feeds, house):
    out = f"{feeds}/out"
    daily_detailed_report(house, 20200102, out)
    rows = {r.TradeRef: r for r in house.detail().collect()}
    assert rows["2"].flag == "On-Exchange" and rows["2"].comments == "Total amount linking"
    assert rows["4"].flag == "Off-Exchange" and rows["4"].comments == "NULL"
    assert (rows["4"].SettlementValue_BaseCurrency, rows["4"].NewFee, rows["4"].OldFee) == (2250.0, 75.0, 10.0)
    assert rows["5"].subsequent == "DCSS" and rows["5"].Rate == S.DEFAULT_RATE
    full = spark.read.option("header", True).csv(f"{out}/all/Output_SD20200102")
    off = spark.read.option("header", True).csv(f"{out}/off_exchange/SD20200102")
    assert full.count() == 4 and off.count() == 1
    assert not set(S.OFF_EXCHANGE_DROPS) & set(off.columns)
    daily_detailed_report(house, 20200102)
    assert house.detail().count() == 4
    daily_detailed_report(house, 20200102, out, manual=True)
    assert house.detail().count() == 4
    assert os.path.isdir(f"{out}/Manual_Run_Output_SD20200102") and os.path.isdir(f"{out}/Manual_Run_SD20200102")

    long = daily_summary(house, 20200102)
    total = long.where("section = 'totals' AND ord = 1").first()
    assert total.instructions == 4 and total.SettlementDate == 20200102
    weekly = weekly_summary_report(house, 20200101, 20200107, out, manual=True)
    assert weekly == f"{out}/Manual_Run_Weekly_Summary_Report_20200101_to_20200107"
    assert len([d for d in os.listdir(weekly) if d.startswith("sheet=")]) == 3
    monthly = monthly_summary(house, 20200101, 20200131)
    assert monthly.select("sheet").distinct().count() == 6
    empty = weekly_summary(house, 20190101, 20190107).where("ord = 1").collect()
    assert {r.instructions for r in empty} == {0} and {r.revenue for r in empty} == {None}
    for report in (weekly_summary, monthly_summary):
        with pytest.raises(ValueError):
            report(house, 20200102, 20200101)


def test_missing_inputs_fail_fast(spark, house):
    with pytest.raises(ValueError, match=FACTS):
        daily_detailed_report(house, 20211231)


def days(spark, *pairs):
    return spark.createDataFrame(pairs, "SettlementDate int, v int")


def test_append_replace_and_prune(spark, tmp_path):
    path = f"{tmp_path}/t"
    append_new_dates(days(spark, (20200101, 1), (20200102, 2)), path)
    append_new_dates(days(spark, (20200102, 9), (20200103, 3)), path, clustered=False)
    read = lambda: sorted((r.SettlementDate, r.v) for r in commits.read(spark, path).collect())
    assert read() == [(20200101, 1), (20200102, 2), (20200103, 3)]
    replace_dates(days(spark, (20200102, 7), (20200102, 8)), path)
    assert read() == [(20200101, 1), (20200102, 7), (20200102, 8), (20200103, 3)]
    assert prune(spark, path, 20200104, 2) == [20200101]
    assert stored_dates(spark, path) == {20200102, 20200103}
    assert prune(spark, f"{tmp_path}/none", 20200104) == []


def test_cleanup_leaves_rates_and_prices(spark, tmp_path):
    h = Warehouse(spark, str(tmp_path))
    for t in (FACTS, DETAIL, RATES, PRICES):
        append_new_dates(days(spark, (20200101, 1), (20200401, 1)), h.path(t))
    assert cleanup(h, 20200402) == {FACTS: [20200101], DETAIL: [20200101]}
    assert stored_dates(spark, h.path(RATES)) == stored_dates(spark, h.path(PRICES)) == {20200101, 20200401}


def test_command_line_cleanup(spark, tmp_path, capsys):
    h = Warehouse(spark, str(tmp_path))
    append_new_dates(days(spark, (20200101, 1), (20200401, 1)), h.path(FACTS))
    main(["cleanup", "--root", str(tmp_path), "--today", "20200402"])
    assert "20200101" in capsys.readouterr().out
    assert stored_dates(spark, h.path(FACTS)) == {20200401}


def test_reports_add_up_stored_blocks(spark, feeds, tmp_path):
    """Blocks serve the reports without the detail; a replaced, pruned or damaged date is seen by the next report."""
    h = Warehouse(spark, f"{tmp_path}/blocks")
    load_feeds(h, f"{feeds}/in/merged.txt", f"{feeds}/fx", f"{feeds}/px", today=20200103)
    spark.createDataFrame([(561, "DA one")], "Sender int, DaName string").write.parquet(h.path(AGENTS))
    spark.createDataFrame([("A1", "n", "SG")], "CDPSafeKeepingAccount string, CDPAccountName string, Location string").write.parquet(h.path(ACCOUNTS))
    daily_detailed_report(h, 20200102)
    assert stored_dates(spark, h.path(BLOCKS)) == {20200102}
    kept = h.detail().drop("SettlementDate")
    more = kept.withColumn("SettlementDate", F.explode(F.array(*[F.lit(20200103 + i) for i in range(3)])))
    append_new_dates(more, h.path(DETAIL))

    def shown(report, *days):
        df = report(h, *days)
        assert "output_daily" not in df._jdf.queryExecution().optimizedPlan().toString() and DETAIL not in str(df.inputFiles())
        return sorted(map(str, df.collect()))

    def plain(monthly, *days):
        return sorted(map(str, summary(cube(h.detail(*days), ["SettlementDate"], True, TOPS), monthly=monthly).collect()))

    assert shown(weekly_summary, 20200101, 20200104) == plain(False, 20200101, 20200104)
    assert stored_dates(spark, h.path(BLOCKS)) == {20200102, 20200103, 20200104}  # only what was asked for
    before = shown(monthly_summary, 20200101, 20200131)
    assert before == plain(True, 20200101, 20200131)
    changed = h.detail(20200103, 20200103).withColumn("NewFee", F.col("NewFee") + 1)
    replace_dates(spark.createDataFrame(changed.collect(), changed.schema), h.path(DETAIL))
    after = shown(monthly_summary, 20200101, 20200131)
    assert after == plain(True, 20200101, 20200131) != before
    folder = f"{h.path(BLOCKS)}/_attempt={commits.current(spark, h.path(BLOCKS))[20200104]}/SettlementDate=20200104"
    for f in os.listdir(folder):
        os.remove(f"{folder}/{f}")
    assert shown(monthly_summary, 20200101, 20200131) == after
    prune(spark, h.path(DETAIL), 20200105, 1)
    assert shown(weekly_summary, 20200101, 20200131) == plain(False, 20200101, 20200131)
    cleanup(h, 20200105, 1)
    assert min(stored_dates(spark, h.path(BLOCKS))) == 20200104


def test_half_written_date_is_loaded_again(spark, tmp_path):
    path = f"{tmp_path}/t"
    append_new_dates(days(spark, (20200101, 1)), path)
    days(spark, (20200102, 5)).write.partitionBy("SettlementDate").parquet(f"{path}/_attempt=alost")  # an interrupted run's leftovers
    append_new_dates(days(spark, (20200101, 9), (20200102, 2), (20200102, 3)), path)
    assert sorted(map(tuple, commits.read(spark, path).select("SettlementDate", "v").collect())) == [(20200101, 1), (20200102, 2), (20200102, 3)]


def test_replaced_dates_get_few_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    many = spark.range(4000).select((F.lit(20200101) + F.col("id") % 5).cast("int").alias("SettlementDate"), F.col("id").alias("v"))
    replace_dates(many.repartition(20), path)
    files = commits.read(spark, path).inputFiles()
    assert len(files) == len({os.path.dirname(f) for f in files}) == 5


def test_a_job_that_ends_between_any_two_steps_leaves_every_date_whole(spark, tmp_path, monkeypatch):
    """Each step of a replacement of two dates and of a retention run is made to fail in turn."""
    path, steps = f"{tmp_path}/t", ["write_text", "move_path", "written_dates", "remove_path"]
    read = lambda: sorted((r.SettlementDate, r.v) for r in commits.read(spark, path).collect())
    old = [(20200101, 1), (20200102, 2), (20200103, 3)]
    append_new_dates(days(spark, *old), path)
    new = [(20200101, 8), (20200102, 9), (20200103, 3)]

    def stopped(*_):
        raise RuntimeError("executor and driver lost")

    for step in steps[:3]:
        with monkeypatch.context() as m:
            m.setattr(commits, step, stopped)
            with pytest.raises(RuntimeError):
                replace_dates(days(spark, *new[:2]), path)
        assert read() == old
    with monkeypatch.context() as m:
        m.setattr(tables, "mark_done", stopped)
        with pytest.raises(RuntimeError):
            replace_dates(days(spark, *new[:2]), path)
    assert read() == new
    assert sum(d.startswith("_attempt=") for d in os.listdir(path)) == 5  # first, three without commit, the counted one
    assert commits.sweep(spark, path) == []  # too young
    assert len(commits.sweep(spark, path, hours=0)) == 5 and read() == new  # three attempts, two replaced dates
    assert len(os.listdir(f"{path}/_commits")) == 2  # one commit and its checksum
    with monkeypatch.context() as m:
        m.setattr(tables, "remove_path", stopped)
        with pytest.raises(RuntimeError):
            prune(spark, path, 20200104, 2)
    assert read() == new[1:]
    commits.sweep(spark, path, hours=0)
    assert read() == new[1:] and stored_dates(spark, path) == {20200102, 20200103}


def test_a_commit_by_another_job_in_between_is_kept(spark, tmp_path, monkeypatch):
    path, move = f"{tmp_path}/t", commits.move_path
    append_new_dates(days(spark, (20200101, 1)), path)

    def second(sp, source, target):
        monkeypatch.setattr(commits, "move_path", move)
        append_new_dates(days(spark, (20200102, 2)), path)
        raise OSError("exists")

    monkeypatch.setattr(commits, "move_path", second)
    append_new_dates(days(spark, (20200103, 3)), path)
    assert sorted(r.v for r in commits.read(spark, path).collect()) == [1, 2, 3]


def test_rows_without_a_date_are_not_stored_in_part(spark, tmp_path):
    path = f"{tmp_path}/t"
    with pytest.raises(ValueError, match="without a"):
        append_new_dates(days(spark, (20200101, 1), (None, 2)), path)
    assert not commits.is_committed(spark, path)


def test_table_emptied_by_retention_keeps_its_columns(spark, tmp_path):
    path = f"{tmp_path}/t"
    append_new_dates(days(spark, (20200101, 1)), path)
    assert prune(spark, path, 20210101) == [20200101]
    df = commits.read(spark, path)
    assert df.columns == ["v", "SettlementDate"] and df.count() == 0


def test_malformed_fields_stop_or_are_kept_aside(spark, tmp_path):
    good = [instruction(TradeRef=str(i)) for i in range(3)]
    bad = [instruction(TradeRef="b1", Sender="A01"), instruction(TradeRef="b2", Quantity="1e4x"), instruction(TradeRef="b3", SettlementDate="2020-01-02"),
           instruction(TradeRef="b4", SettlementDate="", Quantity="?")]
    blank = [instruction(TradeRef="e", Quantity="", SettlementAmt="")]
    write(f"{tmp_path}/in.txt", [",".join(r) for r in [good[0], bad[0], bad[1], good[1], *blank, bad[2], bad[3], good[2]]])
    with pytest.raises(ValueError, match="malformed"):
        files.read_instructions(spark, f"{tmp_path}/in.txt", Scratch(spark, "test"))
    got = files.read_instructions(spark, f"{tmp_path}/in.txt", Scratch(spark, "test"), f"{tmp_path}/bad").orderBy("row_id").collect()
    assert [(r.row_id, r.TradeRef) for r in got] == [(1, "0"), (2, "1"), (3, "e"), (4, "2")] and got[2].Quantity is None
    left = {r.TradeRef: r.malformed for r in spark.read.parquet(f"{tmp_path}/bad").collect()}
    assert left == {"b1": {"Sender": "A01"}, "b2": {"Quantity": "1e4x"}, "b3": {"SettlementDate": "2020-01-02"}, "b4": {"SettlementDate": "", "Quantity": "?"}}


def test_records_with_another_number_of_fields(spark, tmp_path):
    """32 and 33 fields pass, also with quoted commas and quotes; others are rejected and take no number."""
    def of(n, ref, **fields):
        return ",".join((instruction(TradeRef=ref, **fields) + ["x"] * 9)[:n])

    quoted = {"SecurityDescription": '"a, b ""c"", d"', "ClientAccount": '", e"'}
    lines = [of(32, "0"), of(25, "b25"), of(33, "1"), of(31, "b31"), of(34, "b34"), of(32, "2", **quoted), of(33, "3", **quoted),
             of(35, "b35"), of(32, "b33", SecurityDescription="a, b, c")]
    write(f"{tmp_path}/in.txt", lines)
    with pytest.raises(ValueError, match="fields"):
        files.read_instructions(spark, f"{tmp_path}/in.txt", Scratch(spark, "test"))
    rows = files.read_instructions(spark, f"{tmp_path}/in.txt", Scratch(spark, "test"), f"{tmp_path}/bad")
    assert [(r.row_id, r.TradeRef) for r in rows.orderBy("row_id").collect()] == [(1, "0"), (2, "1"), (3, "2"), (4, "3")]
    assert rows.where("row_id = 3").first().SecurityDescription == 'a, b "c", d'
    left = {r.TradeRef: r.malformed["fields"] for r in spark.read.parquet(f"{tmp_path}/bad").collect()}
    assert left == {"b25": "25", "b31": "31", "b34": "34", "b35": "35", "b33": "34"}


def test_numbers_keep_file_order_without_a_range_sort(spark, tmp_path):
    """Several files, each cut into many splits, two dates in turn."""
    want = []
    for f in range(3):
        refs = [f"{f}-{i:04d}" for i in range(400)]
        write(f"{tmp_path}/in/{f}.txt", [",".join(instruction(TradeRef=r, SettlementDate=str(20200101 + int(r[-1]) % 2))) for r in refs])
        want += refs
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        rows = files.read_instructions(spark, f"{tmp_path}/in", Scratch(spark, "test"))
        got = rows.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert "rangepartitioning" not in rows._jdf.queryExecution().toString()
    for day in (20200101, 20200102):
        mine = sorted((r.row_id, r.TradeRef) for r in got if r.SettlementDate == day)
        assert [i for i, _ in mine] == list(range(1, 601))
        assert [t for _, t in mine] == [t for t in want if 20200101 + int(t[-1]) % 2 == day]


def test_price_lines_without_isin_do_not_stop_a_day(spark):
    facts = spark.createDataFrame([(1, 20200101, "I1", "SGD", 1.0, 5, "A"), (2, 20200101, "", "SGD", 1.0, 5, "A"), (3, 20200101, None, "SGD", 1.0, 5, "A")],
                                  "row_id long, SettlementDate int, ISIN string, SettlementCcy string, Quantity double, Sender int, CDPSafeKeepingAccount string")
    prices = spark.createDataFrame([(20200101, i, p) for i, p in (("I1", 2.0), ("", 3.0), ("", 4.0), (None, 5.0), (None, 6.0))], "SettlementDate int, ISIN string, Price double")
    rates = spark.createDataFrame([(20200101, "USD", 1.2)], "SettlementDate int, Currency string, Rate double")
    agents = spark.createDataFrame([(5, "n")], "Sender int, DaName string")
    accounts = spark.createDataFrame([("A", "n", "l")], "CDPSafeKeepingAccount string, CDPAccountName string, Location string")
    got = {r.row_id: r.Price for r in enrich(facts, rates, prices, agents, accounts).collect()}
    assert got == {1: 2.0, 2: None, 3: None}


def test_run_over_days_names_the_one_that_lacks_rates(spark, house):
    extra = house.read(FACTS).withColumn("SettlementDate", F.lit(20200103))
    append_new_dates(extra, house.path(FACTS))
    append_new_dates(house.read(PRICES).withColumn("SettlementDate", F.lit(20200103)), house.path(PRICES))
    with pytest.raises(ValueError, match=f"{RATES}.*20200103"):
        daily_detailed_report(house, [20200102, 20200103])


def test_scratch_needs_a_shared_folder_on_a_cluster():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(ValueError, match="share"):
        shared_root(Session)
    Session.conf = {"spark.checkpoint.dir": "hdfs://x/shared/"}
    assert shared_root(Session) == "hdfs://x/shared"

"""What is shuffled and written stays narrow, and rounds shrink with what is still to be done."""

import re

from tradeweave.llm.decontamination import count_words, words
from pyspark.sql import functions as F

from tradeweave.operators.components import component_labels, settle, settle_components, split_components
from tradeweave.operators.enrich import with_accounts
from tradeweave.operators.linking import supplied_cells, touched_groups
from tradeweave.operators.numbering import number_in_place
from tradeweave.plans.detailed import charged
from tradeweave.plans.blocks import report_blocks
from tradeweave.plans.summaries import cube, ranked  # noqa: F401 (as tests/test_skew.py takes them)
from tradeweave.plans.workbench import LINKS, Workbench
from tradeweave.session import Scratch, child_names
from tradeweave.sources.star_schema import Star
from tradeweave.schemas import INSTRUCTION_COLUMNS
from tradeweave.sources.files import read_instructions
from tradeweave.sources.tables import BLOCKS, TOP_BLOCKS
from conftest import SF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_numbered_before_their_texts_are_made(spark):
    scratch = Scratch(spark, "narrow")
    facts = Star(spark, SF).facts(scratch)
    stored = spark.read.parquet(scratch.at("numbered")).columns
    assert not {"SecurityDescription", "ISIN", "SGXSecurityCode", "PSMSMatchedReference"} & set(stored)
    assert {"SecurityDescription", "ISIN", "row_id"} <= set(facts.columns)


def test_prices_are_dealt_once_for_their_pairs_and_their_join(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        text = plan(Star(spark, SF).prices())
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert text.count("Exchange hashpartitioning(l_partkey") == 1


def test_links_alone_are_stored(spark):
    bench = Workbench.of(spark, SF)
    verdicts = bench.linked()
    assert spark.read.parquet(bench.house.path(LINKS)).columns == ["SettlementDate", "row_id", "comments"]
    assert verdicts.count() == bench.loaded().facts().where("Status = 'SETTLED'").count()
    assert verdicts.where("comments LIKE 'Total%' OR comments LIKE 'Individual%' OR comments LIKE 'Reference%'").count() > 0


def test_prices_need_no_facts(spark):
    bench = Workbench(spark, SF)
    bench.priced()
    assert not bench._done("Raw_PSMS") and bench.priced().read("Closing_price").count() > 0


def test_settled_references_leave_the_rounds(spark):
    # a chain of 16 groups, and 500 pairs of groups that are whole after one round
    pairs = [(i, 10_000 + i) for i in range(16)] + [(i + 1, 10_000 + i) for i in range(15)]
    for i in range(500):
        pairs += [(100_000 + 2 * i, 200_000 + i), (100_001 + 2 * i, 200_000 + i)]
    rows = spark.createDataFrame(pairs, "_g long, _h long")
    scratch = Scratch(spark, "rounds")
    labels, unfinished = component_labels(rows, scratch, 8)
    assert unfinished is None
    got = {r["_g"]: r["comp"] for r in labels.collect()}
    assert got == {**{i: 0 for i in range(16)}, **{100_000 + i: 100_000 + i - i % 2 for i in range(1000)}}
    sizes = [spark.read.parquet(scratch.at(n)).count() for n in ("pairs", "pairs1", "pairs2")]
    assert sizes[0] == sizes[1] == 1030 and sizes[2] <= 30


def test_a_round_limit_names_what_is_unfinished(spark):
    chain = [(i, 1000 + i) for i in range(400)] + [(i + 1, 1000 + i) for i in range(399)]
    rows = spark.createDataFrame([*chain, (5000, 7), (5001, 7)], "_g long, _h long")
    labels, unfinished = component_labels(rows, Scratch(spark, "rounds"), 1)
    assert unfinished.where("comp >= 5000").isEmpty() and not unfinished.isEmpty()
    assert {r["comp"] for r in labels.where("_g >= 5000").collect()} == {5000}


def test_touched_groups_where_links_are_many(spark):
    links = spark.createDataFrame([(1, "a"), (1, "a"), (1, None)], "SettlementDate int, Code_CDP string")
    cells = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "a", 3), (1, None, 4)], "SettlementDate int, Code_CDP string, n int")
    scratch = Scratch(spark, "touched")
    for few in (True, False):
        assert [r["n"] for r in touched_groups(links, scratch, "t", few)(cells).collect()] == [1]
    assert "t" in child_names(spark, scratch.path)


def test_words_are_cut_at_gaps(spark):
    texts = ["", None, " ", "a", " A-b ", "Ärger ÜBER ١٢ x9!", "--", "\x7fq\x00R", "漢字 mixed漢A"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", words().alias("w"), count_words().alias("n"))
    assert "regexp_extract" not in plan(rows)  # ten times the time
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    for r in rows.collect():
        want = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r["text"] or "").translate(lower))
        assert (r["w"], r["n"]) == (want, len(want))


def test_line_items_are_numbered_by_what_an_instruction_is_made_of(spark):
    scratch = Scratch(spark, "narrow")
    Star(spark, SF).facts(scratch)
    stored = set(spark.read.parquet(scratch.at("numbered")).columns)
    assert not {"l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"} & stored


def test_detail_makes_no_blocks_and_a_report_those_of_its_dates(spark):
    bench = Workbench(spark, SF)
    days = sorted(r[0] for r in bench.detail().select("SettlementDate").distinct().collect())
    assert not bench._done(BLOCKS)
    report_blocks(bench.house, days[1], days[3])
    assert sorted(r[0] for r in bench.house.read(BLOCKS).select("SettlementDate").distinct().collect()) == days[1:4]


def test_only_rare_accounts_move_their_rows(spark, monkeypatch):
    import tradeweave.operators.enrich as module

    keys = ["A"] * 50 + ["", None] * 20 + ["B", "C", "D"]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "row_id long, CDPSafeKeepingAccount string")
    names = spark.createDataFrame([(k, f"n{k}", f"l{k}") for k in ("A", "B", "C", "X")] + [(None, "?", "?")],
                                  "CDPSafeKeepingAccount string, CDPAccountName string, Location string")
    monkeypatch.setattr(module, "FREQUENT", 2)
    moved, plain = [], module.attach
    monkeypatch.setattr(module, "attach", lambda df, *a, **k: moved.append(df) or plain(df, *a, **k))
    got = {r.row_id: (r.CDPAccountName, r.Location) for r in with_accounts(rows, names, broadcast_rows=0).collect()}
    assert got == {i: (f"n{k}", f"l{k}") if k in ("A", "B", "C") else (None, None) for i, k in enumerate(keys)}
    assert sorted(r.CDPSafeKeepingAccount for r in moved[1].collect()) == ["B", "C", "D"]


def test_made_columns_are_not_moved(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    import tradeweave.operators.enrich as module
    bench, limit = Workbench.of(spark, SF), module.attach.__defaults__
    try:
        for k in old:
            spark.conf.set(k, "-1")
        module.attach.__defaults__ = (True, 0, *limit[2:])
        rows = charged(bench.loaded(), None, bench.links())
        tree = rows._jdf.queryExecution().sparkPlan().toString()
    finally:
        module.attach.__defaults__ = limit
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    joins = [i for i, line in enumerate(tree.splitlines()) if "SortMergeJoin [SettlementDate" in line and "ISIN" in line]
    below = "\n".join(tree.splitlines()[joins[0]:])
    assert "Code_CDP" not in below and "SubsequentBuySell" not in below and "CDPAccountName" in below
    facts = [c for c in bench.loaded().facts().columns if c not in rows.columns[:5]]
    assert rows.columns[:5] == ["CDPSafeKeepingAccount", "Sender", "SettlementDate", "ISIN", "Currency"] and rows.columns[5:-16] == facts


def test_classes_without_other_references_leave_the_rounds(spark):
    pairs = [(i, 10_000 + i) for i in range(16)] + [(i + 1, 10_000 + i) for i in range(15)]
    for i in range(500):
        pairs += [(100_000 + 2 * i, 200_000 + i), (100_001 + 2 * i, 200_000 + i)]
    scratch = Scratch(spark, "rounds")
    labels, _ = component_labels(spark.createDataFrame(pairs, "_g long, _h long"), scratch, 8)
    assert labels.count() == 1016
    assert spark.read.parquet(scratch.at("joined1")).count() == 1016 and spark.read.parquet(scratch.at("joined2")).count() <= 16


def test_components_need_what_is_supplied_alone(spark):
    links = spark.createDataFrame([(1, 1, "a", "B", 2.0), (1, 2, "a", "B", 2.0), (1, 3, None, "B", 2.0), (1, 4, "b", "S", None)],
                                  "SettlementDate int, row_id long, Code_CDP string, side string, Quantity double")
    cells = supplied_cells(links)
    assert [tuple(r) for r in cells.collect()] == [(1, "a", "S", 2.0, 2, 0)]
    rows = spark.createDataFrame([(1, 9, "a", "S", 2.0, "r"), (1, 10, "c", "S", 2.0, "r"), (1, 11, None, "7", 2.0, "r"), (1, 12, None, "8", 2.0, "q")],
                                 "SettlementDate int, row_id long, Code_CDP string, side string, Quantity double, PSMSMatchedReference string")
    for most, few in ((10, 10), (2, 10), (2, 0)):
        parts = split_components(rows, cells, Scratch(spark, "split"), most, 8, few)
        small, small_cells, large, large_cells = [p.count() for p in parts]
        assert (small, small_cells, large, large_cells) == ((3, 1, 0, 0) if most == 10 else (0, 0, 3, 1))
        assert parts[0].unionByName(parts[2]).agg(F.countDistinct("comp")).first()[0] == 1


def test_records_are_numbered_where_they_lie(spark, tmp_path):
    blank = dict.fromkeys(INSTRUCTION_COLUMNS, "")
    lines = [",".join({**blank, "SettlementDate": str(20200101 + i % 3) if i % 5 else "x", "TradeRef": str(i)}.values()) for i in range(60)]
    folder = tmp_path / "in"
    folder.mkdir()
    for n, part in enumerate((lines[:25], lines[25:26], lines[26:])):
        (folder / f"part-{n}.csv").write_text("\n".join(part) + "\n")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:
            spark.conf.set(k, "-1")
        rows = read_instructions(spark, str(folder), Scratch(spark, "feed"), f"{tmp_path}/bad")
        text = plan(rows)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "hashpartitioning" not in text and "Window" not in text
    good = [i for i in range(60) if i % 5]
    want = {i: [j for j in good if j % 3 == i % 3].index(i) + 1 for i in good}
    assert {int(r.TradeRef): r.row_id for r in rows.collect()} == want
    assert {tuple(r.malformed.items()) for r in spark.read.parquet(f"{tmp_path}/bad").collect()} == {(("SettlementDate", "x"),)}


def test_many_splits_are_numbered_by_a_join(spark):
    rows = spark.createDataFrame([(d, s, 100 * s + p) for d in (1, 2) for s in (0, 1, 2) for p in range(s + d)], "SettlementDate int, _block int, _pos long")
    for small in (0, 100):
        got = number_in_place(rows, "SettlementDate", ["_block"], "_pos", "n", Scratch(spark, "numbers"), small)
        assert {d: sorted((r._block, r._pos, r.n) for r in got.collect() if r.SettlementDate == d) for d in (1, 2)} == {
            1: [(0, 0, 1), (1, 100, 2), (1, 101, 3), (2, 200, 4), (2, 201, 5), (2, 202, 6)],
            2: [(0, 0, 1), (0, 1, 2), (1, 100, 3), (1, 101, 4), (1, 102, 5), (2, 200, 6), (2, 201, 7), (2, 202, 8), (2, 203, 9)]}


def test_components_go_on_across_batches(spark):
    """Many components to a batch, one over several batches, quantities within and beyond 64 bits of whole units."""
    labels = lambda n: (f"t{n}", f"i{n}", f"r{n}")
    pairs = [(c, n, 1e17 if c % 2 else 2.5) for c in range(40) for n in range(200 if c == 7 else 2)]
    schema = "comp long, SettlementDate int, row_id long, Code_CDP string, side string, Quantity double, PSMSMatchedReference string"
    rows = spark.createDataFrame([(c, 1, 1000 * c + n, f"g{c}", "B", q, f"r{c}-{n}") for c, n, q in pairs], schema)
    cells = spark.createDataFrame([(c, 1, f"g{c}", "B", 1e17 if c % 2 else 2.5, 1) for c in range(40)],
                                  "comp long, SettlementDate int, Code_CDP string, side string, Quantity double, have long")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "16")
    try:
        got = sorted(tuple(r) for r in settle_components(rows, cells, labels, 9).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    want = []
    for c in range(40):
        mine = [(n, q) for d, n, q in pairs if d == c]
        group, units = (1, f"g{c}"), 10**27 if c % 2 else 25 * 10**9
        linked = settle([(1000 * c + n, group, "B", units, (1, f"r{c}-{n}")) for n, _ in mine], [(group, "B", units, 1)], labels, 9)
        want += [(1, 1000 * c + mine[i][0], f"g{c}", "B", mine[i][1], f"r{c}-{mine[i][0]}", text, turn) for i, turn, text in linked]
    assert got == sorted(want) and len(want) > 40


def test_one_record_batch_in_makes_one_out():
    import pyarrow as pa
    from tradeweave.operators.components import _MOVED, _settled

    rows = [(c, 1, c, f"g{c}", "B", 1.0, f"r{c}", None, 10**10) for c in range(50)] + [(c, 1, None, f"g{c}", "B", 1.0, None, 1, 10**10) for c in range(50)]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.string(), pa.int64(), pa.decimal128(38, 0)]
    rows = sorted(rows, key=lambda r: r[0])
    batch = pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=_MOVED)
    out = [*_settled(lambda n: ("t", "i", "r"), 9)(iter([batch]))]
    assert sum(b.num_rows for b in out) == 50 and len(out) <= 2


def test_a_report_makes_the_blocks_it_adds_up(spark, monkeypatch):
    import tradeweave.plans.workbench as module
    from tradeweave.plans.summaries import monthly_summary, weekly_summary

    bench, plain = Workbench(spark, SF), module.append_new_dates
    bench.loaded()
    written = []
    monkeypatch.setattr(module, "append_new_dates", lambda df, *a, **k: written.append(plan(df)) or plain(df, *a, **k))
    bench.reported()  # in the order that the last join left
    assert not [line for line in written[0].splitlines() if "Sort [SettlementDate" in line and "CDPSafeKeepingAccount" in line]
    days = sorted(r[0] for r in bench.detail().select("SettlementDate").distinct().collect())
    weekly_summary(bench.reported(), days[0], days[1])
    assert bench._done(BLOCKS) and not bench._done(TOP_BLOCKS)
    assert {r.part for r in bench.house.read(BLOCKS).select("part").distinct().collect()} == {"class", "participant"}
    monthly_summary(bench.reported(), days[0], days[1])
    assert "participant" not in {r.part for r in bench.house.read(TOP_BLOCKS).select("part").distinct().collect()}


def test_participant_blocks_are_hashed(spark):
    detail = Workbench.of(spark, SF).detail()
    assert "SortAggregate" not in plan(cube(detail, ["SettlementDate"], True, []))
    accounts = cube(detail, ["SettlementDate"], False, ["CDPAccountName"]).where("part = 'CDPAccountName'")
    want = detail.groupBy("SettlementDate", "CDPAccountName", "subsequent", "flag").agg(F.min("DaName").alias("agent"))
    assert sorted(map(str, accounts.select(want.columns).collect())) == sorted(map(str, want.collect()))


def test_the_feed_is_written_from_stored_stretches(spark, tmp_path):
    from types import SimpleNamespace

    from __spark_entry__ import _write_csv_feed
    from tradeweave.sinks.tables import append_new_dates
    from tradeweave import commits

    def fed(name, parts):
        """(references in feed order by date, whether the files are named by stretch)"""
        path = f"{tmp_path}/{name}"
        tasks = spark.sparkContext.parallelize(parts, len(parts))  # a task, and so a file a date, for each part
        facts = tasks.flatMap(lambda part: [(d, n, f"t{d}-{n}") for d, n in part])
        whole = spark.createDataFrame(facts, "SettlementDate int, row_id long, TradeRef string")
        append_new_dates(whole, path)
        bench = SimpleNamespace(loaded=lambda: SimpleNamespace(facts=lambda: commits.read(spark, path)), scratch=lambda label: Scratch(spark, label))
        _write_csv_feed(bench, f"{path}-csv")
        got = {r.TradeRef: r.row_id for r in read_instructions(spark, f"{path}-csv", Scratch(spark, "back")).collect()}
        assert len(bench.loaded().facts().inputFiles()) == sum(len({d for d, _ in p}) for p in parts)
        return got, any(n.startswith("feed=") for n in child_names(spark, f"{path}-csv"))

    parts = [[(20200101, n) for n in range(1, 6)], [(20200101, n) for n in range(6, 13)] + [(20200102, n) for n in range(1, 4)], [(20200102, n) for n in range(4, 12)]]
    want = {f"t{d}-{n}": n for part in parts for d, n in part}
    assert fed("apart", [parts[2], parts[0], parts[1]]) == (want, True)
    mixed = [[(20200101, n) for n in (1, 3, 5)], [(20200101, n) for n in (2, 4, 6)]]
    assert fed("mixed", mixed) == ({f"t20200101-{n}": n for n in range(1, 7)}, False)

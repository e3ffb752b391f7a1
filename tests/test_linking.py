import random

import pytest
from conftest import SF
from model import link_all, walk
from pyspark.sql import functions as F

from tradeweave import schemas as S
from tradeweave.operators import matching as M
from tradeweave.operators.linking import apply_links, link
from tradeweave.operators.prepare import prepare, settled
from tradeweave.plans.workbench import Workbench
from tradeweave.session import Scratch

COLUMNS = ("row_id bigint, SettlementDate int, BuySellIndicator string, TransactionType string, "
           "TransferType string, SGXSecurityCode string, CDPSafeKeepingAccount string, Quantity double, "
           "PSMSMatchedReference string")


def random_rows(seed, days, spread):
    rnd = random.Random(seed)
    rows = []
    for day in range(days):
        n = rnd.randint(1, 45)
        quantities = [0.0, 0.5] + [float(q) for q in range(1, spread)]
        for i in range(1, n + 1):
            rows.append((
                i, 20200101 + day, rnd.choice("BSbs"),
                rnd.choices(["FDVP", "OFOP", "DVPT", "CDIS", "DCSS"], [5, 4, 4, 2, 1])[0],
                rnd.choices(["NORM", "SBLT"], [9, 1])[0],
                rnd.choice(["X", "Y"]), rnd.choice(["", "A1", "A2"]),
                rnd.choice(quantities),
                rnd.choice([None, "", "R1", "R2", "R3", "R4", "R5", "R6"] + [f"Q{i}"] * 12),
            ))
    return rows


def run(spark, rows, limits=M.Limits(), partitions=4):
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    frame = prepare(spark.createDataFrame(rows, COLUMNS).repartition(3))
    frame = Scratch(spark, "given").store(frame, "prepared")
    got = {(r[0], r[1]): r[2] for r in link(frame, Scratch(spark, "test"), limits).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return frame, got


LOOP = M.Limits(component_rows=0)  # all turnarounds in the loop over all groups


@pytest.mark.parametrize("limits", [M.Limits(), LOOP, M.Limits(component_rows=9, component_rounds=1)])
@pytest.mark.parametrize("seed,spread", [(1, 6), (2, 40)])
def test_random_days_match_the_row_walk(spark, seed, spread, limits):
    rows = random_rows(seed, 70, spread)
    frame, got = run(spark, rows, limits)
    want = link_all(frame.collect())
    assert got == want
    kinds = {c.split(" at ")[0] for c in want.values()}
    assert kinds == {S.TOTAL_LINK, S.INDIVIDUAL_LINK, S.REFERENCE_LINK}
    assert any("Turnaround 3" in c for c in want.values())


def test_split_groups_and_cells_give_the_same_links(spark):
    """Tiny limits send every group through the block-wise walk and every cell through stretches."""
    rows = random_rows(3, 40, 25)
    frame, plain = run(spark, rows)
    _, split = run(spark, rows, M.Limits(max_cells=2, block_rows_log2=1, small_list=15, component_rows=0), partitions=7)
    assert split == plain == link_all(frame.collect())


def hot_rows():
    """One group and one reference hold most rows; quantities are many and supply runs short."""
    rnd = random.Random(9)
    rows = []
    for i in range(1, 601):
        later = i % 3 != 0
        rows.append((i, 20200101, rnd.choice("BS"), "FDVP" if later else "DVPT", "NORM", "X", "A1",
                     float(rnd.randint(1, 400) if later else rnd.randint(1, 300)),
                     "HOT" if i % 3 == 1 and i > 560 else f"Q{i}"))
    for i in range(601, 900):
        rows.append((i, 20200101, "B" if i % 2 else "S", "FDVP", "NORM", "X", "A2", 7.0, f"Q{i}"))
    for i in range(900, 960):
        rows.append((i, 20200101, "B", "DVPT", "NORM", "X", "A2", 7.0, f"Q{i}"))
    return rows


@pytest.mark.parametrize("limits", [M.Limits(pending=3, component_rows=0), M.Limits(), M.Limits(component_rounds=2, pending=3)])
def test_long_chain_of_turnarounds(spark, limits):
    """Each turnaround links one more instruction by quantity; rows and histogram are rewritten on the way."""
    rows = [(1, 20200101, "S", "DVPT", "NORM", "X", "A0", 5.0, "Q0"), (2, 20200101, "B", "FDVP", "NORM", "X", "A0", 5.0, "C1")]
    for k in range(1, 14):  # C(k) links a seller of account k by reference, which then supplies a buyer there
        rows.append((10 * k, 20200101, "S", "FDVP", "NORM", "X", f"A{k}", 5.0, f"C{k}"))
        rows.append((10 * k + 1, 20200101, "B", "FDVP", "NORM", "X", f"A{k}", 5.0, f"C{k + 1}"))
    frame, got = run(spark, rows, limits)
    assert got == link_all(frame.collect())
    assert max(int(c.split()[-1]) for c in got.values() if "Turnaround" in c) >= 13


@pytest.mark.parametrize("limits", [M.Limits(), M.Limits(max_cells=16, block_rows_log2=4, small_list=0, pending=1, component_rows=0)])
def test_hot_group_and_hot_cell(spark, limits):
    frame, got = run(spark, hot_rows(), limits)
    assert got == link_all(frame.collect())
    assert S.INDIVIDUAL_LINK in got.values()


def test_driver_rows_match_the_row_walk(spark):
    frame = prepare(settled(Workbench.of(spark, SF).loaded().facts()))
    got = {(r[0], r[1]): r[2] for r in link(frame, Scratch(spark, "test")).collect()}
    assert got == link_all(frame.collect())


def test_histogram_walk_equals_row_walk(spark):
    """The array expression against the row walk, one group per random case."""
    rnd = random.Random(4)
    cases, rows = {}, []
    for g in range(400):
        a = [(i, float(rnd.randint(0, 9))) for i in range(rnd.randint(0, 6))]
        b = [(i, float(rnd.randint(0, 12))) for i in range(rnd.randint(1, 8))]
        covered = sum(q for _, q in a) >= sum(q for _, q in b)
        cases[g] = len(b) if covered else len(walk(a, b))
        for q in {q for _, q in a} | {q for _, q in b}:
            rows.append((1, str(g), "S", q, sum(x == q for _, x in a), sum(x == q for _, x in b)))
    cells = spark.createDataFrame(
        rows, "SettlementDate int, Code_CDP string, side string, Quantity double, have bigint, want bigint")
    got = {int(r[0]): r[1] for r in M.small_groups(cells, False).groupBy("Code_CDP").agg(F.sum("take")).collect()}
    assert {g: got.get(g, 0) for g in cases} == cases


def test_verdicts_only_rise_and_residual_comment(spark):
    rows = random_rows(5, 10, 8)
    frame, got = run(spark, rows)
    links = spark.createDataFrame([(d, i, c) for (d, i), c in got.items()],
                                  "SettlementDate int, row_id bigint, comments string")
    after = {(r.SettlementDate, r.row_id): r for r in apply_links(frame, links).collect()}
    for r in frame.collect():
        new = after[(r.SettlementDate, r.row_id)]
        if r.subsequent == "1" and r.flag == "0":
            linked = (r.SettlementDate, r.row_id) in got
            assert new.flag == ("1" if linked else "0")
            assert linked or new.comments == "NULL"
        else:
            assert (new.flag, new.comments) == (r.flag, "null")
    assert len(after) == len(rows)


@pytest.mark.parametrize("limits", [M.Limits(), LOOP])
def test_round_cap_is_an_error(spark, limits):
    frame = prepare(spark.createDataFrame(random_rows(1, 20, 6), COLUMNS))
    with pytest.raises(RuntimeError, match="did not settle within 1 rounds"):
        link(frame, Scratch(spark, "test"), limits, max_rounds=1)


def test_number_of_jobs_does_not_grow_with_the_chain(spark):
    """A chain four times as long takes no more tables than rounds of the component search."""
    def tables(length):
        rows = []
        for day in range(1, 4):
            rows += [(1, day, "S", "DVPT", "NORM", "X", "A0", 5.0, "Q0"), (2, day, "B", "FDVP", "NORM", "X", "A0", 5.0, "C1")]
            for k in range(1, length):
                rows.append((10 * k, day, "S", "FDVP", "NORM", "X", f"A{k}", 5.0, f"C{k}"))
                rows.append((10 * k + 1, day, "B", "FDVP", "NORM", "X", f"A{k}", 5.0, f"C{k + 1}"))
        frame = Scratch(spark, "given").store(prepare(spark.createDataFrame(rows, COLUMNS)), "prepared")
        scratch, made = Scratch(spark, "test"), []
        keep = Scratch.store
        try:
            Scratch.store = lambda self, df, name: (made.append(name), keep(self, df, name))[1]
            assert link(frame, scratch).count() == 3 * (2 * length - 1)
        finally:
            Scratch.store = keep
        return len(made)

    assert tables(40) <= tables(10) + 4  # two for each further round of the search


def test_odd_rows_in_a_component(spark):
    """Missing sides, groups and references ride along as the row walk has them."""
    rows = random_rows(11, 25, 9)
    rnd = random.Random(6)
    rows = [(*r[:2], rnd.choice([r[2], r[2], r[2], "X", None]), *r[3:7], rnd.choice([r[7], r[7], None]), rnd.choice([r[8], None, "R1"])) for r in rows]
    _, small = run(spark, rows)
    _, loop = run(spark, rows, LOOP)
    assert small == loop and any("Turnaround" in c for c in small.values())


def test_empty_classes(spark):
    """No subsequent rows at all, or nothing to supply them: no links, no error."""
    only_first = [(1, 20200101, "B", "DVPT", "NORM", "X", "A1", 5.0, "R")]
    only_later = [(1, 20200101, "B", "FDVP", "NORM", "X", "A1", 5.0, "R")]
    assert run(spark, only_first)[1] == {}
    assert run(spark, only_later)[1] == {}


def test_zero_quantity_without_supply_counts_as_covered(spark):
    rows = [(1, 20200101, "S", "FDVP", "NORM", "X", "A1", 0.0, "R")]
    assert run(spark, rows)[1] == {(20200101, 1): S.TOTAL_LINK}


def test_missing_quantity_is_never_linked_by_quantity(spark):
    rows = [(1, 20200101, "B", "DVPT", "NORM", "X", "A1", 50.0, "R"),
            (2, 20200101, "S", "FDVP", "NORM", "X", "A1", None, "R2"),
            (3, 20200101, "S", "FDVP", "NORM", "X", "A1", 20.0, "R2")]
    assert run(spark, rows)[1] == {(20200101, 3): S.TOTAL_LINK, (20200101, 2): S.REFERENCE_LINK}


@pytest.mark.parametrize("limits", [M.Limits(), M.Limits(max_cells=1, block_rows_log2=1, small_list=0, component_rows=0)])
def test_quantities_at_the_edges_of_exactness(spark, limits):
    def case(account, have, want):
        return [(account, "S", "DVPT", q) for q in have] + [(account, "B", "FDVP", q) for q in want]

    cases = (
        case("tiny short", [0.00003], [0.00004]) + case("tiny enough", [0.00001, 0.00003], [0.00004])
        + case("huge", [1e16, 1.0], [1e16]) + case("huge short", [1e16], [1e16, 0.0000000001])
        + case("tenths", [0.1] * 3, [0.3]) + case("tenths short", [0.1, 0.1], [0.2000000001]))
    rows = [(i, 20200101, side, kind, "NORM", "X", account, q, f"Q{i}") for i, (account, side, kind, q) in enumerate(cases, 1)]
    _, got = run(spark, rows, limits)
    linked = {(rows[i - 1][6], rows[i - 1][7]) for _, i in got}
    assert linked == {("tiny enough", 0.00004), ("huge", 1e16), ("huge short", 1e16), ("tenths", 0.3)}


@pytest.mark.parametrize("quantity", [-5.0, 1e18, 0.00000000001])
def test_quantities_without_an_exact_form_are_refused(spark, quantity):
    rows = [(1, 20200101, "S", "DVPT", "NORM", "X", "A1", 5.0, "Q1"), (2, 20200101, "B", "FDVP", "NORM", "X", "A1", quantity, "Q2")]
    with pytest.raises(Exception, match="quantity cannot be linked exactly|CAST|out of range|cannot be represented"):
        run(spark, rows)

"""Each stage against a plain version of its decision, on the given small tables; and on none."""

import corpus_pipeline as C
import pytest
from conftest import SF

from tradeweave.session import Scratch


@pytest.fixture(scope="module")
def stages(spark):
    tmp, docs = Scratch(spark, "stages"), spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for i, (_, stage) in enumerate(C.STAGES):
        out.append(tmp.store(stage(spark, out[-1], SF), str(i)))
    return out


def test_columns_and_shrinking(stages):
    columns = stages[0].columns
    assert all(s.columns == columns for s in stages[:-1]) and stages[-1].columns[:len(columns)] == columns
    sizes = [s.count() for s in stages]
    assert sizes == sorted(sizes, reverse=True) and sizes[2] < sizes[0] and sizes[-1] > 0.5 * sizes[0]


def test_one_document_of_each_group_stays(stages):
    from llm.test_jaccard import brute

    want = brute([(r.doc_id, r.text) for r in stages[1].collect()], 5, 0.8)
    assert {r.doc_id for r in stages[2].collect()} == {i for i, (c, _, _) in want.items() if c == i}


def test_passages_are_cut(stages):
    from llm.test_substrings import brute

    want = {w[0]: w[4].split() for w in brute([(r.doc_id, r.text) for r in stages[2].collect()], 20) if w[4] or not w[1]}
    got = {r.doc_id: r for r in stages[3].collect()}
    assert {i: r.text.encode().split() for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_contaminated_documents_go(spark, stages):
    from llm.test_text_operators import brute_contamination

    items = [(r.item_id, r.text, None) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = {k[0] for k in brute_contamination([(r.doc_id, r.text) for r in stages[3].collect()], items) if not k[5]}
    assert {r.doc_id for r in stages[4].collect()} == want


def test_run_gives_the_last_stage(spark, stages):
    got = C.run(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1].collect()))


def test_no_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in C.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0


def test_rows_that_share_an_id_or_have_none(spark):
    """Only copies and near copies go; other texts stay, whatever their doc_id."""
    text = lambda w: " ".join(f"{w}{i}" for i in range(100))
    rows = [(None, text("a")), (None, text("b")), (None, text("a")), (None, ""), (None, ""), (5, text("c")), (5, text("d")),
            (6, text("a")), (7, text("c") + " more"), (8, text("e")), (8, text("e")), (9, None), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(C.near_duplicate_stage(spark, docs, SF).collect(), key=str)
    want = [(None, text("a")), (None, text("b")), (None, ""), (None, ""), (5, text("c")), (5, text("d")), (8, text("e")), (9, None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_columns_of_any_name(spark, stages):
    """Columns named like those the stages make come back as they were; the last stage replaces those it gives."""
    names = ["_chunk", "__key", "__content", "key", "content", "row", "chunk", "code", "n_words", "kept_text", "bands", "perplexity", "is_first"]
    late = ["n_tokens", "IDS_sha256", "ids", "decoded"]
    docs = stages[0].selectExpr("*", *[f"concat('{n} ', doc_id) AS `{n}`" for n in names + late])
    for nth, (_, stage) in enumerate(C.STAGES):
        docs = Scratch(spark, "clash").store(stage(spark, docs, SF), "docs")
        kept = names + (late if nth < 4 else ["ids", "decoded"])
        assert docs.where(" OR ".join(f"NOT `{n}` <=> concat('{n} ', doc_id)" for n in kept)).isEmpty()
        columns = stages[nth + 1].columns
        assert sorted(map(str, docs.select(columns).collect())) == sorted(map(str, stages[nth + 1].collect()))
    assert docs.columns[-3:] == ["n_tokens", "ids_sha256", "decoded_sha256"] and len(docs.columns) == len(stages[-1].columns) + len(names) + 2

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, code string, row string, bands string"


def doc_rows(seed=5):
    """Words from a small set, so that passages, copies and near copies abound; every odd case too."""
    rnd = random.Random(seed)
    vocabulary = [a + b for a in ("al", "be", "ga", "de", "é", "Ze") for b in ("ra", "to", "mi", "na", "üx", "po", "ki", "su")]
    line = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    shared = [line(rnd.randint(20, 45)) for _ in range(4)]
    texts = []
    for _ in range(60):
        words = line(rnd.randint(1, 120))
        for _ in range(rnd.randint(0, 2)):
            at = rnd.randint(0, len(words))
            words[at:at] = rnd.choice(shared)
        texts.append((rnd.choice([" ", "  ", "\n", "\t "])).join(words))
    for _ in range(25):  # near copies
        words = texts[rnd.randint(0, 20)].split()
        words[rnd.randint(0, len(words) - 1)] = "other"
        texts.append(" ".join(words))
    texts += texts[:10] + ["", None, " ", "\n\n", "one", "x " * 60, "And " * 100, "a\x00b c\x0bd", "ein " + " ".join(shared[0]) * 3]
    texts += [" ".join(line(6000)), None, ""]
    ids = list(range(len(texts)))
    rnd.shuffle(ids)
    langs = ["en", "de", None]
    rows = [(i, t, langs[i % 3], f"src{i % 2}", None if t is None else len(t), "c", "r", "b") for i, t in zip(ids, texts)]
    return rows + [rows[3], rows[3], (None, texts[0], "en", None, 1, None, None, None)]


@pytest.fixture(scope="session")
def rows():
    return doc_rows()


@pytest.fixture(scope="session")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

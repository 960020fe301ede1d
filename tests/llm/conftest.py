import random

import pytest

SF001 = "/root/testdata/sf0.001"

WORDS = "the of and to in is alpha beta Gamma delta, one two THREE été ñandú x".split()


@pytest.fixture(scope="session")
def odd_rows():
    """(id, text): nulls, blanks, repeats, ties, long and periodic texts, short words, signs."""
    rng = random.Random(11)
    rows = [(k, " ".join(rng.choice(WORDS) for _ in range(rng.choice([1, 2, 3, 9, 19, 20, 21, 60, 200])))) for k in range(60)]
    passage = " ".join(rng.choice(WORDS) + str(rng.randrange(50)) for _ in range(60))
    rows += [(100 + k, f"head {k} {passage} tail {k}") for k in range(8)]
    rows += [(120, None), (121, ""), (122, " \t\n"), (123, None), (124, "x " * 300), (125, "a b c d e " * 40),
             (126, "日本語 テスト 😀 ß" * 5), (127, "w" * 5000 + " end"), (128, "%%% ### |"), (129, "x"),
             (130, "line\nline\n\nother\nline"), (3, rows[3][1]), (3, "same id, other text"), (5, rows[5][1]),
             (131, rows[9][1]), (132, rows[9][1] + " more")]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The rows with further columns whose names clash with those of the operators."""
    full = [(i, t, "en", 1, "s", True, 0.5) for i, t in odd_rows]
    return spark.createDataFrame(
        full, "doc_id long, text string, lang string, n_words int, spans string, row boolean, score double").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def sf_rows(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").orderBy("doc_id").collect()]

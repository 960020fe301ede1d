import plain
import pytest
from plain import SF001

from wiretable.llm import registry
from wiretable.llm.language_model import score_documents


def check(got, rows):
    want = sorted((i, *x) for (i, _), x in zip(rows, plain.language_model(rows)))
    got = sorted((r.doc_id, *tuple(r)[2:]) for r in got)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for g, w in zip(got, want):
        assert g[4:] == pytest.approx(w[4:], abs=1e-7)


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3000, "range_bytes": 2000}, {"block_bytes": 1000, "range_bytes": 5000, "fan_in": 3}])
def test_odd_rows(odd, odd_rows, options):
    check(score_documents(odd, **options).collect(), odd_rows)


def test_empty_and_untrained(spark, empty):
    assert score_documents(empty).count() == 0
    held = next(k for k in range(100) if plain.fold(k, 7) == 2)
    row = score_documents(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert row.held_out and row.train_tokens == 0 and row.n_known == 0 and row.base_score == 0.0 and row.score == 0.0


def test_query(spark, sf_rows):
    check(registry.op7_language_model(spark, SF001).collect(), sf_rows)


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    rows = [r for r in registry.op7_language_model(spark, "/root/testdata/sf0.01").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)

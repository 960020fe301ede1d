import os

import corpus_pipeline
import plain
from plain import SF001

from wiretable.llm.frames import DOCUMENTS
from wiretable.llm.registry import op6_toxicity
from wiretable.llm.secrets import scan_text


def test_each_stage_against_plain(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "simhash near-dedup", "benchmark decontamination", "secret scans", "sentencepiece"]

    clean = stages["toxicity"](spark, docs, SF001)
    assert clean.columns == DOCUMENTS
    toxic = {r.doc_id for r in op6_toxicity(spark, SF001).collect() if r.predicted}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in docs.collect()} - toxic

    single = stages["simhash near-dedup"](spark, clean, SF001)
    rows = sorted((r.doc_id, r.text) for r in clean.collect())
    own = plain.components([(i, plain.fingerprint(t)) for i, t in rows])
    assert single.columns == DOCUMENTS and sorted(r.doc_id for r in single.collect()) == sorted(set(own))

    cut = stages["benchmark decontamination"](spark, single, SF001)
    before = {r.doc_id: r.text for r in single.collect()}
    for r in cut.collect():
        n, hit, *_ = plain.contamination([before[r.doc_id]], items)[0]
        assert len(plain.ALNUM.findall(plain.lower(r.text))) == n - hit and r.n_chars == len(r.text)
        assert hit or r.text == before[r.doc_id]

    masked = stages["secret scans"](spark, cut, SF001)
    before = {r.doc_id: r.text for r in cut.collect()}
    assert masked.columns == DOCUMENTS
    for r in masked.collect():
        spans = scan_text(before[r.doc_id])
        assert not scan_text(r.text) and r.text.count("[secret]") >= bool(spans) and (spans or r.text == before[r.doc_id])

    last = stages["sentencepiece"](spark, masked, SF001)
    assert last.columns == ["doc_id", "lang", "source", "n_tokens", "ids"]
    assert sorted(r.doc_id for r in corpus_pipeline.run(spark, SF001).collect()) == sorted(r.doc_id for r in last.collect())


def test_run_leaves_only_what_its_result_reads(spark, scratch):
    from wiretable.session import Workspace

    def folders():
        base = os.path.dirname(Workspace(spark).folder).replace("file:", "")
        return {f for f in (os.listdir(base) if os.path.isdir(base) else []) if f != "shared"}

    before = folders()
    result = corpus_pipeline.run(spark, SF001)
    left = folders() - before
    assert len(left) == 1 and result.count() > 0  # the masked documents that the last stage reads


def test_stages_take_odd_and_empty_documents(spark, odd_rows, empty):
    rows = [(i, t, None, None, None) for i, t in odd_rows] + [(None, None, "en", "s", 1), (None, "some text here", "en", "s", 1)]
    for docs in (spark.createDataFrame(rows, empty.schema), empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF001)
            assert name == "sentencepiece" or out.columns == DOCUMENTS
            if name == "simhash near-dedup":
                assert out.count() <= docs.count()
            else:
                assert out.count() == docs.count() or name == "toxicity"

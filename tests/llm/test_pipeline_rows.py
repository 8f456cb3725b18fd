"""The pipeline on awkward tables."""
import pytest

import corpus_pipeline as pipeline
from starmart.llm.common import written
from tests.llm.data import DOCS, ODD, frame, prose


def through(spark, docs, sf_dir):
    kept = []
    for name, stage in pipeline.STAGES[:-1]:
        before = docs.columns
        docs = written(stage(spark, docs, sf_dir), name)
        assert docs.columns == before, name
        kept.append(docs)
    return kept, pipeline.STAGES[-1][1](spark, docs, sf_dir)


@pytest.fixture
def tables(spark, sf_dir):
    return sf_dir


def test_odd_rows_pass_or_go_as_stated(spark, tables):
    body = prose(120, 3)
    texts = [*ODD, body, body, body + " token=abcdefgh12", prose(60_000, 9), prose(80, 4) + " token=abcdefgh34"]
    ids = [*range(len(ODD)), None, 50, 51, 52, None]
    kept, packed = through(spark, frame(spark, texts, ids), tables)
    rules, near, _, clean = [{r.doc_id: r for r in k.collect()} for k in kept]
    assert set(rules) == {None, 50, 51, 52}
    assert set(near) == {None, 50, 52}  # of the near copies the least id that isn't null stays
    assert all("token=" not in r.text for r in clean.values())
    assert all(r.n_chars == len(r.text) for r in clean.values())
    assert {r.doc_id for r in packed.collect()} == {None, 50, 52}


def test_empty_table_and_missing_columns(spark, tables):
    kept, packed = through(spark, spark.createDataFrame([], DOCS), tables)
    assert all(k.count() == 0 for k in kept) and packed.collect() == []
    bare = frame(spark, [prose(50, 1) + " secret=abcdefgh"]).select("doc_id", "text", "lang", "source")
    kept, packed = through(spark, bare, tables)
    assert kept[-1].first().text.endswith("[REDACTED]") and packed.count() == 1


def test_shuffles_of_a_stage_are_freed_before_the_next(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    monkeypatch.setattr(pipeline, "freed", lambda s: seen.append("freed"))

    def stage(name):
        return name, lambda s, docs, sf_dir: (seen.append(name), docs)[1]

    monkeypatch.setattr(pipeline, "STAGES", [stage(x) for x in "abc"])
    assert pipeline.run(spark, str(tmp_path)).count() == 2
    assert seen == ["a", "freed", "b", "freed", "c"]

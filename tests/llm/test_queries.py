"""The registered queries and the pipeline."""

import importlib

import pytest
from compare import connect, differences

import brute
import corpus_pipeline
from estrato.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql_twin(spark, given, name):
    found = QUERIES[name](spark, given("0.01")).toArrow()
    assert differences(found, connect(given("0.01")).sql(ORACLES[name]).to_arrow_table()) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, given, name):
    assert QUERIES[name](spark, given("0.001")).count() > 0


def test_registered():
    entry = importlib.import_module("__spark_entry__")
    assert sorted(n.split("_")[0] for n in QUERIES) == sorted(f"op{i}" for i in range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline(spark, given):
    docs = spark.read.parquet(f"{given('0.01')}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{given('0.01')}/labels.parquet").collect()}
    state = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = corpus_pipeline.written(stage(spark, state, given("0.01")))
        assert after.dtypes == docs.dtypes
        old, new = [(r.doc_id, r.text) for r in state.collect()], [(r.doc_id, r.text) for r in after.collect()]
        if name == "quality classifier":
            gone = {d for d, _ in old} - {d for d, _ in new}
            good, bad = ([d for d, _ in old if labels.get(d) == q] for q in (1, 0))
            # The sample has a few hundred rows here, and a fifth of the labels is held out.
            assert len(gone & set(bad)) >= 0.9 * len(bad) and len(gone & set(good)) <= 0.01 * len(good)
        if name == "line dedup":
            assert sorted(new) == sorted((d, t) for d, t, _ in brute.without_lines(old))
        if name == "MinHash near-dedup":
            assert sorted(d for d, _ in new) == sorted({c for _, c in brute.near_classes(old)})
        if name == "PII":
            assert len(new) == len(old) and not [t for _, t in new if brute.base_spans(t)]
            texts = dict(new)
            assert all(texts[d] == t for d, t in old if not brute.base_spans(t))
        assert after.filter("n_chars <> length(text)").count() == 0
        state = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, state, given("0.01"))
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {r.doc_id for r in state.collect()}

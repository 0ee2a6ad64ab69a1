"""Registered queries against DuckDB, and the pipeline against its stages' brute force."""

import pytest

import corpus_pipeline
from rillstone.llm import queries
from tests.compare import assert_same, connect
from tests.llm import test_decontaminate, test_near_dedup, test_secrets


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert_same(queries.QUERIES[name](spark, sf_dir), con, queries.ORACLES[name])


def test_ten_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = [{r.doc_id: r for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        docs = corpus_pipeline.materialize(out, name)
        if name != "mixing":
            assert docs.columns == columns
        kept.append({r.doc_id: r for r in docs.collect()})
        assert docs.count() == len(kept[-1])
        assert set(kept[-1]) <= set(kept[-2])
    raw, good, distinct, clean, redacted, mixed = kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    verdict = {r.doc_id: r.kept for r in queries.QUERIES["op7_quality_rules"](spark, sf_dir).collect()}
    assert set(good) == {i for i, v in verdict.items() if v}
    assert sum(i in good for i, q in labels.items() if q == 1) >= 0.95 * sum(q == 1 for q in labels.values())
    want = test_near_dedup.brute_force([(i, r.text) for i, r in good.items()])
    assert set(distinct) == {i for i, (_, c) in want.items() if c == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    assert set(clean) == {i for i, r in distinct.items() if not test_decontaminate.brute_force(r.text, items)[4]}
    assert set(redacted) == set(clean)
    for i, r in redacted.items():
        assert not test_secrets.brute_force(r.text)
        if not test_secrets.brute_force(clean[i].text):
            assert r == clean[i]
    assert mixed and all(r.taken == r.size * r.repeats for r in mixed.values())
    assert {r.doc_id: r.taken for r in corpus_pipeline.run(spark, sf_dir).collect()} == {i: r.taken for i, r in mixed.items()}

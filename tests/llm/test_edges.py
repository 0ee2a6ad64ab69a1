"""Every operator on nulls, empty and long texts, repeated rows, clashing columns and empty tables."""

import public_tokenizers
import pytest

from rillstone.llm import decontaminate, language_id, mixing, near_dedup, personal_data, quality_rules, secrets, token_counts, url_filter, warc
from tests.llm.data import SCHEMA, TEXTS, empty, frame, rows

LABELS = "doc_id long, quality int, toxic int"


def operators(spark):
    benchmark = spark.createDataFrame([(1, TEXTS[-1]), (2, "due parole"), (3, None), (4, "")], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(len(TEXTS))] + [(None, 1, None), (3, None, None)], LABELS)
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return {
        "near_duplicates": near_dedup.near_duplicates,
        "identify": language_id.identify,
        "personal_data": personal_data.personal_data,
        "mix": mixing.mix,
        "token_counts": lambda d: token_counts.token_counts(d, vocabulary),
        "quality": lambda d: quality_rules.quality(d, labels),
        "contamination": lambda d: decontaminate.contamination(d, benchmark),
        "findings": secrets.findings,
    }


NAMES = ["near_duplicates", "identify", "personal_data", "mix", "token_counts", "quality", "contamination", "findings"]


@pytest.mark.parametrize("name", NAMES)
def test_hostile_rows(spark, name):
    out = operators(spark)[name](frame(spark)).collect()
    assert sorted(r.doc_id for r in out) == sorted(r[0] for r in rows())
    equal = [r for r in out if r.doc_id == 5]
    if name != "mix":
        assert len(equal) == 3 and len(set(equal)) == 1


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert operators(spark)[name](empty(spark)).collect() == []


def test_labels_or_benchmark_without_rows(spark):
    docs = frame(spark)
    none = spark.createDataFrame([], LABELS)
    out = quality_rules.quality(docs, none).collect()
    assert all(r.kept != r.base_failed for r in out)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in decontaminate.contamination(docs, bench).collect())


@pytest.mark.parametrize("stage", ["quality", "dedup", "clean", "redact", "mixture"])
def test_stages_keep_columns(spark, stage):
    benchmark = spark.createDataFrame([(1, TEXTS[-1])], "item_id long, text string")
    labels = spark.createDataFrame([], LABELS)
    run = {
        "quality": lambda d: quality_rules.keep(d, labels), "dedup": near_dedup.keep, "clean": lambda d: decontaminate.clean(d, benchmark), "redact": secrets.redact,
        "mixture": lambda d: mixing.mixture(d.dropDuplicates(["doc_id"])),
    }[stage]
    out = run(frame(spark))
    assert set(SCHEMA.names) <= set(out.columns)
    if stage != "mixture":
        assert out.columns == SCHEMA.names
    found = out.collect()
    assert found
    if stage == "dedup":
        assert [r.doc_id for r in found].count(5) == 1
        assert {r.doc_id for r in found} >= {0, 1, 2, 3, 4}
    assert run(empty(spark)).collect() == []


def with_nulls_and_versions(spark):
    """Null ids, and one id with two texts."""
    docs = frame(spark)
    return docs.unionByName(docs.where("doc_id in (3, 14, 15)").selectExpr("CAST(null AS BIGINT) AS doc_id", *docs.columns[1:])).unionByName(docs.where("doc_id = 14").selectExpr("CAST(15 AS BIGINT) AS doc_id", *docs.columns[1:]))


@pytest.mark.parametrize("name", NAMES)
def test_null_ids_and_ids_of_several_texts(spark, name):
    docs = with_nulls_and_versions(spark)
    out = operators(spark)[name](docs).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(r.doc_id) for r in docs.select("doc_id").collect())


PAGES = "page_id long, url string, html string, host string, path string, digest string, response_id string, form string, block long, listed string"
HOSTILE = [None, "", "://", "http://", "http://h/" + "d/" * 3000, "http://" + "a." * 300 + "b/", "http://h/x", "http://h/x", "nothing", "http://é/😀"]


def pages(spark):
    rows = [(i if i % 4 else None, u, TEXTS[i], "clash", None, "x", "y", "z", 3, "w") for i, u in enumerate(HOSTILE)]
    return spark.createDataFrame([*rows, rows[6], rows[6]], PAGES)


def test_pages_hostile_rows_and_empty_tables(spark):
    listed = spark.createDataFrame([("h/x",), (None,), ("",), ("a.b",), ("http://h/" + "d/" * 2000,)], "url string")
    for run in (warc.round_trip, lambda p: url_filter.judge(p, listed)):
        out = run(pages(spark)).collect()
        assert sorted(str(r.page_id) for r in out) == sorted(str(r.page_id) for r in pages(spark).select("page_id").collect())
        assert run(spark.createDataFrame([], PAGES)).collect() == []
    out = url_filter.judge(pages(spark), listed).collect()
    assert all(r.verdict == ("block" if r.host == "h" or r.host.endswith(".a.b") else "allow") for r in out if r.path or r.host)
    assert all(r.verdict == "allow" for r in out if not r.host)

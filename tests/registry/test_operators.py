import random

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillstone.functions import geo, numbers, text
from rillstone.operators import dedupe, diff, ingest, ordered, quality, rules


def one(spark, column, *values, schema="a string, b string"):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first().x


def test_upsert_is_idempotent_and_logs_the_old_value(spark):
    policy = {"name": "overwrite", "place": "fill", "status": "differs"}
    master = spark.createDataFrame([("k1", "A", None, "s"), ("k2", "B", "p", "s")], "k string, name string, place string, status string")
    batch = spark.createDataFrame([("k1", "A2", "q", "s", 0), ("k1", "A3", "q", "s", 1), ("k3", "C", "r", "t", 2), (None, "x", "x", "x", 3)], "k string, name string, place string, status string, row_idx int")
    plan = ingest.plan_upsert(master, batch, "k", policy)
    rows = {r.k: r for r in plan.collect()}
    assert {k: r.action for k, r in rows.items()} == {"k1": "changed", "k2": "kept", "k3": "new"}
    assert rows["k1"].name == "A3" and rows["k1"].place == "q"
    assert rows["k1"].changed_fields["name"].old == "A" and rows["k1"].changed_fields["name"].new == "A3"
    again = ingest.plan_upsert(plan.select("k", *policy), batch, "k", policy)
    assert again.where("action IN ('new', 'changed')").count() == 0


def test_project_key_skips_a_shared_page(spark):
    key = lambda base: ingest.project_key(F.col("a"), F.lit(None).cast("string"), F.col("b"), *[F.lit(None).cast("string")] * 3, F.lit(None).cast("double"), base)
    assert one(spark, key(None), "http://list", "Parco") != one(spark, key(F.lit("http://list")), "http://list", "Parco")
    assert one(spark, key(None), None, None) is None


def test_diff_of_equal_snapshots_is_empty(spark):
    a = spark.createDataFrame([("k", "Parco", "1,5", 0), ("k", "Parco", "1.5", 1), ("l", "x", None, 2)], "key string, title string, mw string, row_idx int")
    fields = {"title": "text", "mw": "number"}
    assert diff.snapshot_diff(a, a, "key", fields).count() == 0
    b = a.withColumn("title", F.upper("title")).where("row_idx <> 1")
    out = diff.snapshot_diff(a, b, "key", fields)
    assert [(r.key, r.change_type) for r in out.collect()] == [("k#dup2", "removed")]
    assert {r.change_type: r.keys for r in diff.diff_counts(out).collect()} == {"removed": 1}


def random_links(seed, n=80, m=60):
    rng = random.Random(seed)
    return [(a, b) for a, b in ((rng.randrange(n), rng.randrange(n)) for _ in range(m)) if a < b]


@pytest.mark.parametrize("links", [random_links(1), [(i, i + 1) for i in range(25)], [(0, i) for i in range(1, 20)], []])
def test_components_equal_union_find(spark, links):
    root = list(range(80))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    nodes = spark.range(80).withColumnRenamed("id", "row_idx")
    out = dedupe.connected(nodes, spark.createDataFrame(links, "idx_a long, idx_b long"))
    assert {r.row_idx: r.group_id for r in out.collect()} == {i: find(i) for i in range(80)}


RECORD = "row_idx long, title string, source string, url string, region string, province string, municipality string, proponent string, mw double, source_id string"


def test_dedupe_merges_what_agrees_and_not_what_conflicts(spark):
    rows = [
        (0, "Impianto agrivoltaico Sole Nascente contrada Vento", "lazio", "http://x.it/p?id=11", "Lazio", "RM", "Anzio", "Sole S.r.l.", 10.0, None),
        (1, "Impianto agrivoltaico Sole Nascente, contrada Vento", "mase", "http://x.it/p?id=11", "Lazio", "Roma", "Anzio", "SOLE SRL", 10.1, None),
        (2, "Impianto agrivoltaico Sole Nascente contrada Vento", "lazio", "http://x.it/p?id=11", "Lazio", "VT", "Tuscania", "Sole srl", 10.0, None),
        (3, "Altro parco", "lazio", "http://x.it/elenco", "Lazio", "RM", "Anzio", "Luna srl", 3.0, None),
    ]
    groups, scored = dedupe.dedupe(spark.createDataFrame(rows, RECORD))
    assert {r.row_idx: r.group_id for r in groups.collect()} == {0: 0, 1: 0, 2: 2, 3: 3}
    reasons = {(r.idx_a, r.idx_b): r.reason for r in scored.collect()}
    assert reasons[0, 2] == "province_conflict" and "same_specific_url" in reasons[0, 1]
    accepted, rejected = dedupe.pair_reports(scored)
    assert accepted.count() == 1 and rejected.count() == 2


def test_large_blocks_give_no_pairs(spark):
    blocks = spark.range(81).select(F.col("id").alias("row_idx"), F.lit("b").alias("block"))
    assert dedupe.pairs_in_blocks(blocks).count() == 0
    assert dedupe.pairs_in_blocks(blocks.where("row_idx < 80")).count() == 80 * 79 // 2


def test_repairs_see_earlier_repairs(spark):
    rows = [(0, "Parco da 58,86 MWp (FG)", "lazio", "RM", "", "12/03/2025", 0.05886), (1, "Parco da 10 MW", "x", "FG", "", "Sole srl", 10.0)]
    df = spark.createDataFrame(rows, "row_idx int, title string, source string, province string, municipality string, proponent string, mw double")
    fixed, log = quality.repair(df)
    r = fixed.where("row_idx = 0").first()
    assert (r.mw, r.province, r.proponent) == (58.86, "FG", "")
    assert [x.field for x in log.collect()] == ["mw", "province", "proponent"]
    assert quality.repair(fixed)[1].count() == 0


RULES = "seq int, match_kind string, match_value array<string>, expected_matches long, action string, fields map<string,string>, reason string"


def test_rules_by_containment_equal_brute_force(spark):
    rng = random.Random(2)
    words = ["parco", "solare", "sole", "nord", "troia", "lucera", "agri", "voltaico", "agrivoltaico"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 6))), f"x.it/{rng.choice(words)}/p?id={i % 30}") for i in range(120)]
    table = [(1000 + k, "url_contains", [rng.choice(words)[1:], f"id={k}"], None, "exclude", {}, "r") for k in range(20)]
    table += [(k, "title_contains_all", [" ".join(rng.choice(words) for _ in range(rng.randint(1, 2)))[rng.randint(0, 2) :] for _ in range(rng.randint(1, 3))], None, "exclude", {}, "r") for k in range(300)]
    want = {(i, r[0]) for i, t, u in rows for r in table if (any(v in u for v in r[2]) if r[1] == "url_contains" else all(v in t for v in r[2]))}
    found = rules.matching_rules(spark.createDataFrame(rows, "id int, t string, u string"), spark.createDataFrame(table, RULES), "id", "t", "u").collect()
    assert len(found) == len({(r.id, r.seq) for r in found}) and {(r.id, r.seq) for r in found} == want


def test_rules_with_facts_and_power(spark):
    df = spark.createDataFrame([(1, "parco", "u", "Piemonte", 5.0), (2, "parco", "u", "Lazio", 5.0), (3, "parco", "u", "PIEMONTE", 7.0)], "id int, t string, u string, source string, mw double")
    table = spark.createDataFrame([(1, "title_contains_all", ["parco"], {"source": "piemonte"}, 5.001), (2, "url_eq", ["u"], None, None)], "seq int, match_kind string, match_value array<string>, where map<string,string>, power_mw double")
    assert {(r.id, r.seq) for r in rules.matching_rules(df, table, "id", "t", "u", ["source"], "mw").collect()} == {(1, 1), (1, 2), (2, 2), (3, 2)}


def test_similarity_query_equals_difflib_over_all_pairs(spark, sf_dir):
    from difflib import SequenceMatcher

    from rillstone.plans import entities

    parts = spark.read.parquet(f"{sf_dir}/part.parquet").collect()
    title = {r.p_partkey: f"{r.p_name} {r.p_type} {r.p_size}".lower() for r in parts}
    block = {}
    for r in parts:
        block.setdefault((r.p_brand, r.p_name.split()[0]), []).append(r.p_partkey)
    want = {}
    for members in block.values():
        if 2 <= len(members) <= dedupe.MAX_BLOCK:
            for i, a in enumerate(sorted(members)):
                for b in sorted(members)[i + 1 :]:
                    x, y = title[a], title[b]
                    if 2 * min(len(x), len(y)) / (len(x) + len(y)) >= 0.75:
                        want[a, b] = round(SequenceMatcher(None, x, y).ratio(), 4)
    found = {(r.idx_a, r.idx_b): r.similarity for r in entities.q38_similarity(spark, sf_dir).collect()}
    assert found.keys() == want.keys() and all(abs(found[k] - want[k]) < 1e-3 for k in want)


def test_publish_checks(spark, tmp_path):
    from rillstone.operators import publish

    (tmp_path / "data.json").write_text('{"a": 1}')
    (tmp_path / "bad.json").write_text("{a")
    (tmp_path / "index.html").write_text("x" * 2_000_000)
    (tmp_path / "mobile.html").write_text("x")
    rows = {r.check: r.passed for r in publish.publish_checks(spark, str(tmp_path), ["data.json", "README.md"], most_mb=1).collect()}
    assert rows == {"present: data.json": True, "present: README.md": False, "valid JSON: data.json": True, "valid JSON: bad.json": False, "size: index.html": False, "size: mobile.html": True}


def test_staged_records(spark):
    from rillstone.operators import publish

    staged = spark.createDataFrame([(" Parco ", None, " PZ", "", "http://s", ["Melfi ", ""], None, "PAUR", None, None)], "title string, proponent string, province string, url string, source_url string, municipalities array<string>, project_type string, procedure string, status string, updated_at string")
    r = publish.staged_basilicata(staged, F.lit("2024-03-01 10:00:00").cast("timestamp")).first()
    assert (r.title, r.province, r.url, r.municipalities, r.project_type, r.status, r.updated_at, r.source) == ("Parco", "PZ", "http://s", "Melfi", "PAUR", "PAUR", "2024-03-01T10:00:00", "Basilicata")


def test_value_after_label_stops_at_a_label(spark):
    lines = ["L", "", "v", "L", "L2", "w", "L", " ", "", "", "", "late"]
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate(lines)], "k int, i int, line string")
    out = ordered.value_after_label(df, "k", "i", "line", F.col("line").isin("L", "L2")).orderBy("i").collect()
    assert [(r.i, r.value) for r in out] == [(0, "v"), (3, None), (4, "w"), (6, None)]


def test_fill_from_group_takes_the_first_present(spark):
    df = spark.createDataFrame([("g", 1, "", "x"), ("g", 2, "b", "y"), ("h", 1, None, None)], "g string, o int, p string, q string")
    out = {r.g: (r.p, r.q) for r in ordered.fill_from_group(df, "g", [F.asc("o")], ["p", "q"]).collect()}
    assert out == {"g": ("b", "x"), "h": (None, None)}


def test_geography(spark):
    title = "nei comuni di Troia, Lucera e San Severo (FG)"
    assert one(spark, F.array_join(geo.municipalities(F.col("a")), "|"), title, None).startswith("Troia|Lucera|San Severo")
    both = one(spark, F.array_join(geo.municipalities(F.col("a"), ("Santa Cristina e Bissone",)), "|"), "comune di Santa Cristina e Bissone (PV)", None)
    assert both.startswith("Santa Cristina e Bissone")
    value, found = geo.deduced(F.col("a"), F.col("b"))
    assert (one(spark, value, "", "FG"), one(spark, found, "", "FG"), one(spark, found, "BA", "FG")) == ("FG", True, False)
    names = F.array(F.lit("Francofonte"), F.lit("Siracusa"))
    assert one(spark, geo.without_capital(names, "Siracusa", F.col("a")), "COMUNE DI FRANCOFONTE (SR)", None) == ["Francofonte"]


@given(st.floats(0.001, 999.0), st.integers(0, 3))
def test_italian_numbers_survive_formatting(x, decimals):
    written = f"{x:,.{decimals}f}".translate(str.maketrans(",.", ".,"))
    again = written.replace(".", "").replace(",", ".")
    assert abs(float(again) - x) <= 0.5 * 10**-decimals + 1e-9


def test_similarity_keeps_the_heuristic(spark):
    from difflib import SequenceMatcher

    from rillstone.shipping import ship

    ship(spark)
    a, b = "parco solare " * 20, "parco solare nord " * 15
    assert one(spark, text.similarity()(F.col("a"), F.col("b")), a, b) == SequenceMatcher(None, a, b).ratio()
    assert one(spark, text.similarity(autojunk=False)(F.col("a"), F.col("b")), a, b) > 0.5
    assert one(spark, text.unescape(F.col("a")), "&eacute;&amp;&#x41;", None) == "é&A"
    assert one(spark, numbers.best_title_power(F.array(F.lit(5.0), F.lit(58.86)), F.col("a").cast("double")), "0.05886", None) == 58.86

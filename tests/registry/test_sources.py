import json

import pytest
from pyspark.sql import functions as F

from rillstone.sources import html, readers, sinks, workbook


def test_aliases_resolve_by_letters_alone(spark):
    df = spark.createDataFrame([("", "B", "12,5", None), ("A", "C", None, "LE")], "Titolo string, `project name` string, `Potenza (MW)` string, PROVINCIA string")
    out = readers.resolve_aliases(df).collect()
    assert [(r.title, r.mw, r.province, r.region) for r in out] == [("B", "12,5", None, None), ("C", None, "LE", None)]


def test_snapshot_is_strict(spark, tmp_path):
    good = tmp_path / "good.csv"
    good.write_text(",".join(readers.SNAPSHOT_COLUMNS) + "\n" + ",".join(["a"] * 11) + "\n")
    assert readers.read_snapshot(spark, str(good)).count() == 1
    (tmp_path / "few.csv").write_text("project_name,url\na,b\n")
    with pytest.raises(ValueError, match="columns are missing: proponent"):
        readers.read_snapshot(spark, str(tmp_path / "few.csv"))
    bad = tmp_path / "bad.csv"
    bad.write_text(",".join(readers.SNAPSHOT_COLUMNS) + "\n" + ",".join(["a"] * 12) + "\n")
    with pytest.raises(Exception, match="(?i)malformed|bad record|failfast"):
        readers.read_snapshot(spark, str(bad)).collect()


def test_csv_with_mark_and_escape(spark, tmp_path):
    p = tmp_path / "x.csv"
    p.write_bytes('﻿codice;oggetto\n1;"parco \\"Sole\\"; nord"\n'.encode())
    row = readers.read_csv(spark, str(p), sep=";", escape="\\").first()
    assert row["codice"] == "1" and row["oggetto"] == 'parco "Sole"; nord'
    assert readers.sniff_separator(spark, str(p)) == ";"


def test_newest_and_latest_month(spark, tmp_path):
    import os

    for i, name in enumerate(("b.csv", "a.csv")):
        (tmp_path / name).write_text("x\n")
        os.utime(tmp_path / name, (1000 + i, 1000 + i))
    assert readers.newest(spark, str(tmp_path)).endswith("a.csv")
    df = spark.createDataFrame([(2024, 12, 1), (2025, 2, 2), (2025, 2, 3)], "y int, m int, v int")
    assert sorted(r.v for r in readers.latest_month(df, "y", "m").collect()) == [2, 3]
    assert readers.latest_month(df.limit(0), "y", "m").count() == 0


def test_document_and_union(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"summary": {}, "records": [{"title": "a", "mw": 1}, {"title": "b"}]}))
    assert sorted(r.title for r in readers.read_document(spark, str(tmp_path / "d.json")).collect()) == ["a", "b"]
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(1, "y"), (2, "z")], "k int, v string")
    assert {(r.k, r.v) for r in readers.union_first([a, b], "k").collect()} == {(1, "x"), (2, "z")}
    assert [r.url for r in readers.id_sweep(spark, 3, 1, "u/{id}").orderBy(F.desc("id")).collect()] == ["u/3", "u/2", "u/1"]


def test_municipality_table_last_row_wins(spark):
    df = spark.createDataFrame([("Troia", "Foggia", "FG", "Puglia"), ("TROIA", "x", "XX", "y")], "Comune string, Provincia string, Sigla string, Regione string").coalesce(1)
    assert [(r.key, r.sigla) for r in readers.municipality_table(df).collect()] == [("troia", "XX")]


PAGE = """<html><head><title> A &amp; B </title><script>var x = "<a href='no'>";</script></head><body><p>Proponente</p><p></p><p>Sole srl</p>
<p>Stato</p><p>Potenza</p><p>5 MW</p><a href="/x?id=1">one<b>!</b></a><table><tr><th>Nome</th><th>MW</th></tr><tr><td>p</td><td>1</td></tr><tr><td>odd</td></tr></table></body>"""


def test_pages(spark):
    title, lines, links, rows = html.parse_page(PAGE, "http://h/d/")
    assert title == "A & B" and links == [("http://h/x?id=1", "one!")] and rows == [["Nome", "MW"], ["p", "1"], ["odd"]]
    df = html.parsed(spark.createDataFrame([(PAGE, "http://h/d/"), (None, None)], "html string, url string"))
    labels = ["Proponente", "Stato", "Potenza"]
    one = lambda name: html.value_in_lines(F.col("page.lines"), [name, *[x for x in labels if x != name]])
    out = df.select(one("Proponente").alias("v"), html.table_records(F.col("page.rows"), ["Nome", "MW"]).alias("t"), F.size("page.lines").alias("n")).collect()
    assert out[0].v == "Sole srl" and out[0].t == [{"nome": "p", "mw": "1"}] and out[1].n == 0


def test_array_of_a_script():
    source = "x; const dati = [[1, 'it\\'s', \"q\"], /* [ */ [2, null,], // ]\n ['a\"b', undefined]]; y"
    assert json.loads(html.array_text(source, "dati")) == [[1, "it's", "q"], [2, None], ['a"b', None]]
    assert html.array_text("const dati = [[1", "dati") is None and html.array_text(None, "dati") is None and html.array_text("no", "dati") is None


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("Puglia <&>", 1.5, True, None), ("Lazio", 2.0, False, "x")], "Regione string, MW double, ok boolean, note string").coalesce(1)
    (tmp_path / "r.xlsx").write_bytes(workbook.report({"Sintesi": df, "Vuoto": df.limit(0)}))
    rows = readers_rows = workbook.read_workbooks(spark, str(tmp_path), ["regione", "mw"]).collect()
    assert [(r.cells["Regione"], r.cells["MW"]) for r in readers_rows] == [("Puglia <&>", "1.5"), ("Lazio", "2.0")] and len(rows) == 2
    with pytest.raises(ValueError, match="more than 1 rows"):
        workbook.report({"s": df}, max_rows=1)
    assert [workbook.column_name(i) for i in (0, 25, 26, 701, 702)] == ["A", "Z", "AA", "ZZ", "AAA"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a\nb", 1234.5), ('q"x', None)], "t string, mw double").coalesce(1)
    out = sinks.client_rows(df, ["mw"])
    sinks.write_report_csv(out, f"file://{tmp_path}/csv", sep=";", quote_all=True, line_end="\r\n")
    text = next((tmp_path / "csv").glob("part-*")).read_bytes().decode()
    assert text == '"t";"mw"\r\n"a b";"1.234,5"\r\n"q""x";""\r\n'
    root = f"file://{tmp_path}/table"
    for v in ("1", "2", "3"):
        sinks.write_version(df, root, v)
    assert sinks.versions(spark, root) == ["1", "2", "3"] and sinks.current_version(spark, root).count() == 2
    assert sinks.prune_versions(spark, root, 1) == ["1", "2"] and sinks.versions(spark, root) == ["3"]
    page = sinks.page_with_data("<script>/*DATA*/old/*END*/</script>", sinks.document({"rows": df, "n": {"x": "</script>"}}))
    assert "old" not in page and "<\\/script>" in page and json.loads(page.split("/*DATA*/")[1].split("/*END*/")[0].replace("<\\/", "</"))["n"]["x"] == "</script>"
    with pytest.raises(ValueError, match="marks"):
        sinks.page_with_data("none", "{}")
    assert sinks.markdown_table(spark.createDataFrame([("a|b\nc",)], "t string")).endswith("| a\\|b c |")
    assert sinks.mail_body(0, 0, 0, []) is None and "Added 1" in sinks.mail_body(1, 0, 0, ["x"])
    sinks.append_audit(df, f"file://{tmp_path}/audit", F.lit("r1"))
    sinks.append_audit(df, f"file://{tmp_path}/audit", F.lit("r2"))
    assert spark.read.parquet(f"file://{tmp_path}/audit").groupBy("run").count().count() == 2


def test_pages_tables_and_messages(spark):
    import email.policy
    import json

    from rillstone.sources import sinks

    df = spark.createDataFrame([("a<b>", 1.5), (None, None)], "name string, mw double")
    assert sinks.html_table(df).splitlines()[1:3] == ["<tr><th>name</th><th>mw</th></tr>", "<tr><td>a&lt;b&gt;</td><td>1.5</td></tr>"]
    page = sinks.dashboard({"records": df, "summary": {"n": "</script>"}})
    data = page.split("/*DATA*/")[1].split("/*END*/")[0]
    assert "</script>" not in data and json.loads(data)["records"][0] == {"name": "a<b>", "mw": 1.5}
    mail = email.message_from_bytes(sinks.message("a@x", ["b@y", "c@z"], "Changes", sinks.mail_body(1, 0, 2, ["- Parco è"]), "<p>Parco</p>", {"diff.csv": b"k;v"}), policy=email.policy.default)
    assert mail["To"] == "b@y, c@z" and "Parco è" in mail.get_body(("plain",)).get_content() and "<p>Parco</p>" in mail.get_body(("html",)).get_content()
    assert [(x.get_filename(), x.get_content()) for x in mail.iter_attachments()] == [("diff.csv", b"k;v")]

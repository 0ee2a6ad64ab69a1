from pyspark.sql import functions as F

from rillstone.sources.collectors import SPECS, collect, market_statistics

LANDED = "row_idx long, url string, html string, cells map<string,string>"


def run(spark, name, rows, as_of=None):
    df = spark.createDataFrame([(i, u, h, c) for i, (u, h, c) in enumerate(rows)], LANDED)
    kept, rejected = collect(df, SPECS[name], as_of)
    return kept.collect(), {r.title: r.reason for r in rejected.collect()}


def table(*rows, header=("Progetto", "Proponente", "Procedura", "Stato")):
    line = lambda cells, tag: "<tr>" + "".join(f"<{tag}>{c}</{tag}>" for c in cells) + "</tr>"
    return "<table>" + line(header, "th") + "".join(line(r, "td") for r in rows) + "</table>"


def test_table_source_gates_and_first_wins(spark):
    page = table(("Impianto fotovoltaico da 12,5 MW nel comune di Troia (FG)", "Sole srl", "VIA", "in corso"), ("Parco eolico Vento", "Vento spa", "VIA", "conclusa"), ("Impianto fotovoltaico da 12,5 MW nel comune di Troia (FG)", "Altro srl", "VIA", "conclusa"))
    kept, rejected = run(spark, "mase", [("http://x/Info/123", page, None)])
    assert [(r.external_id.startswith("mase_123"), r.proponent, r.province, r.power_mw, r.status, r.project_type) for r in kept] == [(True, "Sole srl", "FG", 12.5, "in_corso", "fotovoltaico")]
    assert rejected == {"Parco eolico Vento": "not_relevant"}


def test_lines_source_needs_date_size_and_company(spark):
    page = lambda title, power, date, company: f"<html><body><p>Titolo: {title}</p><p>Proponente: {company}</p><p>Data: {date}</p><p>Potenza: {power}</p></body></html>"
    rows = [
        ("u/1", page("Fotovoltaico A", "10 MW", "12/03/2025", "Sole srl"), None), ("u/2", page("Fotovoltaico B", "1 MW", "12/03/2025", "Sole srl"), None), ("u/3", page("Fotovoltaico C", "10 MW", "12/03/2024", "Sole srl"), None),
        ("u/4", page("Fotovoltaico D parere negativo", "10 MW", "12/03/2025", "Sole srl"), None), ("u/5", page("Collocamento mirato installatore fotovoltaico", "10 MW", "12/03/2025", "Sole srl"), None), ("u/6", "<p>Titolo: Fotovoltaico E</p><p>Data: 12/03/2025</p><p>Potenza: 9 MW</p>", None),
    ]
    kept, rejected = run(spark, "calabria", rows)
    assert [r.title for r in kept] == ["Fotovoltaico A"]
    assert rejected == {"Fotovoltaico B": "too_small", "Fotovoltaico C": "too_old", "Fotovoltaico D parere negativo": "negative_outcome", "Collocamento mirato installatore fotovoltaico": "not_relevant", "Fotovoltaico E": "no_proponent"}


def test_weekly_roundups_are_rejected(spark):
    page = lambda note: f"<html><body><p>Titolo: Impianto fotovoltaico {note[:3]}</p><p>{note}</p></body></html>"
    kept, rejected = run(spark, "sistema_puglia_energia", [("u/11", page("Uno: autorizzazione unica"), None), ("u/12", page("Due: Gli  atti della Settimana, n. 3"), None)])
    assert [r.title for r in kept] == ["Impianto fotovoltaico Uno"]
    assert rejected == {"Impianto fotovoltaico Due": "roundup"}


def test_authority_must_be_the_own_region(spark):
    page = lambda name, authority: f"<html><body><p>Titolo: Impianto fotovoltaico {name}</p><p>Proponente: Sole srl</p><p>Comune: Terni</p><p>Provincia: TR</p><p>Potenza: 9 MW</p><p>{authority} In corso</p></body></html>"
    kept, rejected = run(spark, "umbria", [("u/11", page("Uno", "Regione Umbria"), None), ("u/12", page("Due", "Regione Toscana"), None), ("u/13", page("Tre", ""), None), ("u/14", page("Quattro", "Ministero Ambiente"), None)])
    assert sorted(r.title for r in kept) == ["Impianto fotovoltaico Tre", "Impianto fotovoltaico Uno"]
    assert rejected == {"Impianto fotovoltaico Due": "other_authority", "Impianto fotovoltaico Quattro": "other_authority"}


def test_cells_and_years(spark):
    rows = [("u", None, {"Oggetto": "Impianto agrivoltaico Sole", "Data": "2025", "Comune": "Lucca; Pisa, Lucca"}), ("u2", None, {"Oggetto": "Impianto agrivoltaico Luna", "Data": "2024"}), ("u3", None, {"Titolo": "Impianto agrivoltaico senza data"})]
    kept, rejected = run(spark, "toscana", rows)
    assert {r.title: list(r.municipalities) for r in kept} == {"Impianto agrivoltaico Sole": ["Lucca", "Pisa"], "Impianto agrivoltaico senza data": []}
    assert rejected == {"Impianto agrivoltaico Luna": "too_old"}


def test_script_source_ladder(spark):
    page = """<script>const discariche = [['Parco A','Sole srl','Autorizzato','5 MW','01/02/2025','Lucca','LU','FOTOVOLTAICO'], ['Eolico B','x','In iter','5 MW','','','','FOTOVOLTAICO'],
    ['Parco C variante','Sole srl','Autorizzato','5 MW','01/02/2020','Lucca','LU','AGRIVOLTAICO'], ['Parco D','Sole srl','In iter','0,1 MW','','Lucca','LU','FOTOVOLTAICO'], ['Parco E','Sole srl','','5 MW','','','','BIOGAS']];</script>"""
    kept, rejected = run(spark, "toscana_atos", [("http://x/", page, None)], F.lit("2025-06-30").cast("date"))
    assert [(r.title, r.province, r.power_mw) for r in kept] == [("Parco A", "LU", 5.0)]
    assert rejected == {"Eolico B": "title_indicates_eolico", "Parco C variante": "authorized_last_act_older_24_months", "Parco D": "too_small", "Parco E": "type_not_allowed"}


def test_links_and_every_spec(spark):
    page = "<a href='/p/1234'>Impianto fotovoltaico Alfa</a><a href='/q'>Contatti</a>"
    kept, rejected = run(spark, "veneto", [("http://v/", page, None)])
    assert [(r.external_id, r.source_url) for r in kept] == [("veneto_1234", "http://v/p/1234")] and rejected == {"Contatti": "not_relevant"}
    for name in SPECS:
        assert run(spark, name, [("http://x/", None, None)])[0] == []


def test_market_statistics(spark):
    rows = [({"Regione": "Puglia", "Fonte": "Solare", "Stato Connessione": "In corso", "Potenza (MW)": "1.234,5", "Numero Pratiche": "12"}, 2025, 3), ({"Regione": "", "Fonte": "Solare", "Potenza (MW)": "1"}, 2025, 3), ({"Regione": "Lazio", "Fonte": "Eolico", "Potenza (MW)": "1"}, 2025, 3)]
    out = market_statistics(spark.createDataFrame(rows, "cells map<string,string>, year int, month int")).collect()
    assert [(r.external_id, r.power_mw, r.practices, r.is_aggregate) for r in out] == [("terna_econnextion_2025_03_puglia_solare_in_corso", 1234.5, 12, True)]

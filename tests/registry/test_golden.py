"""Golden cases of scalar functions: an input and what is expected of it."""

import datetime

import pytest
from pyspark.sql import functions as F

from rillstone.functions import dates, numbers, text, urls
from rillstone.operators.rules import bad_company_reason, is_aggregate

CASES = []


def _golden(name, doc, function, cases, kind="string"):
    CASES.append(pytest.param(function, cases, kind, id=f"{name}: {doc}"))


_golden("q24_power", "N3.", numbers.parse_power, [
    ("48.491,52 kWp", 48.49152), ("19.056,42 kW", 19.05642), ("12’701,52 kWp", 12.70152), ("24'995,52 kWp", 24.99552), ("8951.00 kWp", 8.951), ("99 MWp", 99.0),
    ("47,01 MWp", 47.01), ("19.305 MWp", 19.305), ("118.07 MW", 118.07), ("MW 36,59", 36.59), ("29.0752 kWp", 29.0752), ("48.491 kWp", 48.491), ("nessuna", None), (None, None),
], "double")
_golden("q24b_power_in_text", "N2.", numbers.power_in_text, [
    ("Impianto della potenza di 36,59 MW", 36.59), ("potenza nominale pari a 19.992,00 kWp", 19.992), ("da 5.000 kW e 7 MW", 7.0), ("MW: 12,5", 12.5), ("kWp 48.491,52", 48.49152), ("2.000 MW", 2.0), ("2000 MW", None), ("", None),
], "double")
_golden("q24c_italian_number", "N1.", numbers.italian_number, [("37.688,4", 37688.4), ("1,234.5", 1234.5), ("12,5", 12.5), ("12.5", 12.5), ("1.234.567", None), ("x", None)], "double")
_golden("q24d_number_in_text", "N4.", numbers.number_in, [("19.994,88", 19994.88), ("6'093.36", 6093.36), ("circa 1.234.567 m", 1234.567), ("-3,5", -3.5), ("", None)], "double")
_golden("q24e_title_power", "N5.", lambda c: numbers.title_power(F.substring_index(c, " ", 1), F.substring_index(c, " ", -1)), [
    ("130.000 kWp", 130.0), ("6.000 kWp", 6.0), ("4.495 kWp", 4.495), ("980.20 kWp", 0.9802), ("6'093.36 kWp", 6.09336), ("19,97 MW", 19.97), ("5000 kW", 5.0),
], "double")
_golden("q24f_title_powers", "N6.", lambda c: F.array_join(F.transform(numbers.title_powers(c), lambda x: F.round(x, 4).cast("string")), ";"), [("10,9326 MWp e 9,635 MW", "10.9326;9.635"), ("5 MW, 5.000 kWp e 5 MW", "5.0"), ("nulla", "")])
_golden("q24g_dashboard_number", "N7.", numbers.dashboard_number, [("1.234,5 MW", 1234.5), ("12,5", 12.5), ("12.5 mw", 12.5), ("n/d", None)], "double")
_golden("q24h_diff_number", "N8.", numbers.diff_number, [("1.234,5", 1234.5), ("1,234.5", 1234.5), ("EUR 12,5", 12.5), ("", None)], "double")
_golden("q24i_export_power", "N9.", numbers.export_power, [("5.000,5 kWp", 5.0005), ("12,5 MW", 12.5), ("", 0.0)], "double")
_golden("q24j_italian_format", "N10.", lambda c: numbers.italian_format(c.cast("double")), [("1234.567", "1.234,567"), ("0.5", "0,500"), ("1000000", "1.000.000,000")])
_golden("q42_status", "X23, T3: the literal order of rules.", text.status, [
    ("Procedura in corso", "in_corso"), ("CONCLUSA", "concluso"), ("archiviato", "archiviato"), ("parere sfavorevole", "positivo"), ("esito negativo", "negativo"), ("sospesa", "sospeso"), ("altro", "altro"), (" ", None),
])
_golden("q42b_status_corrected", "X23, T3: the corrected order.", lambda c: text.status(c, True), [("parere sfavorevole", "negativo"), ("non compatibile", "negativo"), ("favorevole", "positivo")])
_golden("q42c_project_type", "X21.", text.project_type, [("Impianto Agrivoltaico", "agrivoltaico"), ("parco fotovoltaico", "fotovoltaico"), ("BESS", "accumulo"), ("eolico", None)])
_golden("q42d_company", "F12.", bad_company_reason, [("12/03/2025", "date_only"), ("3 marzo 2024", "date_only"), ("123-45", "numeric_only"), ("Proponente", "administrative_label"), ("Dettaglio procedura", "administrative_fragment"), ("Dettaglio Solar srl", None), ("Sole S.r.l.", None)])
_golden("q42e_match_text", "X3.", text.match_text, [("Società Sole &amp; Vento S.r.l.", "societa sole e vento srl"), ("ENEL S.p.A.", "enel spa"), ("  Città–Nuova ", "citta nuova"), (None, "")])
_golden("q42f_slug", "X8.", text.slug, [("Parco  Solare (FG)", "parco-solare-fg"), ("A_b-C", "a_b-c")])
_golden("q42g_place_case", "X9.", text.place_case, [("SAN GIOVANNI IN FIORE", "San Giovanni in Fiore"), ("l'aquila", "L'Aquila"), ("REGGIO DI CALABRIA", "Reggio di Calabria")])
_golden("q42h_mojibake", "X6.", text.repair_mojibake, [("cittÃ\xa0 nuova", "città nuova"), ("perchÃ©", "perché"), ("ok", "ok")])
_golden("q42i_between", "X25.", lambda c: text.between(c, "Proponente", "Data"), [("Proponente: Sole srl Data pubblicazione", "Sole srl"), ("nulla", None)])
_golden("q42j_clean_text", "X5.", text.clean_text, [("  a \xa0 b ", "a b"), ("None", None), ("nan", None), ("x\x07y", "xy"), ("", None)])
_golden("q42k_list", "C1.", lambda c: text.join_list(text.split_list(c)), [("Troia; Lucera, troia | Foggia", "Troia, Lucera, Foggia"), (" ; ", None), ("Bari", "Bari")])
_golden("q42l_ellipsis", "P11.", lambda c: text.ellipsis(c, 5), [("abcdef", "abcd…"), ("abc", "abc")])
_golden("q43_dates", "D1.", dates.parse_date, [("03/02/2025", "2025-02-03"), ("03-02-2025", "2025-02-03"), ("2025-02-03", "2025-02-03"), ("31/02/2025", None), ("", None)], "date")
_golden("q43b_italian_dates", "D3.", dates.italian_date, [("12 marzo 2025", "2025-03-12"), ("il 1 Agosto 2024 alle 10", "2024-08-01"), ("2023", "2023-01-01"), ("boh", None)], "date")
_golden("q43c_year", "D2.", dates.year_in, [("anno 2024", 2024), ("12/03/25", 2025), ("1/2/99", 1999), ("no", None)], "int")
_golden("q43d_latest_date", "D4.", lambda c: dates.latest_date_in(c, F.lit("2025-06-30").cast("date")), [("dal 01/02/2024 al 3/4/2025", "2025-04-03"), ("01/01/2026", None), ("", None)], "date")
_golden("q43e_monthly_key", "D7.", lambda c: F.concat_ws(";", *(x.cast("string") for x in dates.monthly_key(c))), [("terna_2024_03_puglia", "terna_puglia;2024;3"), ("terna_puglia", "terna_puglia")])
_golden("q25b_specific_urls", "X10.", urls.specific_key, [
    ("https://www.x.it/a//b/?id=12&utm=1", "x.it/a/b?id=12"), ("http://x.it/p/progetto-123456", "x.it/p/progetto-123456"), ("http://x.it/ricerca/elenco2024", ""), ("http://x.it/", ""), ("http://x.it/a?Codice=A%20B&id=", "x.it/a?codice=a b"), ("", ""),
])
_golden("q25c_safe_urls", "F24.", urls.safe_url, [("https://x.it/a", "https://x.it/a"), ("javascript:alert(1)", ""), ("http://", ""), ("ftp://x", "")])
_golden("q25d_rewritten_urls", "X20.", lambda c: urls.rewrite(c, urls.NOTICE_RULES), [("https://x.it/avvisiPubblici?id=32", "https://x.it/avvisiPubblici/32"), ("https://x.it/a", "https://x.it/a")])
_golden("q44_is_aggregate", "F11, T10.", lambda c: is_aggregate(F.substring_index(c, ";", 1), F.substring_index(c, ";", -1), F.lit("")), [("terna;x", True), ("Terna Econnextion;x", True), ("lazio;rete esterna", False), ("x;Terna Econnextion Puglia", True)], "boolean")


@pytest.mark.parametrize("function, cases, kind", CASES)
def test_golden(spark, function, cases, kind):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(cases)], "i int, raw string").select("i", function(F.col("raw")).alias("value")).collect()
    want = {i: datetime.date.fromisoformat(c[-1]) if kind == "date" and c[-1] else c[-1] for i, c in enumerate(cases)}
    found = {r.i: r.value for r in rows}
    assert found.keys() == want.keys()
    for i, x in want.items():
        assert found[i] == (pytest.approx(x) if isinstance(x, float) else x), cases[i]

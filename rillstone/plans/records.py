"""Queries of the published record, extraction from texts, places and rules.

Texts are made of the driver's tables, one a row; the SQL makes none of them but computes what they were made of.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import extract, geo
from rillstone.functions.numbers import italian_format, parse_power
from rillstone.functions.text import match_text
from rillstone.operators import dedupe, publish, rules
from rillstone.operators.lineage import settle
from rillstone.plans.common import Registry, table

R = Registry()


def _pick(by: Column, *texts: str | None) -> Column:
    """One of several texts, by a number."""
    return F.get(F.array(*(F.lit(t).cast("string") for t in texts)), (by % len(texts)).cast("int"))


def _sql_pick(by: str, *texts: str | None) -> str:
    quoted = ", ".join("NULL" if t is None else "'" + t.replace("'", "''") + "'" for t in texts)
    return f"([{quoted}])[CAST({by} % {len(texts)} AS INTEGER) + 1]"


def _c(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


_SOURCES = ("MASE Provvedimenti", "toscana-atos", "Lazio", "Terna Econnextion", "", "ignota")
_REGIONS = ("emilia romagna", "VALLE D'AOSTA", "", "puglia", "atlantide grande")


def _raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k, _pick(k, *_SOURCES).alias("source"), F.when(k % 7 != 0, _c("Parco ", F.col("c_name"))).alias("title"), F.lit(" Sole  S.r.l. ").alias("proponent"), _pick(k, *_REGIONS).alias("region"), _pick(k, "FG", "", "Lecce", None).alias("province"),
        _pick(k, "Troia; Lucera", "").alias("municipalities"), F.lit("agrivoltaico").alias("project_type"), F.lit("In corso").alias("status"), F.when(k % 2 == 0, _c("https://x.it/", k)).otherwise("javascript:x").alias("url"), F.lit("2024-01-01").alias("updated_at"),
        _c(k % 500, ",5 MW").alias("power_mw"), F.when(k % 3 == 0, _c(k, " pratiche")).alias("numero_pratiche"),
    )


@R.query(f"""WITH r AS (SELECT c_custkey AS k, c_name, {_sql_pick("c_custkey", "mase_provvedimenti", "toscana_atos", "lazio", "terna_econnextion", "", "ignota")} AS s, {_sql_pick("c_custkey", "mase", "toscana", "lazio", "terna_econnextion", "nd", "ignota")} AS g,
  {_sql_pick("c_custkey", "MASE", "Toscana", "Lazio", "Terna Econnextion", "ND", "ignota")} AS l, {_sql_pick("c_custkey", "Emilia-Romagna", "Valle d'Aosta", None, "Puglia", "Atlantide Grande")} AS given, {_sql_pick("c_custkey", "FG", "", "Lecce", "")} AS p FROM customer),
f AS (SELECT *, coalesce(given, CASE WHEN p <> '' THEN 'Puglia' END, 'ND') AS region FROM r WHERE s <> '' OR k % 7 <> 0)
SELECT CASE WHEN s = '' THEN 'nd' ELSE s END AS source, g AS source_group, l AS source_label, CASE WHEN k % 7 <> 0 THEN 'Parco ' || c_name ELSE CASE WHEN s = '' THEN 'Fonte' ELSE l END || ' - ' || region || ' - agrivoltaico - In corso' END AS title, 'Sole S.r.l.' AS proponent,
  region, p AS province, CASE WHEN k % 2 = 0 THEN 'Troia; Lucera' ELSE '' END AS municipalities, 'agrivoltaico' AS project_type, k % 500 + 0.5::DOUBLE AS power_mw, 'In corso' AS status, CASE WHEN k % 2 = 0 THEN 'https://x.it/' || k ELSE '' END AS url, '2024-01-01' AS updated_at,
  CAST(CASE WHEN k % 3 = 0 THEN k ELSE 0 END AS INTEGER) AS numero_pratiche, s = 'terna_econnextion' AS is_terna, s <> 'terna_econnextion' AS is_punctual, false AS province_deduced, false AS municipalities_deduced FROM f""")
def q45_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 18 fields of a published record."""
    return publish.published(_raw_records(spark, sf_dir))


@R.query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'Calabria' WHEN 1 THEN CASE WHEN c_custkey % 2 = 0 THEN 'toscana_atos' ELSE 'toscana' END WHEN 2 THEN CASE WHEN c_custkey % 2 = 0 THEN 'toscana_atos' ELSE 'x' END WHEN 3 THEN CASE WHEN c_custkey % 2 = 0 THEN 'toscana_atos' ELSE 'Umbria' END ELSE CASE WHEN c_custkey % 2 = 0 THEN 'toscana_atos' ELSE 'mase' END END AS source,
  CASE WHEN c_custkey % 5 = 0 AND c_custkey % 2 = 1 THEN 'Calabria' WHEN c_custkey % 2 = 0 OR c_custkey % 5 = 1 THEN 'Toscana' WHEN c_custkey % 5 = 3 THEN 'Umbria' ELSE 'L' END AS source_label,
  CASE WHEN c_custkey % 5 IN (0, 3) AND c_custkey % 2 = 1 THEN 'Basilicata,y' ELSE 'basilicata,y' END AS merged FROM customer""".replace("CASE c_custkey % 5 WHEN 0 THEN 'Calabria'", "CASE c_custkey % 5 WHEN 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'toscana_atos' ELSE 'Calabria' END"))
def q45b_shown_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of regions, and of Tuscany's register by its page."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(
        k, _pick(k, "calabria", "toscana", "x", " Umbria", "mase").alias("source"), F.lit("g").alias("source_group"), F.lit("L").alias("source_label"), F.when(k % 2 == 0, _c("http://ATOS.arrr.it/scheda_impianto_fer?id=", k)).otherwise("http://x").alias("url"), F.array(F.lit("basilicata"), F.lit("y")).alias("merged_sources"),
    )
    return publish.shown_labels(rows).select("c_custkey", "source", "source_label", F.array_join("merged_sources", ",").alias("merged"))


@R.query("""SELECT p_partkey, concat_ws(' - ', CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN 'agrivoltaico' ELSE 'PAUR' END,
  CASE WHEN p_size % 7 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'FG' END ELSE array_to_string(list_transform(range(1, least(p_size % 7, 4) + 1), lambda i: 'Comune ' || i), ', ') || CASE WHEN p_size % 7 > 4 THEN '…' ELSE '' END END,
  CASE WHEN p_size % 4 = 0 THEN CAST(p_size // 4 AS VARCHAR) || ' MW' WHEN p_size % 4 = 2 THEN (p_size // 4) || '.5 MW' WHEN p_size % 4 = 1 THEN (p_size // 4) || '.25 MW' ELSE (p_size // 4) || '.75 MW' END) AS title FROM part""")
def q45c_operational_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who, where and how much."""
    k, n = F.col("p_partkey"), F.col("p_size") % 7
    towns = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: _c("Comune ", i))).otherwise(F.array().cast("array<string>"))
    title = extract.operational_title(F.when(k % 3 == 0, F.col("p_brand")).otherwise(""), towns, F.when(k % 2 == 0, "FG"), F.col("p_size") / 4, F.when(k % 3 == 1, "agrivoltaico"), F.lit("PAUR"), F.lit("x"))
    return table(spark, sf_dir, "part").select("p_partkey", title.alias("title"))


@R.query("""SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'codice:ab ' || c_custkey WHEN 1 THEN 'idprocedura:' || c_custkey WHEN 2 THEN 'mase:' || (c_custkey + 1000) WHEN 3 THEN 'mase:' || (c_custkey + 1000) ELSE '' END AS source_id FROM customer""")
def q46_source_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An identifier from fields, or from a ministry's title."""
    k = F.col("c_custkey")
    fields = {"codice": F.when(k % 5 == 0, _c("AB-", k)), "id_procedura": F.when(k % 5 == 1, k.cast("string")).when(k % 5 == 0, F.lit(" "))}
    title = F.when(k % 5 == 2, _c("Parco, codice procedura: ", k + 1000)).when(k % 5 == 3, _c("Parco [ID_", k + 1000, "] Sole")).otherwise(_c("Parco id 12 ", k))
    return table(spark, sf_dir, "customer").select("c_custkey", extract.source_identifier(fields, title, F.when(k % 5 == 4, F.lit("Lazio")).otherwise("MASE provvedimenti")).alias("source_id"))


@R.query("""SELECT c_custkey, CASE WHEN c_custkey % 7 = 6 THEN NULL ELSE c_name || ' S.r.l.' END AS company FROM customer""")
def q46b_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names in a register's wrappers, after a label, and before other labels."""
    k, name = F.col("c_custkey"), F.concat(F.col("c_name"), F.lit(" S.r.l."))
    forms = [_c("(Azienda: ", name, ")"), _c("(Persona  Fisica): ", name), _c("): ", name, " ;"), _c("Proponente: ", name, " Data pubblicazione: 01/02/2024"), _c("Società proponente - ", name, "  Tipologia VIA"), _c("  ", name, " – "), F.lit(" ; ")]
    raw = F.element_at(F.array(*forms), (k % 7 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", extract.clean_company(raw).alias("company"))


@R.query("""SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'table_row' WHEN 1 THEN 'sibling' END AS place, CASE c_custkey % 3 WHEN 0 THEN c_name || ' Sole spa' WHEN 1 THEN c_name END AS value FROM customer""")
def q46c_best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most trusted place, then the shortest name."""
    k, name = F.col("c_custkey"), F.col("c_name")
    one = lambda place, value: F.struct(F.lit(place).alias("place"), value.alias("value"))
    many = F.array(one("plain_text", F.lit("Sole")), one("sibling", _c(name, " Luna")), one("sibling", name), one("table_row", F.when(k % 3 == 0, _c("Proponente: ", name, " Sole spa"))))
    best = extract.best_candidate(F.when(k % 3 == 2, F.array(one("sibling", F.lit(" ; ")))).otherwise(many))
    return table(spark, sf_dir, "customer").select("c_custkey", best["place"].alias("place"), best["value"].alias("value"))


_LAZIO = (("Parere Favorevole con prescrizioni", "Favorevole con prescrizioni"), ("FAVOREVOLE", "Favorevole"), ("pratica archiviata", "Archiviato"), ("improcedibile", "Improcedibile"), ("Rinviata alla procedura di V.I.A.", "Rinviato a VIA"), ("escluso dal procedimento di VIA", "Escluso da VIA"), ("conclusa", "Concluso"), ("Procedimento in corso", "In corso"), ("altro", None))
_SARDEGNA = (("Riavvio dell'iter, favorevole", "Riavvio procedimento"), ("esito non compatibile", "Negativo"), ("Improcedibilità", "Improcedibile"), ("osservazioni pervenute", "Osservazioni pervenute"), ("richiesta di integrazioni", "Integrazioni"), ("La ditta ha depositato l'istanza", "Istanza depositata"), ("avvio del procedimento", "Avvio procedimento"), ("niente", None))
_PIEMONTE = (("2024-1/VIN", "Valutazione di incidenza"), ("2024-1/VAL", "VIA"), ("2024-1/ver", "Verifica"), ("2024-1/SPE", "Specificazione"), ("2024", "Piemonte SKVIA"), ("", None))


@R.query(f"""SELECT o_orderkey, {_sql_pick("o_orderkey", *(b for _, b in _LAZIO))} AS lazio, {_sql_pick("o_orderkey", *(b for _, b in _SARDEGNA))} AS sardegna, {_sql_pick("o_orderkey", *(b for _, b in _PIEMONTE))} AS piemonte FROM orders""")
def q46d_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes and procedures by a source's own words."""
    k = F.col("o_orderkey")
    raw = lambda cases: _c(_pick(k, *(a for a, _ in cases)), "; ", F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", extract.outcome(raw(_LAZIO)).alias("lazio"), extract.outcome(raw(_SARDEGNA), extract.SARDEGNA_OUTCOMES).alias("sardegna"), extract.procedure_of_code(_pick(k, *(a for a, _ in _PIEMONTE))).alias("piemonte")
    )


@R.query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'Parco agrivoltaico ' || c_name WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 'Impianto ' || c_name END AS listed,
  CASE WHEN c_custkey % 2 = 0 THEN 'Parco agrivoltaico ' || c_name ELSE 'Impianto di ' || c_name END AS detail, 'Verifica di Ottemperanza: Impianto di ' || c_name || ' Esito positivo' AS page FROM customer""")
def q46e_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Titles of lists and pages, those of a site's sections left out."""
    k, name = F.col("c_custkey"), F.col("c_name")
    listed = F.when(k % 4 == 0, _c("Parco agrivoltaico ", name, " - Dettaglio")).when(k % 4 == 1, "Provvedimenti 2026 - Valutazioni Ambientali").when(k % 4 == 2, "Dettaglio").otherwise(_c("  Impianto  ", name, " :"))
    plain = _c("Home Verifica di Ottemperanza: Impianto di ", name, "  Esito positivo")
    headings = F.array(F.lit("VAS VIA AIA"), F.lit("breve"), F.when(k % 2 == 0, _c("Parco agrivoltaico ", name)))
    return table(spark, sf_dir, "customer").select("c_custkey", extract.list_title(listed).alias("listed"), extract.detail_title(headings, plain).alias("detail"), extract.page_title(plain).alias("page"))


@R.query("""SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_size + 5.25::DOUBLE WHEN 1 THEN p_size + 1.0::DOUBLE WHEN 3 THEN p_size + 0.125::DOUBLE WHEN 4 THEN p_size + 2.5::DOUBLE END AS mw,
  CASE p_partkey % 3 WHEN 0 THEN format('{:.3f}', (p_partkey / 1000)::DOUBLE) WHEN 1 THEN p_size || '.500' ELSE '1' || lpad(CAST(p_size AS VARCHAR), 3, '0') || '.500' END AS legacy FROM part""")
def q46f_plant_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A plant's power beside a battery's; the old way of writing it."""
    k, n = F.col("p_partkey"), F.col("p_size")
    raw = F.element_at(F.array(
        _c("Impianto con sistema di accumulo da ", n, " MW e potenza fotovoltaica pari a ", n + 5, ",25 MWp"), _c("Parco da ", n + 1, " MW con BESS da 3 MW"), _c("BESS da ", n, " MW"),
        _c("superficie 12 ha, potenza nominale di ", n, ".125 kWp, da 77 MW"), _c("Lotto 4 da 9 kW, potenza complessiva ", n + 2, ",5 MW"),
    ), (k % 5 + 1).cast("int"))
    old = F.when(k % 3 == 0, _c("circa ", k, " kW")).when(k % 3 == 1, _c(n, ",5 MW")).otherwise(_c("1", F.lpad(n.cast("string"), 3, "0"), ".5 mw"))
    return table(spark, sf_dir, "part").select("p_partkey", parse_power(extract.plant_power(raw)).alias("mw"), extract.legacy_power(old).alias("legacy"))


@R.query("""SELECT p_partkey, p_name || ' da 25.751,04 kWp e ' || p_size || ' MW' AS title, p_name || ' 25.751,04 kWp' AS titles FROM part""")
def q46g_edited_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A unit put right in a title, and in the titles that were merged into it."""
    edits = [(r"(?i)25\.751,04\s*MW\b", "25.751,04 kWp")]
    name = F.col("p_name")
    titles = F.array(_c(name, " 25.751,04 MW"), _c(name, " 25.751,04 kWp"))
    return table(spark, sf_dir, "part").select("p_partkey", extract.edited_title(_c(name, " da 25.751,04 mw e ", F.col("p_size"), " MW"), edits).alias("title"), F.array_join(extract.edited_titles(titles, edits), "|").alias("titles"))


_PLACES = (
    ("Impianto nel comune di Troia (FG), località Monte", "FG", "Troia"), ("Parco (LE) in più comuni", "LE", ""), ("in provincia di Reggio Calabria, zona industriale", "RC", ""), ("Connessione (ZZ) e comune di Craco (MT) e altro", "MT", "Craco"),
    ("nei Comuni di Troia, Lucera ed Orsara di Puglia, provincia di Foggia", "FG", "Troia,Lucera,Orsara di Puglia"), ("Gravina in Puglia, città metropolitana di Bari", "BA", "Gravina in Puglia"), ("nel territorio comunale di Melfi, denominato Sole 2", None, "Melfi"),
    ("codice (AB) senza luogo", None, ""), ("comune di impianto fotovoltaico 12", None, ""),
)


@R.query(f"""SELECT c_custkey, {_sql_pick("c_custkey", *(b for _, b, _ in _PLACES))} AS province, {_sql_pick("c_custkey", *(t for *_, t in _PLACES))} AS towns FROM customer""")
def q47_places_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The province and the municipalities that a text names."""
    raw = _c(_pick(F.col("c_custkey"), *(a for a, *_ in _PLACES)), ". ", F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", geo.province_in_text(raw).alias("province"), F.array_join(geo.municipalities(raw), ",").alias("towns"))


@R.query("""WITH g AS (SELECT n_nationkey, lower(n_name) AS name FROM nation WHERE length(n_name) >= 4),
x AS (SELECT c_custkey, c_nationkey AS a, (c_nationkey + 3) % 25 AS b, c_custkey % 3 AS m FROM customer)
SELECT c_custkey, array_to_string(list_transform(list_sort(list({'n': -length(name), 'i': i, 'name': name})), lambda t: t.name), ',') AS towns FROM (
  SELECT c_custkey, name, 1 AS i FROM x JOIN g ON n_nationkey = a WHERE m <> 1 UNION ALL SELECT c_custkey, name, 9 FROM x JOIN g ON n_nationkey = b WHERE m <> 2) GROUP BY c_custkey""")
def q47b_gazetteer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of a gazetteer anywhere in a text; not those of provinces and page furniture."""
    nations = table(spark, sf_dir, "nation")
    gazetteer = nations.select(F.replace(F.lower("n_name"), F.lit("_"), F.lit(" ")).alias("key"), F.lower("n_name").alias("comune"))
    k = F.col("c_custkey")
    name = lambda n, x: nations.select(F.col("n_nationkey").alias(n), F.replace("n_name", F.lit("_"), F.lit(" ")).alias(x))
    rows = table(spark, sf_dir, "customer").withColumn("other", (F.col("c_nationkey") + 3) % 25).join(name("c_nationkey", "a"), "c_nationkey").join(name("other", "b"), "other")
    text = _c(F.when(k % 3 == 1, F.lit("provincia di ")).otherwise("presso "), F.col("a"), ", sette parole che stanno tra i nomi; ", F.col("b"), F.when(k % 3 == 2, F.lit(" dettaglio valutazioni")).otherwise(" e basta"))
    found = geo.gazetteer_scan(rows.select("c_custkey", text.alias("text")), gazetteer, "c_custkey", "text")
    return found.select("c_custkey", F.array_join("municipalities", ",").alias("towns"))


@R.query("""SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'FG' WHEN 1 THEN 'LE' WHEN 2 THEN 'MT' END AS province, CASE c_custkey % 4 WHEN 0 THEN 'Troia' WHEN 1 THEN 'Nardò' WHEN 2 THEN 'Craco' ELSE '' END AS towns FROM customer""")
def q47c_ministry_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The title, then the information sheet, then the row."""
    k = F.col("c_custkey")
    title = F.when(k % 4 == 0, _c("Parco nel comune di Troia (FG) ", F.col("c_name"))).otherwise(_c("Parco ", F.col("c_name")))
    info = F.when(k % 4 == 1, F.array(F.lit("Nardò"))).otherwise(F.array().cast("array<string>"))
    place = geo.ministry_place(title, F.when(k % 4 == 2, "comune di Craco (MT)").otherwise(""), F.when(k % 4 <= 1, "Lecce").otherwise(""), info)
    return table(spark, sf_dir, "customer").select("c_custkey", place["province"].alias("province"), F.array_join(place["municipalities"], ",").alias("towns"))


def _ministry_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("row_idx"), _pick(k, "mase", "lazio", "x", "x", "lazio").alias("source"), F.when(k % 5 == 2, "mase").alias("source_group"), F.lit(None).cast("string").alias("source_label"), F.when(k % 5 == 3, F.array(F.lit("y"), F.lit("mase_provvedimenti"))).alias("merged_sources"),
        F.when(k % 2 == 0, F.col("c_name")).otherwise("Proponente").alias("proponent"), _c("http://x/", k % 100).alias("url"),
    )


@R.query("""SELECT c_custkey AS row_idx FROM customer WHERE c_custkey % 5 IN (0, 2, 3)""")
def q48_ministry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """records of the ministry, merged ones among them."""
    return _ministry_records(spark, sf_dir).where(publish.of_ministry()).select("row_idx")


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's company for two of three URLs; some pages were landed twice."""
    n = F.col("s_suppkey") % 100
    return table(spark, sf_dir, "supplier").select(_c("http://x/", n).alias("url"), F.when(n % 3 != 0, _c("Proponente: Sole ", n, " S.r.l.")).otherwise("12/03/2024").alias("candidate"))


@R.query("""WITH s AS (SELECT DISTINCT s_suppkey % 100 AS n FROM supplier), t AS (SELECT c_custkey, c_name, c_custkey % 100 AS n, c_custkey % 5 IN (0, 2, 3) AND c_custkey % 2 = 1 AS target FROM customer)
SELECT c_custkey AS row_idx, CASE WHEN target AND s.n % 3 <> 0 THEN 'Sole ' || t.n || ' S.r.l.' WHEN c_custkey % 2 = 0 THEN c_name ELSE 'Proponente' END AS proponent FROM t LEFT JOIN s ON s.n = t.n""")
def q48b_found_proponents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Companies of the ministry's records from their pages, each page read once."""
    return publish.with_found_proponents(_ministry_records(spark, sf_dir), _found(spark, sf_dir))[0].select("row_idx", "proponent")


@R.query("""WITH s AS (SELECT DISTINCT s_suppkey % 100 AS n FROM supplier), t AS (SELECT c_custkey % 100 AS n, c_custkey % 5 IN (0, 2, 3) AND c_custkey % 2 = 1 AS target FROM customer), j AS (SELECT target, target AND coalesce(s.n % 3 <> 0, false) AS applied FROM t LEFT JOIN s ON s.n = t.n)
SELECT count(*) FILTER (target) AS targets, count(*) FILTER (applied) AS recovered, count(*) FILTER (target AND NOT applied) AS failed, count(*) FILTER (target AND NOT applied) AS still_missing FROM j""")
def q48c_proponent_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was looked for, found, and is still missing."""
    return publish.with_found_proponents(_ministry_records(spark, sf_dir), _found(spark, sf_dir))[2]


@R.query("""WITH l AS (SELECT s_suppkey AS layer_id, s_suppkey % 40 AS id, s_suppkey // 4 AS codproc, 'P' || s_suppkey AS proponent FROM supplier), r AS (SELECT c_custkey AS k, c_custkey % 60 AS id, c_custkey // 6 AS codproc, c_name FROM customer),
a AS (SELECT k, min(layer_id) AS v FROM r JOIN l ON r.id = l.id AND r.codproc = l.codproc GROUP BY k HAVING count(*) = 1), b AS (SELECT k, min(layer_id) AS v FROM r JOIN l ON r.id = l.id GROUP BY k HAVING count(*) = 1),
c AS (SELECT k, min(layer_id) AS v FROM r JOIN l ON r.codproc = l.codproc GROUP BY k HAVING count(*) = 1)
SELECT r.k AS row_idx, CASE WHEN r.k % 2 = 0 THEN c_name ELSE coalesce('P' || coalesce(a.v, b.v, c.v), '') END AS proponent, CASE WHEN a.v IS NOT NULL THEN 'id_codproc' WHEN b.v IS NOT NULL THEN 'id' WHEN c.v IS NOT NULL THEN 'codproc' END AS match_mode
FROM r LEFT JOIN a USING (k) LEFT JOIN b USING (k) LEFT JOIN c USING (k)""")
def q48d_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landed layer fills what a record lacks, where one row of it is meant."""
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    records = table(spark, sf_dir, "customer").select(k.alias("row_idx"), (k % 60).alias("id"), F.floor(k / 6).alias("codproc"), F.when(k % 2 == 0, F.col("c_name")).otherwise("").alias("proponent"), F.lit("").alias("province"), F.lit("").alias("municipality"))
    layer = table(spark, sf_dir, "supplier").select(s.alias("layer_id"), (s % 40).alias("id"), F.floor(s / 4).alias("codproc"), _c("P", s).alias("proponent"), F.lit("PA").alias("province"), F.lit("Enna").alias("municipality"))
    return publish.with_layer(records, layer).select("row_idx", F.coalesce("proponent", F.lit("")).alias("proponent"), "match_mode")


@R.query("""SELECT n_nationkey AS id, 'http://x/p/' || n_nationkey AS url, 'Impianto fotovoltaico ' || n_name || ' da ' || (n_nationkey + 1) || ',5 MWp' AS title, (n_nationkey + 1) || ',5 MWp' AS power_raw FROM nation""")
def q48e_candidate_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of a page whose text names a plant that isn't past."""
    from rillstone.sources.html import parsed

    k, name = F.col("n_nationkey"), F.col("n_name")
    html = _c("<html><body><a href='/p/", k, "'>Impianto fotovoltaico ", name, " da ", k + 1, ",5 MWp</a><a href='/q'>Parco solare archiviato</a><a href='/r'>Contatti</a></body></html>")
    pages = parsed(table(spark, sf_dir, "nation").select(k.alias("id"), html.alias("html"), _c("http://x/", k).alias("url")))
    found = publish.candidate_links(pages)
    return found.select(F.substring_index("source_page", "/", -1).cast("int").alias("id"), "url", "title", "power_raw")


_WORKS = ("Impianto agrivoltaico {}", "fotovoltaico {} su copertura", "Sistema di accumulo {}", "BESS nella centrale {}", "{} eolico", "Parco fv {}")


@R.query(f"""SELECT p_partkey, {_sql_pick("p_partkey", *("yes" if i in (0, 3, 5) else "no" for i in range(6)))} = 'yes' AS commercial FROM part""")
def q48f_commercial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """plants and stores that are works of their own."""
    k = F.col("p_partkey")
    title = F.element_at(F.array(*(_c(*(x for part in zip(w.split("{}"), [F.col("p_name"), ""]) for x in part if not isinstance(x, str) or x)) for w in _WORKS)), (k % 6 + 1).cast("int"))
    return table(spark, sf_dir, "part").select("p_partkey", publish.is_commercial(title, publish.COMMERCIAL_CORE, publish.COMMERCIAL_STORAGE, publish.COMMERCIAL_EXCLUDED, publish.COMMERCIAL_STRONG).alias("commercial"))


@R.query("""SELECT p_partkey, CASE WHEN p_partkey IN (3, 8) THEN 'Alta ' || p_partkey WHEN contains(p_name, 'red') AND contains(p_name, 'bolt') THEN 'Rosso srl' ELSE p_brand END AS proponent FROM part
WHERE p_partkey IN (3, 8) OR (contains(p_name, 'red') AND contains(p_name, 'bolt')) OR NOT contains(p_name, 'ring')""")
def q48g_rule_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An inventory of rules as a table, applied."""
    inventory = publish.rule_table(spark, {f"https://x.it/Info/?id={i}": f"Alta {i}" for i in (3, 8)}, [(("red", "bolt"), "Rosso srl")], [("ring",)])
    key = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("proponent"), match_text(F.col("p_name")).alias("words"), _c("x.it/info?id=", key).alias("url_key"))
    return rules.apply_overrides(rows, inventory, "p_partkey", "words", "url_key", ("proponent",))[0].select("p_partkey", "proponent")


def _evidence_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as records with URLs, identifiers, a ministry's sources and provinces."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("row_idx"), _c("Parco ", F.lower("c_mktsegment"), " ", k % 97).alias("title"), _pick(k, "mase", "mase_provvedimenti", "lazio").alias("source"), F.when(k % 4 == 0, _c("http://x.it/p?id=", F.floor(k / 8))).otherwise("").alias("url"), F.lit("Puglia").alias("region"),
        _pick(F.col("c_nationkey"), "RM", "VT", "FG", "BA", "LE").alias("province"), F.lit("").alias("municipality"), _c("Sole ", k % 50).alias("proponent"), (k % 7 + 1.0).alias("mw"), F.when(k % 5 == 0, _c("codice:", F.floor(k / 10))).alias("source_id"),
    )


@R.query("""WITH c AS (SELECT c_custkey AS i, 'parco ' || lower(c_mktsegment) || ' ' || (c_custkey % 97) AS t, lower(c_mktsegment) AS seg, ['mase', 'mase provvedimenti', 'lazio'][CAST(c_custkey % 3 AS INTEGER) + 1] AS s, CASE WHEN c_custkey % 4 = 0 THEN 'u' || (c_custkey // 8) END AS u,
  CAST(c_nationkey % 5 AS VARCHAR) AS p, 'sole ' || (c_custkey % 50) AS o, c_custkey % 7 + 1.0::DOUBLE AS mw, CASE WHEN c_custkey % 5 = 0 THEN 'c' || (c_custkey // 10) END AS d FROM customer),
k AS (SELECT i, 'u' || u AS k FROM c WHERE u IS NOT NULL UNION ALL SELECT i, 'd' || d FROM c WHERE d IS NOT NULL UNION ALL SELECT i, 't' || t FROM c UNION ALL SELECT i, 'm' || t || '/' || mw FROM c UNION ALL SELECT i, 'p' || p || '/' || mw FROM c WHERE s LIKE 'mase%'),
z AS (SELECT k FROM k GROUP BY k HAVING count(*) BETWEEN 2 AND 80), q AS (SELECT DISTINCT x.i AS a, y.i AS b FROM k x JOIN k y ON x.k = y.k AND x.i < y.i JOIN z ON z.k = x.k),
j AS (SELECT a, b, x.p <> y.p AS far, abs(x.mw - y.mw) / greatest(x.mw, y.mw, 1) AS gap, coalesce(x.u = y.u, false) AS su, coalesce(x.d = y.d, false) AS sd, x.t = y.t AS st, x.seg = y.seg AS sg, x.o = y.o AS so, x.s LIKE 'mase%' OR y.s LIKE 'mase%' AS em, x.s LIKE 'mase%' AND y.s LIKE 'mase%' AND x.s <> y.s AS cr
  FROM q JOIN c x ON x.i = a JOIN c y ON y.i = b),
e AS (SELECT *, cr AND so AND NOT far AND gap <= 0.025 AND (st OR sg) AS cross_ FROM j),
f AS (SELECT *, CASE WHEN far THEN 'province_conflict' WHEN gap > 0.035 THEN 'mw_conflict' END AS conflict, CASE WHEN su THEN 85 ELSE 0 END + CASE WHEN sd THEN 90 ELSE 0 END + CASE WHEN st THEN 105 ELSE 0 END + CASE WHEN so THEN 20 ELSE 0 END + 8
  + CASE WHEN gap <= 0.025 THEN 15 ELSE 0 END + CASE WHEN sg THEN 15 ELSE 0 END + CASE WHEN em AND st AND gap <= 0.025 THEN 15 ELSE 0 END + CASE WHEN cross_ THEN 25 ELSE 0 END AS points FROM e)
SELECT a AS idx_a, b AS idx_b, CAST(CASE WHEN conflict IS NULL THEN points ELSE 0 END AS INTEGER) AS score, conflict IS NULL AND (points >= 90 OR (st AND points >= 75) OR (cross_ AND points >= 75)) AS merge, conflict FROM f""")
def q28c_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks by URL, identifier, title and a ministry's power; their evidence, and conflicts of province and power."""
    canon = settle(dedupe.canonical(_evidence_records(spark, sf_dir)))
    scored = dedupe.score_pairs(canon, dedupe.candidate_pairs(canon), use_similarity=False)
    return scored.select("idx_a", "idx_b", "score", "merge", F.when(F.contains("reason", F.lit("conflict")), F.col("reason")).alias("conflict"))


QUERIES, ORACLES = R.queries, R.oracles

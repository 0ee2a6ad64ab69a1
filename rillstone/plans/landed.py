"""Queries of sources and sinks (S2-S24, K4-K18, P2, P3, P10, D5, F13, F14, J12, M5, M14): pages are made of the driver's tables, and what is written is read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import dates, text
from rillstone.operators import dedupe, rules
from rillstone.operators.lineage import fresh_folder
from rillstone.plans.common import Registry, table
from rillstone.sources import collectors, readers, sinks

R = Registry()


def _c(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


#: Where each source's plants lie, if not in Foggia.
_PROVINCE = {"umbria": "TR", "basilicata": "MT", "toscana_atos": "LU"}
_REASON = {"toscana_atos": "title_indicates_eolico"}


def _page(spec: collectors.Spec, k: Column) -> tuple[Column, Column]:
    """The page and the cells of a landed item: a plant, another work, or nothing that names a project."""
    code = _PROVINCE.get(spec.name, "FG")
    other = "Parco eolico " if spec.parser == "script" else "Strada comunale "
    title = F.when(k % 3 == 0, _c("Impianto fotovoltaico Sole ", k, f" da 10,5 MW nel comune di Troia ({code})")).when(k % 3 == 1, _c(other, k)).otherwise("")
    company = _c("Sole ", k, " srl")
    no_cells = F.lit(None).cast("map<string,string>")
    if spec.parser == "cells":
        cells = F.create_map(*(x for name, v in (("Oggetto", title), ("Proponente", company), ("Data", F.lit("12/03/2025")), ("Comune", F.lit("Troia")), ("Provincia", F.lit(code)), ("Potenza", F.lit("10,5 MW"))) for x in (F.lit(name), v)))
        return F.lit(None).cast("string"), cells
    if spec.parser == "lines":
        return _c("<html><body><p>Titolo: ", title, "</p><p>Proponente: ", company, f"</p><p>Comune: Troia</p><p>Provincia: {code}</p><p>Data: 12/03/2025</p><p>Potenza: 10,5 MW</p><p>Stato: in corso</p></body></html>"), no_cells
    if spec.parser == "links":
        return _c("<html><body><a href='/p/", k + 100, "'>", title, "</a></body></html>"), no_cells
    if spec.parser == "script":
        return _c(f"<script>const {spec.script} = [['", title, "', '", company, f"', 'Autorizzato', '10,5 MW', '01/02/2025', 'Lucca', '{code}', 'FOTOVOLTAICO']];</script>"), no_cells
    head = "".join(f"<th>{x}</th>" for x in ("Progetto", "Proponente", "Procedura", "Stato", "Data di presentazione"))
    return _c(f"<table><tr>{head}</tr><tr><td>", title, "</td><td>", company, "</td><td>VIA</td><td>in corso</td><td>12/03/2025</td></tr></table>"), no_cells


def _collected(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> DataFrame:
    """What each source makes of a page per supplier: kept with its fields, or why it was rejected."""
    out = []
    for name in names:
        spec = collectors.SPECS[name]
        k = F.col("s_suppkey")
        page, cells = _page(spec, k)
        landed = table(spark, sf_dir, "supplier").select(k.alias("row_idx"), _c("http://x/p/", k + 100).alias("url"), page.alias("html"), cells.alias("cells"))
        kept, rejected = collectors.collect(landed, spec, F.lit("2025-06-30").cast("date"))
        ident = (F.regexp_extract("source_url", "([0-9]+)$", 1).cast("long") - 100).alias("id")
        out.append(kept.select(F.lit(name).alias("source"), ident, F.lit("kept").alias("outcome"), "title", "power_mw"))
        out.append(rejected.select(F.lit(name).alias("source"), ident, F.col("reason").alias("outcome"), F.lit(None).cast("string").alias("title"), F.lit(None).cast("double").alias("power_mw")))
    return reduce(DataFrame.unionByName, out)


def _collected_sql(names: tuple[str, ...]) -> str:
    rows = ", ".join(f"('{n}', '{_PROVINCE.get(n, 'FG')}', '{_REASON.get(n, 'not_relevant')}')" for n in names)
    return f"""SELECT source, s_suppkey AS id, CASE s_suppkey % 3 WHEN 0 THEN 'kept' WHEN 1 THEN reason ELSE 'no_title' END AS outcome,
  CASE WHEN s_suppkey % 3 = 0 THEN 'Impianto fotovoltaico Sole ' || s_suppkey || ' da 10,5 MW nel comune di Troia (' || code || ')' END AS title, CASE WHEN s_suppkey % 3 = 0 THEN 10.5::DOUBLE END AS power_mw
FROM supplier, (VALUES {rows}) AS v(source, code, reason)"""


_OF_TABLES, _OF_LINES = ("mase", "sardegna", "piemonte", "campania", "basilicata"), ("mase_provvedimenti", "emilia_romagna", "sistema_puglia_energia", "lazio", "calabria", "umbria")
_OF_CELLS, _OF_LINKS = ("lombardia", "sicilia", "puglia", "toscana"), ("veneto", "toscana_atos")


@R.query(_collected_sql(_OF_TABLES))
def q49_table_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that publish tables."""
    return _collected(spark, sf_dir, _OF_TABLES)


@R.query(_collected_sql(_OF_LINES))
def q49b_line_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that publish labels and values."""
    return _collected(spark, sf_dir, _OF_LINES)


@R.query(_collected_sql(_OF_CELLS))
def q49c_cell_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources that publish files and services."""
    return _collected(spark, sf_dir, _OF_CELLS)


@R.query(_collected_sql(_OF_LINKS))
def q49d_link_and_script_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of links, and an array in a script."""
    return _collected(spark, sf_dir, _OF_LINKS)


@R.query("""SELECT 'terna_econnextion_2025_03_' || lower(n_name) || '_solare_in_corso' AS external_id, n_nationkey + 0.5::DOUBLE AS power_mw, CAST(n_nationkey AS INTEGER) AS practices FROM nation WHERE n_nationkey % 4 <> 3""")
def q49e_market_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest month's solar aggregates."""
    k = F.col("n_nationkey")
    cells = lambda month: F.create_map(*(x for n, v in (("Regione", F.lower("n_name")), ("Fonte", F.when(k % 4 == 3, "Eolico").otherwise(" Solare")), ("Stato Connessione", F.lit("In corso")), ("Potenza (MW)", _c(k, ",5")), ("Numero Pratiche", k.cast("string"))) for x in (F.lit(n), v)))
    rows = reduce(DataFrame.unionByName, (table(spark, sf_dir, "nation").select(cells(m).alias("cells"), F.lit(2025).alias("year"), F.lit(m).alias("month")) for m in (1, 3)))
    return collectors.market_statistics(readers.latest_month(rows, "year", "month")).select("external_id", "power_mw", "practices")


@R.query("""SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || ', "' || p_brand || '"' AS p_name, CAST(p_size AS VARCHAR) AS p_size FROM part""")
def q50_csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report with quotes and separators in its values, read back by the separator that its first line shows."""
    path = fresh_folder(spark, "report")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit(', "'), "p_brand", F.lit('"')).alias("p_name"), "p_size")
    sinks.write_report_csv(rows, path, sep=";", one_file=False, quote_all=True)
    return readers.read_csv(spark, path, sep=readers.sniff_separator(spark, path))


@R.query("""SELECT p_partkey, p_size + 1 AS p_size FROM part""")
def q50b_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions are written, the newest is read, older ones go."""
    root = fresh_folder(spark, "versions")
    rows = table(spark, sf_dir, "part").select("p_partkey", "p_size")
    sinks.write_version(rows, root, "2024-01")
    sinks.write_version(rows.withColumn("p_size", F.col("p_size") + 1), root, "2024-02")
    sinks.prune_versions(spark, root, 1)
    return sinks.current_version(spark, root)


@R.query("""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 2 = 0 THEN 'first' ELSE 'second' END AS run FROM orders""")
def q50c_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit rows appended run by run."""
    path = fresh_folder(spark, "audit")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    for i, run in enumerate(("first", "second")):
        sinks.append_audit(rows.where(F.col("o_orderkey") % 2 == i), path, F.lit(run))
    return spark.read.parquet(path)


@R.query("""SELECT n_nationkey, n_name FROM nation""")
def q50d_json_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document, and the records in it."""
    path = fresh_folder(spark, "document")
    text_ = sinks.document({"summary": {"n": 25}, "records": table(spark, sf_dir, "nation").select("n_nationkey", "n_name")})
    spark.createDataFrame([(text_,)], "value string").coalesce(1).write.text(path)
    return readers.read_document(spark, path).select(F.col("n_nationkey").cast("int").alias("n_nationkey"), "n_name")


@R.query("""SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, regexp_replace(translate(format('{:,.3f}', o_totalprice), ',.', '.,'), ',?0+$', '') AS o_totalprice, o_orderpriority || ' x' AS o_orderpriority FROM orders""")
def q50e_client_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows as a client reads them."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.concat("o_orderpriority", F.lit("\r\nx")).alias("o_orderpriority"))
    return sinks.client_rows(rows, ["o_totalprice"])


@R.query("""SELECT 'Parco ' || c_name AS project_name, c_mktsegment AS source FROM customer""")
def q50f_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot with the columns that it must have."""
    path = fresh_folder(spark, "snapshot")
    given = {"project_name": F.concat(F.lit("Parco "), "c_name"), "source": F.col("c_mktsegment")}
    rows = table(spark, sf_dir, "customer").select(*(given.get(c, F.lit("x")).alias(c) for c in readers.SNAPSHOT_COLUMNS))
    sinks.write_report_csv(rows, path)
    return readers.read_snapshot(spark, readers.newest(spark, path)).select("project_name", "source")


@R.query("""SELECT replace(lower(n_name), '_', '') AS key, n_name AS comune, 'P' || n_regionkey AS sigla FROM nation""")
def q50g_municipality_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gazetteer from columns of either naming, one row of a key."""
    rows = table(spark, sf_dir, "nation").select(F.col("n_name").alias("Denominazione in italiano"), F.concat(F.lit("P"), F.col("n_regionkey").cast("string")).alias("Sigla automobilistica"))
    return readers.municipality_table(rows.unionByName(rows)).select("key", "comune", "sigla")


@R.query("""SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS title, CAST(c_acctbal AS VARCHAR) = '' AS no_power, CASE WHEN c_custkey % 3 = 0 THEN 'Lazio' END AS region FROM customer""")
def q51_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields under any of their names."""
    k = F.col("c_custkey")
    rows = table(spark, sf_dir, "customer").select(k, F.when(k % 2 == 0, F.col("c_name")).otherwise(" ").alias("Project Name"), F.col("c_mktsegment").alias("TITOLO"), F.col("c_acctbal").alias("Potenza_MW"), F.when(k % 3 == 0, F.lit("Lazio")).alias("Regione"))
    aliases = {**readers.ALIASES, "c_custkey": ("c_custkey",), "title": ("project_name", "titolo")}
    return readers.resolve_aliases(rows, aliases).select(F.col("c_custkey").cast("long").alias("c_custkey"), "title", (F.col("mw") == "").alias("no_power"), "region")


@R.query("""SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 24 MONTH AS DATE) AS cutoff, substr(o_orderpriority, 1, 3) AS short FROM orders""")
def q51b_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """So many months before a date; texts cut."""
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.cutoff(F.col("o_orderdate").cast("date")).alias("cutoff"), text.truncate(F.col("o_orderpriority"), 3).alias("short"))


@R.query("""SELECT c_custkey, c_custkey % 5 <= 1 AS company, c_custkey % 5 IN (2, 3) AS bad FROM customer""")
def q51c_companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """what may be a company, and what can't."""
    k = F.col("c_custkey")
    raw = F.element_at(F.array(F.col("c_name"), _c("solare ", k, " srl"), _c(k % 28 + 1, "/03/2024"), F.lit("Proponente"), F.lit("ab")), (k % 5 + 1).cast("int"))
    return table(spark, sf_dir, "customer").select("c_custkey", rules.looks_like_company(raw).alias("company"), rules.bad_company_reason(raw).isNotNull().alias("bad"))


@R.query("""SELECT o_orderkey, CASE WHEN c_custkey % 2 = 0 THEN c_name ELSE o_orderstatus END AS shown FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def q51d_detail_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list with its detail pages; what the detail tells counts."""
    detail = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).otherwise(" ").alias("detail"))
    return table(spark, sf_dir, "orders").join(detail, "o_custkey", "left").select("o_orderkey", text.first_present(F.col("detail"), F.col("o_orderstatus")).alias("shown"))


@R.query("""SELECT p_partkey, p_retailprice AS mw FROM part ORDER BY p_retailprice DESC, p_name || ' ' || p_partkey LIMIT 50""")
def q51e_final_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first fifty of the final order: aggregates last, the largest first, then by title."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_retailprice").alias("mw"), F.concat_ws(" ", "p_name", "p_partkey").alias("title_norm"), F.lit(False).alias("is_aggregate"))
    return rows.orderBy(*dedupe.final_order()).limit(50).select("p_partkey", "mw")


QUERIES, ORACLES = R.queries, R.oracles

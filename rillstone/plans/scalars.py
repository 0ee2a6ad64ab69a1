"""Queries of scalar functions (N, X, D, C, P) over the driver's tables: texts are made of the rows, and the SQL computes what the functions read in them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions import dates, numbers, text, urls
from rillstone.operators.rules import bad_company_reason, is_aggregate
from rillstone.plans.common import Registry, table

R = Registry()


def _over(name: str, doc: str, of: str, key: str, raw: Callable[[], Column], function, sql_raw: str, sql_value: str) -> None:
    """Register a query that applies a function to a text made of each row of a table; the SQL makes the same text and computes the value its own way."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = table(spark, sf_dir, of).select(key, raw().alias("raw"))
        return rows.select(key, "raw", function(F.col("raw")).alias("value"))

    query.__name__, query.__doc__ = name, doc
    R.query(f"SELECT {key}, raw, {sql_value} AS value FROM (SELECT *, {sql_raw} AS raw FROM {of})")(query)


def _c(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def _pick(by: Column, *texts: str) -> Column:
    """One of several texts, by a number."""
    return F.element_at(F.array(*map(F.lit, texts)), (by % len(texts) + 1).cast("int"))


def _sql_pick(by: str, *texts: str) -> str:
    quoted = ", ".join("'" + t.replace("'", "''") + "'" for t in texts)
    return f"([{quoted}])[CAST({by} % {len(texts)} AS INTEGER) + 1]"


def _it(c: Column, n: int) -> Column:
    return numbers.italian_format(c, n)


def _sql_it(x: str, n: int) -> str:
    return f"translate(format('{{:,.{n}f}}', {x}), ',.', '.,')"


def _round(c: Column, n: int) -> Column:
    """As SQL rounds a double: the double itself times a power of ten, not its shortest decimal, in which 136.295 is a tie."""
    return F.round(c * 10**n) / 10**n



_over("q24_power", "N3: prices written as kilowatts in the Italian way, and as megawatts.", "orders", "o_orderkey", lambda: F.when(F.col("o_orderkey") % 2 == 0, _c(_it(F.col("o_totalprice"), 2), " kWp")).otherwise(_c("MW ", F.replace(F.format_string("%.2f", _round(F.col("o_totalprice") / 1000, 2)), F.lit("."), F.lit(",")))),
  numbers.parse_power, f"CASE WHEN o_orderkey % 2 = 0 THEN {_sql_it('o_totalprice', 2)} || ' kWp' ELSE 'MW ' || replace(format('{{:.2f}}', round(o_totalprice / 1000, 2)), '.', ',') END",
  "CASE WHEN o_orderkey % 2 = 0 THEN round(round(o_totalprice, 2) / 1000, 6) ELSE round(o_totalprice / 1000, 2) END")
_over("q24b_power_in_text", "N2.", "part", "p_partkey", lambda: F.when(F.col("p_partkey") % 3 == 0, _c("Impianto della potenza di ", F.col("p_size"), ",5 MW")).when(F.col("p_partkey") % 3 == 1, _c("da ", F.col("p_size"), "00 kW e altro")).otherwise(_c("MW: ", F.col("p_size") + 2000)),
  numbers.power_in_text, "CASE p_partkey % 3 WHEN 0 THEN 'Impianto della potenza di ' || p_size || ',5 MW' WHEN 1 THEN 'da ' || p_size || '00 kW e altro' ELSE 'MW: ' || (p_size + 2000) END",
  "CASE p_partkey % 3 WHEN 0 THEN p_size + 0.5::DOUBLE WHEN 1 THEN p_size / 10 END")
_over("q24c_italian_number", "N1.", "orders", "o_orderkey", lambda: F.when(F.col("o_orderkey") % 2 == 0, _it(F.col("o_totalprice"), 2)).otherwise(_c(F.col("o_orderkey"), ".5")), numbers.italian_number,
  f"CASE WHEN o_orderkey % 2 = 0 THEN {_sql_it('o_totalprice', 2)} ELSE o_orderkey || '.5' END", "CASE WHEN o_orderkey % 2 = 0 THEN round(o_totalprice, 2) ELSE o_orderkey + 0.5::DOUBLE END")
_over("q24d_number_in_text", "N4.", "orders", "o_orderkey", lambda: _c("circa ", F.replace(_it(F.col("o_totalprice"), 2), F.lit("."), F.lit("'")), " m"), numbers.number_in, f"'circa ' || replace({_sql_it('o_totalprice', 2)}, '.', chr(39)) || ' m'", "round(o_totalprice, 2)")
_over("q24e_title_power", "N5: kilowatts with a comma, with one dot and two or three decimals, and megawatts.", "part", "p_partkey", lambda: F.when(F.col("p_partkey") % 4 == 0, _c(F.col("p_size"), ".000,50 kWp")).when(F.col("p_partkey") % 4 == 1, _c(F.col("p_size") + 100, ".25 kWp")).when(F.col("p_partkey") % 4 == 2, _c(F.col("p_size"), ".125 kWp")).otherwise(_c(F.col("p_size"), ",5 MW")),
  lambda c: numbers.title_power(F.substring_index(c, " ", 1), F.substring_index(c, " ", -1)), "CASE p_partkey % 4 WHEN 0 THEN p_size || '.000,50 kWp' WHEN 1 THEN (p_size + 100) || '.25 kWp' WHEN 2 THEN p_size || '.125 kWp' ELSE p_size || ',5 MW' END",
  "CASE p_partkey % 4 WHEN 0 THEN (p_size * 1000 + 0.5::DOUBLE) / 1000 WHEN 1 THEN (p_size + 100.25::DOUBLE) / 1000 WHEN 2 THEN p_size + 0.125::DOUBLE ELSE p_size + 0.5::DOUBLE END")
_over("q24f_title_powers", "N6: all powers of a title, each once.", "part", "p_partkey", lambda: _c("Parco da ", F.col("p_size"), ",5 MWp e ", F.col("p_size") + 1, " MW, ossia ", F.col("p_size") + 1, ".000 kWp"),
  lambda c: F.array_join(F.transform(numbers.title_powers(c), lambda x: F.round(x, 4).cast("string")), ";"), "'Parco da ' || p_size || ',5 MWp e ' || (p_size + 1) || ' MW, ossia ' || (p_size + 1) || '.000 kWp'", "p_size || '.5;' || (p_size + 1) || '.0'")
_over("q24g_dashboard_number", "N7.", "orders", "o_orderkey", lambda: F.when(F.col("o_orderkey") % 3 == 2, _c("n/d ", F.col("o_orderstatus"))).otherwise(_c(_it(F.col("o_totalprice"), 2), " MW")), numbers.dashboard_number,
  f"CASE WHEN o_orderkey % 3 = 2 THEN 'n/d ' || o_orderstatus ELSE {_sql_it('o_totalprice', 2)} || ' MW' END", "CASE WHEN o_orderkey % 3 <> 2 THEN round(o_totalprice, 2) END")
_over("q24h_diff_number", "N8: the last separator is decimal, in either way of writing.", "orders", "o_orderkey", lambda: _c("EUR ", F.when(F.col("o_orderkey") % 2 == 0, _it(F.col("o_totalprice"), 2)).otherwise(F.format_number(F.col("o_totalprice"), 2))), numbers.diff_number,
  f"'EUR ' || CASE WHEN o_orderkey % 2 = 0 THEN {_sql_it('o_totalprice', 2)} ELSE format('{{:,.2f}}', o_totalprice) END", "round(o_totalprice, 2)")
_over("q24i_export_power", "N9.", "part", "p_partkey", lambda: F.when(F.col("p_partkey") % 3 == 0, _c(F.col("p_size"), ".500,5 kWp")).when(F.col("p_partkey") % 3 == 1, _c(F.col("p_size"), ",5 MW")).otherwise(F.lit("")), numbers.export_power,
  "CASE p_partkey % 3 WHEN 0 THEN p_size || '.500,5 kWp' WHEN 1 THEN p_size || ',5 MW' ELSE '' END", "CASE p_partkey % 3 WHEN 0 THEN (p_size * 1000 + 500.5::DOUBLE) / 1000 WHEN 1 THEN p_size + 0.5::DOUBLE ELSE 0 END")
_over("q24j_italian_format", "N10.", "orders", "o_orderkey", lambda: F.format_string("%.2f", F.round("o_totalprice", 2)), lambda c: numbers.italian_format(c.cast("double")), "format('{:.2f}', round(o_totalprice, 2))", _sql_it("round(o_totalprice, 2)", 3))
_STATES = ("Procedura in corso", "CONCLUSA", "archiviato", "parere sfavorevole", "esito negativo", "sospesa", "altro", "non compatibile")
_over("q42_status", "X23, T3: the literal order of rules.", "orders", "o_orderkey", lambda: _c(_pick(F.col("o_orderkey"), *_STATES), " ", F.col("o_orderpriority")), text.status, f"{_sql_pick('o_orderkey', *_STATES)} || ' ' || o_orderpriority",
  "CASE WHEN raw ILIKE '%in corso%' THEN 'in_corso' WHEN raw ILIKE '%conclusa%' THEN 'concluso' WHEN raw ILIKE '%archiviato%' THEN 'archiviato' WHEN raw ILIKE '%favorevole%' OR raw ILIKE '%compatibile%' THEN 'positivo' WHEN raw ILIKE '%negativo%' THEN 'negativo' WHEN raw ILIKE '%sospesa%' THEN 'sospeso' ELSE raw END")
_over("q42b_status_corrected", "X23, T3: the corrected order.", "orders", "o_orderkey", lambda: _c(_pick(F.col("o_orderkey"), *_STATES), " ", F.col("o_orderpriority")), lambda c: text.status(c, True), f"{_sql_pick('o_orderkey', *_STATES)} || ' ' || o_orderpriority",
  "CASE WHEN raw ILIKE '%in corso%' THEN 'in_corso' WHEN raw ILIKE '%conclusa%' THEN 'concluso' WHEN raw ILIKE '%archiviato%' THEN 'archiviato' WHEN raw ILIKE '%negativo%' OR raw ILIKE '%sfavorevole%' OR raw ILIKE '%non compatibile%' THEN 'negativo' WHEN raw ILIKE '%sospesa%' THEN 'sospeso' ELSE raw END")
_KINDS = ("Impianto Agrivoltaico", "parco fotovoltaico", "BESS", "eolico", "agro-voltaico e solare")
_over("q42c_project_type", "X21.", "part", "p_partkey", lambda: _c(_pick(F.col("p_partkey"), *_KINDS), " ", F.col("p_name")), text.project_type, f"{_sql_pick('p_partkey', *_KINDS)} || ' ' || p_name",
  "CASE WHEN regexp_matches(lower(raw), 'agrivolt|agrovolt|agri-volt|agro-volt') THEN 'agrivoltaico' WHEN regexp_matches(lower(raw), 'fotovolt|solare|pv') THEN 'fotovoltaico' WHEN regexp_matches(lower(raw), 'accumulo|storage|bess') THEN 'accumulo' END")
_OWNERS = ("12/03/2025", "Proponente", "Dettaglio procedura", "Sole S.r.l.", "Dettaglio Solar srl")
_over("q42d_company", "F12: names, numbers and labels.", "customer", "c_custkey", lambda: F.when(F.col("c_custkey") % 6 == 5, F.col("c_custkey").cast("string")).when(F.col("c_custkey") % 6 == 4, F.col("c_name")).otherwise(_pick(F.col("c_custkey"), *_OWNERS)), bad_company_reason,
  f"CASE c_custkey % 6 WHEN 5 THEN CAST(c_custkey AS VARCHAR) WHEN 4 THEN c_name ELSE {_sql_pick('c_custkey', *_OWNERS)} END",
  "CASE WHEN regexp_matches(raw, '^[0-9]{2}/[0-9]{2}/[0-9]{4}$') THEN 'date_only' WHEN regexp_matches(raw, '^[0-9]+$') THEN 'numeric_only' WHEN raw = 'Proponente' THEN 'administrative_label' WHEN raw ILIKE '%dettaglio%' AND NOT raw ILIKE '%solar%' THEN 'administrative_fragment' END")
_over("q42e_match_text", "X3: entities, ampersands, legal forms and accents.", "customer", "c_custkey", lambda: _c("Società &quot;", F.col("c_name"), "&quot; &amp; ", F.initcap("c_mktsegment"), _pick(F.col("c_custkey"), " S.r.l.", " s.p.a.", " SRLS", "")), text.match_text,
  f"'Società &quot;' || c_name || '&quot; &amp; ' || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) || {_sql_pick('c_custkey', ' S.r.l.', ' s.p.a.', ' SRLS', '')}",
  f"'societa ' || trim(regexp_replace(lower(c_name), '[^a-z0-9]+', ' ', 'g')) || ' e ' || lower(c_mktsegment) || {_sql_pick('c_custkey', ' srl', ' spa', ' srls', '')}")
_over("q42f_slug", "X8.", "part", "p_partkey", lambda: _c(F.initcap("p_name"), "  (", F.col("p_brand"), ")"), text.slug, "upper(substr(split_part(p_name, ' ', 1), 1, 1)) || substr(split_part(p_name, ' ', 1), 2) || ' ' || upper(substr(split_part(p_name, ' ', 2), 1, 1)) || substr(split_part(p_name, ' ', 2), 2) || '  (' || p_brand || ')'",
  "replace(p_name, ' ', '-') || '-' || replace(lower(p_brand), '#', '')")
_over("q42g_place_case", "X9.", "part", "p_partkey", lambda: _c(F.upper("p_name"), " DI ", F.upper("p_type"), " IN L'AQUILA"), text.place_case, "upper(p_name) || ' DI ' || upper(p_type) || ' IN L''AQUILA'",
  "array_to_string(list_transform(string_split(lower(p_name), ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ' di ' || array_to_string(list_transform(string_split(lower(p_type), ' '), lambda w: upper(w[1]) || w[2:]), ' ') || ' in L''Aquila'")
_over("q42h_mojibake", "X6.", "customer", "c_custkey", lambda: _c("cittÃ\xa0 ", F.col("c_name"), " perchÃ©"), text.repair_mojibake, "'cittÃ' || chr(160) || ' ' || c_name || ' perchÃ©'", "'città ' || c_name || ' perché'")
_over("q42i_between", "X25.", "customer", "c_custkey", lambda: F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).otherwise(_c("Proponente: ", F.col("c_name"), "  Data pubblicazione")), lambda c: text.between(c, "Proponente", "Data"),
  "CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'Proponente: ' || c_name || '  Data pubblicazione' END", "CASE WHEN c_custkey % 3 <> 0 THEN c_name END")
_over("q42j_clean_text", "X5.", "customer", "c_custkey", lambda: F.when(F.col("c_custkey") % 4 == 0, F.lit("None")).when(F.col("c_custkey") % 4 == 1, F.lit("nan")).otherwise(_c("  ", F.col("c_name"), " \xa0 ", F.col("c_mktsegment"), "\x07 ")), text.clean_text,
  "CASE c_custkey % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'nan' ELSE '  ' || c_name || ' ' || chr(160) || ' ' || c_mktsegment || chr(7) || ' ' END", "CASE WHEN c_custkey % 4 >= 2 THEN c_name || ' ' || c_mktsegment END")
_over("q42k_list", "C1.", "part", "p_partkey", lambda: _c(F.col("p_name"), "; ", F.col("p_type"), ", ", F.upper("p_name"), " | ", F.col("p_brand"), " ;"), lambda c: text.join_list(text.split_list(c)),
  "p_name || '; ' || p_type || ', ' || upper(p_name) || ' | ' || p_brand || ' ;'", "p_name || ', ' || p_type || ', ' || p_brand")
_over("q42l_ellipsis", "P11.", "part", "p_partkey", lambda: F.col("p_name"), lambda c: text.ellipsis(c, 9), "p_name", "CASE WHEN length(p_name) > 9 THEN substr(p_name, 1, 8) || '…' ELSE p_name END")
_over("q43_dates", "D1: three ways of writing, and no date.", "orders", "o_orderkey", lambda: F.when(F.col("o_orderkey") % 4 == 3, F.col("o_orderpriority")).when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "dd-MM-yyyy")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")),
  dates.parse_date, "CASE o_orderkey % 4 WHEN 3 THEN o_orderpriority WHEN 0 THEN strftime(o_orderdate, '%d/%m/%Y') WHEN 1 THEN strftime(o_orderdate, '%d-%m-%Y') ELSE strftime(o_orderdate, '%Y-%m-%d') END", "CASE WHEN o_orderkey % 4 <> 3 THEN CAST(o_orderdate AS DATE) END")
_over("q43b_italian_dates", "D3: dates in words, and years.", "orders", "o_orderkey", lambda: F.when(F.col("o_orderkey") % 5 == 0, F.year("o_orderdate").cast("string")).otherwise(_c("il ", F.dayofmonth("o_orderdate"), " ", F.element_at(F.array(*map(F.lit, dates.MONTHS)), F.month("o_orderdate")), " ", F.year("o_orderdate"))),
  dates.italian_date, f"CASE WHEN o_orderkey % 5 = 0 THEN CAST(year(o_orderdate) AS VARCHAR) ELSE 'il ' || day(o_orderdate) || ' ' || {list(dates.MONTHS)}[month(o_orderdate)] || ' ' || year(o_orderdate) END", "CASE WHEN o_orderkey % 5 = 0 THEN make_date(year(o_orderdate), 1, 1) ELSE CAST(o_orderdate AS DATE) END")
_over("q43c_year", "D2: years of four digits and of two.", "orders", "o_orderkey", lambda: F.when(F.col("o_orderkey") % 2 == 0, _c("anno ", F.year("o_orderdate"))).otherwise(F.date_format("o_orderdate", "d/M/yy")), dates.year_in,
  "CASE WHEN o_orderkey % 2 = 0 THEN 'anno ' || year(o_orderdate) ELSE day(o_orderdate) || '/' || month(o_orderdate) || '/' || strftime(o_orderdate, '%y') END", "CAST(year(o_orderdate) AS INTEGER)")
_over("q43d_latest_date", "D4: the latest that isn't in the future.", "orders", "o_orderkey", lambda: _c("dal ", F.date_format("o_orderdate", "d/M/yyyy"), " al ", F.date_format(F.date_add("o_orderdate", 30), "dd/MM/yyyy"), ", 01/01/2099"), lambda c: dates.latest_date_in(c, F.lit("2025-06-30").cast("date")),
  "'dal ' || day(o_orderdate) || '/' || month(o_orderdate) || '/' || year(o_orderdate) || ' al ' || strftime(CAST(o_orderdate AS DATE) + 30, '%d/%m/%Y') || ', 01/01/2099'", "CAST(o_orderdate AS DATE) + 30")
_over("q43e_monthly_key", "D7.", "nation", "n_nationkey", lambda: _c("terna_2024_", F.lpad((F.col("n_nationkey") % 12 + 1).cast("string"), 2, "0"), "_", F.lower("n_name")), lambda c: F.concat_ws(";", *(x.cast("string") for x in dates.monthly_key(c))),
  "'terna_2024_' || lpad(CAST(n_nationkey % 12 + 1 AS VARCHAR), 2, '0') || '_' || lower(n_name)", "'terna_' || lower(n_name) || ';2024;' || (n_nationkey % 12 + 1)")
_over("q25b_specific_urls", "X10: parameters, numbers at the end, and lists.", "pages", "page_id", lambda: F.when(F.col("page_id") % 3 == 0, _c("https://www.x.it/a//b/?Id=", F.col("page_id"), "&utm=1")).when(F.col("page_id") % 3 == 1, _c("http://x.it/p/progetto-", F.col("page_id") + 100000)).otherwise(_c("http://x.it/ricerca/elenco", F.col("page_id") + 10000)), urls.specific_key,
  "CASE page_id % 3 WHEN 0 THEN 'https://www.x.it/a//b/?Id=' || page_id || '&utm=1' WHEN 1 THEN 'http://x.it/p/progetto-' || (page_id + 100000) ELSE 'http://x.it/ricerca/elenco' || (page_id + 10000) END", "CASE page_id % 3 WHEN 0 THEN 'x.it/a/b?id=' || page_id WHEN 1 THEN 'x.it/p/progetto-' || (page_id + 100000) ELSE '' END")
_over("q25c_safe_urls", "F24.", "pages", "page_id", lambda: F.when(F.col("page_id") % 4 == 0, _c("javascript:alert(", F.col("page_id"), ")")).when(F.col("page_id") % 4 == 1, _c("ftp://x/", F.col("page_id"))).otherwise(_c(" ", F.col("url"))), urls.safe_url,
  "CASE page_id % 4 WHEN 0 THEN 'javascript:alert(' || page_id || ')' WHEN 1 THEN 'ftp://x/' || page_id ELSE ' ' || url END", "CASE WHEN page_id % 4 >= 2 THEN url ELSE '' END")
_over("q25d_rewritten_urls", "X20.", "pages", "page_id", lambda: F.when(F.col("page_id") % 2 == 0, _c("https://x.it/avvisiPubblici?id=", F.col("page_id"))).otherwise(F.col("url")), lambda c: urls.rewrite(c, urls.NOTICE_RULES), "CASE WHEN page_id % 2 = 0 THEN 'https://x.it/avvisiPubblici?id=' || page_id ELSE url END",
  "CASE WHEN page_id % 2 = 0 THEN 'https://x.it/avvisiPubblici/' || page_id ELSE url END")
_MARKETS = ("terna;", "Terna Econnextion;", "lazio;rete esterna ", "x;Terna Econnextion ")
_over("q44_is_aggregate", "F11, T10.", "part", "p_partkey", lambda: _c(_pick(F.col("p_partkey"), *_MARKETS), F.col("p_name")), lambda c: is_aggregate(F.substring_index(c, ";", 1), F.substring_index(c, ";", -1), F.lit("")), f"{_sql_pick('p_partkey', *_MARKETS)} || p_name", "lower(raw) LIKE '%terna;%' OR lower(raw) LIKE '%terna econnextion%'")


@R.query("""SELECT o_orderkey, round(o_totalprice, 2) AS italian, round(o_totalprice / 1000, 3) AS mw FROM orders""")
def q24k_numbers_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices written in the Italian way, and read again."""
    price = F.col("o_totalprice")
    written = numbers.italian_format(price, 2)
    return table(spark, sf_dir, "orders").select("o_orderkey", numbers.italian_number(written).alias("italian"), F.round(numbers.export_power(F.concat(written, F.lit(" kWp"))), 3).alias("mw"))


@R.query("""SELECT p_partkey, abs(p_retailprice - p_size * 40) / greatest(abs(p_retailprice), abs(p_size * 40), 1) <= 0.025 AS close, abs(p_retailprice - p_size * 40) / greatest(abs(p_retailprice), abs(p_size * 40), 1) > 0.035 AS conflict,
  abs(p_retailprice - p_size * 40) <= greatest(0.001, abs(p_size * 40) * 0.0005) AS matches FROM part""")
def q24l_power_comparisons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Close, in conflict, and matching a rule."""
    a, b = F.col("p_retailprice"), (F.col("p_size") * 40).cast("double")
    return table(spark, sf_dir, "part").select("p_partkey", numbers.power_close(a, b).alias("close"), numbers.power_conflict(a, b).alias("conflict"), numbers.power_matches(a, b).alias("matches"))


@R.query("""SELECT c_custkey, CAST(3 * (CASE WHEN c_custkey % 3 <> 0 THEN 1 ELSE 0 END + 1) + CASE WHEN c_custkey % 3 <> 0 THEN 1 ELSE 0 END + 2 AS INTEGER) AS score FROM customer""")
def q24m_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points for what is present."""
    name: Column = F.when(F.col("c_custkey") % 3 != 0, F.col("c_name")).otherwise("")
    return table(spark, sf_dir, "customer").select("c_custkey", numbers.completeness([name, F.col("c_mktsegment")], [name, F.col("c_mktsegment"), F.col("c_acctbal")]).cast("int").alias("score"))


@R.query(r"""SELECT doc_id, nullif(trim(regexp_replace(text, '\s+', ' ', 'g')), '') AS normal, trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')) AS words,
  regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', '', 'g') AS compact, substr(sha1(text), 1, 16) AS hash FROM documents""")
def q23_normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X1, X2, X4, X7."""
    whole = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_text(whole).alias("normal"), text.key_words(whole).alias("words"), text.key_compact(whole).alias("compact"), text.short_hash(whole).alias("hash"))


@R.query(r"""WITH u AS (SELECT page_id, regexp_extract(url, '^([^?#]*)', 1) AS base FROM pages), d AS (SELECT page_id, base, replace(lower(regexp_extract(base, '://([^/]*)', 1)), 'www.', '') AS host, trim(lower(regexp_extract(base, '://[^/]*(.*)$', 1)), '/') AS path FROM u)
SELECT page_id, CASE page_id % 3 WHEN 0 THEN host || '/' || path || '?id=' || page_id WHEN 1 THEN host || '/' || CASE WHEN path = '' THEN '' ELSE path || '/' END || (page_id + 100000) ELSE '' END AS specific,
  CASE WHEN page_id % 3 = 2 THEN host || '/' || path ELSE '' END AS generic FROM d""")
def q25_url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of URLs that name a record, and of those that don't."""
    k = F.col("page_id")
    base = F.rtrim(F.regexp_extract("url", "^([^?#]*)", 1), F.lit("/"))
    url = F.when(k % 3 == 0, F.concat(base, F.lit("?id="), k.cast("string"))).when(k % 3 == 1, F.concat(base, F.lit("/"), (k + 100000).cast("string"))).otherwise(base)
    return table(spark, sf_dir, "pages").select("page_id", urls.specific_key(url).alias("specific"), urls.generic_key(url).alias("generic"))


@R.query("""WITH w AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]+', ' ', 'g')), ' '), lambda x: x <> '') AS t FROM documents)
SELECT doc_id, array_to_string(list_slice(list_sort(list_distinct(t)), 1, 10), ' ') AS first_ten, CAST(len(list_distinct(t)) AS INTEGER) AS n FROM w""")
def q40_list_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct words, and the first ten of them."""
    words = F.filter(F.split(text.key_words(F.col("text")), " "), lambda x: x != "")
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(text.first_sorted(words), " ").alias("first_ten"), F.size(text.merge_lists(words, words)).alias("n"))


@R.query("""SELECT page_id, replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') AS escaped FROM (SELECT page_id, replace(html, '"', '') AS html FROM pages)""")
def q42m_escaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X18."""
    return table(spark, sf_dir, "pages").select("page_id", text.escape_html(F.replace("html", F.lit('"'), F.lit(""))).alias("escaped"))


@R.query("""SELECT event_id, replace(props, '"k"', '"kk"') AS props FROM events""")
def q35b_rename_in_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A word replaced anywhere in a document."""
    return table(spark, sf_dir, "events").select("event_id", text.rename_in_json(F.col("props"), "k", "kk").alias("props"))


@R.query("""SELECT n_nationkey, concat_ws(' - ', CASE WHEN n_nationkey % 2 = 0 THEN n_name END, 'R' || n_regionkey) AS title, concat_ws('; ', strftime(DATE '2024-03-01' - to_months(n_nationkey % 3), '%Y-%m-%d')) AS month FROM nation""")
def q42n_fallback_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that are present; the months before a date."""
    k = F.col("n_nationkey")
    title = text.fallback_title(F.when(k % 2 == 0, F.col("n_name")).otherwise(" "), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")))
    month = F.get(dates.last_months(F.lit("2024-03-20").cast("date")), k % 3)
    return table(spark, sf_dir, "nation").select("n_nationkey", title.alias("title"), F.date_format(month, "yyyy-MM-dd").alias("month"))


QUERIES, ORACLES = R.queries, R.oracles

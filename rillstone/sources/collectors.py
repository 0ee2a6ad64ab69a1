"""The sources of the registry as data (S2-S20): how a landed page becomes records, and which records stay.

A source is a Spec; one engine serves them all. A landed item is a row of
url, html or cells; the parser that the Spec names makes fields of it, the
scalars normalise them, and a ladder of gates gives every rejected record its
reason, so that rejects can be looked at. Of records with one external id the
first in arrival order stays.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions import geo, numbers, text
from rillstone.functions.dates import italian_date, latest_date_in, recent, year_in
from rillstone.operators.ordered import keep_first
from rillstone.operators.rules import contains_any, is_aggregate, reason, relevant
from rillstone.sources.html import embedded_array, parsed, table_records, value_in_lines

# Words that make a text relevant, in the forms that sources use.
SOLAR = ("fotovoltaico", "fotovoltaica", "agrivoltaico", "agrivoltaica", "agrovoltaico", "agrovoltaica", "agrofotovoltaico", "agro-fotovoltaico", "agro fotovoltaico")
PLANT = ("impianto fv", "parco fv", "fonte solare", "solare fotovoltaico")
STORAGE = ("bess", "accumulo", "storage")
# Words of other works.
OTHER_WORKS = ("eolico", "eolica", "rifiuti", "discarica", "depuratore", "cava", "biogas", "biometano", "allevamento", "idroelettrico", "metanodotto", "gasdotto", "stradale", "ferroviaria")
BUILDINGS = ("pensilina", "pensiline", "tettoia", "copertura", "coperture", "fabbricato", "edificio", "capannone", "scuola", "ospedale")
JOB_NOTICES = ("collocamento mirato", "preselezione", "legge 68 99", "installatore", "manutentore", "offerta di lavoro")
LAND_NOTICES = ("area demaniale", "demanio idrico", "annullamento decreto", "deposito indennita", "indennita di espropriazione", "concessione di un area")
NEGATIVE = ("diniego", "parere negativo", "non favorevole", "rigetto", "rigettata", "rigettato", "istanza respinta", "esito negativo", "giudizio negativo", "non accoglibile", "improcedibile", "archiviazione dell istanza")
NOT_NEGATIVE = ("parere di esclusione", "esclusione dalla procedura di via")
RECENT_ACTS = ("proroga", "variante", "modifica sostanziale", "voltura", "rinnovo")


@dataclass(frozen=True)
class Spec:
    """A source: its parser, words and gates.

    parser is table, lines, links, script or cells. labels gives for a field
    the headers or labels under which it stands; script names the array, whose
    positions are the numbers in labels.
    """

    name: str
    region: str | None
    parser: str
    labels: dict[str, Sequence] = field(default_factory=dict)
    keywords: Sequence[str] = SOLAR
    strong: Sequence[str] = SOLAR
    exclude: Sequence[str] = OTHER_WORKS
    never: Sequence[str] = ()
    never_in_page: Sequence[str] = ()
    authority: str | None = None
    other_authorities: Sequence[str] = ()
    needed_with_exclude: Sequence[str] = ()
    min_mw: float | None = None
    since: str | None = None
    keep_undated: bool = True
    required: Sequence[str] = ()
    provinces: Sequence[str] = ()
    drop_negative: bool = False
    script: str | None = None
    id_prefix: str = ""


_TABLE = {"title": ("progetto",), "proponent": ("proponente",), "procedure": ("procedura",), "status_raw": ("stato",)}
_LINES = {"title": ("titolo", "progetto", "oggetto"), "proponent": ("proponente", "società proponente"), "status_raw": ("stato",), "province": ("provincia",), "municipality": ("comune",), "procedure": ("tipo procedura",), "date": ("data",), "power": ("potenza",)}
_CELLS = {"title": ("titolo", "oggetto", "procedura_progetto_oggetto", "title"), "proponent": ("proponente", "proponente_progetto", "proponent"), "status_raw": ("stato", "stato_del_procedimento"), "province": ("provincia",), "municipality": ("comune",), "power": ("potenza", "potenza_mw"), "date": ("data", "anno"), "source_type": ("fonte",), "url": ("procedura_url", "url")}

SPECS = {s.name: s for s in (
    Spec("mase", None, "table", _TABLE, id_prefix="mase_"),
    Spec("mase_provvedimenti", None, "lines", _LINES, keywords=(*SOLAR, "solare"), drop_negative=True),
    Spec("veneto", "Veneto", "links", keywords=("fotovolt", "agrivolt", "agrovolt"), strong=("fotovolt", "agrivolt", "agrovolt")),
    Spec("emilia_romagna", "Emilia-Romagna", "lines", _LINES, keywords=("fotovolta", "agrivolta", "agrovolta", "agro-fotovolta", *STORAGE), exclude=()),
    Spec("lombardia", "Lombardia", "cells", _CELLS, keywords=("fotovolta", "agrivolta", "agrovolta", "solare", *STORAGE), strong=("fotovolta", "agrivolta", "agrovolta"), exclude=("idroelettrico", "idropotabile", "acquedotto", "allevamento", "rifiuti", "discarica", "cava"), needed_with_exclude=("potenza",)),
    Spec("sicilia", "Sicilia", "cells", _CELLS, keywords=(*SOLAR, *PLANT, *STORAGE), never=BUILDINGS, exclude=()),
    Spec("puglia", "Puglia", "cells", _CELLS, keywords=(*SOLAR, "solare"), exclude=()),
    Spec("sistema_puglia_energia", "Puglia", "lines", _LINES, keywords=(*SOLAR, "fonte solare"), never=("eolico", "eolica", "offshore", "efficientamento energetico", "edilizia ospedaliera", "elettrodotto"), never_in_page=("gli atti della settimana",)),
    Spec("lazio", "Lazio", "lines", _LINES, keywords=(*SOLAR, *PLANT, *STORAGE)),
    Spec("sardegna", "Sardegna", "table", _TABLE, keywords=(*SOLAR, *PLANT, "fv ", *STORAGE)),
    Spec("toscana", "Toscana", "cells", _CELLS, keywords=(*SOLAR, "impianto fv", *STORAGE), since="2025-01-01"),
    Spec("toscana_atos", "Toscana", "script", {"title": 0, "proponent": 1, "status_raw": 2, "power": 3, "date": 4, "municipality": 5, "province": 6, "kind": 7}, min_mw=0.5, required=("proponent",), script="discariche", id_prefix="atos_"),
    Spec("piemonte", "Piemonte", "table", _TABLE, exclude=(), since="2023-01-01"),
    Spec("campania", "Campania", "table", {**_TABLE, "date": ("data di presentazione",)}, since="2025-01-01", keep_undated=False),
    Spec("calabria", "Calabria", "lines", _LINES, keywords=(*SOLAR, *PLANT), never=(*JOB_NOTICES, *LAND_NOTICES, "tettoia", "su edificio", "su copertura"), min_mw=5.0, since="2025-01-01", keep_undated=False, required=("proponent",), drop_negative=True),
    Spec("umbria", "Umbria", "lines", _LINES, never=("eolico", "eolica"), min_mw=5.0, required=("municipality",), provinces=("PG", "TR"), authority="Regione Umbria", other_authorities=("Ministero Ambiente", "Regione Toscana", "Regione Marche")),
    Spec("basilicata", "Basilicata", "table", _TABLE, keywords=(*SOLAR, "fotovo", "fonte solare", "impianto fv"), never=OTHER_WORKS, min_mw=5.0, required=("proponent", "municipality"), provinces=("PZ", "MT")),
)}

FIELDS = ("title", "proponent", "status_raw", "province", "municipality", "procedure", "date", "power", "kind", "source_type")


def _parse(landed: DataFrame, spec: Spec) -> DataFrame:
    """row_idx, source_url and FIELDS as text."""
    null = F.lit(None).cast("string")
    if spec.parser == "cells":
        low = F.map_from_entries(F.transform(F.map_entries("cells"), lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), e["value"].alias("value"))))
        df = landed.withColumn("__c", low)
        get = lambda names: text.first_present(*(F.try_element_at("__c", F.lit(n)) for n in names))
        url = F.coalesce(get(spec.labels.get("url", ("url",))), F.col("url"))
        return df.select("row_idx", url.alias("source_url"), *((get(spec.labels[f]) if f in spec.labels else null).alias(f) for f in FIELDS))
    if spec.parser == "script":
        rows = F.from_json(embedded_array(F.col("html"), spec.script), "array<array<string>>")
        each = landed.select("row_idx", F.col("url").alias("source_url"), F.posexplode(rows).alias("__at", "__r"))
        return each.select((F.col("row_idx") * 1_000_000 + F.col("__at")).alias("row_idx"), "source_url", *((F.get("__r", F.lit(spec.labels[f])) if f in spec.labels else null).alias(f) for f in FIELDS))
    pages = parsed(landed)
    if spec.parser == "links":
        each = pages.select("row_idx", F.posexplode("page.links").alias("__at", "__l"))
        return each.select((F.col("row_idx") * 1_000_000 + F.col("__at")).alias("row_idx"), F.col("__l.url").alias("source_url"), *((F.col("__l.text") if f == "title" else null).alias(f) for f in FIELDS))
    if spec.parser == "table":
        header = [spec.labels["title"][0], spec.labels["proponent"][0]]
        each = pages.select("row_idx", F.col("url").alias("source_url"), F.posexplode(table_records(F.col("page.rows"), header)).alias("__at", "__r"))
        get = lambda names: text.first_present(*(F.try_element_at("__r", F.lit(n)) for n in names))
        return each.select((F.col("row_idx") * 1_000_000 + F.col("__at")).alias("row_idx"), "source_url", *((get(spec.labels[f]) if f in spec.labels else null).alias(f) for f in FIELDS))
    lines = F.col("page.lines")
    every = tuple(dict.fromkeys(n for names in spec.labels.values() for n in names))
    # what follows each label is a column of its own before the fields choose, so its expression is written out once
    at = {n: f"__label{i}" for i, n in enumerate(every)}
    told = pages.select("row_idx", F.col("url").alias("source_url"), F.col("page.title").alias("__title"), F.concat_ws(" ", "page.title", lines).alias("page_text"), *(value_in_lines(lines, [n], others=every).alias(c) for n, c in at.items()))
    find = lambda names: text.first_present(*(F.col(at[n]) for n in names))
    named = told.select("row_idx", "source_url", "__title", "page_text", *((find(spec.labels[f]) if f in spec.labels else null).alias(f) for f in FIELDS))
    return named.withColumn("title", text.first_present(F.col("title"), F.col("__title"))).drop("__title")


def _gates(spec: Spec, as_of: Column | None) -> list[tuple[str, Column]]:
    """The gates in the order in which they are asked; the names are reasons."""
    words = F.concat_ws(" ", "title", "procedure", "source_type")
    folded = text.key_words(F.concat_ws(" ", "title", "status_raw", "procedure"))
    gates: list[tuple[str, Column]] = [
        ("no_title", text.is_blank(F.col("title"))),
        ("not_relevant", ~relevant(words, spec.keywords, spec.strong, spec.exclude, spec.needed_with_exclude, spec.never)),
    ]
    if spec.parser == "script":
        gates = [gates[0], ("title_indicates_eolico", F.rlike(F.lower("title"), F.lit(r"\Aeol|parco eolico|impianto eolico"))), ("type_not_allowed", ~F.upper(F.coalesce("kind", F.lit(""))).isin("AGRIVOLTAICO", "FOTOVOLTAICO"))]
        status = F.lower(F.coalesce("status_raw", F.lit("")))
        gates += [("missing_authorization_status", status == ""), ("unsupported_authorization_status", ~F.contains(status, F.lit("in iter")) & ~F.contains(status, F.lit("autorizzat")))]
        if as_of is not None:
            authorised = ~F.contains(status, F.lit("in iter"))
            gates += [("authorized_missing_last_act_date", authorised & F.col("day").isNull()), ("authorized_last_act_older_24_months", authorised & (F.col("day") < F.add_months(as_of, -24)))]
    if spec.never_in_page:
        gates.insert(0, ("roundup", F.coalesce(contains_any(text.key_words(F.col("page_text")), spec.never_in_page), F.lit(False))))
    if spec.authority:
        has = lambda name: F.contains("page_text", F.lit(name))
        other = F.lit(False)
        for name in spec.other_authorities:
            other = other | has(name)
        gates.insert(0, ("other_authority", F.coalesce(other & ~has(spec.authority), F.lit(False))))
    if spec.drop_negative:
        gates.append(("negative_outcome", contains_any(folded, NEGATIVE) & ~contains_any(folded, NOT_NEGATIVE)))
    if spec.since:
        day = F.coalesce("day", F.make_date(year_in(F.col("date")), F.lit(12), F.lit(31)))
        gates.append(("too_old", ~recent(day, F.lit(spec.since).cast("date"), spec.keep_undated)))
    if spec.min_mw is not None:
        gates.append(("too_small", F.coalesce(F.col("power_mw") < spec.min_mw, F.lit(True))))
    gates += [(f"no_{f}", text.is_blank(F.col(f))) for f in spec.required]
    if spec.provinces:
        gates.append(("other_province", ~F.coalesce(F.col("province_code").isin(*spec.provinces), F.lit(False))))
    return gates


def collect(landed: DataFrame, spec: Spec, as_of: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """The records that pass, and the rejected ones with their reason.

    landed has row_idx (arrival order), url, and html or cells. A record has
    external_id, source_name, source_url, title, proponent, region, province,
    municipalities, power_mw, project_type, status, procedure, day and
    last_act_kind.
    """
    c = F.col
    df = _parse(landed, spec).withColumns({f: text.clean_text(F.col(f)) for f in FIELDS})
    df = df.withColumns({
        "day": F.coalesce(italian_date(c("date")), latest_date_in(c("date"), as_of if as_of is not None else F.lit("9999-12-31").cast("date"))),
        "power_mw": F.coalesce(numbers.power_in_text(c("power")), numbers.dashboard_number(c("power")), numbers.power_in_text(c("title"))),
    })
    codes = geo.title_province_codes(c("title"))
    given, _ = geo.deduced(geo.province(c("province")), F.get(codes, F.lit(0)))
    towns = F.when(c("municipality").isNotNull(), text.split_list(c("municipality"))).otherwise(geo.municipalities(c("title")))
    df = df.withColumns({"province_code": given, "municipalities": towns})
    df = df.withColumn("municipality", F.coalesce("municipality", F.nullif(F.array_join("municipalities", ", "), F.lit(""))))
    own = F.regexp_extract(F.coalesce("source_url", F.lit("")), r"(?:Info/|[?&]id=|/)([0-9]{2,})/?\z", 1)
    described = text.slug(F.concat_ws(" ", "title", "proponent", "source_url"))
    key = F.when(own != "", F.concat(F.lit(spec.id_prefix or f"{spec.name}_"), own, F.when(F.lit(spec.parser in ("table", "script")), F.concat(F.lit("_"), text.short_hash(c("title"), 8))).otherwise(F.lit("")))).otherwise(F.concat(F.lit(f"{spec.name}_"), described))
    df = df.withColumn("external_id", text.truncate(key, 255)).withColumn("reason", text.settled(reason(_gates(spec, as_of))))
    record = df.select(
        "row_idx", "external_id", F.lit(spec.name).alias("source_name"), "source_url", "title", "proponent", F.lit(spec.region).cast("string").alias("region"), c("province_code").alias("province"), "municipalities", "power_mw",
        F.coalesce(text.project_type(c("kind")), text.project_type(c("title"))).alias("project_type"), text.status(c("status_raw")).alias("status"), "procedure", "day",
        text.ladder(F.lower("title"), [(k, (k,)) for k in RECENT_ACTS]).alias("last_act_kind"), "reason",
    )
    kept = keep_first(record.where("reason is null"), "external_id", F.asc("row_idx"))
    return kept.drop("reason", "row_idx"), record.where("reason is not null").drop("row_idx")


def market_statistics(cells: DataFrame) -> DataFrame:
    """Aggregates by region, source and status from the cells of a workbook, with year and month."""
    get = lambda n: F.try_element_at("cells", F.lit(n))
    df = cells.select(get("Regione").alias("region"), get("Fonte").alias("source_type"), get("Stato Connessione").alias("status"), numbers.dashboard_number(get("Potenza (MW)")).alias("power_mw"), numbers.dashboard_integer(get("Numero Pratiche")).alias("practices"), "year", "month")
    df = df.where((F.lower(F.trim("source_type")) == "solare") & F.col("power_mw").isNotNull() & ~text.is_blank(F.col("region")))
    key = F.concat_ws("_", F.lit("terna_econnextion"), F.col("year").cast("string"), F.lpad(F.col("month").cast("string"), 2, "0"), text.key_snake(F.col("region")), text.key_snake(F.col("source_type")), text.key_snake(F.col("status")))
    return df.withColumn("external_id", key).withColumn("is_aggregate", is_aggregate(F.lit("terna econnextion"), F.lit(""), F.lit("")))

"""The published record and what stands before and after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions import geo, numbers, text, urls
from rillstone.functions.extract import clean_company
from rillstone.operators.rules import contains_any, ladder_join, looks_like_company

#: Labels of sources, and the group that a source belongs to if it isn't its own.
SOURCE_LABELS = {
    "mase": "MASE", "mase_provvedimenti": "MASE", "terna_econnextion": "Terna Econnextion", "puglia": "Puglia", "sistema_puglia_energia": "Puglia", "lazio": "Lazio", "sicilia": "Sicilia", "lombardia": "Lombardia",
    "veneto": "Veneto", "emilia_romagna": "Emilia-Romagna", "sardegna": "Sardegna", "toscana": "Toscana", "toscana_atos": "Toscana", "piemonte": "Piemonte", "campania": "Campania",
}
SOURCE_GROUPS = {"toscana_atos": "toscana", "mase": "mase", "mase_provvedimenti": "mase", "puglia": "puglia", "sistema_puglia_energia": "puglia"}
#: Sources that are shown under their region's name.
SHOWN_AS_REGION = {"calabria": "Calabria", "basilicata": "Basilicata", "umbria": "Umbria", "sardegna": "Sardegna"}
ATOS_PAGE = "atos.arrr.it/scheda_impianto_fer"


def _looked_up(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def source_key(c: Column) -> Column:
    """A source's name in lower case with underscores."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text.clean_text(c), F.lit(""))), "[^a-z0-9]+", "_"), F.lit("_"))


def source_group(source: Column) -> Column:
    """The group of a source; its own name without one, nd for none."""
    known = F.coalesce(text.null_if_blank(source), F.lit("nd"))
    return F.coalesce(_looked_up(SOURCE_GROUPS, known), known)


def source_label(source: Column) -> Column:
    """The label of a source's group, else of the source, else its name, else ND."""
    return F.coalesce(_looked_up(SOURCE_LABELS, source_group(source)), _looked_up(SOURCE_LABELS, F.coalesce(source, F.lit(""))), text.null_if_blank(source), F.lit("ND"))


#: The fields of a published record that are texts, and the characters that are kept of them.
TEXT_FIELDS = {"title": 500, "proponent": 300, "region": 120, "province": 120, "municipalities": 500, "project_type": 200, "status": 500, "updated_at": 120}


def published(records: DataFrame, known_towns: Column | None = None) -> DataFrame:
    """P5: the 18 fields of a published record; rows without a source and a title are left out.

    records has source, url, power_mw and numero_pratiche as text, and the
    columns of TEXT_FIELDS. known_towns is an array of municipalities found by
    a gazetteer.
    """
    c = F.col
    rows = records.select(
        source_key(c("source")).alias("source"), *(text.clean_text(c(f)).alias(f) for f in TEXT_FIELDS), text.clean_text(c("url")).alias("url"),
        numbers.dashboard_number(c("power_mw")).alias("power_mw"), F.coalesce(numbers.dashboard_integer(c("numero_pratiche")), F.lit(0)).alias("numero_pratiche"),
        (known_towns if known_towns is not None else F.lit(None).cast("array<string>")).alias("__known"),
    )
    rows = rows.where((c("source") != "") | c("title").isNotNull()).withColumn("region", geo.region(c("region")))
    seen = F.concat_ws(" ", "title", "municipalities", "province", F.nullif("region", F.lit("")), "status")
    given = F.when(c("municipalities").isNotNull(), text.split_list(c("municipalities")))
    rows = rows.withColumn("__geo", text.settled(geo.place_from_text(seen, F.nullif("region", F.lit("ND")), c("province"), given, c("__known"))))
    rows = rows.withColumns({
        "province": F.coalesce("province", "__geo.province"), "region": F.coalesce(F.nullif(F.nullif("region", F.lit("")), F.lit("ND")), "__geo.region", F.lit("ND")),
        "municipalities": F.coalesce("municipalities", F.nullif(F.array_join("__geo.municipalities", ", "), F.lit(""))),
    })
    market = (c("source") == "terna_econnextion") | F.contains(F.lower(F.coalesce("title", F.lit(""))), F.lit("terna econnextion"))
    label = F.coalesce(_looked_up(SOURCE_LABELS, c("source")), F.nullif("source", F.lit("")), F.lit("Fonte"))
    title = F.coalesce("title", text.fallback_title(label, c("region"), c("project_type"), c("status")))
    shown = {f: F.coalesce(text.truncate(title if f == "title" else c(f), n), F.lit("")) for f, n in TEXT_FIELDS.items()}
    return rows.select(
        F.coalesce(F.nullif("source", F.lit("")), F.lit("nd")).alias("source"), source_group(c("source")).alias("source_group"), source_label(c("source")).alias("source_label"),
        *(shown[f].alias(f) for f in ("title", "proponent", "region", "province", "municipalities", "project_type")), "power_mw", shown["status"].alias("status"),
        urls.safe_url(F.coalesce("url", F.lit(""))).alias("url"), shown["updated_at"].alias("updated_at"), "numero_pratiche", market.alias("is_terna"), (~market).alias("is_punctual"),
        c("__geo.province_deduced").alias("province_deduced"), c("__geo.municipalities_deduced").alias("municipalities_deduced"),
    )


def shown_labels(records: DataFrame) -> DataFrame:
    """Records (source, source_group, source_label, url, merged_sources) under the names that are shown: Tuscany's by their page, four regions by their name, in the list of merged sources too."""
    key = F.lower(F.trim(F.coalesce("source", F.lit(""))))
    atos = (key == "toscana_atos") | F.contains(F.lower(F.coalesce("url", F.lit(""))), F.lit(ATOS_PAGE))
    tuscan = atos | (key == "toscana")
    region = _looked_up(SHOWN_AS_REGION, key)
    named = lambda own, c: F.when(tuscan, own).otherwise(F.coalesce(region, F.col(c)))
    merged = F.when(~tuscan & region.isNotNull(), F.transform("merged_sources", lambda x: F.coalesce(_looked_up(SHOWN_AS_REGION, F.lower(F.trim(x))), x))).otherwise(F.col("merged_sources"))
    return records.withColumns({
        "source": named(F.when(atos, "toscana_atos").otherwise("toscana"), "source"), "source_group": named(F.lit("toscana"), "source_group"), "source_label": named(F.lit("Toscana"), "source_label"), "merged_sources": merged,
    })


def staged_basilicata(records: DataFrame, as_of: Column) -> DataFrame:
    """Staged records (title, proponent, province, url, source_url, municipalities as an array, project_type, procedure, status, updated_at) with what all of this source share."""
    c, name = F.col, F.lit("Basilicata")
    blank = lambda x: F.coalesce(F.trim(x), F.lit(""))
    return records.select(
        name.alias("source"), name.alias("source_label"), name.alias("source_group"), F.array(name).alias("merged_sources"), name.alias("region"),
        F.array_join(F.filter(F.transform("municipalities", lambda x: F.trim(x)), lambda x: x != ""), ", ").alias("municipalities"), *(blank(c(f)).alias(f) for f in ("province", "proponent", "title")),
        F.coalesce(text.null_if_blank(c("url")), blank(c("source_url"))).alias("url"), F.lit(False).alias("is_terna"), F.lit(True).alias("is_punctual"), F.lit(0).alias("numero_pratiche"),
        F.lit(False).alias("province_deduced"), F.lit(False).alias("municipalities_deduced"), text.first_present(c("project_type"), c("procedure"), F.lit("Basilicata VIA/Screening")).alias("project_type"),
        F.coalesce("status", "procedure", F.lit("")).alias("status"), F.coalesce(text.null_if_blank(c("updated_at")), F.date_format(as_of, "yyyy-MM-dd'T'HH:mm:ss")).alias("updated_at"),
    )


#: The ministry's sources.
MINISTRY = ("mase", "mase_provvedimenti")


def of_ministry() -> Column:
    """a record of the ministry, by source, group, label or a merged source."""
    merged = F.coalesce(F.arrays_overlap("merged_sources", F.array(*map(F.lit, MINISTRY))), F.lit(False))
    of = lambda c, *names: F.coalesce(F.col(c).isin(*names), F.lit(False))
    return of("source", *MINISTRY) | of("source_group", "mase") | of("source_label", "MASE") | merged


def with_found_proponents(records: DataFrame, found: DataFrame, id_col: str = "row_idx") -> tuple[DataFrame, DataFrame, DataFrame]:
    """The ministry's records without a company get that of their page.

    found has url and candidate, a row of a URL or more: pages are fetched
    once, whatever number of records names them, so it stands for the cache.
    Gives the records with proponent and proponent_source, an audit row per
    target, and one row of counters: targets, recovered, failed, still_missing.
    """
    pages = found.groupBy("url").agg(F.min_by("candidate", F.length("candidate")).alias("__candidate"))
    missing = of_ministry() & ~F.coalesce(looks_like_company(F.col("proponent")), F.lit(False))
    marked = records.withColumn("__target", text.settled(missing)).join(pages, "url", "left").withColumn("__candidate", clean_company(F.col("__candidate")))
    applied = F.col("__target") & F.coalesce(looks_like_company(F.col("__candidate")), F.lit(False))
    marked = marked.withColumn("__applied", text.settled(applied))
    out = marked.withColumns({"proponent": F.when(F.col("__applied"), F.col("__candidate")).otherwise(F.col("proponent")), "proponent_source": F.when(F.col("__applied"), F.lit("mase_detail_page"))}).select(*records.columns, "proponent_source")
    audit = marked.where("__target").select(id_col, F.col("__applied").alias("applied"), F.col("proponent").alias("old_proponent"), F.col("__candidate").alias("candidate_proponent"), "url")
    counters = marked.agg(F.count_if("__target").alias("targets"), F.count_if("__applied").alias("recovered"), F.count_if(F.col("__target") & ~F.col("__applied")).alias("failed"))
    return out, audit, counters.withColumn("still_missing", F.col("failed"))


def with_layer(records: DataFrame, layer: DataFrame, id_col: str = "row_idx") -> DataFrame:
    """Records (id, codproc, proponent, province, municipality) with what a landed layer (layer_id, id, codproc and the same fields) tells of them.

    A record meets the one row of the layer with its id and codproc, else with
    its id, else with its codproc; several rows tell nothing. Only what a
    record lacks is filled; match_mode names the step.
    """
    names = {"id": "__id", "codproc": "__codproc"}
    right = layer.select(F.col("layer_id"), *(F.col(a).alias(b) for a, b in names.items()))
    steps = [[("id", "__id"), ("codproc", "__codproc")], [("id", "__id")], [("codproc", "__codproc")]]
    met = ladder_join(records, right, id_col, steps, "layer_id")
    fields = ("proponent", "province", "municipality")
    told = layer.select("layer_id", *(F.col(f).alias(f"__{f}") for f in fields)).dropDuplicates(["layer_id"])
    joined = records.join(met, id_col, "left").join(told, "layer_id", "left")
    mode = F.element_at(F.array(F.lit("id_codproc"), F.lit("id"), F.lit("codproc")), F.col("step"))
    return joined.withColumns({f: text.first_present(F.col(f), F.col(f"__{f}")) for f in fields}).withColumn("match_mode", F.when(F.col("step").isNotNull(), mode)).select(*records.columns, "match_mode")


#: Words of pages that may name a project, and of those that are past.
CANDIDATE_WORDS = ("fotovolta", "agrivolta", "agrovolta", "impianto fv", "solare", "mwp", " mw")
PAST_WORDS = ("archivia", "improcedibil", "diniego", "respint", "negativ", "annull")


def candidate_links(pages: DataFrame) -> DataFrame:
    """The links of parsed pages whose text names a plant and no past procedure: url of the page, link, title and the power as written."""
    each = pages.select(F.col("url").alias("source_page"), F.explode("page.links").alias("l")).select("source_page", F.col("l.url").alias("url"), text.normalize_text(F.col("l.text")).alias("title"))
    low = F.lower("title")
    wanted = each.where(contains_any(low, CANDIDATE_WORDS) & ~contains_any(low, PAST_WORDS))
    return wanted.withColumn("power_raw", F.nullif(F.regexp_extract("title", r"(?i)([0-9]{1,4}(?:[.,][0-9]{1,4})?\s*MWp?)", 1), F.lit(""))).dropDuplicates(["source_page", "url", "title"])


def is_commercial(title: Column, core: Sequence[str], storage: Sequence[str], excluded: Sequence[str], strong: Sequence[str]) -> Column:
    """a plant or a store, no building, and a word for a work of its own."""
    low = F.concat(F.lit(" "), F.lower(F.coalesce(text.normalize_text(title), F.lit(""))), F.lit(" "))
    return (contains_any(low, core) | contains_any(low, storage)) & ~contains_any(low, excluded) & contains_any(low, strong)


#: The words of F3.
COMMERCIAL_CORE = ("fotovoltaico", "agro-fotovoltaico", "agrofotovoltaico", "agrivoltaico", "agrovoltaico", "impianto fv", "parco fv", "fv ", " fv", "solare fotovoltaico")
COMMERCIAL_STORAGE = ("accumulo", "storage", "bess")
COMMERCIAL_EXCLUDED = (
    "pensilina", "pensiline", "tettoia", "copertura", "coperture", "fabbricato", "edificio", "capannone", "scuola", "ospedale", "ripristino dell'impianto fotovoltaico esistente", "ripristino dell’impianto fotovoltaico esistente",
)
COMMERCIAL_STRONG = ("impianto", "parco", "centrale", "produzione di energia", "agro", "agrivoltaico", "agrovoltaico", "revamping")

RULE = T.StructType([
    T.StructField("seq", T.IntegerType()), T.StructField("match_kind", T.StringType()), T.StructField("match_value", T.ArrayType(T.StringType())), T.StructField("expected_matches", T.LongType()),
    T.StructField("action", T.StringType()), T.StructField("fields", T.MapType(T.StringType(), T.StringType())), T.StructField("reason", T.StringType()),
])


def rule_table(spark: SparkSession, companies_by_url: dict[str, str], companies_by_title: Sequence[tuple[Sequence[str], str]] = (), excluded_titles: Sequence[Sequence[str]] = ()) -> DataFrame:
    """An inventory of rules as a table that apply_overrides() takes: companies by URL, companies by words of the title, titles that go, in this order."""
    rows = [("url_eq", [u], None, "patch", {"proponent": company}, "manual_proponent_override_by_url") for u, company in companies_by_url.items()]
    rows += [("title_contains_all", list(words), None, "patch", {"proponent": company}, "manual_proponent_override_by_title") for words, company in companies_by_title]
    rows += [("title_contains_all", list(words), None, "exclude", {}, "manual_exclude") for words in excluded_titles]
    table = spark.createDataFrame([(i, *r) for i, r in enumerate(rows, 1)], RULE)
    key = F.when(F.col("match_kind") == "url_eq", F.transform("match_value", urls.override_key)).otherwise(F.transform("match_value", text.match_text))
    return table.withColumn("match_value", key)


def publish_checks(spark: SparkSession, folder: str, required: Sequence[str], most_mb: int = 15) -> DataFrame:
    """check and passed: required files are there, JSON files parse, pages aren't larger than most_mb."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    name = F.substring_index("path", "/", -1)
    sized = files.select(name.alias("file"), "length", F.when(F.endswith(F.col("path"), F.lit(".json")), F.col("content").cast("string")).alias("json"))
    judged = sized.select("file", F.when(F.col("json").isNotNull(), F.try_parse_json("json").isNotNull()).alias("valid"), F.when(F.endswith("file", F.lit(".html")), F.col("length") <= most_mb * 1024 * 1024).alias("small"))
    there = spark.createDataFrame([(n,) for n in required], "file string").join(judged.select("file", F.lit(True).alias("__there")).distinct(), "file", "left")
    rows = there.select(F.concat(F.lit("present: "), "file").alias("check"), F.coalesce("__there", F.lit(False)).alias("passed"))
    rows = rows.unionByName(judged.where("valid is not null").select(F.concat(F.lit("valid JSON: "), "file").alias("check"), F.col("valid").alias("passed")))
    return rows.unionByName(judged.where("small is not null").select(F.concat(F.lit("size: "), "file").alias("check"), F.col("small").alias("passed")))

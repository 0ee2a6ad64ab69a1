"""Provinces and municipalities in fields and titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bind, distinct_by, key_words, match_text, place_case

#: Province names, folded, and their codes.
PROVINCES = {
    "agrigento": "AG", "alessandria": "AL", "ancona": "AN", "aosta": "AO", "arezzo": "AR", "ascoli piceno": "AP", "asti": "AT",
    "avellino": "AV", "bari": "BA", "barletta andria trani": "BT", "belluno": "BL", "benevento": "BN", "bergamo": "BG", "biella": "BI",
    "bologna": "BO", "bolzano": "BZ", "brescia": "BS", "brindisi": "BR", "cagliari": "CA", "caltanissetta": "CL", "campobasso": "CB",
    "caserta": "CE", "catania": "CT", "catanzaro": "CZ", "chieti": "CH", "como": "CO", "cosenza": "CS", "cremona": "CR", "crotone": "KR",
    "cuneo": "CN", "enna": "EN", "fermo": "FM", "ferrara": "FE", "firenze": "FI", "foggia": "FG", "forli cesena": "FC", "forli": "FC",
    "frosinone": "FR", "genova": "GE", "gorizia": "GO", "grosseto": "GR", "imperia": "IM", "isernia": "IS", "la spezia": "SP",
    "laquila": "AQ", "l aquila": "AQ", "latina": "LT", "lecce": "LE", "lecco": "LC", "livorno": "LI", "lodi": "LO", "lucca": "LU",
    "macerata": "MC", "mantova": "MN", "massa carrara": "MS", "matera": "MT", "messina": "ME", "milano": "MI", "modena": "MO",
    "monza brianza": "MB", "monza e brianza": "MB", "napoli": "NA", "novara": "NO", "nuoro": "NU", "oristano": "OR", "padova": "PD",
    "palermo": "PA", "parma": "PR", "pavia": "PV", "perugia": "PG", "pesaro urbino": "PU", "pescara": "PE", "piacenza": "PC",
    "pisa": "PI", "pistoia": "PT", "pordenone": "PN", "potenza": "PZ", "prato": "PO", "ragusa": "RG", "ravenna": "RA",
    "reggio calabria": "RC", "reggio emilia": "RE", "rieti": "RI", "rimini": "RN", "roma": "RM", "rovigo": "RO", "salerno": "SA",
    "sassari": "SS", "savona": "SV", "siena": "SI", "siracusa": "SR", "sondrio": "SO", "sud sardegna": "SU", "taranto": "TA",
    "teramo": "TE", "terni": "TR", "torino": "TO", "trapani": "TP", "trento": "TN", "treviso": "TV", "trieste": "TS", "udine": "UD",
    "varese": "VA", "venezia": "VE", "verbano cusio ossola": "VB", "vercelli": "VC", "verona": "VR", "vibo valentia": "VV",
    "vicenza": "VI", "viterbo": "VT",
}
CODES = tuple(dict.fromkeys(PROVINCES.values()))
#: Regions and the codes of their provinces.
REGIONS = {
    "Abruzzo": "AQ CH PE TE", "Basilicata": "MT PZ", "Calabria": "CS CZ KR RC VV", "Campania": "AV BN CE NA SA", "Emilia-Romagna": "BO FC FE MO PC PR RA RE RN", "Friuli-Venezia Giulia": "GO PN TS UD",
    "Lazio": "FR LT RI RM VT", "Liguria": "GE IM SP SV", "Lombardia": "BG BS CO CR LC LO MB MI MN PV SO VA", "Marche": "AN AP FM MC PU", "Molise": "CB IS", "Piemonte": "AL AT BI CN NO TO VB VC",
    "Puglia": "BA BR BT FG LE TA", "Sardegna": "CA NU OR SS SU", "Sicilia": "AG CL CT EN ME PA RG SR TP", "Toscana": "AR FI GR LI LU MS PI PO PT SI", "Trentino-Alto Adige": "BZ TN", "Umbria": "PG TR",
    "Valle d'Aosta": "AO", "Veneto": "BL PD RO TV VE VI VR",
}
_NAMES = sorted(PROVINCES, key=len, reverse=True)
_ANY_NAME = "|".join(_NAMES)
#: The tables as one literal each: a plan is made faster with it than with one for each entry.
_CODE_TABLE = ";".join(f"{name}:{code}" for name, code in PROVINCES.items())
_ALL_CODES = f" {' '.join(CODES)} "
_REGION_TABLE = ";".join(f"{code}:{name}" for name, codes in REGIONS.items() for code in codes.split())


def _code_of(name: Column) -> Column:
    return F.try_element_at(F.str_to_map(F.lit(_CODE_TABLE), F.lit(";"), F.lit(":")), name)


def _is_code(c: Column) -> Column:
    return (F.length(c) == 2) & F.contains(F.lit(_ALL_CODES), F.concat(F.lit(" "), c, F.lit(" ")))


def province(c: Column) -> Column:
    """G1: the code of a province given by code or name, with or without "provincia di"; else the text in capitals."""
    text = F.coalesce(F.trim(c), F.lit(""))
    parts = F.struct(text.alias("text"), F.upper(F.regexp_replace(text, "[^A-Za-z]", "")).alias("letters"), match_text(text).alias("name"))
    return bind(parts, lambda x: _province(x["text"], x["letters"], x["name"]))


def _province(text: Column, letters: Column, name: Column) -> Column:
    bare = F.trim(F.regexp_replace(name, r"provincia (?:di )?", ""))
    return F.when(text == "", "").when(_is_code(letters), letters).otherwise(F.coalesce(_code_of(name), _code_of(bare), F.nullif(letters, F.lit("")), F.upper(name)))


def province_codes(c: Column) -> Column:
    """All provinces that a field names, sorted."""
    text = F.coalesce(F.trim(c), F.lit(""))
    return bind(F.struct(text.alias("text"), province(text).alias("single")), lambda x: _province_codes(x["text"], x["single"]))


def _province_codes(text: Column, single: Column) -> Column:
    pairs = F.filter(F.regexp_extract_all(F.upper(text), F.lit("[A-Z]{2}"), F.lit(0)), lambda x: _is_code(x))
    names = F.transform(F.regexp_extract_all(match_text(text), F.lit(rf"\b({_ANY_NAME})\b"), F.lit(1)), _code_of)
    return F.when(text == "", F.array().cast("array<string>")).when(_is_code(single), F.array(single)).otherwise(F.sort_array(F.array_distinct(F.concat(pairs, names))))


#: Codes that may be acronyms, and the words around them that tell so.
ELECTRICAL = {
    "AT": ("alta tensione", "stallo", "cabina primaria", "rete at", "connessione at", "linea at"),
    "MT": ("media tensione", "rete mt", "connessione mt", "cavidotto mt", "linea mt", "cabina primaria", "15 000 v", "15000 v"),
}
REACH = 80


def title_province_codes(title: Column) -> Column:
    """Provinces that a title names in parentheses or after "provincia", in order of the forms.

    A code in parentheses isn't one where the words within REACH characters
    speak of voltage.
    """
    raw = F.coalesce(title, F.lit(""))
    return bind(F.struct(raw.alias("raw"), match_text(raw).alias("words")), lambda x: _title_province_codes(x["raw"], x["words"]))


def _title_province_codes(raw: Column, words: Column) -> Column:
    form = r"\(([A-Za-z]{2})\)"
    codes = F.transform(F.regexp_extract_all(raw, F.lit(form), F.lit(1)), F.upper)
    gaps = F.split(raw, form, -1)

    def is_province(code: Column, i: Column) -> Column:
        before = F.right(F.array_join(F.slice(gaps, F.lit(1), i + 1), " () "), F.lit(REACH))
        after = F.left(F.array_join(F.slice(gaps, i + 2, F.size(gaps)), " () "), F.lit(REACH))
        around = F.concat_ws(" ", match_text(before), match_text(after))
        electrical = F.lit(False)
        for k, words in ELECTRICAL.items():
            electrical = electrical | ((code == k) & F.rlike(around, F.lit("|".join(words))))
        return _is_code(code) & ~electrical

    after_word = F.filter(F.transform(F.regexp_extract_all(words, F.lit(r"\b(?:prov|provincia)\s+(?:di\s+)?([a-z]{2})\b"), F.lit(1)), F.upper), lambda x: _is_code(x))
    named = F.transform(F.regexp_extract_all(words, F.lit(rf"\b(?:provincia|prov)\s+(?:di\s+)?({_ANY_NAME})\b"), F.lit(1)), _code_of)
    return F.array_distinct(F.concat(F.filter(codes, is_province), after_word, named))


def municipality(c: Column) -> Column:
    """A municipality's name for comparison."""
    return F.trim(F.regexp_replace(F.regexp_replace(match_text(c), r"\b(?:comune di|in)\b", " "), " +", " "))


def title_municipality(title: Column) -> Column:
    """The municipality that a title names after "comune di"; empty without."""
    form = r"\b(?:comun[ei]|nel territorio comunale) di ([a-z0-9 ]{3,80}?)(?: provincia| prov | in provincia| e |$)"
    found = F.regexp_extract(match_text(title), form, 1)
    return municipality(F.trim(F.regexp_replace(found, r"\b(?:provincia|prov|regione|potenza|mw|mwp)\b.*$", "")))


def region_of(code: Column) -> Column:
    """The region in which a province lies; null for other codes."""
    return F.try_element_at(F.str_to_map(F.lit(_REGION_TABLE), F.lit(";"), F.lit(":")), F.upper(code))


def region(c: Column) -> Column:
    """A region's name as it is published; other texts with capitals, empty for null."""
    given = F.trim(F.coalesce(c, F.lit("")))
    known = F.create_map(*(F.lit(x) for name in REGIONS for x in (" ".join(_plain(name).split()), name)))
    return F.coalesce(F.try_element_at(known, key_words(given)), F.initcap(given))


def _plain(name: str) -> str:
    """A region's name in lower case, its signs as spaces."""
    return "".join(ch if ch.isalnum() else " " for ch in name.lower())


#: Words that speak of a place.
PLACE_WORDS = r"(?:provincia|prov\.|comune|comuni|localit[àa])"


def province_in_text(c: Column) -> Column:
    """The province that a text names: a code in parentheses in one sentence with a word for a place, within 160 characters; else a name after "provincia di"; else a code with such a word within 120 characters. Null without."""
    text = F.coalesce(c, F.lit(""))
    sentence = (rf"(?i)\b{PLACE_WORDS}(?![\p{{L}}\p{{N}}])[^.;\n]{{0,160}}\(([A-Z]{{2}})\)", rf"(?i)\(([A-Z]{{2}})\)[^.;\n]{{0,160}}\b{PLACE_WORDS}(?![\p{{L}}\p{{N}}])")
    valid = lambda x: _is_code(x)
    together = F.filter(F.transform(F.flatten(F.array(*(F.regexp_extract_all(text, F.lit(p), F.lit(1)) for p in sentence))), F.upper), valid)
    named = _code_of(F.regexp_extract(match_text(text), rf"\b(?:provincia|prov|citta metropolitana) di (?:[a-z0-9]+ ){{0,6}}?({_ANY_NAME})\b", 1))
    form = r"\(([A-Z]{2})\)"
    codes, gaps = F.regexp_extract_all(text, F.lit(form), F.lit(1)), F.split(text, form, -1)

    def beside(code: Column, i: Column) -> Column:
        before = F.right(F.array_join(F.slice(gaps, F.lit(1), i + 1), "(  )"), F.lit(120))
        after = F.left(F.array_join(F.slice(gaps, i + 2, F.size(gaps)), "(  )"), F.lit(120))
        return valid(code) & F.rlike(F.concat_ws(" ", before, after), F.lit(rf"(?i){PLACE_WORDS}"))

    return F.coalesce(F.get(together, F.lit(0)), named, F.get(F.filter(codes, beside), F.lit(0)))


#: How texts introduce municipalities, in order of trust: after a word for a territory up to what ends a place, and before "in provincia di".
_ENDS = r"(?=\s*\([A-Za-z]{2}\)|,?\s+(?:in\s+)?provincia|,?\s+citt[àa]\s+metropolitana|,?\s+denominat|,?\s+avente|,?\s+con\s+una|,?\s+di\s+potenza|\.|;|\n|\s+-|\s*\z)"
MUNICIPALITY_FORMS = (
    rf"(?i)\bcomun[ei]\s+di\s+(.+?){_ENDS}",
    rf"(?i)\bterritori[oa]?\s+comunal[ei]\s+di\s+(.+?){_ENDS}",
    rf"(?i)\bcentro\s+abitato\s+di\s+(.+?){_ENDS}",
    r"(?i)(?<![\p{L}\p{N}])([A-ZÀ-Ú][A-Za-zÀ-ÿ'’\- ]{2,80}),\s+(?:in\s+provincia|citt[àa]\s+metropolitana)\s+di\s+[A-ZÀ-Ú]",
)
#: Words that no municipality's name holds, and words that don't end one.
NOT_IN_NAMES = (
    "dettaglio", "valutazioni", "autorizzazioni", "ambientali", "vas", "via", "aia", "conclusa", "concluso", "successivamente", "ridotta", "ridotto", "determinazione", "determina", "decreto", "ministeriale",
    "direttoriale", "provvedimento", "d.m.", "dm_", "dm ", "data pubblicazione", "pubblicazione", "esito", "positivo", "negativo", "scarica", "progetto", "documentazione", "procedura", "pagina", "home", "menu",
    "mw", "mwp", "kw", "kwp", "potenza", "impianto", "impianti",
)
NOT_AT_END = ("in", "nel", "nella", "nei", "nelle", "del", "della", "delle", "dei", "con", "da", "di", "e", "ed")
MOST_MUNICIPALITIES, MOST_WORDS = 12, 6


def _town(x: Column) -> Column:
    """A candidate without what follows a name; null if it can't be one."""
    name = F.regexp_replace(x, r"(?i)\A\s*(?:nel|nei)?\s*(?:territori[oa]?\s+comunal[ei]|comun[ei])\s+di\s+", "")
    name = F.regexp_replace(name, r"(?i)\s*\([A-Z]{2}\b.*\z|\s*-?\s*\b(?:dettaglio|valutazioni|provincia|prov\.|localit[àa]|citt[àa] metropolitana|denominat[oa]|avente|con potenza|di potenza|successivamente)\b.*\z", "")
    name = F.regexp_replace(F.btrim(name, F.lit(" .:-,;()[]")), rf"(?i)(?:\s+(?:{'|'.join(NOT_AT_END)}))+\z", "")

    def checked(name: Column) -> Column:
        bad = F.rlike(F.lower(name), F.lit("|".join(rf"\Q{w}\E" for w in NOT_IN_NAMES))) | F.rlike(name, F.lit("[0-9]"))
        fits = F.length(name).between(3, 80) & (F.size(F.split(name, r"\s+")) <= MOST_WORDS) & ~bad
        return F.when(fits, place_case(name))

    return bind(name, checked)


def municipalities(text: Column, protected: tuple[str, ...] = ()) -> Column:
    """The municipalities that a text names, by the forms in order, at most MOST_MUNICIPALITIES.

    protected names hold an "e" that doesn't separate two.
    """
    found = F.flatten(F.array(*(F.regexp_extract_all(text, F.lit(form), F.lit(1)) for form in MUNICIPALITY_FORMS)))
    for i, name in enumerate(protected):
        found = F.transform(found, _protect(name, i))
    items = F.flatten(F.transform(found, lambda x: F.split(x, r"(?i)\s*[,;/]\s*|\s+(?:e|ed)\s+")))
    for i, name in enumerate(protected):
        items = F.transform(items, _restore(name, i))
    items = F.filter(F.transform(items, _town), lambda x: x.isNotNull())
    return bind(items, lambda x: F.slice(distinct_by(x, key_words), 1, MOST_MUNICIPALITIES))


def _protect(name: str, i: int):
    return lambda x: F.replace(x, F.lit(name), F.lit(f"\u0001{i}\u0001"))


def _restore(name: str, i: int):
    return lambda x: F.replace(x, F.lit(f"\u0001{i}\u0001"), F.lit(name))


def with_gazetteer(df: DataFrame, gazetteer: DataFrame, name: str = "municipality") -> DataFrame:
    """Left join with a table of key, comune, sigla and regione; the table has a row per municipality."""
    return df.withColumn("__key", key_words(F.col(name))).join(gazetteer.withColumnRenamed("key", "__key"), "__key", "left").drop("__key")


def infer_province(df: DataFrame, gazetteer: DataFrame, id_col: str, names: str) -> DataFrame:
    """id_col and the province of all municipalities of an array, null unless they lie in one."""
    each = df.select(id_col, F.explode(names).alias("__name")).withColumn("key", key_words(F.col("__name")))
    found = each.join(gazetteer.select("key", "sigla"), "key").groupBy(id_col).agg(F.collect_set("sigla").alias("__all"))
    return found.select(id_col, F.when(F.size("__all") == 1, F.col("__all")[0]).alias("province"))


def deduced(given: Column, *found: Column) -> tuple[Column, Column]:
    """The given value, else the first that was found; and whether it was found."""
    value = F.coalesce(F.nullif(F.trim(given), F.lit("")), *(F.nullif(x, F.lit("")) for x in found))
    return value, (F.coalesce(F.trim(given), F.lit("")) == "") & value.isNotNull()


def without_capital(names: Column, capital: str, title: Column) -> Column:
    """The names without that of the provincial capital, where others stand beside it or the title speaks of another municipality."""
    others = F.filter(names, lambda x: key_words(x) != key_words(F.lit(capital)))
    return F.when((F.size(others) > 0) | ((title_municipality(title) != "") & (title_municipality(title) != key_words(F.lit(capital)))), others).otherwise(names)


#: Words before a name that make it a province's, and after it a page's furniture.
NOT_BEFORE, NOT_AFTER = ("provincia", "prov", "metropolitana"), ("dettaglio", "valutazioni", "ambientali")
CONTEXT_WORDS, LEAST_LETTERS = 4, 4


def gazetteer_scan(df: DataFrame, gazetteer: DataFrame, id_col: str, text: str, most_words: int = MOST_WORDS) -> DataFrame:
    """id_col and the municipalities of a gazetteer (key, comune) that stand anywhere in a text, the longest names first, at most MOST_MUNICIPALITIES.

    A text's runs of up to most_words words are looked up by an equi join, and
    only those that are a name are kept; what stands within four words tells
    provinces and page furniture from places. A row without any has no row.
    """
    words = F.split(key_words(F.col(text)), " ")
    each = df.select(id_col, words.alias("__w")).where(F.size("__w") > 0)
    runs = F.flatten(F.transform("__w", lambda w, i: F.transform(F.sequence(F.lit(1), F.least(F.lit(most_words), F.size("__w") - i)), lambda n: F.struct(F.array_join(F.slice("__w", i + 1, n), " ").alias("key"), i.alias("i"), n.alias("n")))))
    before = F.slice("__w", F.greatest(F.col("x.i") - CONTEXT_WORDS, F.lit(0)) + 1, F.least(F.col("x.i"), F.lit(CONTEXT_WORDS)))
    after = F.slice("__w", F.col("x.i") + F.col("x.n") + 1, F.lit(CONTEXT_WORDS))
    place = ~F.arrays_overlap(before, F.array(*map(F.lit, NOT_BEFORE))) & ~F.arrays_overlap(after, F.array(*map(F.lit, NOT_AFTER)))
    names = gazetteer.select("key", "comune").where(F.length("key") >= LEAST_LETTERS).dropDuplicates(["key"])
    asked = each.select(id_col, "__w", F.explode(runs).alias("x")).where(F.length("x.key") >= LEAST_LETTERS)
    asked = asked.select(id_col, F.col("x.key").alias("key"), F.col("x.i").alias("i"), place.alias("place"))
    found = asked.where("place").join(names, "key").groupBy(id_col, "comune").agg(F.max(F.length("key")).alias("n"), F.min("i").alias("i"))
    ranked = F.transform(F.sort_array(F.collect_list(F.struct(-F.col("n"), F.col("i"), F.col("comune").alias("comune")))), lambda x: x["comune"])
    return found.groupBy(id_col).agg(F.slice(ranked, 1, MOST_MUNICIPALITIES).alias("municipalities"))


def place_from_text(text: Column, given_region: Column, given_province: Column, given_towns: Column, known_towns: Column | None = None, known_province: Column | None = None) -> Column:
    """Region, province, municipalities and whether the last two were deduced.

    What is given stays; then what the text names; then known_towns and
    known_province, as gazetteer_scan() and infer_province() find them.
    """
    own = F.coalesce(given_towns, F.array().cast("array<string>"))
    named = municipalities(text)
    known = F.coalesce(known_towns if known_towns is not None else F.lit(None).cast("array<string>"), F.array().cast("array<string>"))
    towns = F.when(F.size(own) > 0, own).when(F.size(named) > 0, named).otherwise(known)
    inferred = known_province if known_province is not None else F.lit(None).cast("string")
    code, deduced_code = deduced(province(given_province), province_in_text(text), inferred)
    parts = F.struct(code.alias("province"), deduced_code.alias("province_deduced"), towns.alias("municipalities"), ((F.size(own) == 0) & (F.size(towns) > 0)).alias("municipalities_deduced"), F.nullif(F.trim(given_region), F.lit("")).alias("given"))
    return bind(parts, lambda x: F.struct(F.coalesce(x["given"], region_of(x["province"])).alias("region"), x["province"], x["municipalities"], x["province_deduced"], x["municipalities_deduced"]))


def ministry_place(title: Column, row_text: Column, info_province: Column, info_towns: Column, known_province: Column | None = None, known_towns: Column | None = None) -> Column:
    """Province and municipalities of a ministry's record: of the title, then known from the title, then of the information sheet, then of the row's text."""
    none = F.lit(None).cast("string")
    some = lambda a: F.when(F.size(a) > 0, a)
    code = F.coalesce(F.get(title_province_codes(title), F.lit(0)), province_in_text(title), known_province if known_province is not None else none, F.nullif(province(info_province), F.lit("")), province_in_text(row_text))
    towns = F.coalesce(some(municipalities(title)), *([some(known_towns)] if known_towns is not None else []), some(info_towns), some(municipalities(row_text)), F.array().cast("array<string>"))
    return F.struct(code.alias("province"), towns.alias("municipalities"))

"""Facts told in the free text of records and pages: identifiers, companies, powers, titles, outcomes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bind, ladder, match_text, normalize_text, null_if_blank, truncate, unescape_basic

#: Fields that may hold a source's own identifier, in the order in which they are asked.
IDENTIFIER_FIELDS = ("id", "project_id", "procedure_id", "id_procedura", "id_procedimento", "codice", "codice_procedura", "codice_pratica", "numero_procedura", "id_pratica", "mase_id")


def source_identifier(fields: dict[str, Column], title: Column, source: Column) -> Column:
    """Field:value of the first identifier field that is present; of the ministry's records without one, mase: and the number that the title gives; else empty."""
    named = [F.when(null_if_blank(fields[f].cast("string")).isNotNull(), F.concat(F.lit(f.replace("_", "") + ":"), match_text(fields[f].cast("string")))) for f in IDENTIFIER_FIELDS if f in fields]
    words = match_text(title)
    number = F.coalesce(*(F.nullif(F.regexp_extract(words, p, 1), F.lit("")) for p in (r"\b(?:id|codice)\s?(?:procedura|progetto|pratica)?\s?([0-9]{3,})\b", r"\bid ?([0-9]{3,})\b")))
    of_ministry = F.when(F.contains(match_text(source), F.lit("mase")), F.concat(F.lit("mase:"), number))
    return F.coalesce(*named, of_ministry, F.lit(""))


#: Labels that stand before a company, and those that end it where a page's lines run together.
COMPANY_LABELS = ("soggetto proponente", "società proponente", "societa proponente", "proponente")
LABELS_AFTER = ("data pubblicazione", "data avvio", "tipologia", "procedura", "autorità", "autorita", "regione", "provincia", "comune", "localizzazione", "documentazione", "codice", "id", "identificativo")
#: What a register puts around names.
HOLDERS = ("azienda", "ente", "persona fisica")


def _spaced(words: tuple[str, ...]) -> str:
    return "|".join(w.replace(" ", r"\s+") for w in words)


def clean_company(c: Column) -> Column:
    """A company's name without a register's wrappers, the label before it and the labels after it; null if nothing is left."""
    text = normalize_text(unescape_basic(c.cast("string")))
    steps = (
        (rf"(?i)\(\s*(?:{_spaced(HOLDERS)})\s*\)?\s*:?\s*", ""),
        (r"\A\s*\)\s*:?\s*", ""),
        (r";\s*\)\s*:?\s*|\)\s*;", "; "),
        (rf"(?i)\A(?:{_spaced(COMPANY_LABELS)})\s*[:\-]\s*", ""),
        (rf"(?i)\s+(?:{_spaced(LABELS_AFTER)})(?![\p{{L}}\p{{N}}]).*\z", ""),
        (r"(?:\s*;)+\s*", "; "),
        (r"\A[\s:;|\-–—]+|[\s:;|\-–—]+\z", ""),
        (r"\A([^(]*)\)\z", "$1"),
    )
    for pattern, replacement in steps:
        text = F.regexp_replace(text, pattern, replacement)
    return normalize_text(text)


#: Where a candidate was found, the most trusted place first.
CANDIDATE_PLACES = ("table_row", "sibling", "plain_text")


def best_candidate(candidates: Column) -> Column:
    """Of structs (place, value), the cleaned one of the most trusted place, then the shortest, then the first; equal names count as their first. Null without any."""
    cleaned = F.filter(F.transform(candidates, lambda x, i: F.struct(x["place"].alias("place"), clean_company(x["value"]).alias("value"), i.alias("i"))), lambda x: x["value"].isNotNull())

    def chosen(all_: Column) -> Column:
        names = F.transform(all_, lambda x: match_text(x["value"]))
        first = F.filter(all_, lambda x, i: F.array_position(names, F.get(names, i)) == i + 1)
        trust = lambda p: F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, CANDIDATE_PLACES)), p), F.lit(0)), F.lit(99))
        return F.array_min(F.transform(first, lambda x: F.struct(trust(x["place"]).alias("trust"), F.length(x["value"]).alias("n"), x["i"].alias("i"), x["place"].alias("place"), x["value"].alias("value"))))

    best = bind(cleaned, chosen)
    return F.when(best.isNotNull(), F.struct(best["place"].alias("place"), best["value"].alias("value")))


#: Words that tell a battery's power from a plant's, and the phrase that overrules them.
STORAGE_WORDS = ("bess", "accumulo", "storage", "batteria", "batterie")
PLANT_PHRASE = "potenza fotovoltaica"
_AMOUNT = r"(?i)(?<![0-9.,])([0-9]+(?:[.\s'’][0-9]{3})*(?:[,.][0-9]+)?)\s*(mwp|mw|kwp|kw)\b"


def plant_power(c: Column, before: int = 140, near: int = 60) -> Column:
    """Number and unit of the plant's power in a text.

    Amounts after "potenza" count first, then those after "da", then others;
    amounts that follow a word for storage within before characters don't,
    unless "potenza fotovoltaica" stands within near characters.
    """
    return bind(F.coalesce(normalize_text(c), F.lit("")), lambda x: _plant_power(x, before, near))


def _plant_power(text: Column, before: int, near: int) -> Column:
    whole, number, unit = (F.regexp_extract_all(text, F.lit(_AMOUNT), F.lit(g)) for g in (0, 1, 2))
    parts = F.struct(whole.alias("whole"), number.alias("number"), unit.alias("unit"), F.split(text, _AMOUNT, -1).alias("gaps"))

    def described(p: Column) -> Column:
        def one(i: Column) -> Column:
            ahead = F.flatten(F.transform(F.sequence(F.lit(0), i), lambda j: F.array(F.when(j > 0, F.get(p["whole"], j - 1)), F.get(p["gaps"], j))))
            context = F.lower(F.right(F.array_join(ahead, ""), F.lit(before)))
            stored = F.rlike(context, F.lit("|".join(STORAGE_WORDS))) & ~F.contains(F.right(context, F.lit(near)), F.lit(PLANT_PHRASE))
            rank = F.when(F.rlike(context, F.lit(r"potenza(?:\s+\p{L}+){0,5}\s*\z")), 0).when(F.rlike(context, F.lit(r"\bda\s*\z")), 1).otherwise(2)
            return F.struct(rank.alias("rank"), i.alias("i"), F.concat_ws(" ", F.get(p["number"], i), F.get(p["unit"], i)).alias("amount"), stored.alias("stored"))

        every = F.transform(F.sequence(F.lit(0), F.size(p["whole"]) - 1), one)
        return F.when(F.size(p["whole"]) > 0, F.array_min(F.filter(every, lambda x: ~x["stored"]))["amount"])

    return bind(parts, described)


def legacy_power(c: Column) -> Column:
    """The first number of a text as megawatts with three decimals; a dot groups thousands only beside a comma."""
    text = F.lower(normalize_text(c))
    number = F.regexp_extract(text, r"([0-9]+(?:[.,][0-9]+)?)", 1)
    plain = F.when(F.contains(number, F.lit(",")), F.replace(F.replace(number, F.lit("."), F.lit("")), F.lit(","), F.lit("."))).otherwise(number)
    value = F.nullif(plain, F.lit("")).try_cast("double")
    kilo = F.contains(text, F.lit("kw")) & ~F.contains(text, F.lit("mw"))
    return F.when(value.isNotNull(), F.format_string("%.3f", F.when(kilo, value / 1000).otherwise(value)))


#: Outcomes and the words that stand for them, asked in this order.
LAZIO_OUTCOMES = (
    ("Favorevole con prescrizioni", ("favorevole con prescrizioni",)),
    ("Favorevole", ("favorevole",)),
    ("Archiviato", ("archiviato", "archiviata")),
    ("Improcedibile", ("improcedibile",)),
    ("Rinviato a VIA", ("rinviato a via", "rinviato a v.i.a", "rinviato alla procedura di via", "rinviata alla procedura di via", "rinviato alla procedura di v.i.a", "rinviata alla procedura di v.i.a")),
    ("Escluso da VIA", ("esclusa dal via", "escluso dal via", "esclusa da via", "escluso da via", "escluso dal procedimento di via", "esclusa dal procedimento di via", "escluso dal procedimento di v.i.a", "esclusa dal procedimento di v.i.a")),
    ("Concluso", ("conclus",)),
    ("In corso", ("in corso",)),
)
SARDEGNA_OUTCOMES = (
    ("Riavvio procedimento", ("riavvio",)),
    ("Favorevole con prescrizioni", ("favorevole con prescrizioni",)),
    ("Favorevole", ("favorevole",)),
    ("Negativo", ("negativo", "non compatibile")),
    ("Improcedibile", ("improcedibil",)),
    ("Archiviato", ("archiviat",)),
    ("Osservazioni pervenute", ("osservazioni pervenute",)),
    ("Integrazioni", ("integrazioni",)),
    ("Istanza depositata", ("ha depositato l'istanza", "depositato l’istanza")),
    ("Avvio procedimento", ("avvio del procedimento",)),
)
SARDEGNA_PROCEDURES = (("PAUR", ("p.a.u.r", "paur")), ("VERIFICA", ("verifica",)), ("VALUTAZIONE PRELIMINARE", ("valutazione preliminare",)), ("VIA", ("v.i.a", " via ")))
PIEMONTE_PROCEDURES = (("Valutazione di incidenza", ("/VI",)), ("VIA", ("/VAL",)), ("Verifica", ("/VER",)), ("Specificazione", ("/SPE",)))


def outcome(c: Column, rules=LAZIO_OUTCOMES) -> Column:
    """What a text says of a procedure, by the words of the first rule that has one; null without."""
    return ladder(F.concat(F.lit(" "), F.lower(normalize_text(c)), F.lit(" ")), rules)


def procedure_of_code(code: Column) -> Column:
    """The procedure that a register's code names; of a code without, the register; null without a code."""
    return F.when(null_if_blank(code).isNotNull(), ladder(F.upper(code), PIEMONTE_PROCEDURES, F.lit("Piemonte SKVIA")))


#: Titles of pages that name no project.
GENERIC_TITLES = (
    "valutazioni e autorizzazioni ambientali vas via aia", "provvedimenti 2026 valutazioni ambientali", "provvedimenti 2026", "valutazioni ambientali", "vas via aia", "dettaglio valutazioni", "home comunicazione",
)
#: Procedures that stand before a project's title.
PROCEDURE_HEADS = ("Valutazione Impatto Ambientale", "Valutazione di Impatto Ambientale", "Verifica di Assoggettabilità a VIA", "Provvedimento Unico in materia Ambientale", "Verifica di Ottemperanza")


def is_generic_title(c: Column) -> Column:
    """A title that names a section of a site, or is too short to name a project."""
    words = match_text(c)
    return (F.length(words) < 10) | F.rlike(words, F.lit("|".join(GENERIC_TITLES)))


def list_title(c: Column) -> Column:
    """A title from a list of links, without the link's own word; null if it is generic."""
    text = F.regexp_replace(F.replace(normalize_text(c), F.lit("Dettaglio"), F.lit("")), r"\A[\s:\-–—]+|[\s:\-–—]+\z", "")
    return F.when(~is_generic_title(text), truncate(text, 800))


def detail_title(headings: Column, plain: Column) -> Column:
    """The first heading of a page that isn't generic, of 15 characters at least, else what follows a procedure's name in its text; null without."""
    fit = F.filter(F.transform(headings, normalize_text), lambda x: x.isNotNull() & ~is_generic_title(x) & (F.length(x) >= 15))
    named = F.regexp_extract(normalize_text(plain), rf"(?i)(?:{'|'.join(PROCEDURE_HEADS)})\s*:\s*(.+?)(?:\s+Data pubblicazione|\s+Esito|\s+D\.M\.|\s+DM_|\z)", 1)
    named = normalize_text(named)
    return F.coalesce(F.get(fit, F.lit(0)), F.when(~is_generic_title(named), named))


def page_title(plain: Column, n: int = 350) -> Column:
    """A title from a page's text as a last resort: from the procedure's name on, cut between words."""
    text = F.coalesce(normalize_text(plain), F.lit("MASE Provvedimento"))
    named = F.regexp_extract(text, rf"(?i)(?:{'|'.join(PROCEDURE_HEADS)})\s*:?\s*.+", 0)
    text = F.coalesce(F.nullif(named, F.lit("")), text)
    return F.when(F.length(text) > n, F.regexp_replace(F.left(text, F.lit(n)), r" [^ ]*\z", "")).otherwise(text)


def written_power(mw: Column) -> Column:
    """Megawatts with up to six decimals, trailing zeros gone."""
    return F.concat(F.regexp_replace(F.regexp_replace(F.format_string("%.6f", F.round(mw.cast("double"), 6)), r"0+\z", ""), r"\.\z", ""), F.lit(" MW"))


def operational_title(proponent: Column, municipalities: Column, province: Column, mw: Column, kind: Column, procedure: Column, administrative: Column) -> Column:
    """Who, or what, or how; where; and how much. Of more than four municipalities four are named."""
    who = F.coalesce(*map(null_if_blank, (proponent, kind, procedure)))
    named = F.concat(F.array_join(F.slice(municipalities, 1, 4), ", "), F.when(F.size(municipalities) > 4, "…").otherwise(""))
    where = F.when(F.size(municipalities) > 0, named).otherwise(null_if_blank(province))
    title = normalize_text(F.concat_ws(" - ", who, where, F.when(mw.isNotNull(), written_power(mw))))
    return truncate(F.coalesce(title, null_if_blank(administrative), F.lit("Sistema Puglia Energia")), 700)


def edited_title(title: Column, edits: list[tuple[str, str]]) -> Column:
    """Regular expressions and what they become, in order."""
    for pattern, replacement in edits:
        title = F.regexp_replace(title, pattern, replacement)
    return title


def edited_titles(titles: Column, edits: list[tuple[str, str]]) -> Column:
    """The same in a list of merged titles; titles that become equal stay once."""
    return F.array_distinct(F.transform(titles, lambda x: edited_title(x, edits)))


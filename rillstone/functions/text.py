"""String scalars: cleaning, keys, tokens, slugs, ladders of labels."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Iterable, Sequence
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


#: Characters that count as white space besides those of \s: no-break and zero-width ones.
_SPACES = r"[\s\x{00A0}\x{FEFF}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


def _accents() -> tuple[str, str]:
    """Latin letters with marks and the letters without, from their decompositions."""
    pairs = [(chr(i), unicodedata.normalize("NFKD", chr(i))[0]) for i in range(0xC0, 0x250) if len(unicodedata.normalize("NFKD", chr(i))) > 1 and unicodedata.normalize("NFKD", chr(i))[0].isascii()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_MARKED, _PLAIN = _accents()


def bind(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body mentions it.

    An expression that is mentioned many times is written out as often, and
    generated code grows beyond what the JVM compiles.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def settled(c: Column) -> Column:
    """The column, with a term that isn't deterministic but changes nothing.

    A filter on it is not pushed below the projection that makes it. Pushed
    down, it would write out all that the column is made of, at each mention.
    """
    return F.when(F.monotonically_increasing_id() >= 0, c)


def is_blank(c: Column) -> Column:
    """Null, or white space alone."""
    return F.coalesce(F.trim(F.regexp_replace(c.cast("string"), _SPACES, " ")), F.lit("")) == ""


def null_if_blank(c: Column) -> Column:
    return F.when(~is_blank(c), c)


def first_present(*columns: Column) -> Column:
    """The first that isn't blank."""
    return F.coalesce(*map(null_if_blank, columns))


def truncate(c: Column, n: int) -> Column:
    """P10."""
    return F.left(c, F.lit(n))


def normalize_text(c: Column) -> Column:
    """White space collapsed and trimmed, byte-order marks gone; null if nothing is left."""
    text = F.trim(F.regexp_replace(F.regexp_replace(c.cast("string"), r"\x{FEFF}", ""), _SPACES, " "))
    return F.nullif(text, F.lit(""))


def fold(c: Column) -> Column:
    """Latin letters without their marks, by a table made from Unicode decompositions; combining marks go."""
    return F.regexp_replace(F.translate(c, _MARKED, _PLAIN), r"\p{M}+", "")


def key_words(c: Column) -> Column:
    """Lower-case words of a-z and 0-9 between single spaces; empty for null."""
    text = F.regexp_replace(F.lower(fold(F.coalesce(c.cast("string"), F.lit("")))), "[^a-z0-9]+", " ")
    return F.trim(text)


def key_compact(c: Column) -> Column:
    """As key_words, without spaces."""
    return F.replace(key_words(c), F.lit(" "), F.lit(""))


def key_snake(c: Column) -> Column:
    """As key_words, joined by underscores."""
    return F.replace(key_words(c), F.lit(" "), F.lit("_"))


#: Legal forms, longest last, as they are folded one after another.
LEGAL_FORMS = (("srl", r"s\.?\s*r\.?\s*l\.?|srl"), ("spa", r"s\.?\s*p\.?\s*a\.?|spa"), ("srls", r"s\.?\s*r\.?\s*l\.?\s*s\.?|srls"))


def match_text(c: Column) -> Column:
    """Key words with legal forms folded and & as a word."""
    text = F.replace(F.lower(fold(F.coalesce(unescape_basic(c.cast("string")), F.lit("")))), F.lit("&"), F.lit(" e "))
    for name, form in LEGAL_FORMS:
        text = F.regexp_replace(text, rf"\b(?:{form})\b", f" {name} ")
    return F.trim(F.regexp_replace(text, "[^a-z0-9]+", " "))


#: Entities that are resolved without Python.
ENTITIES = (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"))


def unescape_basic(c: Column) -> Column:
    """The common entities; unescape() knows all."""
    out = c
    for a, b in ENTITIES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.when(F.contains(c, F.lit("&")), out).otherwise(c)


@F.pandas_udf(StringType())
def unescape(texts: pd.Series) -> pd.Series:
    """Every HTML entity."""
    return texts.map(html.unescape, na_action="ignore")


def clean_text(c: Column) -> Column:
    """Normalised text; none, nan and null count as missing, control characters go."""
    text = F.regexp_replace(normalize_text(c), r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]", "")
    return F.when(~F.lower(text).isin("none", "nan", "null"), text)


#: uTF-8 read as Latin-1: what is seen and what was meant.
MOJIBAKE = tuple((c.encode().decode("latin-1"), c) for c in "àèéìòùÀÈÉ°") + tuple((c.encode().decode("cp1252", "ignore"), c) for c in "’–“")


def repair_mojibake(c: Column) -> Column:
    """X6."""
    for seen, meant in MOJIBAKE:
        c = F.replace(c, F.lit(seen), F.lit(meant))
    return c


def short_hash(c: Column, n: int = 16) -> Column:
    """The first hexadecimal digits of SHA-1."""
    return F.left(F.sha1(F.coalesce(c, F.lit(""))), F.lit(n))


def slug(c: Column, n: int = 250) -> Column:
    """Lower case, white space as hyphens, other signs gone."""
    text = F.regexp_replace(F.lower(F.trim(c)), r"\s+", "-")
    return F.left(F.regexp_replace(text, r"[^a-z0-9_\-]", ""), F.lit(n))


#: Particles of place names that stay in lower case.
PARTICLES = ("di", "del", "della", "dei", "delle", "dello", "degli", "da", "dal", "in", "e", "a", "al", "alla", "la", "il", "lo", "sul", "nel")


def place_case(c: Column) -> Column:
    """Words with a capital, particles but the first in lower case."""
    words = F.split(F.lower(F.trim(c)), r"\s+")
    cased = F.transform(words, lambda w, i: F.when((i > 0) & w.isin(*PARTICLES), w).otherwise(_capital(w)))
    return F.array_join(cased, " ")


def _capital(word: Column) -> Column:
    """A capital at the start and after an apostrophe or hyphen."""
    parts = F.split(word, r"(?<=['’\-])")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.left(p, F.lit(1))), F.substr(p, F.lit(2)))), "")


#: Words that say nothing about which project a title names.
STOPWORDS = (
    "impianto", "fotovoltaico", "agrivoltaico", "agrovoltaico", "realizzazione", "costruzione", "esercizio", "progetto", "procedura",
    "valutazione", "verifica", "assoggettabilita", "via", "vas", "pnrr", "pniec", "autorizzazione", "unica", "determina", "determinazione",
    "provvedimento", "comune", "provincia", "localita", "sito", "territorio", "potenza", "nominale", "complessiva", "mw", "mwp", "kw", "kwp",
)


def tokens(normalized: Column, stopwords: Sequence[str] = STOPWORDS, least: int = 4) -> Column:
    """X11: the distinct words of some length that aren't stop words."""
    return F.array_distinct(F.filter(F.split(normalized, " "), lambda w: (F.length(w) >= least) & ~w.isin(*stopwords)))


def jaccard(a: Column, b: Column) -> Column:
    shared, union = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / union).otherwise(0.0)


def containment(a: Column, b: Column) -> Column:
    shared = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), shared / F.least(F.size(a), F.size(b))).otherwise(0.0)


def similarity(autojunk: bool = True):
    """A vectorised function of two texts, their Ratcliff-Obershelp ratio; the order of the two matters."""

    @F.pandas_udf("double")
    def ratio(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, x, y, autojunk=autojunk).ratio() if x and y else 0.0 for x, y in zip(a, b, strict=True)])

    return ratio


def similarity_bound(a: Column, b: Column) -> Column:
    """What the ratio can't exceed, given the lengths: a filter before similarity()."""
    return F.try_divide(2 * F.least(F.length(a), F.length(b)), F.length(a) + F.length(b))


def ladder(text: Column, rules: Iterable[tuple[str, Sequence[str]]], default: Column | None = None) -> Column:
    """The label of the first rule of which a word is in the text."""
    out = None
    for label, words in rules:
        hit = F.rlike(text, F.lit("|".join(map(_quoted, words))))
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    return out.otherwise(default if default is not None else F.lit(None).cast("string"))


def _quoted(word: str) -> str:
    return rf"\Q{word}\E"


#: Labels and the words that stand for them, asked in this order.
STATUS_RULES = (
    ("in_corso", ("in corso", "in itinere", "avviata", "avviato", "verifica amministrativa")),
    ("concluso", ("conclusa", "concluso", "chiusa", "chiuso", "valutato", "parere via espresso")),
    ("archiviato", ("archiviata", "archiviato", "improcedibile")),
    ("positivo", ("positivo", "positiva", "favorevole", "compatibile")),
    ("negativo", ("negativo", "negativa", "sfavorevole", "non compatibile")),
    ("sospeso", ("sospesa", "sospeso", "sospensione")),
)
#: The order in which a negative outcome isn't mistaken for the positive one that it contains.
CORRECTED_STATUS_RULES = (*STATUS_RULES[:3], STATUS_RULES[4], STATUS_RULES[3], STATUS_RULES[5])


def status(c: Column, corrected: bool = False) -> Column:
    """One of six labels, else the text itself, cut to 100 characters."""
    text = normalize_text(c)
    return F.when(text.isNotNull(), ladder(F.lower(text), CORRECTED_STATUS_RULES if corrected else STATUS_RULES, truncate(text, 100)))


#: Fixed values.
PROJECT_TYPES = (("agrivoltaico", ("agrivolt", "agrovolt", "agri-volt", "agro-volt")), ("fotovoltaico", ("fotovolt", "solare", "pv")), ("accumulo", ("accumulo", "storage", "bess")))


def project_type(c: Column) -> Column:
    """X21."""
    return ladder(F.lower(c), PROJECT_TYPES)


def between(c: Column, start: str, end: str) -> Column:
    """What stands between two labels; null if nothing does."""
    found = F.regexp_extract(c, rf"(?is){_quoted(start)}\s*:?\s*(.+?)\s*{_quoted(end)}", 1)
    return F.nullif(normalize_text(found), F.lit(""))


def escape_html(c: Column) -> Column:
    """X18."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def escape_markdown(c: Column) -> Column:
    return F.replace(F.regexp_replace(c, r"[\r\n]+", " "), F.lit("|"), F.lit(r"\|"))


def split_list(c: Column) -> Column:
    """Items between ; , or |, normalised, distinct by their key, in their order."""
    items = F.filter(F.transform(F.split(c, "[;,|]"), normalize_text), lambda x: x.isNotNull())
    return distinct_by(items, key_words)


def distinct_by(items: Column, key) -> Column:
    """The first item of each key, in order."""
    keys = F.transform(items, key)
    return F.filter(items, lambda x, i: F.array_position(keys, F.get(keys, i)) == i + 1)


def join_list(items: Column, n: int = 500) -> Column:
    """The items in one text; null without any."""
    return F.nullif(F.left(F.array_join(items, ", "), F.lit(n)), F.lit(""))


def merge_lists(*arrays: Column) -> Column:
    """Items of all, in order, each once."""
    return F.array_distinct(F.flatten(F.array(*arrays)))


def first_sorted(items: Column, n: int = 10) -> Column:
    """The first n of the sorted distinct items."""
    return F.slice(F.sort_array(F.array_distinct(items)), 1, n)


def rename_in_json(json_text: Column, old: str, new: str) -> Column:
    """A word replaced wherever it stands in a document, whatever its depth."""
    return F.regexp_replace(json_text, rf"\b{_quoted(old)}\b", new)


def fallback_title(*parts: Column) -> Column:
    """What is present, joined by dashes."""
    return F.concat_ws(" - ", *map(null_if_blank, parts))


def ellipsis(c: Column, n: int = 160) -> Column:
    """Cut to n characters, of which the last is an ellipsis."""
    return F.when(F.length(c) > n, F.concat(F.left(c, F.lit(n - 1)), F.lit("…"))).otherwise(c)

"""URL keys (X10, X20, X26, F24)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import key_compact, match_text

#: Parameters that name one record.
RECORD_PARAMETERS = ("id", "idprocedimento", "idprocedura", "idpratica", "idprogetto", "idistanza", "articleid", "articlegroupid", "codice", "uuid", "key", "n", "numero", "pk", "iddocumento")
#: Words of paths that lead to lists.
LIST_WORDS = ("search", "ricerca", "lista", "elenco", "progetti", "procedimenti", "archivio", "home", "index", "page", "portal", "download", "center")

_PARTS = r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)([^?#]*)(?:\?([^#]*))?"


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path and query as written; empty if absent. A malformed URL gives what can be read of it."""
    text = F.coalesce(F.trim(url), F.lit(""))
    has_host = F.rlike(text, F.lit(_PARTS))
    host, path, query = (F.regexp_extract(text, _PARTS, g) for g in (1, 2, 3))
    bare_path, bare_query = F.regexp_extract(text, r"\A([^?#]*)", 1), F.regexp_extract(text, r"\A[^?#]*\?([^#]*)", 1)
    return host, F.when(has_host, path).otherwise(bare_path), F.when(has_host, query).otherwise(bare_query)


def domain(url: Column) -> Column:
    return F.replace(F.lower(parts(url)[0]), F.lit("www."), F.lit(""))


def clean_path(url: Column) -> Column:
    return F.regexp_replace(F.trim(F.btrim(F.lower(parts(url)[1]), F.lit("/"))), "/+", "/")


def specific_key(url: Column) -> Column:
    """A key of the one record that a URL names, by its parameters or a number or code at its end; empty if it names none."""
    items = F.filter(
        F.transform(F.split(parts(url)[2], "&"), lambda p: F.struct(key_compact(F.substring_index(p, "=", 1)).alias("k"), match_text(F.try_url_decode(F.when(F.contains(p, F.lit("=")), F.substr(p, F.instr(p, "=") + F.lit(1))))).alias("v"))),
        lambda x: x["k"].isin(*RECORD_PARAMETERS) & (x["v"] != ""),
    )
    named = F.array_join(F.transform(F.array_sort(items), lambda x: F.concat_ws("=", x["k"], x["v"])), "&")
    path = clean_path(url)
    last = F.substring_index(path, "/", -1)
    coded = F.rlike(last, F.lit("[0-9]{4,}|[a-f0-9]{8,}")) & ~F.rlike(last, F.lit("|".join(LIST_WORDS)))
    whole = F.concat(domain(url), F.lit("/"), path)
    return F.when(F.coalesce(url, F.lit("")) == "", "").when(named != "", F.concat(whole, F.lit("?"), named)).when(coded, whole).otherwise("")


def generic_key(url: Column) -> Column:
    """Host and path of a URL that names no one record; empty if it does."""
    path = F.btrim(F.lower(parts(url)[1]), F.lit("/"))
    return F.when((specific_key(url) == "") & (domain(url) != ""), F.concat(domain(url), F.lit("/"), path)).otherwise("")


def override_key(url: Column) -> Column:
    """The key by which a rule names a URL."""
    text = F.coalesce(F.trim(url), F.lit(""))
    return F.coalesce(F.nullif(specific_key(text), F.lit("")), F.lower(F.rtrim(text, F.lit("/"))))


def safe_url(url: Column) -> Column:
    """http or https with a host; else empty."""
    return F.when(F.rlike(F.trim(url), F.lit(r"\Ahttps?://[^/?#]+")), F.trim(url)).otherwise("")


def rewrite(url: Column, rules: list[tuple[str, str]]) -> Column:
    """Regular expressions and replacements, in order."""
    for pattern, replacement in rules:
        url = F.regexp_replace(url, pattern, replacement)
    return url


#: A query parameter that names a notice becomes the last step of the path.
NOTICE_RULES = [(r"(/avvisiPubblici)\?id=([0-9]+)\z", "$1/$2")]


def first_link(links: Column, suffix: str) -> Column:
    """The first link of an array with a suffix, such as .pdf."""
    return F.get(F.filter(links, lambda x: F.endswith(F.lower(F.regexp_extract(x, r"\A([^?#]*)", 1)), F.lit(suffix))), F.lit(0))

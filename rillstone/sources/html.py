"""Parsing of landed pages (S2-S5, S11, S14, X17, X24, X26, W9) with the standard library's parser.

HTML has no parser among Spark's functions, so pages go through Arrow-batched
functions; what comes out are arrays of structs, and all that follows is
Column expressions.
"""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillstone.functions.text import key_words
from rillstone.shipping import ship

_SKIPPED = ("script", "style", "noscript", "template")
_BLOCKS = ("p", "div", "li", "tr", "br", "h1", "h2", "h3", "h4", "h5", "h6", "dt", "dd", "table", "section", "title", "td", "th", "ul", "ol", "option", "label")


class _Page(HTMLParser):
    """Title, visible lines, links and table rows of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.lines, self.links, self.rows = "", [""], [], []
        self._skip = 0
        self._in_title = False
        self._link: tuple[str, list[str]] | None = None
        self._row: list[list[str]] | None = None

    def handle_starttag(self, tag, attrs):
        if tag in _SKIPPED:
            self._skip += 1
        if tag in _BLOCKS:
            self.lines.append("")
        if tag == "title":
            self._in_title = True
        elif tag == "a":
            self._close_link()
            self._link = (dict(attrs).get("href") or "", [])
        elif tag == "tr":
            self._close_row()
            self._row = []
        elif tag in ("td", "th") and self._row is not None:
            self._row.append([])

    def handle_endtag(self, tag):
        if tag in _SKIPPED:
            self._skip = max(0, self._skip - 1)
        if tag in _BLOCKS:
            self.lines.append("")
        if tag == "title":
            self._in_title = False
        elif tag == "a":
            self._close_link()
        elif tag in ("tr", "table"):
            self._close_row()

    def handle_data(self, data):
        if self._skip:
            return
        if self._in_title:
            self.title += data
            return
        self.lines[-1] += data
        if self._link:
            self._link[1].append(data)
        if self._row:
            self._row[-1].append(data)

    def _close_link(self):
        if self._link:
            self.links.append((self._link[0], _tidy("".join(self._link[1]))))
        self._link = None

    def _close_row(self):
        if self._row:
            self.rows.append([_tidy("".join(c)) for c in self._row])
        self._row = None


def _tidy(text: str) -> str:
    return " ".join(text.split())


def parse_page(html: str | None, base: str | None = None) -> tuple[str, list[str], list[tuple[str, str]], list[list[str]]]:
    """Title, non-empty lines, links resolved against base, and table rows."""
    page = _Page()
    page.feed(html or "")
    page.close()
    page._close_link()
    page._close_row()
    links = []
    for href, text in page.links:
        try:
            links.append((urljoin(base or "", href), text))
        except ValueError:
            links.append((href, text))
    return _tidy(page.title), [t for x in page.lines if (t := _tidy(x))], links, page.rows


_TEXTS = T.ArrayType(T.StringType())
_LINK = T.StructType([T.StructField("url", T.StringType()), T.StructField("text", T.StringType())])
PAGE_TYPE = T.StructType([T.StructField("title", T.StringType()), T.StructField("lines", _TEXTS), T.StructField("links", T.ArrayType(_LINK)), T.StructField("rows", T.ArrayType(_TEXTS))])


@F.pandas_udf(PAGE_TYPE)
def page(html: pd.Series, base: pd.Series) -> pd.DataFrame:
    """A page's title, visible lines, links and table rows; of a null page all empty."""
    out = []
    for h, b in zip(html, base, strict=True):
        title, lines, links, rows = parse_page(h, b)
        out.append((title, lines, [{"url": u, "text": t} for u, t in links], rows))
    return pd.DataFrame(out, columns=["title", "lines", "links", "rows"])


def parsed(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """pages with a column page."""
    ship(pages.sparkSession)
    return pages.withColumn("page", page(F.col(html), F.col(url)))


def value_in_lines(lines: Column, labels: list[str], reach: int = 4, others: tuple[str, ...] = ()) -> Column:
    """What follows the first label, in its line after a colon, or in the next line if that isn't a label, or one of others, too; null without."""
    names = [" ".join(x.lower().split()) for x in labels]
    keys = F.transform(lines, lambda x: F.rtrim(key_words(x)))
    is_label = lambda k: k.isin(*names)
    at = F.array_position(F.transform(keys, is_label), True)
    after = F.slice(lines, at.cast("int") + 1, F.lit(reach))
    any_label = rf"(?i)\A\s*(?:{'|'.join(re.escape(x) for x in (*labels, *others))})\s*(?::.*)?\z"
    stop = F.array_position(F.transform(after, lambda x: F.rlike(x, F.lit(any_label)) | is_label(F.rtrim(key_words(x)))), True)
    upto = F.when(stop > 0, F.slice(after, F.lit(1), stop.cast("int") - 1)).otherwise(after)
    same_line = F.get(F.filter(F.transform(lines, lambda x: F.regexp_extract(x, rf"(?i)\A\s*(?:{'|'.join(map(re.escape, labels))})\s*:\s*(\S.*)\z", 1)), lambda x: x != ""), F.lit(0))
    return F.coalesce(same_line, F.when(at > 0, F.get(upto, F.lit(0))))


def table_records(rows: Column, header: list[str]) -> Column:
    """The rows below the one that has all header words, each a map from header to cell."""
    wanted = [" ".join(h.lower().split()) for h in header]
    folded = F.transform(rows, lambda r: F.transform(r, key_words))
    is_header = F.transform(folded, lambda r: F.size(F.array_intersect(r, F.array(*map(F.lit, wanted)))) == len(wanted))
    at = F.array_position(is_header, True).cast("int")
    names = F.get(folded, at - 1)
    body = F.filter(F.slice(rows, at + 1, F.size(rows)), lambda r: F.size(r) == F.size(names))
    return F.when(at > 0, F.transform(body, lambda r: F.map_from_arrays(names, r))).otherwise(F.array().cast("array<map<string,string>>"))


_COMMENT = re.compile(r"//[^\n]*|/\*.*?\*/", re.S)


def array_text(source: str | None, name: str) -> str | None:
    """The JSON text of an array that a script assigns to a name; null if there is none or it isn't closed."""
    if not source or not (m := re.search(rf"\b(?:const|let|var)\s+{re.escape(name)}\s*=\s*\[", source)):
        return None
    out, depth, quote, at, start = [], 0, "", m.end() - 1, m.end() - 1
    while at < len(source):
        ch = source[at]
        if quote:
            if ch == "\\" and at + 1 < len(source):
                out.append("'" if source[at + 1] == "'" else ch + source[at + 1])
                at += 2
                continue
            if ch == quote:
                quote = ""
                out.append('"')
            else:
                out.append('\\"' if ch == '"' else ch)
        elif ch in "'\"`":
            quote = ch
            out.append('"')
        elif ch == "/" and (c := _COMMENT.match(source, at)):
            at = c.end()
            continue
        else:
            depth += (ch == "[") - (ch == "]")
            out.append(ch)
            if not depth and at > start:
                break
        at += 1
    text = re.sub(r",(\s*[\]}])", r"\1", "".join(out))
    try:
        return json.dumps(json.loads(re.sub(r"\b(undefined|NaN)\b", "null", text)), ensure_ascii=False)
    except ValueError:
        return None


def embedded_array(source: Column, name: str) -> Column:
    """As array_text, for from_json."""

    @F.pandas_udf("string")
    def extract(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: array_text(t, name))

    return extract(source)

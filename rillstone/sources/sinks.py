"""Sinks (K4, K7-K18): tables, CSV, JSON and HTML reports, written beside what was there."""

from __future__ import annotations

import html
import json
from collections.abc import Sequence
from email.message import EmailMessage

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions.text import escape_markdown


def write_version(df: DataFrame, root: str, version: str) -> str:
    """A new version below root; readers follow current_version(), so a failed write changes nothing."""
    path = f"{root.rstrip('/')}/version={version}"
    df.write.mode("error").parquet(path)
    return path


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[str]:
    """The complete versions below root, oldest first."""
    p, fs = _files(spark, root)
    if not fs.exists(p):
        return []
    done = [s.getPath() for s in fs.listStatus(p) if s.isDirectory() and fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS"))]
    return sorted(x.getName().removeprefix("version=") for x in done)


def current_version(spark: SparkSession, root: str) -> DataFrame:
    """The newest complete version."""
    found = versions(spark, root)
    if not found:
        raise FileNotFoundError(root)
    return spark.read.parquet(f"{root.rstrip('/')}/version={found[-1]}")


def prune_versions(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Delete all but the newest; what was deleted."""
    gone = versions(spark, root)[: -keep or None]
    for v in gone:
        p, fs = _files(spark, f"{root.rstrip('/')}/version={v}")
        fs.delete(p, True)
    return gone


def write_report_csv(df: DataFrame, path: str, sep: str = ",", one_file: bool = True, quote_all: bool = False, line_end: str = "\n") -> None:
    """Header and rows; one_file suits reports of bounded size."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss").csv(path, header=True, sep=sep, quoteAll=quote_all, lineSep=line_end, escape='"', timestampFormat="yyyy-MM-dd'T'HH:mm:ss")


def client_rows(df: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """Texts without line ends, numbers in Italian form, all as text."""
    from rillstone.functions.numbers import italian_format

    return df.select(*((F.coalesce(italian_format(F.col(c), 3, True), F.lit("")) if c in numbers else F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"[\r\n]+", " "), F.lit(""))).alias(c) for c in df.columns))


def document(parts: dict[str, DataFrame | dict]) -> str:
    """K7: one JSON document; a frame becomes a list of its rows, which the caller has bounded."""
    out = {}
    for name, x in parts.items():
        out[name] = [json.loads(r[0]) for r in x.select(F.to_json(F.struct(*x.columns))).collect()] if isinstance(x, DataFrame) else x
    return json.dumps(out, ensure_ascii=False, indent=2)


def page_with_data(template: str, document_json: str, start: str = "/*DATA*/", end: str = "/*END*/") -> str:
    """K8, K9: the page with its data between two marks replaced; a page without the marks is an error."""
    a = template.find(start)
    b = template.find(end, a + len(start)) if a >= 0 else -1
    if b < 0:
        raise ValueError("the marks of the data are missing")
    return template[: a + len(start)] + document_json.replace("</", "<\\/") + template[b:]


def markdown_table(df: DataFrame, n: int = 50) -> str:
    """The first n rows."""
    rows = df.select(*(escape_markdown(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in df.columns)).limit(n).collect()
    return "\n".join(["| " + " | ".join(r) + " |" for r in [df.columns, ["---"] * len(df.columns), *rows]])


def html_table(df: DataFrame, n: int = 500) -> str:
    """The first n rows as a table of a page, every value escaped."""
    from rillstone.functions.text import escape_html

    rows = df.select(*(escape_html(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c in df.columns)).limit(n).collect()
    line = lambda cells, tag: "<tr>" + "".join(f"<{tag}>{x}</{tag}>" for x in cells) + "</tr>"
    return "<table>\n" + "\n".join([line([html.escape(c) for c in df.columns], "th"), *(line(r, "td") for r in rows)]) + "\n</table>"


#: A page that shows a document's records: what page_with_data() fills.
PAGE = """<!doctype html>
<html><head><meta charset="utf-8"><title>Records</title></head><body><input id="q" placeholder="search"><table id="t"></table>
<script>const data = /*DATA*/{}/*END*/;
const rows = data.records || [], names = rows.length ? Object.keys(rows[0]) : [], table = document.getElementById("t"), box = document.getElementById("q");
function show() {
  const q = box.value.toLowerCase();
  table.replaceChildren();
  for (const r of [names].concat(rows.filter(r => JSON.stringify(r).toLowerCase().includes(q)).map(r => names.map(n => r[n])))) {
    const tr = table.insertRow();
    for (const x of r) tr.insertCell().textContent = x ?? "";
  }
}
box.oninput = show; show();
</script></body></html>
"""


def dashboard(parts: dict[str, DataFrame | dict]) -> str:
    """K8: a page of its own with a document's data inside."""
    return page_with_data(PAGE, document(parts))


def message(sender: str, to: Sequence[str], subject: str, body: str, page: str | None = None, attachments: dict[str, bytes] | None = None) -> bytes:
    """A message as it would be sent: the text, the same as a page, and files. Sending is left to the caller."""
    mail = EmailMessage()
    mail["From"], mail["To"], mail["Subject"] = sender, ", ".join(to), subject
    mail.set_content(body)
    if page:
        mail.add_alternative(page, subtype="html")
    for name, content in (attachments or {}).items():
        mail.add_attachment(content, maintype="application", subtype="octet-stream", filename=name)
    return mail.as_bytes()


def append_audit(audit: DataFrame, path: str, run: Column) -> None:
    """Audit or rejected rows, by run."""
    audit.withColumn("run", run).write.mode("append").partitionBy("run").parquet(path)


def mail_body(added: int, removed: int, changed: int, lines: Sequence[str]) -> str | None:
    """The text of a message; null if nothing changed. Sending is left to the caller."""
    if not (added or removed or changed):
        return None
    return "\n".join([f"Added {added}, removed {removed}, changed {changed}.", *lines])

"""URL filters: host and path rules, and a list of canonical URLs behind a blocked Bloom filter.

A listed URL covers itself and what lies below it. A page's URL is therefore
looked up under its canonical form and the forms above it: the host and the
hosts it lies in, each with the path and the paths above it, as far as the
list has entries of so many labels and steps. The Bloom filter is an array of
256-bit blocks; a form sets, or asks for, one bit in each of the block's eight
words. It is asked before anything is shuffled; what passes is made distinct
and goes on to an exact hash join with the list, which removes false
positives. A host that a third of all pages share so reaches the join as few
rows of each task.

A null URL, or one without ``://``, has an empty host and path, matches no
rule and no entry, and is allowed. Repeated rows get equal verdicts. Extra
columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, materialize, null_text

#: (verdict, host, path) of the rules; the longest that fits wins.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: URLs that the query lists: hosts of spam, and parts of hosts.
LISTED = (
    *(f"{name}.example.{top}/" for name in ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm") for top in ("com", "net", "org")),
    "http://tionble.example.org/en/6", "http://blog.tionsh.example.com/en/", "m.ththth.example.net/es", "https://example.org/de/1234/",
)

#: Bits of the filter for each entry; about 1 form in 1,000 passes falsely.
BITS_PER_ENTRY = 16
BLOCK_BITS, WORD_BITS = 256, 32
#: Blocks that are broadcast at most (32 bytes each); a larger filter is joined by block number.
BROADCAST_BLOCKS = 1_000_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first ``://``, with A-Z in lower case, and the path up to a query or fragment."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise(F.lit(""))
    rest = null_text(rest)
    authority = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(F.substr(rest, F.length(authority) + F.lit(1)), r"\A([^?#]*)", 1)
    lower = F.translate(authority, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, path


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # the longest is asked first
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, F.lit(f"{h}{p}")).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def canonical(host: Column, path: Column) -> tuple[Column, Column]:
    """Host without port, user and final dots; path without dot segments, doubled and final slashes and index pages."""
    h = F.regexp_replace(F.regexp_replace(host, r"\A.*@", ""), r":[0-9]*\z", "")
    h = F.rtrim(h, F.lit("."))
    p = F.regexp_replace(F.regexp_replace(path, r"/(?:\./)+", "/"), r"/{2,}", "/")
    p = F.regexp_replace(p, r"/(?:index\.html?)?\z", "")
    return h, p


def levels(entries: DataFrame) -> dict[int, int]:
    """For each number of labels that hosts among the entries (form) have, the steps of the longest path; no other form can be listed."""
    host = F.substring_index("form", "/", 1)
    rows = entries.groupBy(F.size(F.split(host, r"\.")).alias("labels")).agg(F.max(F.size(F.split("form", "/")) - 1).alias("steps"))
    return {r["labels"]: r["steps"] for r in rows.collect()}  # a row for each number of labels


def forms(host: Column, path: Column, most: dict[int, int]) -> Column:
    """The forms under which a page may be listed, host/path/: of hosts of as many labels as most has, with as many steps as it says."""
    h, p = canonical(host, path)
    labels, steps = F.split(h, r"\."), F.split(p, "/")
    n, m = F.size(labels), F.size(steps)
    none = F.array().cast("array<string>")

    def of(k: int, deepest: int) -> Column:
        name = F.array_join(F.slice(labels, n - (k - 1), F.lit(k)), ".")
        return F.when(n >= k, F.transform(F.sequence(F.lit(1), F.least(m, F.lit(deepest))), lambda i: F.concat(name, F.array_join(F.slice(steps, F.lit(1), i), "/"), F.lit("/")))).otherwise(none)

    every = F.concat(none, *(of(k, deepest) for k, deepest in sorted(most.items())))
    return F.when(h != "", every).otherwise(none)


def listed_form(url: Column) -> Column:
    """The canonical form of a list entry, given with or without scheme."""
    h, p = host_and_path(F.when(F.contains(url, F.lit("://")), url).otherwise(F.concat(F.lit("http://"), url)))
    h, p = canonical(h, p)
    return F.concat(h, p, F.lit("/"))


def _hash(form: Column) -> tuple[Column, list[Column]]:
    """A number for the block and the bit in each of its eight words."""
    block, bits = F.xxhash64(form), F.xxhash64(form, F.lit("bits"))
    return block, [F.pmod(F.shiftrightunsigned(bits, 5 * i), F.lit(WORD_BITS)).cast("int") for i in range(8)]


def bloom(entries: DataFrame, bits_per_entry: int = BITS_PER_ENTRY) -> tuple[DataFrame, int]:
    """The blocks that have a bit (block, w0 ... w7) and the number of blocks of the filter."""
    n = max(1, math.ceil(entries.count() * bits_per_entry / BLOCK_BITS))
    block, bits = _hash(F.col("form"))
    rows = entries.select(F.pmod(block, F.lit(n)).alias("block"), *(F.call_function("shiftleft", F.lit(1), b).alias(f"w{i}") for i, b in enumerate(bits)))
    return rows.groupBy("block").agg(*(F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8))), n


def possible(candidates: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """The candidates (form) whose bits are all set."""
    block, bits = _hash(F.col("form"))
    asked = candidates.withColumn("block", F.pmod(block, F.lit(n)))
    joined = asked.join(F.broadcast(blocks) if n <= BROADCAST_BLOCKS else blocks, "block")
    inside = reduce(lambda a, b: a & b, [F.getbit(F.col(f"w{i}"), b) == 1 for i, b in enumerate(bits)])
    return joined.where(inside).select(*candidates.columns)


def covered(pages: DataFrame, entries: DataFrame) -> DataFrame:
    """host, path and listed (the longest entry that covers them) of the pages' hosts and paths that are covered: through the filter, then the exact join."""
    blocks, n = bloom(entries)
    asked = pages.select("host", "path", F.explode(forms(F.col("host"), F.col("path"), levels(entries))).alias("form"))
    if n > BROADCAST_BLOCKS:
        asked = asked.distinct()  # the filter itself needs a shuffle
    hits = possible(asked, blocks, n).distinct()
    few = BROADCAST_ROWS // 4
    exact = hits.join(F.broadcast(entries) if entries.limit(few + 1).count() <= few else entries, "form", "left_semi")
    return exact.groupBy("host", "path").agg(F.max_by("form", F.struct(F.length("form"), "form")).alias("listed"))


def judge(pages: DataFrame, urls: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict and listed (the entry that covers the page, the longest; null without one).

    urls has a column url. A page that fits a rule gets its verdict, and
    another one is blocked if it is listed. If few pages are covered, what
    covers them is broadcast, and no page is shuffled.
    """
    entries = materialize(urls.where("url is not null").select(listed_form(F.col("url")).alias("form")).distinct(), "entries")
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    found = materialize(covered(rows, entries), "covered")
    few = BROADCAST_ROWS // 4
    found = F.broadcast(found) if found.limit(few + 1).count() <= few else found
    name, verdict = best_rule(F.col("host"), F.col("path"), rules)
    out = rows.join(found, ["host", "path"], "left").withColumn("rule", name)
    return out.select("page_id", "host", "path", "rule", F.coalesce(verdict, F.when(F.col("listed").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"), "listed")

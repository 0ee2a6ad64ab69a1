"""Predicates, ladders of reasons, validation and override rules.

Rules are rows of a table, or tuples that become Column expressions when the
plan is made; nothing is evaluated row by row in Python.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions.numbers import power_matches
from rillstone.functions.text import is_blank, match_text


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """One regular expression for all words."""
    if not words:
        return F.lit(False)
    return F.coalesce(F.rlike(text, F.lit("|".join(rf"\Q{w}\E" for w in words))), F.lit(False))


def relevant(text: Column, keywords: Sequence[str], strong: Sequence[str], exclude: Sequence[str], needed_with_exclude: Sequence[str] = (), never: Sequence[str] = ()) -> Column:
    """A keyword, and unless a strong one stands there no excluded word.

    With needed_with_exclude, an excluded word also needs one of these words
    beside it; words of never exclude whatever else there is.
    """
    low = F.lower(F.coalesce(text, F.lit("")))
    excluded = contains_any(low, exclude)
    out = contains_any(low, keywords) & ~(excluded & ~contains_any(low, strong)) & ~contains_any(low, never)
    return out & (~excluded | contains_any(low, needed_with_exclude)) if needed_with_exclude else out


def reason(rules: Sequence[tuple[str, Column]], otherwise: str | None = None) -> Column:
    """The name of the first rule that holds."""
    out = F.lit(otherwise).cast("string")
    for name, condition in reversed(rules):
        out = F.when(F.coalesce(condition, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def split_by_reason(df: DataFrame, rules: Sequence[tuple[str, Column]], name: str = "reason") -> tuple[DataFrame, DataFrame]:
    """the rows that no rule rejects, and the rejected ones with their reason."""
    marked = df.withColumn(name, reason(rules))
    return marked.where(F.col(name).isNull()).drop(name), marked.where(F.col(name).isNotNull())


def errors(rules: Sequence[tuple[str, Column]]) -> Column:
    """The names of all rules that hold."""
    return F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules)))


def each_error(df: DataFrame, rules: Sequence[tuple[str, Column]], name: str = "issue") -> DataFrame:
    """A row for each rule that a row breaks."""
    return df.withColumn(name, F.explode(errors(rules)))


def gates(df: DataFrame, checks: Sequence[tuple[str, Column]]) -> DataFrame:
    """check and passed of each check, an aggregate condition; one pass. A condition over missing values fails."""
    row = df.agg(*(F.coalesce(c, F.lit(False)).alias(f"c{i}") for i, (_, c) in enumerate(checks)))
    return row.select(F.inline(F.array(*(F.struct(F.lit(n).alias("check"), F.col(f"c{i}").alias("passed")) for i, (n, _) in enumerate(checks)))))


def interactive_filter(df: DataFrame, query: str | None = None, searched: Sequence[str] = (), **equal: str | None) -> DataFrame:
    """Equality on the columns that are given, and a substring of the searched ones together."""
    for column, value in equal.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    if query:
        df = df.where(F.contains(F.lower(F.concat_ws(" ", *searched)), F.lit(query.lower())))
    return df


def blob_contains(df: DataFrame, words: Sequence[str]) -> Column:
    """whether any word is anywhere in the row."""
    return contains_any(F.lower(F.to_json(F.struct(*df.columns))), [w.lower() for w in words])


#: Markers of market aggregates among sources.
AGGREGATE_SOURCES = ("terna", "terna econnextion")


def is_aggregate(source: Column, title: Column, url: Column, kind: Column | None = None) -> Column:
    """rows of market statistics, told by source, title, site or kind; a word that merely holds the name doesn't count."""
    s, t = match_text(source), match_text(title)
    of_market = s.isin(*AGGREGATE_SOURCES) | F.startswith(s, F.lit("terna "))
    out = of_market | F.startswith(t, F.lit("terna econnextion")) | F.contains(F.lower(F.coalesce(url, F.lit(""))), F.lit("dati.terna.it"))
    return out if kind is None else out | (of_market & F.contains(match_text(kind), F.lit("aggreg")))


#: Labels that sources print where a company should stand.
ADMINISTRATIVE_LABELS = ("data", "data pubblicazione", "pubblicato", "pubblicazione", "proponente", "societa proponente", "soggetto proponente")
ADMINISTRATIVE_FRAGMENTS = ("data pubblicazione", "valutazione impatto ambientale", "verifica di assoggettabilita", "provvedimento unico", "pniec pnrr", "determinazione", "comunicazione", "dettaglio")
COMPANY_MARKERS = ("srl", "spa", "s p a", "s r l", "societa", "energy", "energia", "renewables", "solar", "green", "rinnovabili")


def bad_company_reason(c: Column) -> Column:
    """why a text can't be a company; null if it may be one."""
    from rillstone.functions.dates import MONTHS

    text = F.regexp_replace(F.trim(c), r"\s+", " ")
    words = match_text(text)
    date = rf"(?i)\A(?:[0-9]{{1,2}}[/-][0-9]{{1,2}}[/-][0-9]{{2,4}}|[0-9]{{4}}[/-][0-9]{{1,2}}[/-][0-9]{{1,2}}|[0-9]{{1,2}}\s+(?:{'|'.join(MONTHS)})\s+[0-9]{{4}})\z"
    return reason([
        ("date_only", F.rlike(text, F.lit(date))),
        ("numeric_only", F.rlike(text, F.lit(r"\A[0-9\s./:-]+\z"))),
        ("administrative_label", words.isin(*ADMINISTRATIVE_LABELS)),
        ("administrative_fragment", (F.length(text) <= 80) & contains_any(words, ADMINISTRATIVE_FRAGMENTS) & ~contains_any(words, COMPANY_MARKERS)),
    ])


def looks_like_company(c: Column) -> Column:
    """nothing against it, and a company's marker or a capital."""
    return ~is_blank(c) & bad_company_reason(c).isNull() & F.length(F.trim(c)).between(3, 160) & (contains_any(match_text(c), COMPANY_MARKERS) | F.rlike(c, F.lit(r"\A\p{Lu}")))


def ladder_join(left: DataFrame, right: DataFrame, id_col: str, steps: Sequence[Sequence[tuple[str, str]]], value: str) -> DataFrame:
    """The value of the first step whose equality gives one right value; a step that gives several gives none.

    A step is pairs of a left and a right column. Each is an equi join, pre-aggregated on the right.
    """
    out = left.select(id_col, *{a for step in steps for a, _ in step})
    for i, step in enumerate(steps):
        only = F.when(F.min(value) == F.max(value), F.min(value)).alias(f"__v{i}")
        best = right.groupBy(*(F.col(b).alias(f"__k{j}") for j, (_, b) in enumerate(step))).agg(only)
        on = reduce(lambda x, y: x & y, [F.col(a) == F.col(f"__k{j}") for j, (a, _) in enumerate(step)])
        out = out.join(best, on, "left").drop(*(f"__k{j}" for j in range(len(step))))
    found = F.coalesce(*(F.col(f"__v{i}") for i in range(len(steps))))
    rank = F.coalesce(*(F.when(F.col(f"__v{i}").isNotNull(), F.lit(i + 1)) for i in range(len(steps))))
    return out.select(id_col, found.alias(value), rank.alias("step"))


_RUNS = "[\\p{L}\\p{N}]+"


def _longest_run(c: Column) -> Column:
    """The longest run of letters and digits of a text; empty without."""
    runs = F.regexp_extract_all(c, F.lit(_RUNS), F.lit(0))
    return F.coalesce(F.array_max(F.transform(runs, lambda r: F.struct(F.length(r).alias("n"), r.alias("r"))))["r"], F.lit(""))


def matching_rules(df: DataFrame, rules: DataFrame, id_col: str, text: str, url_key: str, conditions: Sequence[str] = (), power: str | None = None) -> DataFrame:
    """id_col and the columns of each rule that a row matches.

    rules has seq, match_kind (url_eq, url_contains or title_contains_all) and
    match_value (an array). Equality is an equi join. For containment, what a
    rule looks for holds a run of letters and digits, and so must a run of the
    row: the distinct runs of all rows, far fewer than rows, are asked which
    rules' runs they hold, rows meet those rules by an equi join on their
    runs, and the whole condition is then confirmed.

    Rules may also have where (a map of a column among conditions to its
    normalised value) and power_mw, which the row's power must match.
    """
    own = rules.columns
    fixed = rules.where("match_kind = 'url_eq'").withColumn("__value", F.explode(F.array_distinct("match_value")))
    extra = {"__url": F.lower(F.col(url_key)), "__text": F.col(text), "__facts": F.create_map(*(x for c in conditions for x in (F.lit(c), match_text(F.col(c).cast("string"))))) if conditions else F.lit(None).cast("map<string,string>"), "__power": F.col(power) if power else F.lit(None).cast("double")}
    rows = df.select(id_col, F.col(url_key).alias("__key"), *(v.alias(k) for k, v in extra.items()))
    hits = rows.join(fixed.withColumnRenamed("__value", "__key"), "__key").select(id_col, *extra, *own)
    by_url = F.col("match_kind") == "url_contains"
    loose = rules.where("match_kind <> 'url_eq'").withColumn("__value", F.explode(F.when(by_url, F.transform("match_value", F.lower)).otherwise(F.array(F.array_join("match_value", " ")))))
    loose = loose.withColumn("__run", _longest_run(F.col("__value"))).withColumn("__of_url", by_url)
    runs = lambda c, of_url: rows.select(id_col, F.explode(F.array_distinct(F.regexp_extract_all(F.col(c), F.lit(_RUNS), F.lit(0)))).alias("__token"), F.lit(of_url).alias("__of_url"))
    tokens = runs("__url", True).unionByName(runs("__text", False))
    asked = loose.where("__run <> ''").select("seq", "__run", "__of_url").distinct()
    held = tokens.select("__token", "__of_url").distinct().alias("t").join(asked.alias("r"), (F.col("t.__of_url") == F.col("r.__of_url")) & F.contains("t.__token", F.col("r.__run"))).select("t.__token", "t.__of_url", "seq").distinct()
    possible = tokens.join(held, ["__token", "__of_url"]).select(id_col, "seq").distinct()
    met = possible.join(rules.where("match_kind <> 'url_eq'"), "seq").join(rows, id_col)
    within = F.when(by_url, F.exists("match_value", lambda v: F.contains(F.col("__url"), F.lower(v)))).otherwise(F.forall("match_value", lambda v: F.contains(F.col("__text"), v)))
    out = hits.unionByName(met.where(within).select(id_col, *extra, *own))
    if "where" in own:
        out = out.where(F.col("where").isNull() | F.forall(F.map_keys("where"), lambda k: F.try_element_at("__facts", k).eqNullSafe(F.try_element_at("where", k))))
    if "power_mw" in own:
        out = out.where(F.coalesce(power_matches(F.col("__power"), F.col("power_mw")), F.lit(False)))
    return out.drop(*extra)


def apply_overrides(df: DataFrame, rules: DataFrame, id_col: str, text: str, url_key: str, fields: Sequence[str], conditions: Sequence[str] = (), power: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows with the first matching rule's fields set or the row excluded; and an audit row for each change.

    fields (a map) holds the new values; action is patch or exclude. The
    first rule by seq wins.
    """
    hits = matching_rules(df, rules, id_col, text, url_key, conditions, power)
    first = hits.groupBy(id_col).agg(F.min_by(F.struct("action", F.col("fields").alias("__new"), F.col("reason").alias("__reason"), "seq"), "seq").alias("__first")).select(id_col, "__first.*")
    joined = df.join(first, id_col, "left")
    new = lambda c: F.try_element_at(F.col("__new"), F.lit(c))
    differs = lambda c: new(c).isNotNull() & ~match_text(F.col(c).cast("string")).eqNullSafe(match_text(new(c)))
    changes = [F.when((F.col("action") == "patch") & differs(c), F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("old_value"), new(c).alias("new_value"))) for c in fields]
    removed = F.when(F.col("action") == "exclude", F.struct(F.lit("record").alias("field"), F.lit("").alias("old_value"), F.lit("").alias("new_value")))
    audit = joined.where("action is not null").select(id_col, "seq", "action", F.col("__reason").alias("reason"), F.inline(F.array_compact(F.array(*changes, removed))))
    kinds = dict(df.dtypes)
    patched = {c: F.when((F.col("action") == "patch") & differs(c), new(c).cast(kinds[c])).otherwise(F.col(c)) for c in fields}
    kept = joined.where(F.coalesce(F.col("action"), F.lit("")) != "exclude").withColumns(patched).select(*df.columns)
    return kept, audit


def match_counts(df: DataFrame, rules: DataFrame, id_col: str, text: str, url_key: str) -> DataFrame:
    """For each rule how many rows it matches and whether that is what it expects (expected_matches; null: any number)."""
    hits = matching_rules(df, rules, id_col, text, url_key).groupBy("seq").agg(F.count("*").alias("matches"))
    out = rules.select("seq", "expected_matches").join(hits, "seq", "left").withColumn("matches", F.coalesce("matches", F.lit(0)))
    return out.withColumn("as_expected", F.col("expected_matches").isNull() | (F.col("matches") == F.col("expected_matches")))


def insert_if_absent(df: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """Df and those rows, first of their key, whose key it doesn't have."""
    return df.unionByName(rows.dropDuplicates([key]).join(df.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)

"""Ingestion: keys, upserts by policy, and the change log.

A batch meets the master table in one join. Nothing is updated in place: a
new version is written beside the old one, then a pointer is switched, so a
job that fails leaves the old version.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillstone.functions.text import is_blank, key_words, normalize_text
from rillstone.operators.ordered import keep_first

#: How a field of the master follows a new value: overwrite it if present and different, fill it only if empty,
#: take any different value, or take links alone.
POLICIES = {
    "project_name": "overwrite", "proponent": "overwrite", "region": "overwrite", "project_type": "overwrite", "province": "fill",
    "municipalities": "fill", "power_mw": "fill", "status_normalized": "differs", "primary_url": "link", "primary_source": "differs",
}


def project_key(url: Column, external_id: Column, name: Column, proponent: Column, region: Column, municipalities: Column, power: Column, base_url: Column | None = None) -> Column:
    """M1: SHA-1 of the URL, else of the external id, else of the words that describe a project; null if there are none.

    With base_url, a URL equal to it, which names no one record, is skipped.
    """
    link, external = normalize_text(url), normalize_text(external_id)
    usable = F.startswith(link, F.lit("http"))
    if base_url is not None:
        usable = usable & ~F.coalesce(link == base_url, F.lit(False))
    described = F.concat_ws("|", key_words(name), key_words(proponent), key_words(region), key_words(municipalities), F.coalesce(F.round(power, 6).cast("string"), F.lit("")))
    words = F.btrim(described, F.lit("|"))
    raw = F.when(F.coalesce(usable, F.lit(False)), F.concat(F.lit("url|"), link)).when(external.isNotNull(), F.concat(F.lit("external|"), external)).otherwise(F.nullif(words, F.lit("")))
    return F.sha1(raw)


def different(old: Column, new: Column) -> Column:
    """Different once normalised."""
    return ~normalize_text(old).eqNullSafe(normalize_text(new))


def _taken(policy: str, old: Column, new: Column) -> Column:
    if policy == "overwrite":
        return ~is_blank(new) & different(old, new)
    if policy == "fill":
        return is_blank(old.cast("string")) & ~is_blank(new.cast("string"))
    if policy == "differs":
        return ~is_blank(new) & different(old, new)
    if policy == "link":
        return F.coalesce(F.startswith(new, F.lit("http")), F.lit(False)) & different(old, new)
    raise ValueError(policy)


def plan_upsert(master: DataFrame, batch: DataFrame, key: str, policies: Mapping[str, str] = POLICIES, idx: str = "row_idx") -> DataFrame:
    """M2-M4: each key of either side with action (new, changed, unchanged or kept), the resulting fields, and changed_fields.

    Of rows of the batch with one key the last counts; rows without a key are
    skipped. changed_fields maps a field to its old and new value.
    """
    last = keep_first(batch.where(F.col(key).isNotNull()), key, F.desc(idx))
    m = master.select(key, *(F.col(c).alias(f"__o_{c}") for c in policies), F.lit(True).alias("__old"))
    b = last.select(key, *(F.col(c).alias(f"__n_{c}") for c in policies), F.lit(True).alias("__new"))
    both = m.join(b, key, "full_outer")
    old, new = (lambda c: F.col(f"__o_{c}")), (lambda c: F.col(f"__n_{c}"))
    known, given = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    taken = {c: known & given & _taken(p, old(c), new(c)) for c, p in policies.items()}
    change = lambda c: F.when(taken[c], F.struct(F.lit(c).alias("key"), F.struct(old(c).cast("string").alias("old"), new(c).cast("string").alias("new")).alias("value")))
    changed = F.map_from_entries(F.array_compact(F.array(*map(change, policies))))
    out = both.withColumn("changed_fields", changed)
    action = F.when(~known, "new").when(~given, "kept").when(F.size("changed_fields") > 0, "changed").otherwise("unchanged")
    return out.select(key, action.alias("action"), *(F.when(~known | taken[c], new(c)).otherwise(old(c)).alias(c) for c in policies), "changed_fields")


def events(plan: DataFrame, key: str, as_of: Column) -> DataFrame:
    """M4: a created event for each new key, and a changed event, with old and new values, for each changed one."""
    kind = F.when(F.col("action") == "new", "project_created").otherwise("project_updated")
    return plan.where(F.col("action").isin("new", "changed")).select(key, kind.alias("event_type"), F.to_json("changed_fields").alias("details_json"), as_of.alias("created_at"))


def upsert_latest(table: DataFrame, batch: DataFrame, key: list[str], recency: str) -> DataFrame:
    """K2: rows of both, of each key the most recent; the batch wins a tie."""
    both = table.withColumn("__side", F.lit(0)).unionByName(batch.withColumn("__side", F.lit(1)))
    return keep_first(both, key, F.desc(recency), F.desc("__side")).drop("__side")


def upsert_sources(table: DataFrame, batch: DataFrame) -> DataFrame:
    """K1: a source's URL follows the batch if it differs once normalised; new names are added."""
    new = batch.groupBy("name").agg(F.max("base_url").alias("__url"))
    joined = table.join(new, "name", "full_outer")
    url = F.when(F.col("__url").isNotNull() & different(F.col("base_url"), F.col("__url")), F.col("__url")).otherwise(F.col("base_url"))
    return joined.withColumn("base_url", url).drop("__url")


def replace_source(table: DataFrame, staged: DataFrame, source: str, value: str) -> DataFrame:
    """The table without a source's rows, and the staged ones."""
    return table.where(~F.col(source).eqNullSafe(F.lit(value))).unionByName(staged, allowMissingColumns=True)


def purge(tables: Mapping[str, DataFrame], source: str, value: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Sources, raw_items, projects and events without a source, and how many rows of each went.

    An event goes with its project or with its own source.
    """
    own = lambda name, c: F.col(c).eqNullSafe(F.lit(value))
    projects = tables["projects"]
    gone = projects.where(own("projects", source)).select("project_id")
    kept = {
        "projects": projects.where(~own("projects", source)),
        "events": tables["events"].where(~own("events", source)).join(gone, "project_id", "left_anti"),
    }
    if "raw_items" in tables:
        kept["raw_items"] = tables["raw_items"].where(~own("raw_items", source))
    each = None
    for name, df in kept.items():
        both = tables[name].select(F.lit(name).alias("table"), F.lit(1).alias("n")).unionByName(df.select(F.lit(name).alias("table"), F.lit(-1).alias("n")))
        each = both if each is None else each.unionByName(both)
    counts = each.groupBy("table").agg(F.sum("n").alias("deleted"))
    return kept, counts

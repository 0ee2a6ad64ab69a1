"""Roll-ups, scores and counters over records (A1-A20), and rankings.

Records have at least region, source, status, mw, practices, is_aggregate;
other names are parameters. Sums are rounded once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillstone.functions.numbers import safe_ratio
from rillstone.functions.text import null_if_blank

UNKNOWN = "ND"


def _label(name: str) -> Column:
    return F.coalesce(null_if_blank(F.col(name)), F.lit(UNKNOWN)).alias(name)


def totals(records: DataFrame) -> DataFrame:
    """One row of counts and sums, of all records, of projects and of aggregates."""
    mw = F.coalesce("mw", F.lit(0.0))
    project = ~F.col("is_aggregate")
    return records.agg(
        F.count("*").alias("records"),
        F.count_if(project).alias("projects"),
        F.count_if(F.col("is_aggregate")).alias("aggregates"),
        F.round(F.sum(mw), 3).alias("total_mw"),
        F.round(F.sum(F.when(project, mw)), 3).alias("project_mw"),
        F.round(F.sum(F.when(F.col("is_aggregate"), mw)), 3).alias("aggregate_mw"),
    )


def region_rollup(records: DataFrame) -> DataFrame:
    """A5: for each region the projects and the aggregates, counted and summed, unrounded."""
    mw, project = F.coalesce("mw", F.lit(0.0)), ~F.col("is_aggregate")
    return records.groupBy(_label("region")).agg(
        F.count_if(project).alias("project_count"),
        F.coalesce(F.sum(F.when(project, mw)), F.lit(0.0)).alias("project_mw"),
        F.count_if(F.col("is_aggregate")).alias("aggregate_count"),
        F.coalesce(F.sum(F.when(F.col("is_aggregate"), mw)), F.lit(0.0)).alias("aggregate_mw"),
        F.coalesce(F.sum(F.when(F.col("is_aggregate"), F.col("practices"))), F.lit(0)).cast("long").alias("aggregate_practices"),
    )


def with_score(rollup: DataFrame, variant: str = "relative") -> DataFrame:
    """The rows of region_rollup with total_mw and priority_score, sums rounded.

    relative: 40, 25, 25 and 10 points for the shares of the largest region;
    absolute: 0.05 per project and megawatts by 1,000 and 5,000; light: 0.06
    per project and megawatts by 1,000. A row per region makes one small window.
    """
    if variant == "relative":
        most = W.partitionBy()
        share = lambda c: safe_ratio(F.col(c), F.max(c).over(most))
        score = share("project_mw") * 40 + share("project_count") * 25 + share("aggregate_mw") * 25 + share("aggregate_practices") * 10
    elif variant == "absolute":
        score = F.col("project_count") * 0.05 + F.col("project_mw") / 1000 + F.col("aggregate_mw") / 5000
    elif variant == "light":
        score = F.col("project_count") * 0.06 + F.col("project_mw") / 1000
    else:
        raise ValueError(variant)
    out = rollup.withColumn("total_mw", F.col("project_mw") + F.col("aggregate_mw")).withColumn("priority_score", F.round(score, 1))
    return out.withColumns({c: F.round(c, 3) for c in ("project_mw", "aggregate_mw", "total_mw")})


def ranked(df: DataFrame, *order: Column) -> DataFrame:
    """With rank, the row's number in the order; for tables of one row per group."""
    return df.withColumn("rank", F.row_number().over(W.orderBy(*order)).cast("long"))


def source_counts(records: DataFrame, source: str = "source", label: str = "label", idx: str = "row_idx") -> DataFrame:
    """Records of each source, its first place, and its most frequent label, ties going to the label seen first."""
    per_label = records.groupBy(source, label).agg(F.count("*").alias("__n"), F.min(idx).alias("__first"))
    return per_label.groupBy(source).agg(
        F.sum("__n").alias("count"),
        F.min("__first").alias("first_idx"),
        F.min_by(label, F.struct(-F.col("__n"), F.col("__first"))).alias("label"),
    )


def counts_by_label(counts: DataFrame, label: str = "label") -> DataFrame:
    """The counts of sources that share a label, added up."""
    return counts.groupBy(label).agg(F.sum("count").alias("count"), F.min("first_idx").alias("first_idx"))


def status_rollup(records: DataFrame) -> DataFrame:
    """A9."""
    return records.groupBy(_label("status")).agg(
        F.round(F.sum(F.coalesce("mw", F.lit(0.0))), 3).alias("mw"),
        F.count("*").alias("count"),
        F.coalesce(F.sum("practices"), F.lit(0)).cast("long").alias("practices"),
    )


def quality_summary(records: DataFrame, count_all_urls: bool = True, nd_is_missing: bool = True) -> DataFrame:
    """A10: how many projects lack which field. Two points on which reports differ are parameters."""
    project = ~F.col("is_aggregate")
    blank = lambda c: null_if_blank(F.col(c)).isNull()
    no_region = blank("region") | (F.col("region") == UNKNOWN) if nd_is_missing else blank("region")
    return records.agg(
        F.count_if(project).alias("projects"),
        F.count_if(project & F.col("mw").isNull()).alias("missing_mw"),
        F.count_if(project & no_region).alias("missing_region"),
        F.count_if(project & blank("province")).alias("missing_province"),
        F.count_if(project & blank("municipality")).alias("missing_municipality"),
        F.count_if(blank("url") if count_all_urls else project & blank("url")).alias("missing_url"),
    )


def quality_by_source(records: DataFrame, source: str = "source", variant: str = "projects_missing") -> DataFrame:
    """For each source the gaps and completeness, in percent of three fields.

    projects_missing: all rows count, places are missed of projects alone;
    projects_only: projects alone, or all rows where a source has none;
    all: all rows.
    """
    project = ~F.col("is_aggregate")
    blank = lambda c: null_if_blank(F.col(c)).isNull()
    if variant == "projects_only":
        some = F.max(project.cast("int")).over(W.partitionBy(source)) == 1
        records = records.withColumn("__some", some).where(project | ~F.col("__some"))
    place = project if variant == "projects_missing" else F.lit(True)
    out = records.groupBy(source).agg(
        F.count("*").alias("count"),
        F.count_if(F.col("mw").isNull()).alias("missing_mw"),
        F.count_if(place & blank("province")).alias("missing_province"),
        F.count_if(place & blank("municipality")).alias("missing_municipality"),
    )
    missed = F.col("missing_mw") + F.col("missing_province") + F.col("missing_municipality")
    return out.withColumn("completeness_pct", F.round(100 * (3 * F.col("count") - missed) / (3 * F.col("count")), 1))


def surplus_rows(df: DataFrame, key: str) -> DataFrame:
    """One row: rows with a key, keys, and rows beyond the first of their key."""
    per = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count("*").alias("key_count"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("surplus"), F.count_if(F.col("n") > 1).alias("repeated_keys"))


def entity_rollup(records: DataFrame, entity: str, item: str, mw: str, lists: dict[str, str], name: str | None = None, idx: str = "row_idx", width: int = 1000) -> DataFrame:
    """For each entity distinct items, sum, mean and maximum of mw, and sorted distinct values of columns, joined and cut to width.

    One aggregate: an entity with very many records gathers its distinct
    values alone, and each task hands on those that it has seen.
    """
    shown = F.min_by(name, idx) if name else F.first(entity)
    texts = [F.left(F.array_join(F.sort_array(F.collect_set(column)), ", "), F.lit(width)).alias(out) for out, column in lists.items()]
    return records.groupBy(entity).agg(
        F.count_distinct(item).alias("items"), F.round(F.sum(mw), 2).alias("sum_mw"), F.round(F.avg(mw), 4).alias("avg_mw"), F.max(mw).alias("max_mw"), shown.alias("display_name"), *texts
    )


def top_sums(records: DataFrame, label: str, mw: str, n: int = 10) -> DataFrame:
    """The n labels of the largest sums."""
    return records.groupBy(label).agg(F.round(F.sum(mw), 2).alias("mw")).orderBy(F.desc("mw"), label).limit(n)


def families(df: DataFrame, reason: str, n: int = 20) -> DataFrame:
    """Reasons up to their colon, counted; the n most frequent."""
    return df.groupBy(F.substring_index(reason, ":", 1).alias("family")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "family").limit(n)


def run_counters(actions: DataFrame, action: str = "action") -> DataFrame:
    """One row of how many rows were new, changed, unchanged or skipped."""
    return actions.agg(F.count("*").alias("raw"), *(F.count_if(F.col(action) == a).alias(a) for a in ("new", "changed", "unchanged", "skipped")))


def histogram(df: DataFrame, column: str, members: str) -> DataFrame:
    """Counts by value, and how many distinct members each has."""
    return df.groupBy(column).agg(F.count("*").alias("count"), F.count_distinct(members).alias("members"))


def top_k(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first k rows of an order that ends in a unique column."""
    return df.orderBy(*order).limit(k)


def snapshot_order() -> list[Column]:
    """O1: region and province, then power and name, blanks last."""
    return [F.asc_nulls_last("region"), F.asc_nulls_last("province"), F.desc_nulls_last("mw"), F.asc_nulls_last("name")]


def chosen_order(column: str, kind: str = "text", descending: bool = False) -> Column:
    """An unknown number stands below all, texts are compared without case and accents."""
    key = F.coalesce(F.col(column).cast("double"), F.lit(float("-inf"))) if kind == "number" else F.collate(F.col(column), "UNICODE_CI_AI")
    return key.desc() if descending else key.asc()

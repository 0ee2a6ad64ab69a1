"""Duplicates of records: keys, blocking, scoring, components, merging.

Pairs arise only within blocks that share a key and have 2 to max_block
members, as the registry defines candidates; larger blocks give none, by
definition. Components are found by contracting the graph, links being
checkpointed as tables in the shared folder where lineage would grow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillstone.functions import geo, urls
from rillstone.functions.numbers import power_close, power_conflict
from rillstone.functions.text import containment, jaccard, match_text, null_if_blank, settled, short_hash, similarity, tokens
from rillstone.operators.lineage import settle
from rillstone.operators.ordered import least_per_key
from rillstone.operators.rules import is_aggregate, reason

MAX_BLOCK = 80


def canonical(records: DataFrame) -> DataFrame:
    """What comparisons need, computed once per record: row_idx and normalised fields.

    records has row_idx, title, source, url, region, province, municipality,
    proponent, mw and source_id (null if unknown).
    """
    c = F.col
    return records.select(
        "row_idx", "title", "source", "url", "province", "municipality", "mw",
        match_text(c("title")).alias("title_norm"), match_text(c("source")).alias("source_norm"), match_text(c("region")).alias("region_norm"),
        geo.province(c("province")).alias("province_norm"), geo.province_codes(c("province")).alias("province_codes"),
        geo.municipality(c("municipality")).alias("municipality_norm"), match_text(c("proponent")).alias("proponent_norm"),
        urls.specific_key(c("url")).alias("url_key"), F.coalesce("source_id", F.lit("")).alias("source_id"),
        geo.title_municipality(c("title")).alias("hint"), tokens(match_text(c("title"))).alias("tokens"),
        is_aggregate(c("source"), c("title"), c("url")).alias("is_aggregate"),
    )


def block_keys() -> Column:
    """M8: the blocks of a canonical record."""
    c = F.col
    mw = lambda n: F.format_string(f"%.{n}f", F.round("mw", n))
    key = lambda name, *parts: F.concat_ws(":", F.lit(name), *parts)
    words = F.array_sort("tokens")
    return F.array_compact(F.array(
        F.when(c("url_key") != "", key("url", "url_key")),
        F.when(c("source_id") != "", key("sid", "source_id")),
        F.when(c("title_norm") != "", key("title", "title_norm")),
        F.when((c("title_norm") != "") & c("mw").isNotNull(), key("title_mw", "title_norm", mw(1))),
        F.when((c("proponent_norm") != "") & (c("municipality_norm") != "") & c("mw").isNotNull(), key("place_mw", "proponent_norm", "municipality_norm", mw(1))),
        F.when(F.contains("source_norm", F.lit("mase")) & c("mw").isNotNull() & (c("province_norm") != ""), key("mase_mw", "province_norm", mw(3))),
        F.when(F.size("tokens") >= 3, key("tokens", F.array_join(F.slice(words, 1, 8), " "))),
    ))


def pairs_in_blocks(blocks: DataFrame, idx: str = "row_idx", key: str = "block", max_block: int = MAX_BLOCK) -> DataFrame:
    """The distinct pairs idx_a < idx_b that share a block of 2 to max_block rows.

    A block's size is counted before its rows meet, so a block of a third of
    all rows is one row of a partial count and then gone.
    """
    sizes = blocks.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n").between(2, max_block)).drop("__n")
    small = blocks.select(idx, key).join(sizes, key)
    a, b = (small.select(F.col(idx).alias(f"idx_{x}"), F.col(key)) for x in "ab")
    return a.join(b, key).where("idx_a < idx_b").select("idx_a", "idx_b").distinct()


def candidate_pairs(canon: DataFrame, max_block: int = MAX_BLOCK) -> DataFrame:
    return pairs_in_blocks(canon.select("row_idx", F.explode(F.array_distinct(block_keys())).alias("block")), max_block=max_block)


def _sides(canon: DataFrame, pairs: DataFrame) -> DataFrame:
    a, b = (canon.select(*(F.col(c).alias(f"{x}_{c}") for c in canon.columns)) for x in "ab")
    return pairs.join(a, F.col("idx_a") == F.col("a_row_idx")).join(b, F.col("idx_b") == F.col("b_row_idx"))


def _apart(a: Column, b: Column) -> Column:
    """Both given, neither holding the other."""
    return (a != "") & (b != "") & ~F.contains(a, b) & ~F.contains(b, a)


def conflict() -> Column:
    """M9: why two records can't be one; null if they may be."""
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    disjoint = (F.size(a("province_codes")) > 0) & (F.size(b("province_codes")) > 0) & ~F.arrays_overlap(a("province_codes"), b("province_codes"))
    return reason([
        ("terna_aggregate_vs_project", a("is_aggregate") != b("is_aggregate")),
        ("province_conflict", disjoint),
        ("municipality_conflict", _apart(a("municipality_norm"), b("municipality_norm"))),
        ("title_location_conflict", _apart(a("hint"), b("municipality_norm")) | _apart(b("hint"), a("municipality_norm"))),
        ("mw_conflict", power_conflict(a("mw"), b("mw"))),
    ])


def _evidence(sim: Column) -> list[tuple[str, int, Column]]:
    """Names, points and conditions."""
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    same = lambda c: (a(c) != "") & (a(c) == b(c))
    overlap, within = jaccard(a("tokens"), b("tokens")), containment(a("tokens"), b("tokens"))
    near = power_close(a("mw"), b("mw"))
    of_mase = lambda x: F.contains(x("source_norm"), F.lit("mase"))
    across = (a("source_norm") != b("source_norm")) & of_mase(a) & of_mase(b)
    town, prov = same("municipality_norm"), same("province_norm")
    return [
        ("same_specific_url", 85, same("url_key")),
        ("same_source_identifier", 90, same("source_id")),
        ("same_title", 60, same("title_norm")),
        ("title_similarity_high", 45, sim >= 0.92),
        ("title_similarity", 25, (sim >= 0.82) & (sim < 0.92)),
        ("same_proponent", 20, same("proponent_norm")),
        ("same_municipality", 15, town),
        ("same_province", 8, ~town & prov),
        ("same_region", 4, ~town & ~prov & same("region_norm")),
        ("same_mw", 15, a("mw").isNotNull() & b("mw").isNotNull() & near),
        ("title_token_overlap", 15, overlap >= 0.65),
        ("title_token_containment", 15, (overlap < 0.65) & (within >= 0.85)),
        ("mase_bonus", 15, (of_mase(a) | of_mase(b)) & (a("title_norm") != "") & (b("title_norm") != "") & (sim >= 0.82) & near),
        ("mase_cross_source", 25, across & same("proponent_norm") & prov & near & ((sim >= 0.75) | (within >= 0.85))),
    ]


def score_pairs(canon: DataFrame, pairs: DataFrame, use_similarity: bool = True) -> DataFrame:
    """idx_a, idx_b, merge, score and reason of each pair.

    Pairs meet once. Those in conflict give the similarity of titles, the one
    Python function here, nothing to compare. A conflict's reason names the
    values that differ.
    """
    rest = _sides(canon, pairs).withColumn("conflict", settled(conflict()))
    free = F.col("conflict").isNull()
    sim = F.col("__sim")
    equal = F.when((F.col("a_title_norm") != "") & (F.col("a_title_norm") == F.col("b_title_norm")), 1.0).otherwise(0.0)
    rest = rest.withColumn("__sim", similarity()(F.when(free, F.col("a_title_norm")), F.when(free, F.col("b_title_norm"))) if use_similarity else equal)
    found = _evidence(sim)
    points = [F.when(F.coalesce(c, F.lit(False)), n).otherwise(0) for _, n, c in found]
    names = F.array_join(F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, _, c in found))), "+")
    rest = rest.withColumn("score", sum(points[1:], points[0])).withColumn("__names", names)
    a, b = (lambda c: F.col(f"a_{c}")), (lambda c: F.col(f"b_{c}"))
    same = lambda c: (a(c) != "") & (a(c) == b(c))
    aggregates = a("is_aggregate") & b("is_aggregate")
    exact = (a("title_norm") == b("title_norm")) & (a("source_norm") == b("source_norm"))
    enough = (F.col("score") >= 90) | (same("title_norm") & (F.col("score") >= 75)) | (F.contains("__names", F.lit("mase_cross_source")) & (F.col("score") >= 75))
    enough = enough | (same("proponent_norm") & same("municipality_norm") & power_close(a("mw"), b("mw")) & (sim >= 0.75))
    exactly = aggregates & exact
    why = F.when(exactly, "terna_exact_aggregate_duplicate").when(aggregates, "terna_aggregate_not_exact").when(F.col("__names") != "", F.col("__names")).otherwise("insufficient_evidence")
    return rest.select(
        "idx_a", "idx_b", (free & F.when(aggregates, exact).otherwise(enough)).alias("merge"), F.when(~free, 0).when(exactly, 100).otherwise(F.col("score")).alias("score"),
        F.coalesce("conflict", why).alias("reason"), F.when(~free, _opposed()).alias("values"),
    )


def _opposed() -> Column:
    """M9: the values of two records that are in conflict, as a | b."""
    told = lambda x: F.concat_ws(", ", F.array_join(F.col(f"{x}_province_codes"), "/"), f"{x}_municipality_norm", f"{x}_hint", F.col(f"{x}_mw").cast("string"))
    fields = {"province_conflict": lambda x: F.array_join(F.col(f"{x}_province_codes"), "/"), "municipality_conflict": lambda x: F.col(f"{x}_municipality_norm"), "mw_conflict": lambda x: F.col(f"{x}_mw").cast("string"), "terna_aggregate_vs_project": lambda x: F.col(f"{x}_source_norm")}
    out = F.concat_ws(" | ", told("a"), told("b"))
    for name, of in fields.items():
        out = F.when(F.col("conflict") == name, F.concat_ws(" | ", of("a"), of("b"))).otherwise(out)
    return out


def pair_reports(scored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The accepted pairs, and those rejected for a conflict or in spite of some evidence."""
    return scored.where("merge"), scored.where(~F.col("merge") & ((F.col("score") > 0) | F.contains("reason", F.lit("conflict"))))


def connected(nodes: DataFrame, links: DataFrame, id_col: str = "row_idx") -> DataFrame:
    """id_col and group_id, the smallest id that a node reaches over links (idx_a, idx_b).

    Each round a node takes the smallest label of its neighbours and of its
    own label; labels spread over halved distances. Rounds are checkpointed
    (reliably), and end when no label changes.
    """
    edges = links.select(F.col("idx_a").alias("u"), F.col("idx_b").alias("v"))
    edges = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    edges = settle(edges)
    labels = settle(edges.groupBy(F.col("u").alias("node")).agg(F.least(F.col("u"), F.min("v")).alias("label")))
    while not labels.isEmpty():
        near = edges.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("label").alias("__near"))
        lower = labels.join(near, "node").select("node", F.least("label", "__near").alias("__low"), "label")
        jump = lower.select(F.col("node").alias("__low"), F.col("__low").alias("__next"))
        moved = settle(lower.join(jump, "__low", "left").select("node", F.least("__low", F.coalesce("__next", "__low")).alias("label"), F.col("label").alias("__was")))
        labels = moved.drop("__was")
        if moved.where("label <> __was").isEmpty():
            break
    return nodes.select(id_col).join(labels.withColumnRenamed("node", id_col), id_col, "left").select(id_col, F.coalesce("label", id_col).alias("group_id"))


def merge_groups(records: DataFrame, group: str, score: str, fill: Sequence[str], modes: Sequence[str], title: str, url: str, mw: str, source: str, idx: str = "row_idx") -> DataFrame:
    """One row per group.

    Columns of fill come from the most complete row, blanks from the next;
    modes are the most frequent values; the title is the longest, the URL the
    first specific one; power the most frequent at three decimals. Lists say
    what was merged. Values are made distinct, or aggregated by value, before
    a group's are gathered, so a large group gathers what differs alone.
    """
    place = F.struct(F.col(score).isNull(), -F.col(score), F.col(idx))
    specific = urls.specific_key(F.col(url)) != ""
    picked = records.groupBy(group).agg(
        F.count("*").alias("group_size"), *(F.min_by(null_if_blank(F.col(c)), F.when(null_if_blank(F.col(c)).isNotNull(), place)).alias(c) for c in fill),
        F.min_by(title, F.struct(-F.length(title), F.col(idx))).alias("longest_title"),
        F.coalesce(F.min_by(url, F.when(specific, F.col(idx))), F.min_by(url, F.when(null_if_blank(F.col(url)).isNotNull(), F.col(idx)))).alias("best_url"),
    )
    # one row for each field and value of a record; equal ones are counted before a group's are gathered
    modal = {m: null_if_blank(F.col(m)) for m in modes} | {"mw": F.round(mw, 3).cast("string")}
    listed = {"titles": title, "urls": url, "sources": source}
    told = F.array(*(F.struct(F.lit(f"mode {n}").alias("f"), v.cast("string").alias("v")) for n, v in modal.items()), *(F.struct(F.lit(f"list {n}").alias("f"), null_if_blank(F.col(c)).cast("string").alias("v")) for n, c in listed.items()))
    each = records.select(group, idx, F.inline(told)).where("v is not null")
    counted = each.groupBy(group, "f", "v").agg(F.count("*").alias("n"), F.min(idx).alias("i"))
    of = lambda name, x: F.when(F.col("f") == name, x)
    kinds = dict(records.dtypes)
    most = [F.min_by("v", of(f"mode {n}", F.struct(-F.col("n"), F.col("i")))).cast("double" if n == "mw" else kinds[n]).alias(f"{n}_mode") for n in modal]
    names = [F.slice(F.sort_array(F.collect_list(of(f"list {n}", F.col("v")))), 1, 10).alias(f"merged_{n}") for n in ("titles", "urls")]
    sources = F.transform(F.sort_array(F.collect_list(of("list sources", F.struct("i", "v")))), lambda x: x["v"]).alias("merged_sources")
    return picked.join(counted.groupBy(group).agg(*most, *names, sources), group, "left")


def stable_key(canon: DataFrame) -> Column:
    """M6: a prefix that tells what names the record, and 16 digits of SHA-1."""
    c = F.col
    described = F.concat_ws("|", "title_norm", "proponent_norm", "region_norm", "province_norm", "municipality_norm", F.coalesce(F.format_string("%.2f", F.round("mw", 2)), F.lit("")))
    statistic = F.concat_ws("|", F.lit("terna_aggregate"), "source_norm", "region_norm", "province_norm", "title_norm")
    return (
        F.when(c("is_aggregate"), F.concat(F.lit("agg:terna:"), short_hash(statistic)))
        .when(c("source_id") != "", F.concat(F.lit("src:"), short_hash(c("source_id"))))
        .when(c("url_key") != "", F.concat(F.lit("url:"), short_hash(c("url_key"))))
        .otherwise(F.concat(F.lit("prj:"), short_hash(described)))
    )


def unique_keys(df: DataFrame, key: str, material: Sequence[str], idx: str = "row_idx") -> DataFrame:
    """Keys that several rows have get a suffix for each of them, from what describes the row and its place."""
    by = W.partitionBy(key)
    n, place = F.count("*").over(by), F.row_number().over(by.orderBy(idx))
    text = F.concat_ws("|", F.col(key), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in material), place.cast("string"))
    new = F.when(n > 1, F.concat(F.col(key), F.lit(":split:"), short_hash(text, 8))).otherwise(F.col(key))
    return df.withColumn("unique_key", new).withColumn("original_key", F.when(n > 1, F.col(key)))


def final_order() -> list[Column]:
    """M14."""
    return [F.asc("is_aggregate"), F.desc(F.coalesce("mw", F.lit(0.0))), F.asc("title_norm")]


def dedupe(records: DataFrame, use_similarity: bool = True, max_block: int = MAX_BLOCK) -> tuple[DataFrame, DataFrame]:
    """row_idx and group_id of each record, and the scored pairs."""
    canon = settle(canonical(records))
    scored = score_pairs(canon, candidate_pairs(canon, max_block), use_similarity)
    scored = settle(scored)
    return connected(records, scored.where("merge")), scored


def one_per_group(records: DataFrame, groups: DataFrame, score: str = "completeness") -> DataFrame:
    """Of each group the most complete record."""
    return least_per_key(records.join(groups, "row_idx"), "group_id", F.col(score).isNull(), -F.col(score), F.col("row_idx"))

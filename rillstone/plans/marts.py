"""Queries of roll-ups, scores, counters and rankings (A, O, W5, F22)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.operators import marts as M
from rillstone.operators.ordered import mode_first_seen
from rillstone.operators.rules import gates
from rillstone.plans.common import RECORDS_SQL, Registry, records, table

R = Registry()

_ROLLUP_SQL = f"""{RECORDS_SQL},
r AS (
  SELECT region, count(*) FILTER (NOT is_aggregate) AS project_count, coalesce(sum(mw) FILTER (NOT is_aggregate), 0) AS pm, count(*) FILTER (is_aggregate) AS aggregate_count,
    coalesce(sum(mw) FILTER (is_aggregate), 0) AS am, CAST(coalesce(sum(practices) FILTER (is_aggregate), 0) AS BIGINT) AS aggregate_practices
  FROM records GROUP BY region
)"""
_ROLLUP_COLUMNS = "region, project_count, round(pm, 3) AS project_mw, aggregate_count, round(am, 3) AS aggregate_mw, aggregate_practices, round(pm + am, 3) AS total_mw"


@R.query(f"""WITH {_ROLLUP_SQL}, s AS (SELECT {_ROLLUP_COLUMNS}, round(project_count * 0.05::DOUBLE + pm / 1000 + am / 5000, 1) AS priority_score FROM r)
SELECT *, row_number() OVER (ORDER BY priority_score DESC, region) AS rank FROM s""")
def q01_region_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5, A7, O5."""
    return M.ranked(M.with_score(M.region_rollup(records(spark, sf_dir)), "absolute"), F.desc("priority_score"), F.asc("region"))


_RELATIVE = "round(coalesce(pm / nullif(max(pm) OVER (), 0), 0) * 40 + coalesce(project_count / nullif(max(project_count) OVER (), 0), 0) * 25 + coalesce(am / nullif(max(am) OVER (), 0), 0) * 25 + coalesce(aggregate_practices / nullif(max(aggregate_practices) OVER (), 0), 0) * 10, 1)"


@R.query(f"WITH {_ROLLUP_SQL} SELECT {_ROLLUP_COLUMNS}, {_RELATIVE} AS priority_score FROM r")
def q02_region_relative_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6, W5."""
    return M.with_score(M.region_rollup(records(spark, sf_dir)), "relative")


@R.query(f"WITH {_ROLLUP_SQL} SELECT {_ROLLUP_COLUMNS}, round(project_count * 0.06::DOUBLE + pm / 1000, 1) AS priority_score FROM r")
def q02b_region_light_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8."""
    return M.with_score(M.region_rollup(records(spark, sf_dir)), "light")


@R.query(f"""WITH {RECORDS_SQL} SELECT count(*) AS records, count(*) FILTER (NOT is_aggregate) AS projects, count(*) FILTER (is_aggregate) AS aggregates,
  round(sum(mw), 3) AS total_mw, round(sum(mw) FILTER (NOT is_aggregate), 3) AS project_mw, round(sum(mw) FILTER (is_aggregate), 3) AS aggregate_mw FROM records""")
def q01b_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A20."""
    return M.totals(records(spark, sf_dir))


@R.query("""WITH l AS (SELECT c_mktsegment AS source, n_name AS label, count(*) AS n, min(c_custkey) AS first FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, first) AS rn FROM l)
SELECT source, CAST(sum(n) AS BIGINT) AS count, min(first) AS first_idx, max(label) FILTER (rn = 1) AS label FROM r GROUP BY source""")
def q03_source_counts_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3, A4, W6."""
    return M.source_counts(_labelled_customers(spark, sf_dir))


def _labelled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = table(spark, sf_dir, "nation")
    return table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_mktsegment").alias("source"), F.col("n_name").alias("label"), F.col("c_custkey").alias("row_idx"))


@R.query("""WITH l AS (SELECT c_nationkey AS source, c_mktsegment AS label, count(*) AS n, min(c_custkey) AS first FROM customer GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, first) AS rn FROM l),
s AS (SELECT source, sum(n) AS count, min(first) AS first_idx, max(label) FILTER (rn = 1) AS label FROM r GROUP BY source)
SELECT label, CAST(sum(count) AS BIGINT) AS count, min(first_idx) AS first_idx FROM s GROUP BY label""")
def q03b_counts_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate of an aggregate."""
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("source"), F.col("c_mktsegment").alias("label"), F.col("c_custkey").alias("row_idx"))
    return M.counts_by_label(M.source_counts(rows))


@R.query(f"WITH {RECORDS_SQL} SELECT coalesce(nullif(status, 'P'), 'ND') AS status, round(sum(mw), 3) AS mw, count(*) AS count, CAST(sum(practices) AS BIGINT) AS practices FROM records WHERE is_aggregate GROUP BY 1")
def q04_status_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A9; one status is blanked."""
    rows = records(spark, sf_dir).where("is_aggregate").withColumn("status", F.when(F.col("status") != "P", F.col("status")))
    return M.status_rollup(rows)


def _gappy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with gaps: power, province, municipality and URL are missing by rule."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("source"), F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("mw"),
        F.when(k % 7 != 0, F.col("c_name")).otherwise(" ").alias("province"), F.when(k % 5 != 0, F.col("c_name")).alias("municipality"),
        F.when(k % 3 == 0, "ND").when(k % 13 == 0, "").otherwise("R").alias("region"), F.when(k % 4 != 0, F.lit("http://x")).alias("url"), (k % 11 == 0).alias("is_aggregate"),
    )


_GAPPY_SQL = """g AS (SELECT c_mktsegment AS source, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS mw, c_custkey % 7 = 0 AS no_province, c_custkey % 5 = 0 AS no_town,
  c_custkey % 3 = 0 AS nd, c_custkey % 3 <> 0 AND c_custkey % 13 = 0 AS no_region, c_custkey % 4 = 0 AS no_url, c_custkey % 11 = 0 AS agg FROM customer)"""


@R.query(f"""WITH {_GAPPY_SQL} SELECT count(*) FILTER (NOT agg) AS projects, count(*) FILTER (NOT agg AND mw IS NULL) AS missing_mw, count(*) FILTER (NOT agg AND (nd OR no_region)) AS missing_region,
  count(*) FILTER (NOT agg AND no_province) AS missing_province, count(*) FILTER (NOT agg AND no_town) AS missing_municipality, count(*) FILTER (no_url) AS missing_url FROM g""")
def q05b_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10."""
    return M.quality_summary(_gappy(spark, sf_dir))


def _by_source_sql(where: str, place: str) -> str:
    return f"""WITH {_GAPPY_SQL}, s AS (SELECT source, count(*) AS count, count(*) FILTER (mw IS NULL) AS missing_mw, count(*) FILTER (no_province AND {place}) AS missing_province,
  count(*) FILTER (no_town AND {place}) AS missing_municipality FROM g WHERE {where} GROUP BY source)
SELECT *, round(100 * (3 * count - (missing_mw + missing_province + missing_municipality)) / (3 * count), 1) AS completeness_pct FROM s"""


@R.query(_by_source_sql("true", "NOT agg"))
def q05_quality_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11, places missed of projects alone."""
    return M.quality_by_source(_gappy(spark, sf_dir))


@R.query(_by_source_sql("NOT agg", "true"))
def q05c_quality_of_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A11, projects alone."""
    return M.quality_by_source(_gappy(spark, sf_dir), variant="projects_only")


@R.query("SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def q06_topk_stable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty largest, in a total order."""
    rows = table(spark, sf_dir, "orders").where("o_orderstatus <> 'F'").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return M.top_k(rows, 20, F.desc("o_totalprice"), F.asc("o_orderkey"))


@R.query("""SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN p_brand END AS region, CASE WHEN p_size % 3 <> 0 THEN p_type END AS province, CASE WHEN p_size % 5 <> 0 THEN p_retailprice END AS mw, p_name AS name
FROM part ORDER BY region NULLS LAST, province NULLS LAST, mw DESC NULLS LAST, name NULLS LAST, p_partkey LIMIT 100""")
def q07_nulls_last_sort_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: the first hundred rows of a snapshot."""
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(size % 4 != 0, F.col("p_brand")).alias("region"), F.when(size % 3 != 0, F.col("p_type")).alias("province"), F.when(size % 5 != 0, F.col("p_retailprice")).alias("mw"), F.col("p_name").alias("name"))
    return M.top_k(rows, 100, *M.snapshot_order(), F.asc("p_partkey"))


@R.query("""SELECT c_custkey, c_mktsegment, CASE WHEN c_custkey % 20 <> 0 THEN c_acctbal END AS balance FROM customer
ORDER BY lower(c_mktsegment), coalesce(CASE WHEN c_custkey % 20 <> 0 THEN c_acctbal END, '-Infinity'::DOUBLE), c_custkey LIMIT 30""")
def q07b_chosen_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without case and accents, an unknown number below all; the first thirty rows."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.when(F.col("c_custkey") % 20 != 0, F.col("c_acctbal")).alias("balance"))
    return M.top_k(rows, 30, M.chosen_order("c_mktsegment"), M.chosen_order("balance", "number"), F.asc("c_custkey"))


@R.query("""WITH k AS (SELECT md5(text) AS k, count(*) AS n FROM documents GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS row_count, count(*) AS key_count, CAST(sum(n - 1) AS BIGINT) AS surplus, count(*) FILTER (n > 1) AS repeated_keys FROM k""")
def q11_duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A12."""
    return M.surplus_rows(table(spark, sf_dir, "documents").select(F.md5("text").alias("k")), "k")


@R.query("""WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS first FROM events GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, first) AS rn FROM c) SELECT user_id, event_type, n AS count FROM r WHERE rn = 1""")
def q12_mode_tie_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19."""
    return mode_first_seen(table(spark, sf_dir, "events"), "user_id", "event_type", "event_id")


@R.query("""SELECT l_suppkey, count(DISTINCT l_partkey) AS items, round(sum(l_quantity), 2) AS sum_mw, round(avg(l_quantity), 4) AS avg_mw, max(l_quantity) AS max_mw, min(s_name) AS display_name,
  substr(string_agg(DISTINCT p_brand, ', ' ORDER BY p_brand), 1, 1000) AS brands, substr(string_agg(DISTINCT p_type, ', ' ORDER BY p_type), 1, 1000) AS types
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey""")
def q13_proponent_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A13."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_orderkey", "l_quantity")
    rows = lines.join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.join(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return M.entity_rollup(rows, "l_suppkey", "l_partkey", "l_quantity", {"brands": "p_brand", "types": "p_type"}, "s_name", "l_orderkey")


@R.query(f"WITH {RECORDS_SQL} SELECT province, round(sum(mw), 2) AS mw FROM records WHERE NOT is_aggregate GROUP BY province ORDER BY mw DESC, province LIMIT 10")
def q13b_top_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten largest."""
    return M.top_sums(records(spark, sf_dir).where("NOT is_aggregate"), "province", "mw")


@R.query("SELECT split_part(event_type || ':' || user_id, ':', 1) AS family, count(*) AS count FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def q16c_reason_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reasons up to their colon."""
    rows = table(spark, sf_dir, "events").select(F.concat_ws(":", "event_type", F.col("user_id").cast("string")).alias("reason"))
    return M.families(rows, "reason")


@R.query("SELECT c_nationkey, count(*) AS count, count(DISTINCT c_mktsegment) AS members FROM customer GROUP BY c_nationkey")
def q13c_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A18."""
    return M.histogram(table(spark, sf_dir, "customer"), "c_nationkey", "c_mktsegment")


@R.query("""SELECT * FROM (SELECT unnest(['some rows', 'no negative price', 'keys are unique', 'at least three statuses', 'no unknown priority', 'impossible']) AS "check",
  unnest([n > 0, negative = 0, keys = n, statuses >= 3, unknown = 0, n < 0]) AS passed FROM (
  SELECT count(*) AS n, count(*) FILTER (o_totalprice < 0) AS negative, count(DISTINCT o_orderkey) AS keys, count(DISTINCT o_orderstatus) AS statuses,
    count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW')) AS unknown FROM orders))""")
def q17_validation_gates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F22."""
    known = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    return gates(table(spark, sf_dir, "orders"), [
        ("some rows", F.count("*") > 0), ("no negative price", F.count_if(F.col("o_totalprice") < 0) == 0), ("keys are unique", F.count_distinct("o_orderkey") == F.count("*")),
        ("at least three statuses", F.count_distinct("o_orderstatus") >= 3), ("no unknown priority", F.count_if(~F.col("o_orderpriority").isin(*known)) == 0), ("impossible", F.count("*") < 0),
    ])


@R.query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS events, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def q36_event_time_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: events by day."""
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")
    return table(spark, sf_dir, "events").groupBy(day, "event_type").agg(F.count("*").alias("events"), F.round(F.sum("value"), 2).alias("total"))


@R.query("""SELECT c_mktsegment, o_orderstatus, CAST(grouping(c_mktsegment) * 2 + grouping(o_orderstatus) AS BIGINT) AS level, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY CUBE (c_mktsegment, o_orderstatus)""")
def q37_rollup_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extension: all grouping sets of two columns."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.cube("c_mktsegment", "o_orderstatus").agg(F.grouping_id().cast("long").alias("level"), F.count("*").alias("orders"))


QUERIES, ORACLES = R.queries, R.oracles

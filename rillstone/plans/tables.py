"""Queries of filters, joins, ordered analytics, ingestion, differences and sets (F, J, W, K, M1-M5, M19-M26, U)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.functions.text import match_text
from rillstone.operators import diff, ingest, ordered, rules
from rillstone.operators.marts import run_counters
from rillstone.plans.common import Registry, sql_values, table, values

R = Registry()


@R.query("""SELECT event_id, ts, user_id, c_name, c_mktsegment FROM events LEFT JOIN customer ON user_id * 20 = c_custkey
WHERE event_type IN ('purchase', 'signup') AND ts >= TIMESTAMP '2024-01-29 12:00:00' AND ts <= TIMESTAMP '2024-01-30 12:00:00'""")
def q08_recent_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the day before as_of, each with its customer or none."""
    as_of = F.lit("2024-01-30 12:00:00").cast("timestamp_ntz")
    recent = table(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "signup") & (F.col("ts") >= as_of - F.expr("INTERVAL 24 HOURS")) & (F.col("ts") <= as_of))
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return recent.join(customers, F.col("user_id") * 20 == F.col("c_custkey"), "left").select("event_id", "ts", "user_id", "c_name", "c_mktsegment")


@R.query("""WITH r AS (SELECT *, row_number() OVER w AS rn, first_value(event_id) OVER w AS kept_event, first_value(value) OVER w AS kept_value FROM events WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC))
SELECT event_id, user_id, event_type, CASE WHEN rn = 1 THEN 'kept' ELSE 'dropped' END AS role, CASE WHEN rn > 1 THEN kept_event END AS kept_event, CASE WHEN rn > 1 THEN kept_value END AS kept_value FROM r""")
def q09_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest row of each key, and the others with what was kept instead."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts", "value")
    kept, lost = ordered.latest_with_losers(rows, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")], {"kept_event": "event_id", "kept_value": "value"})
    columns = ["event_id", "user_id", "event_type", "role", "kept_event", "kept_value"]
    return kept.withColumn("role", F.lit("kept")).unionByName(lost.withColumn("role", F.lit("dropped")), allowMissingColumns=True).select(*columns)


@R.query("""WITH r AS (SELECT event_id, user_id || '-' || event_type AS k, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS n FROM events)
SELECT event_id, CASE WHEN n = 1 THEN k ELSE k || '#dup' || n END AS unique_key, CAST(n AS INTEGER) AS ordinal, n = 1 AS first FROM r""")
def q10_first_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that repeat a key, told apart."""
    rows = table(spark, sf_dir, "events").select("event_id", F.concat_ws("-", F.col("user_id").cast("string"), "event_type").alias("k"))
    numbered = ordered.with_ordinal(ordered.duplicate_suffix(rows, "k", F.asc("event_id")), "k", F.asc("event_id"))
    return numbered.select("event_id", "unique_key", "ordinal", (F.col("ordinal") == 1).alias("first"))


@R.query("""SELECT o_orderkey, c_name, c_mktsegment, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey
WHERE c_mktsegment = 'BUILDING' AND o_orderstatus = 'O' AND contains(lower(concat_ws(' ', c_name, o_orderpriority, c_mktsegment)), '#00000000')""")
def q14_interactive_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F16: equality where asked, and a substring of several columns."""
    rows = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    found = rules.interactive_filter(rows, "#00000000", ("c_name", "o_orderpriority", "c_mktsegment"), c_mktsegment="BUILDING", o_orderstatus="O", c_nationkey=None)
    return found.select("o_orderkey", "c_name", "c_mktsegment", "o_totalprice")


@R.query("""WITH d AS (SELECT doc_id, lower(text) AS t FROM documents)
SELECT doc_id, regexp_matches(t, 'license|token|est') AND NOT (regexp_matches(t, 'idiot|moron|\\|') AND NOT contains(t, 'license')) AS tiered,
  regexp_matches(t, 'ation|keit') AND NOT (contains(t, 'der ') AND NOT contains(t, 'ung ')) AND (NOT contains(t, 'der ') OR contains(t, 'lich')) AS needed,
  contains(t, 'the') AND NOT contains(t, 'clown') AS never FROM d""")
def q15_keyword_relevance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevance by tiers of words."""
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        rules.relevant(text, ("license", "token", "est"), ("license",), ("idiot", "moron", "|")).alias("tiered"),
        rules.relevant(text, ("ation", "keit"), ("ung ",), ("der ",), needed_with_exclude=("lich",)).alias("needed"),
        rules.relevant(text, ("the",), (), (), never=("clown",)).alias("never"),
    )


_ORDER_RULES_SQL = "CASE WHEN o_totalprice < 50000 THEN 'too_small' WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'too_old' WHEN o_orderpriority = '5-LOW' THEN 'low_priority' END"


def _order_rules() -> list:
    return [("too_small", F.col("o_totalprice") < 50000), ("too_old", F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")), ("low_priority", F.col("o_orderpriority") == "5-LOW")]


@R.query(f"SELECT o_orderkey, {_ORDER_RULES_SQL} AS reason FROM orders")
def q16_reason_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted rows, and rejected ones with the first reason."""
    good, bad = rules.split_by_reason(table(spark, sf_dir, "orders"), _order_rules())
    return good.unionByName(bad, allowMissingColumns=True).select("o_orderkey", "reason")


@R.query("""SELECT o_orderkey, unnest(list_filter([CASE WHEN o_totalprice < 50000 THEN 'too_small' END, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 'too_old' END,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'low_priority' END], lambda x: x IS NOT NULL)) AS issue FROM orders""")
def q16b_row_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each broken rule."""
    return rules.each_error(table(spark, sf_dir, "orders"), _order_rules()).select("o_orderkey", "issue")


@R.query("""SELECT o_orderkey FROM orders WHERE contains(lower(to_json({o_orderkey: o_orderkey, o_orderstatus: o_orderstatus, o_orderpriority: o_orderpriority})), '2-high')""")
def q16d_blob_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a word anywhere in a row."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return rows.where(rules.blob_contains(rows, ["2-HIGH"])).select("o_orderkey")


_POLICY = {"o_orderstatus": "overwrite", "o_orderpriority": "fill", "url": "link"}


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A master of all orders, and a batch of all of them twice, changed by rule; the keys of each fifth are new there."""
    k = F.col("k")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), "o_orderstatus", "o_orderpriority", F.lit("http://old").alias("url"))
    master = orders.withColumn("o_orderpriority", F.when(k % 3 != 0, F.col("o_orderpriority")))
    status = F.when(k % 4 == 0, "X").when(k % 4 == 1, F.col("o_orderstatus")).otherwise(F.concat(F.lit(" "), "o_orderstatus"))
    late = orders.withColumns({"o_orderstatus": status, "url": F.when(k % 8 == 0, "http://new").otherwise("ftp://new"), "row_idx": F.lit(2)})
    both = late.unionByName(orders.withColumns({"o_orderstatus": F.lit("EARLY"), "row_idx": F.lit(1)}))
    return master, both.withColumn("k", F.when(k % 5 == 0, -k - 1).otherwise(k))


_UPSERT_SQL = """
m AS (SELECT o_orderkey AS k, o_orderstatus AS s, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END AS p, 'http://old' AS u FROM orders),
b AS (SELECT CASE WHEN o_orderkey % 5 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS k, CASE o_orderkey % 4 WHEN 0 THEN 'X' WHEN 1 THEN o_orderstatus ELSE ' ' || o_orderstatus END AS s, o_orderpriority AS p,
  CASE WHEN o_orderkey % 8 = 0 THEN 'http://new' ELSE 'ftp://new' END AS u FROM orders),
j AS (SELECT coalesce(m.k, b.k) AS k, m.k IS NULL AS is_new, b.k IS NULL AS kept, m.s AS ms, b.s AS bs, m.p AS mp, b.p AS bp, m.u AS mu, b.u AS bu,
  m.k IS NOT NULL AND b.k IS NOT NULL AND trim(b.s) <> m.s AS cs, m.k IS NOT NULL AND b.k IS NOT NULL AND m.p IS NULL AS cp, m.k IS NOT NULL AND b.k IS NOT NULL AND starts_with(b.u, 'http') AS cu
  FROM m FULL JOIN b ON m.k = b.k),
p AS (SELECT k, CASE WHEN is_new THEN 'new' WHEN kept THEN 'kept' WHEN cs OR cp OR cu THEN 'changed' ELSE 'unchanged' END AS action,
  CASE WHEN is_new OR cs THEN bs ELSE ms END AS o_orderstatus, CASE WHEN is_new OR cp THEN bp ELSE mp END AS o_orderpriority, CASE WHEN is_new OR cu THEN bu ELSE mu END AS url,
  CAST(cs::INT + cp::INT + cu::INT AS INTEGER) AS changes FROM j)"""


@R.query(f"WITH {_UPSERT_SQL} SELECT * FROM p")
def q18_upsert_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch meets the master, field by field."""
    plan = ingest.plan_upsert(*_sides(spark, sf_dir), "k", _POLICY)
    return plan.select("k", "action", "o_orderstatus", "o_orderpriority", "url", F.size("changed_fields").alias("changes"))


@R.query(f"""WITH {_UPSERT_SQL} SELECT CAST(count(*) AS BIGINT) AS raw, count(*) FILTER (action = 'new') AS new, count(*) FILTER (action = 'changed') AS changed,
  count(*) FILTER (action = 'unchanged') AS unchanged, CAST(0 AS BIGINT) AS skipped FROM p WHERE action <> 'kept'""")
def q18b_run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A17."""
    return run_counters(ingest.plan_upsert(*_sides(spark, sf_dir), "k", _POLICY).where("action <> 'kept'"))


@R.query(f"""WITH {_UPSERT_SQL} SELECT k, CASE WHEN action = 'new' THEN 'project_created' ELSE 'project_updated' END AS event_type FROM p WHERE action IN ('new', 'changed')""")
def q18c_change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: the change log."""
    plan = ingest.plan_upsert(*_sides(spark, sf_dir), "k", _POLICY)
    return ingest.events(plan, "k", F.lit("2024-01-30").cast("timestamp_ntz")).select("k", "event_type")


@R.query("""WITH a AS (SELECT user_id, event_type, value, ts, 0 AS side FROM events UNION ALL SELECT user_id, event_type, value + 1, CASE WHEN event_id % 3 = 0 THEN ts ELSE ts - INTERVAL 1 DAY END, 1 FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, side DESC) AS rn FROM a) SELECT user_id, event_type, value, ts FROM r WHERE rn = 1""")
def q18d_upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the most recent row of each key of a table and a batch."""
    rows = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value", "ts")
    new = rows.withColumns({"value": F.col("value") + 1, "ts": F.when(F.col("event_id") % 3 == 0, F.col("ts")).otherwise(F.col("ts") - F.expr("INTERVAL 1 DAY"))})
    return ingest.upsert_latest(rows.drop("event_id"), new.drop("event_id"), ["user_id", "event_type"], "ts")


@R.query("""SELECT coalesce(s.name, b.name) AS name, CASE WHEN b.url IS NOT NULL AND b.url IS DISTINCT FROM s.base_url THEN b.url ELSE s.base_url END AS base_url FROM
  (SELECT n_name AS name, 'http://' || n_regionkey AS base_url FROM nation) s FULL JOIN
  (SELECT CASE WHEN n_nationkey % 3 = 0 THEN n_name || ' II' ELSE n_name END AS name, 'http://' || (n_regionkey % 2) AS url FROM nation) b ON s.name = b.name""")
def q18e_upsert_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1."""
    rows = table(spark, sf_dir, "nation")
    url = lambda c: F.concat(F.lit("http://"), c.cast("string")).alias("base_url")
    old = rows.select(F.col("n_name").alias("name"), url(F.col("n_regionkey")))
    name = F.when(F.col("n_nationkey") % 3 == 0, F.concat("n_name", F.lit(" II"))).otherwise(F.col("n_name"))
    return ingest.upsert_sources(old, rows.select(name.alias("name"), url(F.col("n_regionkey") % 2)))


@R.query("""SELECT page_id, sha1(CASE page_id % 3 WHEN 0 THEN 'url|' || url WHEN 1 THEN 'external|' || page_id ELSE 'page ' || page_id || '||region|a b|' || CAST(page_id AS DOUBLE) END) AS project_key FROM pages""")
def q19_project_key_sha1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By URL, by external id, or by what describes a project."""
    k = F.col("page_id")
    key = ingest.project_key(
        F.when(k % 3 == 0, F.col("url")), F.when(k % 3 == 1, k.cast("string")), F.concat(F.lit("Page #"), k.cast("string")), F.lit(None).cast("string"), F.lit("Région"), F.lit("A, B"), k.cast("double")
    )
    return table(spark, sf_dir, "pages").select("page_id", key.alias("project_key"))


_FIELDS = {"p_name": "text", "p_brand": "text", "p_retailprice": "number"}


@R.query("""WITH o AS (SELECT CAST(p_partkey AS VARCHAR) AS key, p_name, p_brand, p_retailprice FROM part),
n AS (SELECT CASE WHEN p_partkey % 11 = 0 THEN 'new ' ELSE '' END || p_partkey AS key, CASE WHEN p_partkey % 5 = 0 THEN upper(p_name) WHEN p_partkey % 4 = 0 THEN p_name || ' x' ELSE p_name END AS p_name,
  p_brand, CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS p_retailprice FROM part),
j AS (SELECT coalesce(o.key, n.key) AS key, o.key IS NULL AS a, n.key IS NULL AS r, o.p_name AS on_, n.p_name AS nn, o.p_retailprice AS op, n.p_retailprice AS np FROM o FULL JOIN n USING (key))
SELECT key, 'added' AS change_type, NULL::VARCHAR AS field, NULL::VARCHAR AS new_value FROM j WHERE a
UNION ALL SELECT key, 'removed', NULL, NULL FROM j WHERE r
UNION ALL SELECT key, 'changed', 'p_name', nn FROM j WHERE NOT a AND NOT r AND lower(on_) <> lower(nn)
UNION ALL SELECT key, 'changed', 'p_retailprice', translate(format('{:,.3f}', np), ',.', '.,') FROM j WHERE NOT a AND NOT r AND op <> np""")
def q20_snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What was added, removed and changed."""
    k = F.col("p_partkey")
    rows = table(spark, sf_dir, "part").select(k, k.cast("string").alias("key"), k.alias("row_idx"), "p_name", "p_brand", "p_retailprice")
    changed = rows.withColumns({"p_name": F.when(k % 5 == 0, F.upper("p_name")).when(k % 4 == 0, F.concat("p_name", F.lit(" x"))).otherwise(F.col("p_name")), "p_retailprice": F.when(k % 3 == 0, F.col("p_retailprice") + 1).otherwise(F.col("p_retailprice"))})
    changed = changed.withColumn("key", F.concat(F.when(k % 11 == 0, "new ").otherwise(""), "key"))
    found = diff.snapshot_diff(rows, changed, "key", _FIELDS)
    return found.select("key", "change_type", "field", "new_value")


@R.query("""SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'project_key:' || c_name WHEN c_custkey % 5 = 1 THEN 'url:http://x/' || c_custkey
  ELSE 'fallback:' || lower(c_mktsegment) || '|' || replace(lower(c_name), '#', ' ') END AS key FROM customer""")
def q20b_record_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ladder of keys."""
    k = F.col("c_custkey")
    key = diff.record_key({"project_key": F.when(k % 5 == 0, F.col("c_name")), "url": F.when(k % 5 == 1, F.concat(F.lit("http://x/"), k.cast("string"))).otherwise("")}, F.col("c_mktsegment"), F.col("c_name"))
    return table(spark, sf_dir, "customer").select("c_custkey", key.alias("key"))


@R.query("""SELECT 'projects' AS "table", count(*) AS deleted FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT 'events', count(*) FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE o_orderpriority = 'BUILDING' OR c_mktsegment = 'BUILDING'""")
def q21_left_anti_semi_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source goes with its projects and their events; how many rows of each."""
    projects = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("project_id"), F.col("c_mktsegment").alias("source"))
    events = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("project_id"), F.col("o_orderpriority").alias("source"))
    return ingest.purge({"projects": projects, "events": events}, "source", "BUILDING")[1].select("table", F.col("deleted").cast("long").alias("deleted"))


@R.query("""SELECT c_custkey, 'in' AS side FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)
UNION ALL SELECT c_custkey, 'out' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)""")
def q21b_semi_and_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9, J10, J13, F18."""
    customers, large = table(spark, sf_dir, "customer").select("c_custkey"), table(spark, sf_dir, "orders").where("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return customers.join(large, "c_custkey", "left_semi").withColumn("side", F.lit("in")).unionByName(customers.join(large, "c_custkey", "left_anti").withColumn("side", F.lit("out")))


_RULES = [(1, "title_contains_all", ["red", "bolt"], None, "patch", {"p_brand": "Brand#99"}, "brand"), (2, "title_contains_all", ["ring"], None, "exclude", {}, "no rings"), (3, "url_eq", ["part/7"], 1, "patch", {"p_name": "seventh"}, "name"), (4, "url_contains", ["part/19"], None, "patch", {"p_brand": "Brand#1"}, "brand")]
_RULE_SCHEMA = "seq int, match_kind string, match_value array<string>, expected_matches long, action string, fields map<string,string>, reason string"
_HITS_SQL = """h AS (SELECT *, CASE WHEN contains(p_name, 'red') AND contains(p_name, 'bolt') THEN 1 WHEN contains(p_name, 'ring') THEN 2 WHEN p_partkey = 7 THEN 3 WHEN starts_with(CAST(p_partkey AS VARCHAR), '19') THEN 4 END AS seq FROM part)"""


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("url_key"), match_text(F.col("p_name")).alias("words"))


@R.query(f"""WITH {_HITS_SQL} SELECT p_partkey, CASE WHEN seq = 3 THEN 'seventh' ELSE p_name END AS p_name, CASE WHEN seq = 1 THEN 'Brand#99' WHEN seq = 4 THEN 'Brand#1' ELSE p_brand END AS p_brand FROM h WHERE seq IS DISTINCT FROM 2""")
def q22_rule_override(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first matching rule patches or excludes."""
    return rules.apply_overrides(_parts(spark, sf_dir), values(spark, _RULE_SCHEMA, _RULES), "p_partkey", "words", "url_key", ("p_name", "p_brand"))[0].select("p_partkey", "p_name", "p_brand")


@R.query(f"""WITH {_HITS_SQL} SELECT p_partkey, CAST(seq AS INTEGER) AS seq, CASE WHEN seq = 2 THEN 'record' WHEN seq = 3 THEN 'p_name' ELSE 'p_brand' END AS field,
  CASE WHEN seq = 2 THEN '' WHEN seq = 3 THEN p_name ELSE p_brand END AS old_value, CASE seq WHEN 1 THEN 'Brand#99' WHEN 2 THEN '' WHEN 3 THEN 'seventh' ELSE 'Brand#1' END AS new_value
FROM h WHERE seq IS NOT NULL AND NOT (seq = 4 AND p_brand = 'Brand#1') AND NOT (seq = 1 AND p_brand = 'Brand#99')""")
def q22b_override_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each change."""
    audit = rules.apply_overrides(_parts(spark, sf_dir), values(spark, _RULE_SCHEMA, _RULES), "p_partkey", "words", "url_key", ("p_name", "p_brand"))[1]
    return audit.select("p_partkey", "seq", "field", "old_value", "new_value")


@R.query("""SELECT CAST(1 AS INTEGER) AS seq, count(*) FILTER (contains(p_name, 'red') AND contains(p_name, 'bolt')) AS matches, true AS as_expected FROM part
UNION ALL SELECT 2, count(*) FILTER (contains(p_name, 'ring')), true FROM part UNION ALL SELECT 3, count(*) FILTER (p_partkey = 7), count(*) FILTER (p_partkey = 7) = 1 FROM part
UNION ALL SELECT 4, count(*) FILTER (starts_with(CAST(p_partkey AS VARCHAR), '19')), true FROM part""")
def q22c_exactly_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that must match one row."""
    return rules.match_counts(_parts(spark, sf_dir), values(spark, _RULE_SCHEMA, _RULES), "p_partkey", "words", "url_key").drop("expected_matches")


@R.query("""SELECT n_name AS name, 'old' AS origin FROM nation WHERE n_nationkey < 20 UNION ALL SELECT n_name, 'new' FROM nation WHERE n_nationkey >= 20""")
def q22d_insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose key isn't there."""
    rows = table(spark, sf_dir, "nation")
    old = rows.where("n_nationkey < 20").select(F.col("n_name").alias("name"), F.lit("old").alias("origin"))
    return rules.insert_if_absent(old, rows.where("n_nationkey >= 15").select(F.col("n_name").alias("name"), F.lit("new").alias("origin")), "name")


@R.query("""WITH s AS (SELECT *, s_suppkey + 1400 AS k FROM supplier), a AS (SELECT s_suppkey, min(c_custkey) AS v FROM s JOIN customer ON c_custkey = k AND c_nationkey = s_nationkey GROUP BY s_suppkey HAVING count(*) = 1),
b AS (SELECT s_suppkey, min(c_custkey) AS v FROM s JOIN customer ON c_custkey = k GROUP BY s_suppkey HAVING count(*) = 1), c AS (SELECT s_suppkey, min(c_custkey) AS v FROM s JOIN customer ON c_nationkey = s_nationkey AND c_custkey % 25 = s_suppkey % 25 GROUP BY s_suppkey HAVING count(*) = 1)
SELECT s_suppkey, coalesce(a.v, b.v, c.v) AS c_custkey, CASE WHEN a.v IS NOT NULL THEN 1 WHEN b.v IS NOT NULL THEN 2 WHEN c.v IS NOT NULL THEN 3 END AS step FROM s LEFT JOIN a USING (s_suppkey) LEFT JOIN b USING (s_suppkey) LEFT JOIN c USING (s_suppkey)""")
def q22e_ladder_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first step of several equalities that finds one row; several are none."""
    left = table(spark, sf_dir, "supplier").withColumns({"k": F.col("s_suppkey") + 1400, "rest": F.col("s_suppkey") % 25})
    right = table(spark, sf_dir, "customer").withColumns({"id": F.col("c_custkey"), "rest": F.col("c_custkey") % 25})
    steps = [[("k", "id"), ("s_nationkey", "c_nationkey")], [("k", "id")], [("s_nationkey", "c_nationkey"), ("rest", "rest")]]
    return rules.ladder_join(left, right, "s_suppkey", steps, "c_custkey")


@R.query("""WITH l AS (SELECT conv_id, turn, role, text, lead(text, 1) OVER w AS t1, lead(role, 1) OVER w AS r1, lead(text, 2) OVER w AS t2, lead(role, 2) OVER w AS r2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
SELECT conv_id, turn, CASE WHEN r1 = 'user' THEN NULL WHEN trim(coalesce(t1, '')) <> '' THEN t1 WHEN r2 = 'user' THEN NULL WHEN trim(coalesce(t2, '')) <> '' THEN t2 END AS value FROM l WHERE role = 'user'""")
def q34_value_after_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line after a label, unless that is one."""
    rows = table(spark, sf_dir, "conversations")
    return ordered.value_after_label(rows, "conv_id", "turn", "text", F.col("role") == "user", reach=2).select("conv_id", "turn", "value")


@R.query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def q35_json_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first key of a payload that is present."""
    from rillstone.sources.readers import payload_value

    return table(spark, sf_dir, "events").select("event_id", payload_value(F.col("props"), "missing", "k").try_cast("long").alias("k"))


@R.query("""SELECT c_custkey, c_mktsegment, 'kept' AS origin FROM customer WHERE c_mktsegment <> 'BUILDING' UNION ALL SELECT s_suppkey, 'BUILDING', 'staged' FROM supplier""")
def q39_union_replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source's rows are replaced by staged ones."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.lit("kept").alias("origin"))
    staged = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.lit("BUILDING").alias("c_mktsegment"), F.lit("staged").alias("origin"))
    return ingest.replace_source(rows, staged, "c_mktsegment", "BUILDING")


@R.query("""SELECT k, CASE WHEN a AND b THEN 'both' WHEN a THEN 'old' ELSE 'new' END AS side FROM (SELECT coalesce(x.k, y.k) AS k, x.k IS NOT NULL AS a, y.k IS NOT NULL AS b
FROM (SELECT DISTINCT user_id AS k FROM events WHERE event_type = 'signup') x FULL JOIN (SELECT DISTINCT user_id AS k FROM events WHERE event_type = 'error') y ON x.k = y.k)""")
def q39b_key_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of one side, of the other, and of both."""
    rows = table(spark, sf_dir, "events")
    old, new = (rows.where(F.col("event_type") == e).select(F.col("user_id").alias("k")) for e in ("signup", "error"))
    side = lambda df, name: df.withColumn("side", F.lit(name))
    return side(old.intersect(new), "both").unionByName(side(old.subtract(new), "old")).unionByName(side(new.subtract(old), "new"))


@R.query("SELECT DISTINCT c_mktsegment AS value, 'segment' AS filter FROM customer UNION ALL SELECT DISTINCT o_orderstatus, 'status' FROM orders")
def q39c_filter_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U4: the values that a filter offers."""
    segments = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("value")).distinct().withColumn("filter", F.lit("segment"))
    return segments.unionByName(table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("value")).distinct().withColumn("filter", F.lit("status")))


@R.query("SELECT r_regionkey AS id, r_name AS name, NULL::INTEGER AS region FROM region UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation")
def q39d_union_of_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A union with the columns of both."""
    regions = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return regions.unionByName(table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")), allowMissingColumns=True)


_SNIFF = [("12/03/2025", "2025-03-12", 1), ("2025-01-09", "2025-01-09", 1), ("31-12-2024", "2024-12-31", 0), ("soon", None, 1), ("", None, 1)]


@R.query(f"SELECT raw, CAST(iso AS DATE) AS date, kept = 1 AS kept FROM {sql_values('raw, iso, kept', _SNIFF)}")
def q08b_recency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not before a cutoff; without a date, kept."""
    from rillstone.functions.dates import parse_date, recent

    date = parse_date(F.col("raw"))
    return values(spark, "raw string", [(r,) for r, _, _ in _SNIFF]).select("raw", date.alias("date"), recent(date, F.lit("2025-01-01").cast("date"), True).alias("kept"))


QUERIES, ORACLES = R.queries, R.oracles

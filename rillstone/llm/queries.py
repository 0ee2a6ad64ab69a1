"""The queries opN_<name>: each applies its operator to a whole table of the test data.

QUERIES and ORACLES are what ``__spark_entry__.py`` adds to its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, language_id, mixing, near_dedup, personal_data, quality_rules, secrets, token_counts, url_filter, warc
from .common import table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.personal_data(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_path())


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame([(u,) for u in url_filter.LISTED], "url string")
    return url_filter.judge(table(spark, sf_dir, "pages"), listed)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.findings(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_language_id": op2_language_id,
    "op3_personal_data": op3_personal_data,
    "op4_warc": op4_warc,
    "op5_mixing": op5_mixing,
    "op6_token_counts": op6_token_counts,
    "op7_quality_rules": op7_quality_rules,
    "op8_url_filter": op8_url_filter,
    "op9_decontamination": op9_decontamination,
    "op10_secret_scans": op10_secret_scans,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9_SQL = rf"""
WITH d AS (SELECT doc_id, {_SQL_WORDS} AS words FROM documents),
b AS (SELECT item_id, {_SQL_WORDS} AS words FROM benchmark),
iw AS (
  SELECT DISTINCT item_id, least(13, len(words)) AS n, array_to_string(words[i:i + least(13, len(words)) - 1], ' ') AS w
  FROM (SELECT item_id, words, unnest(range(1, greatest(1, len(words) - 12) + 1)) AS i FROM b WHERE len(words) > 0)
),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, sizes WHERE len(words) >= n)
),
hits AS (SELECT doc_id, i, n, item_id FROM dw JOIN iw USING (n, w)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS line
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(line, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_SQL_SECRETS = {
    "assign": r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
}
_SQL_VALID = {"assign": f"length(regexp_extract(m, '{_SQL_SECRETS['assign']}', 2)) >= 6", "access": "length(m) >= 20", "hex": "length(m) >= 24"}


def sql_spans(table_name: str, patterns: dict[str, str]) -> str:
    """DuckDB SQL of the rows doc_id, kind, m (the match), a (its first code point): gaps and matches before it, summed."""
    each = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, regexp_extract_all(x, '{p}') AS ms, string_split_regex(x, '{p}') AS ps FROM {table_name}" for k, p in patterns.items())
    return f"""SELECT doc_id, kind, ms[k] AS m,
      CAST(list_sum(list_transform(ps[1:k], lambda p: length(p))) + coalesce(list_sum(list_transform(ms[1:k - 1], lambda p: length(p))), 0) AS BIGINT) AS a
    FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS k FROM ({each}) WHERE len(ms) > 0)"""


OP10_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
s AS ({sql_spans("t", _SQL_SECRETS)}),
v AS (SELECT *, list_position(['assign', 'access', 'hex'], kind) AS o FROM s
  WHERE CASE kind {" ".join(f"WHEN '{k}' THEN {c}" for k, c in _SQL_VALID.items())} END),
g AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  string_agg(kind || ':' || a || ':' || (a + length(m)), ',' ORDER BY a, o) AS line FROM v GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n_assign, 0) AS BIGINT) AS n_assign, CAST(coalesce(n_access, 0) AS BIGINT) AS n_access, CAST(coalesce(n_hex, 0) AS BIGINT) AS n_hex,
  sha256(coalesce(line, '')) AS base_sha256, coalesce(line, '') AS spans, sha256(x) AS blob
FROM t LEFT JOIN g USING (doc_id)
"""

OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    -ln((CAST('0x' || substr(md5(doc_id || ':mix-1'), 1, 13) AS BIGINT) + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
      / (4 - 3 * (length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) / greatest(length(coalesce(text, '')), 1))) AS key
  FROM documents
),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, [1, 2, 3][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source
),
o AS (
  SELECT *, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w, coalesce(sum(source_size) OVER p, 0) AS size_before, coalesce(sum(w) OVER p, 0) AS w_before
  FROM s WINDOW p AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
c AS (SELECT *, w * (total - 3 * size_before) > 3 * source_size * (all_w - w_before) AS capped FROM o),
g AS (
  SELECT source, source_size, CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
    ELSE CAST(w * (total - 3 * coalesce(sum(source_size) FILTER (capped) OVER (), 0)) AS DOUBLE) / CAST(sum(w) FILTER (NOT capped) OVER () AS DOUBLE) END AS target
  FROM c
),
r AS (
  SELECT d.*, source_size, target, coalesce(floor(target / nullif(CAST(source_size AS DOUBLE), 0)), 0) AS epochs,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN 2 * ahead + size <= 2 * (target - epochs * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken, source
FROM r
"""

def _canonical_entry(url: str) -> str:
    """host/path/ of a listed URL of the query, which has neither port nor dots to remove."""
    return url.rpartition("://")[2].rstrip("/") + "/"


OP8_SQL = rf"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^([^/?#]*)', 1) AS authority FROM u),
p AS (
  SELECT page_id, translate(authority, '{_UPPER}', '{_LOWER}') AS host, regexp_extract(substr(rest, length(authority) + 1), '^([^?#]*)', 1) AS path
  FROM h
),
rules(verdict, rule, h, p) AS (VALUES {", ".join(f"('{v}', '{h}{q}', '{h}', '{q}')" for v, h, q in url_filter.RULES)}),
fits AS (
  SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM p JOIN rules r ON (host = r.h OR ends_with(host, '.' || r.h)) AND starts_with(path, r.p) GROUP BY page_id
),
entries(e) AS (VALUES {", ".join(f"('{_canonical_entry(u)}')" for u in url_filter.LISTED)}),
k AS (
  SELECT *, rtrim(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS ch,
    regexp_replace(regexp_replace(regexp_replace(path, '/(\./)+', '/', 'g'), '/{{2,}}', '/', 'g'), '/(index\.html?)?$', '') AS cp
  FROM p
),
covered AS (
  SELECT page_id, arg_max(e, struct_pack(a := length(e), b := e)) AS listed
  FROM k JOIN entries ON (ch = split_part(e, '/', 1) OR ends_with(ch, '.' || split_part(e, '/', 1))) AND starts_with(cp || '/', substr(e, instr(e, '/')))
  GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN listed IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict, listed
FROM p LEFT JOIN fits USING (page_id) LEFT JOIN covered USING (page_id)
"""

OP4_SQL = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS x FROM pages),
d AS (SELECT page_id, trim(regexp_replace(url, '\\s+', ' ', 'g')) AS url, strlen(x) AS n, sha1(x) AS hex, max(page_id) OVER (PARTITION BY sha1(x)) AS last FROM p),
b AS (SELECT *, list_transform(range(0, 40), lambda i: instr('0123456789abcdef', substr(hex, CAST(i AS BIGINT) + 1, 1)) - 1) AS h FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
    list_sum(list_transform(range(0, 5), lambda j: ((h[(5 * k + j) // 4 + 1] >> (3 - (5 * k + j) % 4)) & 1) << (4 - j))) AS BIGINT) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> last THEN last END AS refers_to, url
FROM b
"""

OP1_SQL = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)
),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
e AS MATERIALIZED (
  SELECT i.a, i.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS k FROM s p JOIN s q ON p.x = q.x AND p.doc_id <> q.doc_id GROUP BY ALL) i
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)
),
r AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT r.node, e.b FROM r JOIN e ON r.seen = e.a),
c AS (SELECT node, min(seen) AS component FROM r GROUP BY node)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(component, doc_id) AS component_id, coalesce(component, doc_id) = doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c ON node = doc_id
"""

ORACLES = {
    "op1_near_dedup": OP1_SQL,
    "op4_warc": OP4_SQL,
    "op5_mixing": OP5_SQL,
    "op8_url_filter": OP8_SQL,
    "op9_decontamination": OP9_SQL,
    "op10_secret_scans": OP10_SQL,
}

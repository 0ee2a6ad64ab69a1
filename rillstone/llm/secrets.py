"""Secret scans over an incremental ledger of blobs.

Every version of a file is a path (here doc_id) and a text. Texts are content
addressed: their SHA-256 is the blob. Only pairs of a blob and a rule version
that the ledger doesn't hold yet are scanned, each once, however many paths
show the blob; findings are joined back to all paths.

Nulls count as the empty text, which has no findings. Repeated rows share a
blob and get equal findings. Rows of one id with different texts are versions
of a path, each with findings of its own; rows with a null id are paths
without a name, scanned like the others. Extra columns are ignored by
:func:`findings` and kept by :func:`redact`. Case in the keyword of an assignment is that of
ASCII letters alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BROADCAST_ROWS, arrow_rows, materialize, null_text, restrict, scratch

#: The rules by kind, in the order of equal starts.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
#: A run of hexadecimal digits, as long as it is; runs of under 24 fail.
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
ASSIGN_MIN, ACCESS_MIN = 6, 20
#: A keyword in lower case must be in the text before ASSIGN is tried.
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Findings are kept by this version; a change of the rules needs a new one.
RULES_VERSION = "1"

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()
LEDGER = T.StructType([
    T.StructField("blob", T.StringType()),
    T.StructField("rules_version", T.StringType()),
    *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
    T.StructField("base_sha256", T.StringType()),
    T.StructField("spans", T.StringType()),
])


def scan_text(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each finding, by start and then kind as listed."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_MIN]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def blobs(docs: DataFrame) -> DataFrame:
    """doc_id and blob of every version."""
    return docs.select("doc_id", F.sha2(null_text(F.col("text")), 256).alias("blob"))


def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER)


def _named(df: DataFrame, blobs_: DataFrame, how: str) -> DataFrame:
    """df joined with materialized rows by blob; up to a checked number they are broadcast, so a blob that many paths share makes no large partition."""
    few = BROADCAST_ROWS // 4
    return df.join(F.broadcast(blobs_) if blobs_.limit(few + 1).count() <= few else blobs_, "blob", how)


def scan(docs: DataFrame, versions: DataFrame, ledger: DataFrame | None, rules_version: str) -> DataFrame:
    """Ledger rows, one a blob, of the blobs in versions that the ledger doesn't hold for this rule version.

    Of the paths of a blob, that with the smallest id is read. Without a
    ledger, most ids are the first of a blob: the others are left out before
    Python sees a text, by an anti join with ids. With one, few are: they are
    chosen by a semi join. Ids of several versions, and null ones, don't tell
    which version to read; those rows are hashed and chosen by blob.
    """
    spark = docs.sparkSession
    arrow_rows(spark)
    n = 4 * versions.count()  # rows with a hash are wide: four times as many files
    first = versions.groupBy("blob").agg(F.min("doc_id").alias("first"), F.count("*").alias("paths"))
    if ledger is not None:
        first = first.join(ledger.where(F.col("rules_version") == rules_version).select("blob").distinct(), "blob", "left_anti")
    unseen = materialize(first, "unseen", n)
    several = materialize(versions.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "several-versions", n)
    repeated = several.limit(1).count() > 0
    docs = docs.select("doc_id", "text")
    named = docs.where("doc_id is not null")
    if ledger is None:
        again = materialize(unseen.where("paths > 1").select("blob", "first"), "again", n)
        left_out = _named(versions, again, "inner").where("doc_id <> first").select("doc_id").distinct()
        left_out = left_out.unionByName(several).distinct() if repeated else left_out
        texts = restrict(named, materialize(left_out, "left-out", n), "doc_id", False)
    else:
        wanted = unseen.where("first is not null").select(F.col("first").alias("doc_id")).distinct()
        wanted = wanted.join(several, "doc_id", "left_anti") if repeated else wanted
        texts = restrict(named, materialize(wanted, "wanted", n), "doc_id", True)
    unsure = docs.where("doc_id is null")
    if repeated:
        unsure = unsure.unionByName(restrict(named, several, "doc_id", True))
    hashed = unsure.withColumn("blob", F.sha2(null_text(F.col("text")), 256))
    # of what these rows show, the blobs whose first path isn't read already
    sure = unseen.where("first is not null").select("blob", F.col("first").alias("doc_id"))
    sure = sure.join(several, "doc_id", "left_anti") if repeated else sure
    open_blobs = materialize(unseen.select("blob").join(sure.select("blob"), "blob", "left_anti"), "open-blobs", n)
    parts = [texts.select("text")]
    if open_blobs.limit(1).count():
        parts.append(_named(hashed, open_blobs, "left_semi").dropDuplicates(["blob"]).select("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                found = scan_text(text or "")
                line = ",".join(f"{k}:{a}:{b}" for k, a, b in found)
                rows.append((hashlib.sha256((text or "").encode()).hexdigest(), rules_version, *(sum(f[0] == k for f in found) for k in KINDS), hashlib.sha256(line.encode()).hexdigest(), line))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if isinstance(f.dataType, T.LongType) else pa.string()) for i, f in enumerate(LEDGER)], LEDGER.names)

    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.mapInArrow(run, LEDGER)


def update_ledger(docs: DataFrame, ledger: DataFrame | None = None, rules_version: str = RULES_VERSION) -> tuple[DataFrame, DataFrame]:
    """The paths with their blobs, and the ledger with what was unseen. Both are materialized for this application; :func:`scan_into` keeps a ledger for later ones."""
    with scratch() as keep:
        versions = keep(materialize(blobs(docs), "versions"))
        fresh = keep(materialize(scan(docs, versions, ledger, rules_version), "ledger"))
    return versions, fresh if ledger is None else ledger.unionByName(fresh)


def read_ledger(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger stored at path; null if none is."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder)
    return spark.read.schema(LEDGER).parquet(path) if there else None


def scan_into(docs: DataFrame, path: str, rules_version: str = RULES_VERSION) -> DataFrame:
    """Scan what the ledger stored at path hasn't seen, append it there, and return the findings of every path.

    The appended rows are committed at once, so a run that fails leaves the
    ledger as it was, and the next one scans the same blobs again. One run at
    a time may write to a ledger.
    """
    ledger = read_ledger(docs.sparkSession, path)
    versions, full = update_ledger(docs, ledger, rules_version)
    fresh = full if ledger is None else full.join(ledger.where(F.col("rules_version") == rules_version).select("blob"), "blob", "left_anti").where(F.col("rules_version") == rules_version).select(*LEDGER.names)
    fresh = materialize(fresh, "fresh-ledger")
    fresh.write.mode("append").parquet(path)
    return _joined(versions, read_ledger(docs.sparkSession, path), rules_version)


def _joined(versions: DataFrame, ledger: DataFrame, rules_version: str) -> DataFrame:
    """Findings of every path. Few blobs have any, and the join is with those alone."""
    found = ledger.where((F.col("rules_version") == rules_version) & (F.col("spans") != "")).drop("rules_version").dropDuplicates(["blob"])
    joined = _named(versions, materialize(found, "blobs-with-findings"), "left")
    return joined.select(
        "doc_id",
        *(F.coalesce(f"n_{k}", F.lit(0)).cast("long").alias(f"n_{k}") for k in KINDS),
        F.coalesce("base_sha256", F.lit(EMPTY_SHA256)).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
        "blob",
    )


def findings(docs: DataFrame, ledger: DataFrame | None = None, rules_version: str = RULES_VERSION) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans and blob of every path."""
    return _joined(*update_ledger(docs, ledger, rules_version), rules_version)


def cut(text: str, spans: str) -> str:
    """The text with each span, merged where they overlap, replaced by [SECRET]."""
    out, at = [], 0
    merged: list[list[int]] = []
    for start, end in sorted(tuple(map(int, s.split(":")[1:])) for s in spans.split(",")):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    for start, end in merged:
        out += [text[at:start], "[SECRET]"]
        at = end
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, ledger: DataFrame | None = None, rules_version: str = RULES_VERSION) -> DataFrame:
    """The documents with all their columns; in their texts, findings are replaced by [SECRET].

    Texts without a finding stay in their partitions: only ids and spans of
    those with one are joined, by broadcast where their number allows it.
    """
    spark = docs.sparkSession
    with scratch() as keep:
        found = keep(materialize(findings(docs, ledger, rules_version).where("spans <> ''").select("doc_id", F.col("blob").alias("__blob"), F.col("spans").alias("__spans")), "found"))
    spans = found.select("__blob", "__spans").dropDuplicates(["__blob"])
    blob = F.sha2(null_text(F.col("text")), 256)
    if found.limit(BROADCAST_ROWS // 10 + 1).count() <= BROADCAST_ROWS // 10:
        # the texts of paths without findings aren't hashed again
        ids = found.select(F.col("doc_id").alias("__id")).where("__id is not null").distinct().withColumn("__has", F.lit(True))
        marked = docs.join(F.broadcast(ids), F.col("doc_id") == F.col("__id"), "left")
        marked = marked.withColumn("__blob", F.when(F.col("__has") | F.col("doc_id").isNull(), blob)).drop("__id", "__has").join(F.broadcast(spans), "__blob", "left")
    else:
        marked = docs.withColumn("__blob", blob).join(spans, "__blob", "left")
    arrow_rows(spark)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            spans = batch.column("__spans").to_pylist()
            column = batch.column("text")
            if any(spans):
                column = pa.array([cut(t, s) if s else t for t, s in zip(column.to_pylist(), spans, strict=True)], column.type)
            names = [n for n in batch.schema.names if n != "__spans"]
            yield pa.RecordBatch.from_arrays([column if n == "text" and i == at else batch.column(i) for i, n in enumerate(batch.schema.names) if n != "__spans"], names)

    return marked.drop("__blob").mapInArrow(replace, docs.schema)

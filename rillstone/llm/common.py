"""Helpers that the operators of this package share.

Intermediate tables go to the folder that the cluster names in
``spark.checkpoint.dir``; it is shared by the driver and the executors, so a
lost executor costs only a re-read.
"""

from __future__ import annotations

import atexit
import contextlib
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.shipping import ship

#: Space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
#: The same characters as a Java character class.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_REGEX = r"[^\x20\x09-\x0D]+"

#: Rows of a batch handed to Python: with it, 500 very long texts must fit at once.
ARROW_ROWS = 500
#: A set of ids is broadcast up to so many rows (24 bytes each, 48 MB hashed).
BROADCAST_ROWS = 2_000_000
#: Rows of a file of a table whose size is known.
ROWS_PER_FILE = 500_000

_written: list[tuple[SparkSession, str]] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the test data, by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables, which spark.checkpoint.dir names; without one, in local mode alone, Spark's own folder serves.

    On a cluster, a folder of one machine would hide what the others write, so there the setting must be there.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if not named:
        own = spark.sparkContext._jsc.sc().getCheckpointDir()
        named = own.get() if own.isDefined() else ""
    if not named:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        named = f"file://{tempfile.mkdtemp(prefix='rillstone-')}"
        spark.sparkContext.setCheckpointDir(named)
    return f"{named.rstrip('/')}/rillstone-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder; it is deleted when the driver ends, or by release()."""
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex[:12]}-{name}"
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    return path


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store it lies."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _clean() -> None:
    while _written:
        with contextlib.suppress(Exception):  # the session may have ended before
            delete_path(*_written.pop())


def release(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing reads any more: what was made of them is written. Other DataFrames are left alone."""
    for df in tables:
        path = getattr(df, "_rillstone_path", None)
        found = [x for x in _written if x[1] == path]
        for x in found:
            _written.remove(x)
            delete_path(*x)


@contextlib.contextmanager
def scratch():
    """Tables that are materialized inside are deleted at the end, but for those handed to what this yields."""
    before, kept = {path for _, path in _written}, []
    yield lambda df: kept.append(df) or df
    stay = {getattr(df, "_rillstone_path", None) for df in kept}
    for spark, path in [x for x in _written if x[1] not in before and x[1] not in stay]:
        _written.remove((spark, path))
        delete_path(spark, path)


def materialize(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends here, and the size is known from then on.

    rows, a number that df's rows are known not to exceed, makes as many files
    as that needs; a small table isn't left in a file per task.
    """
    spark = df.sparkSession
    if rows is not None:
        df = df.repartition(rows // ROWS_PER_FILE + 1)
    path = new_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._rillstone_path = path
    return out


def arrow_rows(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Before Python runs on executors: they get this package, and batches of bounded size, as long texts make those of the default too large."""
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def restrict(df: DataFrame, ids: DataFrame, key: str, keep: bool) -> DataFrame:
    """Rows of df whose key is (keep) or is not in ids, which must be materialized and distinct.

    Up to BROADCAST_ROWS ids are broadcast, so df isn't shuffled; beyond that
    both sides are shuffled by the key, and ids alone are hashed.
    """
    how = "left_semi" if keep else "left_anti"
    if ids.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(ids), key, how)
    return df.join(ids.hint("shuffle_hash"), key, how)


def null_text(c) -> F.col:
    """Null counts as the empty text."""
    return F.coalesce(c, F.lit(""))

"""Where lineage ends: tables in the folder that the cluster names, so a lost executor costs a re-read."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def _with_folder(spark: SparkSession) -> str:
    """The checkpoint folder: that of spark.checkpoint.dir; where it is unset, in local mode alone, one of this machine."""
    context = spark.sparkContext
    own = context._jsc.sc().getCheckpointDir()
    if own.isDefined():
        return own.get()
    named = context.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if not named:
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        import tempfile

        named = f"file://{tempfile.mkdtemp(prefix='rillstone-')}"
    context.setCheckpointDir(named)
    return context._jsc.sc().getCheckpointDir().get()


def settle(df: DataFrame) -> DataFrame:
    """df as a reliable checkpoint: computed once, however often it is read."""
    _with_folder(df.sparkSession)
    return df.checkpoint()


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, where nothing is yet."""
    return f"{_with_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

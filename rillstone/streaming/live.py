"""Structured Streaming over the change log: an extension; the batch operators do the work."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillstone.operators.ingest import upsert_latest
from rillstone.sources.sinks import current_version, versions, write_version


def landed(spark: SparkSession, path: str, schema, max_files: int = 100) -> DataFrame:
    """A stream of the parquet files of a landing directory."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).parquet(path)


def first_seen(stream: DataFrame, key: list[str], ts: str, delay: str = "1 day") -> DataFrame:
    """Of each key the first event; state is forgotten once the watermark has passed it."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, ts: str, by: str, value: str, length: str = "1 day", slide: str | None = None, delay: str = "1 day") -> DataFrame:
    """Events and sums in windows; late events within the delay count."""
    window = F.window(ts, length, slide) if slide else F.window(ts, length)
    return stream.withWatermark(ts, delay).groupBy(window.alias("w"), by).agg(F.count("*").alias("events"), F.round(F.sum(value), 2).alias("total")).select("w.start", "w.end", by, "events", "total")


def sessions(stream: DataFrame, ts: str, by: str, gap: str = "30 minutes", delay: str = "1 day") -> DataFrame:
    """Events of a user without a gap between them."""
    return stream.withWatermark(ts, delay).groupBy(F.session_window(ts, gap).alias("w"), by).agg(F.count("*").alias("events")).select("w.start", "w.end", by, "events")


def upsert_stream(stream: DataFrame, root: str, key: list[str], recency: str, checkpoint: str) -> StreamingQuery:
    """K2: the latest row of each key, kept as versions below root; a batch that is repeated writes its version anew or finds it complete."""

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        name = f"{number:012d}"
        found = versions(spark, root)
        if name in found:
            return
        table = upsert_latest(current_version(spark, root), batch, key, recency) if found else upsert_latest(batch.limit(0), batch, key, recency)
        write_version(table, root, name)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

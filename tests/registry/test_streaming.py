from pyspark.sql import functions as F

from rillstone.operators.ingest import upsert_latest
from rillstone.sources.sinks import current_version
from rillstone.streaming import live


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "user_id", "event_type", "ts", "value").withColumn("ts", F.col("ts").cast("timestamp"))
    for i in range(4):
        events.where(F.col("event_id") % 4 == i).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    stream = live.landed(spark, f"file://{tmp_path}/in", events.schema, max_files=1)
    key = ["user_id", "event_type"]
    live.upsert_stream(stream, f"file://{tmp_path}/out", key, "ts", f"file://{tmp_path}/ck").awaitTermination()
    want = upsert_latest(events.limit(0), events, key, "ts")
    assert sorted(map(tuple, current_version(spark, f"file://{tmp_path}/out").collect())) == sorted(map(tuple, want.collect()))


def test_windows_and_sessions(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events.coalesce(1).write.parquet(f"file://{tmp_path}/in")
    stream = live.landed(spark, f"file://{tmp_path}/in", events.schema)
    for name, df in (("w", live.windowed_counts(stream, "ts", "event_type", "value")), ("s", live.sessions(stream, "ts", "user_id", "1 day")), ("f", live.first_seen(stream, ["user_id"], "ts").select("user_id", "ts"))):
        q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
        q.awaitTermination()
    daily = {(r.start, r.event_type): r.events for r in spark.table("w").collect()}
    batch = events.groupBy(F.window("ts", "1 day").alias("w"), "event_type").count().select("w.start", "event_type", "count").collect()
    assert daily and all(daily[r.start, r.event_type] == r["count"] for r in batch if (r.start, r.event_type) in daily)
    assert spark.table("s").count() > 0
    assert spark.table("f").count() >= events.select("user_id").distinct().count()

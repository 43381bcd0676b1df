from pyspark.sql import functions as F

from lodestrata.operators import state
from lodestrata.streaming import events

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def _events(spark, n=60):
    return spark.range(n).select(F.col("id").alias("event_id"), F.timestamp_seconds(F.col("id") * 300 + 1704067200).alias("ts"), (F.col("id") % 3).alias("user_id"), F.when(F.col("id") % 4 == 0, "view").otherwise("error").alias("event_type"), F.col("id").cast("double").alias("value"))


def _run(spark, tmp_path, df, f, mode):
    df.coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "in"))
    q = f(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))).writeStream.format("memory").queryName("out").outputMode(mode).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    return {tuple(r) for r in spark.table("out").collect()}


def test_tumbling_stream_equals_batch(spark, tmp_path):
    df = _events(spark)
    want = {tuple(r) for r in events.tumbling(df, "1 hour").collect()}
    assert _run(spark, tmp_path, df, lambda s: events.tumbling(s, "1 hour"), "complete") == want


def test_dedup_stream(spark, tmp_path):
    df = _events(spark, 6).union(_events(spark, 6))
    assert len(_run(spark, tmp_path, df, lambda s: events.deduplicated(s, ["event_id"]).select("event_id"), "append")) == 6


def test_failure_states_stream_equals_batch(spark, tmp_path):
    df = _events(spark).select("user_id", "event_id", (F.col("event_type") == "error").alias("failed"))
    want = {(r["user_id"], r["event_id"], r["state"]) for r in state.failure_runs(df, "user_id", "event_id", "failed").collect()}
    got = _run(spark, tmp_path, df, events.failure_states, "append")
    assert {(u, e, s) for u, e, _, s in got} == want


def test_upserts_continue_from_the_checkpoint(spark, tmp_path):
    df = _events(spark)
    arg = (spark, str(tmp_path / "in"), df.schema, f"file://{tmp_path}/target", str(tmp_path / "ck"), "user_id", "event_id")
    df.where("event_id < 30").coalesce(1).write.parquet(str(tmp_path / "in"))
    events.upsert_available(*arg)
    df.where("event_id >= 30").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    events.upsert_available(*arg)
    events.upsert_available(*arg)
    at = (tmp_path / "target/_latest").read_text()
    got = spark.read.parquet(f"file://{tmp_path}/target/v{at}").orderBy("user_id").collect()
    assert [(r["user_id"], r["event_id"]) for r in got] == [(0, 57), (1, 58), (2, 59)]

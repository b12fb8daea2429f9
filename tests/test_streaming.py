"""Streams give what the batch forms give, and keep their state between runs of batches."""

import datetime as dt

from pyspark.sql import functions as F

from quillon.operators import ledger
from quillon.streaming import observe

SHAPE = "id long, key long, at long, status string, content long"
ROWS = [(1, 1, 1, "200", 5), (2, 1, 2, "404", None), (3, 2, 2, "error:x", None), (4, 1, 3, "202", 6), (5, 2, 4, "error:x", None), (6, 2, 5, "200", 1), (7, 1, 6, "429", None), (8, 1, 7, "200", 7)]


def test_changes_over_two_batches(spark, tmp_path):
    for k, part in enumerate((ROWS[:4], ROWS[4:])):
        spark.createDataFrame(part, SHAPE).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SHAPE).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = observe.stream_changes(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    got = sorted(map(tuple, spark.read.schema(observe.OUTPUT).parquet(f"{tmp_path}/out").collect()))
    want = sorted(map(tuple, ledger.observed_changes(spark.createDataFrame(ROWS, SHAPE)).select("id", "key", "class", "change").collect()))
    assert got == want and {r[3] for r in got} >= {"dark", "recovered", "throttled", "changed", "baselined"}


def test_deduplicated_and_hourly(spark, tmp_path):
    t = dt.datetime(2026, 1, 1, 10)
    rows = [("s", "h1", t, "a"), ("s", "h1", t + dt.timedelta(minutes=5), "a"), ("s", "h2", t, "b"), ("z", "h1", t + dt.timedelta(minutes=70), "a")]
    spark.createDataFrame(rows, "source string, content_hash string, fetched_at timestamp, event_type string").write.parquet(f"{tmp_path}/in")
    stream = lambda: spark.readStream.schema(spark.read.parquet(f"{tmp_path}/in").schema).parquet(f"{tmp_path}/in")
    once = observe.run_to_table(spark, observe.deduplicated(stream()), "once")
    assert once.groupBy("source", "content_hash").count().filter("count > 1").isEmpty() and once.count() == 3
    hours = observe.hourly(stream().withColumnRenamed("fetched_at", "ts"))
    query = hours.writeStream.format("memory").queryName("hours").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    got = sorted((r.start.hour, r.event_type, r.n) for r in spark.table("hours").select(F.col("window.start").alias("start"), "event_type", "n").collect())
    assert got == [(10, "a", 2), (10, "b", 1), (11, "a", 1)]

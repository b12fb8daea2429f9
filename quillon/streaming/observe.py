"""Observation changes over a stream: the batch rules with the state of each key kept between micro-batches."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quillon.operators.storage import shared_path

OUTPUT = "id long, key long, class string, change string"
STATE = "class string, flagged boolean, known long"


def classify(status: str | None) -> str:
    if status is None or not status.isdigit():
        return "transient"
    code = int(status)
    return "reachable" if 200 <= code < 400 else "throttled" if code == 429 else "unreachable"


def changes(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Rows of one key in order of time; state is (last class, flagged, last content)."""
    rows = pd.concat(list(batches)).sort_values(["at", "id"])
    prior, flagged, known = state.get if state.exists else (None, False, None)
    out = []
    for row in rows.itertuples(index=False):
        now, content = classify(row.status), None if pd.isna(row.content) else int(row.content)
        dark = (now, prior) in {("unreachable", "reachable"), ("transient", "transient")}
        if now == "throttled":
            change = "throttled"
        elif dark:
            change = "dark"
        elif now == "reachable" and flagged:
            change = "recovered"
        elif content is not None and known is not None and known != content:
            change = "changed"
        elif content is not None and known is None:
            change = "baselined"
        else:
            change = "none"
        flagged = dark or (flagged and now != "reachable")
        known, prior = (known if content is None else content), now
        out.append((row.id, key[0], now, change))
    state.update((prior, flagged, known))
    yield pd.DataFrame(out, columns=["id", "key", "class", "change"])


def stream_changes(observations: DataFrame) -> DataFrame:
    """The streaming form of ledger.observed_changes; late rows are taken in the order in which batches bring them."""
    return observations.groupBy("key").applyInPandasWithState(changes, OUTPUT, STATE, "append", GroupStateTimeout.NoTimeout)


def run_to_table(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """Process what is available now into a table in the shared folder, and read it."""
    path = shared_path(spark, name)
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", shared_path(spark, f"{name}-state")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def deduplicated(captures: DataFrame, delay: str = "1 day") -> DataFrame:
    """Captures (source, content_hash, fetched_at) once each; state is bounded by the watermark."""
    return captures.withWatermark("fetched_at", delay).dropDuplicatesWithinWatermark(["source", "content_hash"])


def hourly(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Tumbling counts by kind, with late rows dropped after the delay."""
    from pyspark.sql import functions as F

    return events.withWatermark("ts", delay).groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count("*").alias("n"))

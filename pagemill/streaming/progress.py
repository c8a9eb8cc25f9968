"""Progress of runs as a stream: validated events, counts in event-time windows, and the state of each page."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contracts import PROGRESS, VERSION, progress_error

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"
#: How late an event may come, and the width of a window.
LATE, WIDTH = "1 hour", "1 hour"


def payloads(events: DataFrame) -> DataFrame:
    """Events of the test table as progress payloads: a user is a page, a type a stage; errors lack their page."""
    fields = F.struct(
        F.lit(PROGRESS).alias("contract"), F.lit(VERSION).alias("contract_version"), F.lit("page_stage").alias("event"), F.when(F.col("event_type") == "error", "fail").otherwise("ok").alias("status"),
        F.col("event_type").alias("stage"), F.when(F.col("event_type") != "error", F.col("user_id") + 1).alias("page"), F.col("value").alias("seconds"),
    )
    return events.withColumn("payload", F.to_json(fields)).withColumn("error", progress_error(F.col("payload")))


def source(spark: SparkSession, path: str, schema: str = EVENT, *, files: int | None = None) -> DataFrame:
    """Parquet files of a folder as a stream.  A backlog comes in one micro-batch: files have no order of event time, and the
    watermark that some of them set would drop what others hold.  Give `files` a micro-batch where the order of rows does not matter."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(path)


def windowed(events: DataFrame) -> DataFrame:
    """Counts and seconds by window, stage and status; events later than LATE are left out, state is dropped behind the mark."""
    timed = events.withWatermark("ts", LATE) if events.isStreaming else events
    g = timed.groupBy(F.window("ts", WIDTH), "event_type", F.col("error").isNull().alias("valid")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("seconds"))
    return g.select(F.col("window.start").alias("start"), "event_type", "valid", "n", "seconds")


def page_state(events: DataFrame) -> DataFrame:
    """Running state of each page: events seen, failures, last stage.  One small state a page; updates leave as they come."""

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        seen, failed, last, at = state.get if state.exists else (0, 0, "", pd.Timestamp(0).value)
        for batch in batches:
            batch = batch.sort_values(["ts", "event_id"])
            seen, failed = seen + len(batch), failed + int((batch["event_type"] == "error").sum())
            if len(batch) and batch["ts"].iloc[-1].value >= at:
                last, at = batch["event_type"].iloc[-1], int(batch["ts"].iloc[-1].value)
        state.update((seen, failed, last, at))
        yield pd.DataFrame({"page": [key[0]], "seen": [seen], "failed": [failed], "last_stage": [last]})

    keyed = events.select(F.col("user_id").alias("page"), "event_id", "ts", "event_type")
    return keyed.groupBy("page").applyInPandasWithState(update, "page long, seen long, failed long, last_stage string", "seen long, failed long, last string, at long", "update", "NoTimeout")


def drain(stream: DataFrame, mode: str, checkpoint: str, out: str) -> DataFrame:
    """Run a stream over all that is there and return what its sink holds.  Each micro-batch is written under its number, so
    a batch that is run again overwrites itself: exactly once.  Events that came too late are counted, and an error."""

    def sink(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch_no={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(sink).start()
    query.awaitTermination()
    if lost := dropped(query):
        raise RuntimeError(f"{lost} groups of events came behind the watermark")
    return stream.sparkSession.read.parquet(out)


def dropped(query) -> int:
    """Rows that the operators with state left out because they came behind the watermark."""
    return sum(int(op.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for op in p["stateOperators"])

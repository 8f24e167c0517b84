"""Event-time operators on the live stream, under a watermark: de-duplication and hourly totals.

Both keep state only for what the watermark has not passed, whatever the stream has brought before. What arrives
behind the watermark is dropped by Spark and counted in the progress table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tillhouse.functions.contracts import LIVE_KEY
from tillhouse.functions.money import exact_sum
from tillhouse.sources.sinks import append

DELAY = "1 hour"
MOMENT, INSTANT = "transaction_time", "_instant"
EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"
# A message that is sent again is the same line of the same moment; a correction has a later one.
DELIVERY_KEY = (*LIVE_KEY, MOMENT)
PROGRESS = """run string, batch long, watermark string, input_rows long, late_rows long, state_rows long"""


def watermarked(lines: DataFrame, delay: str = DELAY) -> DataFrame:
    """Lines in event time. A line without a moment has no place there and is left out.

    Watermarks are instants; zone-less local time is read as if it were UTC, so no session zone moves or repeats an hour.
    """
    instant = F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, {EPOCH}, {MOMENT}))")
    return lines.where(F.col(MOMENT).isNotNull()).withColumn(INSTANT, instant).withWatermark(INSTANT, delay)


def deduplicated(lines: DataFrame, delay: str = DELAY, key: Sequence[str] = DELIVERY_KEY) -> DataFrame:
    """Each line once, however often its message is delivered; null key parts equal each other.

    A key is remembered for `delay` of event time after its line. A copy that comes later than that is behind the
    watermark itself, as the moment is part of the key, so it is dropped as well.
    """
    return watermarked(lines, delay).dropDuplicatesWithinWatermark(list(key)).drop(INSTANT)


def hourly(lines: DataFrame, delay: str = DELAY) -> DataFrame:
    """Lines, units and revenue by hour and store, each hour once: when the watermark has passed its end."""
    hour = F.window(INSTANT, "1 hour").alias("hour")
    totals = watermarked(lines, delay).groupBy(hour, "store_id").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"), exact_sum(F.col("final_amount")).alias("revenue"))
    start = F.expr(f"timestampadd(MICROSECOND, unix_micros(hour.start), {EPOCH})")
    return totals.select(start.alias("hour"), "store_id", "lines", "units", "revenue")


def run_to_folder(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived and what the watermark closes, each once over restarts; then stop."""
    return (stream.writeStream.format("parquet").outputMode("append").option("path", path)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def record_progress(query: StreamingQuery, path: str) -> None:
    """Append a row per micro-batch of a finished run: its watermark, rows in, rows too late, rows of state.

    Rows too late are counted where the state is kept: after de-duplication's projection, or per hour and store that
    a task has folded already.
    """
    spark: SparkSession = query.sparkSession if hasattr(query, "sparkSession") else SparkSession.getActiveSession()
    rows = [(str(query.runId), p["batchId"], p["eventTime"].get("watermark"), p["numInputRows"],
             sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"]),
             sum(s["numRowsTotal"] for s in p["stateOperators"])) for p in query.recentProgress]
    if rows:
        append(spark.createDataFrame(rows, PROGRESS), path)

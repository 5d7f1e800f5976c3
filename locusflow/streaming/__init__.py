"""Operators on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusflow.operators.hits import filter_hits, score_ratio


def ingest_hits(hits: DataFrame, queries: DataFrame, **limits) -> DataFrame:
    """New hits filtered and scored, without state: write in append mode."""
    return score_ratio(filter_hits(hits, queries, **limits))


def first_of_key(rows: DataFrame, keys: list[str], time: str | None = None, delay: str = "1 hour") -> DataFrame:
    """The first row of each key; with an event time, state goes once the watermark has passed."""
    if time is None:
        return rows.dropDuplicates(keys)
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def gap_sessions(events: DataFrame, key: str, time: str, gap: str, delay: str = "1 hour", min_events: int = 2) -> DataFrame:
    """Sessions of a key: events at most the gap apart; in append mode closed ones only."""
    grouped = events.withWatermark(time, delay).groupBy(key, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"), F.max(time).alias("last"))
    return grouped.filter(F.col("n") >= min_events).select(key, F.col("w.start").alias("begin"), "last", "n")


def drained(stream: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """All that a stream has to give now, as a table written to ``path`` (with its checkpoint beside it).

    In append mode the rows go to Parquet. In update mode every batch is written
    under its number, and the last row of a key is the one with the greatest.
    """
    spark = stream.sparkSession
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}-state").trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", path).start()
    else:
        query = writer.foreachBatch(lambda rows, number: rows.withColumn("batch", F.lit(number)).write.mode("append").parquet(path)).start()
    query.awaitTermination()
    kept = stream.schema if mode == "append" else stream.schema.add("batch", "long")
    return spark.read.schema(kept).parquet(path)


def running_limits(rows: DataFrame, key: str, score: str) -> DataFrame:
    """Count and extremes of each key, for update mode."""
    return rows.groupBy(key).agg(F.count("*").alias("n"), F.min(score).alias("lower"), F.max(score).alias("upper"))

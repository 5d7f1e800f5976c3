"""Stream results equal batch results."""

from pyspark.sql import functions as F

from locusflow import streaming

EVENTS = "/root/testdata/sf0.001"


def source(spark, tmp_path):
    """The events as a folder of files that a stream reads."""
    rows = spark.read.parquet(f"{EVENTS}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).orderBy("ts")
    path = str(tmp_path / "events")
    rows.repartition(3).write.parquet(path)
    return rows, spark.readStream.schema(rows.schema).parquet(path)


def drained(df, name, mode):
    stream = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    stream.awaitTermination(120)
    return df.sparkSession.sql(f"select * from {name}")


def test_running_limits(spark, tmp_path):
    rows, stream = source(spark, tmp_path)
    got = drained(streaming.running_limits(stream, "event_type", "value"), "limits", "complete")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, streaming.running_limits(rows, "event_type", "value").collect()))


def test_limits_in_update_mode(spark, tmp_path):
    rows, stream = source(spark, tmp_path)
    out = streaming.drained(streaming.running_limits(stream, "event_type", "value"), str(tmp_path / "out"), "update")
    last = out.groupBy("event_type").agg(F.max(F.struct("batch", "n", "lower", "upper")).alias("m")).select("event_type", "m.n", "m.lower", "m.upper")
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, streaming.running_limits(rows, "event_type", "value").collect()))


def test_first_of_key_within_the_watermark(spark, tmp_path):
    rows, stream = source(spark, tmp_path)
    got = streaming.drained(streaming.first_of_key(stream, ["user_id", "event_type"], "ts", "3650 days"), str(tmp_path / "out"))
    assert got.count() == rows.select("user_id", "event_type").distinct().count() and got.columns == rows.columns


def test_first_of_key(spark, tmp_path):
    rows, stream = source(spark, tmp_path)
    got = drained(streaming.first_of_key(stream, ["user_id", "event_type"]), "firsts", "append")
    assert got.count() == rows.select("user_id", "event_type").distinct().count()


def test_sessions_closed_by_the_watermark(spark, tmp_path):
    rows, stream = source(spark, tmp_path)
    got = drained(streaming.gap_sessions(stream, "user_id", "ts", "3 hours"), "sessions", "append")
    whole = rows.groupBy("user_id", F.session_window("ts", "3 hours").alias("w")).agg(F.count("*").alias("n"), F.max("ts").alias("last")).filter("n > 1")
    closed = {(r.user_id, r.begin, r.n) for r in got.collect()}
    every = {(r.user_id, r.begin, r.n) for r in whole.select("user_id", F.col("w.start").alias("begin"), "n").collect()}
    assert closed and closed <= every and len(closed) >= 0.9 * len(every)


def test_ingest(spark, tmp_path):
    hits = spark.createDataFrame([("h1", "q", 1e-9, 150.0, 1, 80, 10.0, None), ("h2", "q", 1e-9, 150.0, 1, 10, 10.0, None)], "hit_id string, query_id string, evalue double, bitscore double, sstart int, send int, pident double, bsr double")
    queries = spark.createDataFrame([("q", 100, 200.0)], "query_id string, length int, self_score double")
    hits.write.parquet(str(tmp_path / "hits"))
    stream = spark.readStream.schema(hits.schema).parquet(str(tmp_path / "hits"))
    got = drained(streaming.ingest_hits(stream, queries), "ingested", "append")
    assert [(r.hit_id, r.bsr) for r in got.collect()] == [("h1", 0.75)]

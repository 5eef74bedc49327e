"""Streams: replayed files against the batch results."""

import datetime as dt

from pyspark.sql import functions as F

from barloom.sources import tables
from barloom.streaming import start_ingest, weekly_bars_stream

SCHEMA = "ticker string, ts timestamp, open double, high double, low double, close double, volume bigint"


def land(spark, path, rows):
    df = spark.createDataFrame([(t, s, c, c, c, c, 1) for t, s, c in rows], SCHEMA.replace("ts timestamp", "ts string"))
    df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(path)


def run_weekly(spark, source, out, delay="21 days"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    q = (
        weekly_bars_stream(stream, delay)
        .writeStream.format("parquet")
        .option("checkpointLocation", out + "-state")
        .trigger(availableNow=True)
        .start(out)
    )
    q.awaitTermination()
    return {(r.ticker, r.week_start): r for r in spark.read.parquet(out).collect()}


def test_late_rows_count_until_the_week_is_closed(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    land(spark, source, [("A", "2024-01-02 10:00:00", 1.0), ("A", "2024-01-04 10:00:00", 3.0)])
    run_weekly(spark, source, out)
    land(spark, source, [("A", "2024-01-20 10:00:00", 9.0)])
    run_weekly(spark, source, out)
    # 18 days late, and a copy of a row that is already in: counted, and not counted twice.
    land(spark, source, [("A", "2024-01-03 10:00:00", 2.0), ("A", "2024-01-04 10:00:00", 3.0)])
    got = run_weekly(spark, source, out)
    assert got == {}
    land(spark, source, [("A", "2024-02-20 10:00:00", 5.0)])
    got = run_weekly(spark, source, out)
    # The first week is closed now: a row for it is dropped.
    land(spark, source, [("A", "2024-01-05 10:00:00", 99.0)])
    got = run_weekly(spark, source, out)
    week = got[("A", dt.date(2024, 1, 1))]
    assert (week.open, week.close, week.high, week.volume) == (1.0, 3.0, 3.0, 3)
    assert week.week_ending == dt.date(2024, 1, 4)
    assert set(got) == {("A", dt.date(2024, 1, 1)), ("A", dt.date(2024, 1, 15))}


def test_ingest_stream_equals_the_batch_reload(spark, tmp_path):
    landing, table, state = (str(tmp_path / n) for n in ("landing", "daily", "state"))
    names = "Symbol string, Date string, Open string, High string, Low string, Close string, `Adj Close` string, Volume string"

    def deliver(rows):
        df = spark.createDataFrame([(t, d, *[str(c)] * 5, "10") for t, d, c in rows], names)
        df.coalesce(1).write.mode("append").parquet(landing)
        schema = spark.read.parquet(landing).schema
        start_ingest(spark, landing, schema, table, state, files_per_batch=1).awaitTermination()

    deliver([("A", "2024-01-02", 1.0), ("A", "2024-01-31", 2.0), ("B", "2024-01-31", 3.0)])
    deliver([("A", "2024-01-31", 5.0), ("A", "2024-02-01", 6.0)])
    got = sorted((r.ticker, str(r.date), r.close) for r in tables.daily_prices(spark, table).collect())
    assert got == [("A", "2024-01-02", 1.0), ("A", "2024-01-31", 5.0), ("A", "2024-02-01", 6.0), ("B", "2024-01-31", 3.0)]
    # Nothing new has landed: nothing changes.
    schema = spark.read.parquet(landing).schema
    start_ingest(spark, landing, schema, table, state).awaitTermination()
    assert tables.daily_prices(spark, table).count() == 4


def test_streams_keep_their_state_on_disk(spark):
    from barloom.session import ROCKSDB, stream_session

    session = stream_session(spark)
    assert session.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") != ROCKSDB

import datetime as dt

from pyspark.sql import functions as F

from lotledger.streaming import service

START = dt.datetime(2024, 1, 1)


def rows(spark, seconds, folder=None):
    df = spark.createDataFrame([(START + dt.timedelta(seconds=s), "api") for s in seconds], "ts timestamp, source string")
    if folder:
        df.coalesce(1).write.mode("append").parquet(folder)
    return df


def stream(spark, folder, per_trigger=None):
    reader = spark.readStream.schema("ts timestamp, source string")
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return service.as_event_time(reader.parquet(folder))


def test_stream_equals_batch(spark, tmp_path):
    seconds = [i * 7 for i in range(300)]
    batch = rows(spark, seconds, str(tmp_path / "in"))
    live = service.run_available(service.rate(stream(spark, str(tmp_path / "in"))), "complete")
    still = service.rate(batch)
    assert live.count() == still.count() and live.exceptAll(still.select(*live.columns)).isEmpty()


def test_late_row_is_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    for part in ([0, 10], [4000], [4001], [5, 8000]):  # 5 arrives after the watermark passed it
        rows(spark, part, folder)
    windows = stream(spark, folder, 1).groupBy(F.window("ts", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    got = {r.w.start: r.n for r in service.run_available(windows, "append").collect()}
    assert got[START] == 2


def test_absence_alerts(spark, tmp_path):
    seconds = [0, 30, 3590, 3610, 3800, 7300]
    batch = rows(spark, seconds, str(tmp_path / "in"))
    got = sorted((r.alert_at - START).total_seconds() for r in service.absence_alerts(batch, "source").collect())
    assert got == [90, 3670, 3860, 7360]
    live = service.run_available(service.absence_alerts(stream(spark, str(tmp_path / "in")), "source"), "append")
    assert sorted((r.alert_at - START).total_seconds() for r in live.collect()) == [90, 3670, 3860]


def test_bucket_quantile(spark):
    df = spark.createDataFrame([(START, v) for v in [0.05] * 50 + [0.3] * 40 + [100.0] * 10], "ts timestamp, v double")
    out = service.windowed_quantile(df, "v", (0.1, 0.5, 1.0), width="1 hour", q=0.7).first()
    assert abs(out["quantile"] - 0.3) < 1e-9
    tail = service.windowed_quantile(df, "v", (0.1, 0.5, 1.0), width="1 hour", q=0.95).first()
    assert tail["quantile"] == 1.0


def test_mean_of_nothing_is_zero(spark):
    assert service.mean_value(spark.createDataFrame([], "v double"), "v").first()[0] == 0.0


def test_absence_alerts_match_every_gap(spark):
    import random

    rng = random.Random(1)
    seconds = sorted(rng.sample(range(20_000), 300))
    rows = [(s, "a") for s in seconds] + [(5, "b"), (65, "b"), (126, "b"), (None, "b"), (7, None)]
    events = spark.createDataFrame(rows, "s long, source string").selectExpr("timestamp_seconds(s) ts", "source")
    got = sorted((r["source"] or "", int(r["alert_at"].timestamp())) for r in service.absence_alerts(events, "source", quiet_s=60).collect())
    gaps = [("a", s + 60) for s, t in zip(seconds, [*seconds[1:], 10**9]) if t > s + 60]
    assert got == sorted(gaps + [("b", 125), ("b", 186), ("", 67)])


def test_a_silent_source_alerts_without_a_later_event(spark, tmp_path):
    import time

    path = str(tmp_path / "in")
    rows(spark, [0, 1, 2, 30, 31], path)
    alerts = service.live_absence_alerts(stream(spark, path), "source", quiet_s=5)
    running = alerts.writeStream.format("memory").queryName("alerts").outputMode("append").option(
        "checkpointLocation", str(tmp_path / "checkpoint")).trigger(processingTime="1 second").start()
    try:
        end = time.time() + 90
        while time.time() < end and spark.table("alerts").count() < 2:
            time.sleep(1)
        time.sleep(4)  # a silence is told once
        got = sorted((r.alert_at - START).total_seconds() for r in spark.table("alerts").collect())
    finally:
        running.stop()
    # the gap inside the batch, and the silence after the last event, with no event to follow
    assert got == [7, 36]

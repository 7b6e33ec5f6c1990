from pyspark.sql import functions as F

from siftmill.sources.readers import stream_folder
from siftmill.streaming import events as E

DATA = "/root/testdata/sf0.001"


def run(spark, df, name, mode="append"):
    q = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def folder(spark, tmp_path):
    df = spark.read.parquet(f"{DATA}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    df.orderBy("ts").coalesce(1).write.parquet(str(tmp_path / "in"))
    return df, ", ".join(f"{n} {t}" for n, t in df.dtypes), str(tmp_path / "in")


def test_hourly_stream_equals_batch(spark, tmp_path):
    df, schema, path = folder(spark, tmp_path)
    got = run(spark, E.hourly(stream_folder(spark, path, schema), watermark="0 seconds"), "hours")
    want = E.hourly(df)
    key = lambda d: {(str(r.hour), r.n, round(r.total, 4)) for r in d.collect()}
    assert key(got) <= key(want) and len(key(want)) - len(key(got)) <= 1  # the last hour is still open


def test_alert_stream_equals_batch(spark, tmp_path):
    df, schema, path = folder(spark, tmp_path)
    got = run(spark, E.alerts_stream(stream_folder(spark, path, schema), "event_type", "value > 50", 3600), "alerts_s")
    want = E.alerts(df, "event_type", "value > 50", 3600)
    key = lambda d: {(r.event_id, r.key, r.ts) for r in d.collect()}
    assert key(got) == key(want) and len(key(want)) > 10


def test_cooldown_restarts_when_it_fires(spark):
    rows = [(i, f"2024-01-01 00:{m:02d}:00", "k", 60.0) for i, m in enumerate((0, 5, 9, 10, 19, 20))]
    df = spark.createDataFrame(rows, "event_id long, ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r.event_id for r in E.alerts(df, "event_type", "value > 50", 600).collect()) == [0, 3, 5]
    assert E.alerts(df.limit(0), "event_type", "value > 50", 600).count() == 0


def test_sessions_and_breaker(spark):
    rows = [(1, "2024-01-01 00:00:00", 1, 90.0), (2, "2024-01-01 00:20:00", 1, 10.0), (3, "2024-01-01 02:00:00", 1, 90.0)]
    df = spark.createDataFrame(rows, "event_id long, ts string, user_id int, value double").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r.n for r in E.sessions(df, "user_id").collect()) == [1, 2]
    assert {(r.event_id, r.share) for r in E.breaker(df, "user_id", "value > 50", 3600, 0.5).collect()} == {(1, 1.0), (2, 0.5), (3, 1.0)}

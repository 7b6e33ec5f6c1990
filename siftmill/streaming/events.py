"""Time-aware operators on event tables and streams: the same transform serves both."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut


def hourly(df: DataFrame, ts: str = "ts", value: str = "value", watermark: str | None = None) -> DataFrame:
    """Tumbling hours: events, sum and mean. With a watermark it runs on a stream in append mode."""
    src = df.withWatermark(ts, watermark) if watermark else df
    g = src.groupBy(F.window(ts, "1 hour").alias("w")).agg(F.count("*").alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"))
    return g.select(F.col("w.start").alias("hour"), "n", "total", "mean")


def trailing(df: DataFrame, key: str, seconds: int, ts: str = "ts", value: str = "value", order: str = "event_id") -> DataFrame:
    """Per event: count and sum of its key over the last seconds, the event included."""
    w = Window.partitionBy(key).orderBy(F.unix_micros(F.col(ts).cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    return df.select(order, key, F.count("*").over(w).alias("n"), F.round(F.sum(value).over(w), 4).alias("total"))


def running_mean(df: DataFrame, key: str, ts: str = "ts", value: str = "value", order: str = "event_id") -> DataFrame:
    """Per event: how many of its key came so far, and their mean (null values do not count into it).

    The events are partitioned by ranges of key and time; sums run within a range and
    only the totals of the ranges are carried over, so a frequent key fills many tasks.
    """
    rows = df.select(order, key, ts, F.col(value).cast("double").alias("_v"))
    ranges = cut(rows.repartitionByRange(key, ts, order).withColumn("_r", F.spark_partition_id()))
    parts = ranges.groupBy(key, "_r").agg(F.count("*").alias("_n"), F.count("_v").alias("_c"), F.coalesce(F.sum("_v"), F.lit(0.0)).alias("_s"))
    past = Window.partitionBy(key).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(key, "_r", *[F.coalesce(F.sum(c).over(past), F.lit(0)).alias(f"{c}0") for c in ("_n", "_c", "_s")])
    w = Window.partitionBy(key, "_r").orderBy(ts, order).rowsBetween(Window.unboundedPreceding, 0)
    inside = ranges.withColumns({"_n": F.count("*").over(w), "_c": F.count("_v").over(w), "_s": F.coalesce(F.sum("_v").over(w), F.lit(0.0))})
    count = F.col("_c") + F.col("_c0")
    return inside.join(before, [key, "_r"]).select(order, key, (F.col("_n") + F.col("_n0")).alias("n"), F.round(F.when(count > 0, (F.col("_s") + F.col("_s0")) / count), 8).alias("mean"))


def paired(df: DataFrame, key: str, start: str, end: str, ts: str = "ts", order: str = "event_id", watermark: str | None = None) -> DataFrame:
    """(key, started, ended, seconds): every start with the first end of its key before the next start.

    A start without an end has null; an end without a start gives no row.
    """
    w = Window.partitionBy(key).orderBy(ts, order).rowsBetween(1, Window.unboundedFollowing)
    rows = df.filter(F.expr(f"({start}) or ({end})")).withColumn("_start", F.expr(start))
    rows = rows.withColumn("_next", F.first(F.when(F.col("_start"), F.col(ts)), ignorenulls=True).over(w)).withColumn("_end", F.first(F.when(~F.col("_start"), F.col(ts)), ignorenulls=True).over(w))
    ended = F.when(F.col("_next").isNull() | (F.col("_end") <= F.col("_next")), F.col("_end"))
    out = rows.filter("_start").select(order, key, F.col(ts).alias("started"), ended.alias("ended"))
    return out.withColumn("seconds", F.unix_seconds(F.col("ended").cast("timestamp")) - F.unix_seconds(F.col("started").cast("timestamp")))


def retained(df: DataFrame, as_of: str, days: int, ts: str = "ts") -> DataFrame:
    """Events not older than so many days at a given time."""
    return df.filter(F.col(ts) >= F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {days} days"))


def trailing_summary(df: DataFrame, group: str, as_of: str, hours: int, ts: str = "ts", value: str = "value") -> DataFrame:
    """Per group over the last hours before a given time: events, total, mean, greatest."""
    end = F.lit(as_of).cast("timestamp_ntz")
    recent = df.filter((F.col(ts) > end - F.expr(f"interval {hours} hours")) & (F.col(ts) <= end))
    return recent.groupBy(group).agg(F.count("*").alias("n"), F.round(F.sum(value), 4).alias("total"), F.round(F.avg(value), 4).alias("mean"), F.round(F.max(value), 4).alias("top"))


def hourly_rate(df: DataFrame, ts: str = "ts") -> DataFrame:
    """One row: events, hours from the first to the last, events an hour."""
    span = F.unix_seconds(F.max(ts).cast("timestamp")) - F.unix_seconds(F.min(ts).cast("timestamp"))
    return df.agg(F.count("*").alias("n"), F.round(span / 3600, 4).alias("hours"), F.round(F.when(span > 0, F.count("*") * 3600.0 / span).otherwise(0.0), 4).alias("per_hour"))


def sessions(df: DataFrame, key: str, gap: str = "30 minutes", ts: str = "ts", watermark: str | None = None) -> DataFrame:
    src = df.withWatermark(ts, watermark) if watermark else df
    g = src.groupBy(F.session_window(ts, gap).alias("w"), key).agg(F.count("*").alias("n"))
    return g.select(key, F.col("w.start").alias("begun"), F.col("w.end").alias("ended"), "n")


def breaker(df: DataFrame, key: str, failed: str, seconds: int, threshold: float, least: int = 1, ts: str = "ts", order: str = "event_id") -> DataFrame:
    """Per event: failure share of its key over the last seconds, and whether it opens the circuit."""
    w = Window.partitionBy(key).orderBy(F.unix_micros(F.col(ts).cast("timestamp"))).rangeBetween(-seconds * 1_000_000, 0)
    share = F.avg(F.expr(failed).cast("int")).over(w)
    return df.select(order, key, F.round(share, 6).alias("share"), ((share >= threshold) & (F.count("*").over(w) >= least)).alias("opened"))


def _fire(times: list[int], cooldown: int, last: int | None) -> tuple[list[bool], int | None]:
    out = []
    for t in times:
        hit = last is None or t - last >= cooldown
        out.append(hit)
        if hit:
            last = t
    return out, last


ALERT_SCHEMA = "event_id long, key string, ts long"


def alerts(df: DataFrame, key: str, condition: str, cooldown_s: int) -> DataFrame:
    """Alerts with a cooldown that restarts when one fires (batch).

    Rows are read in time order partition by partition, so a key of any size streams
    through a task with one number of state.
    """
    src = df.filter(condition).select(F.col("event_id"), F.col(key).cast("string").alias("key"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[str, int] = {}
        current = None
        for b in batches:
            keep = []
            for k, t in zip(b["key"], b["ts"]):
                if k != current:
                    last, current = {}, k
                hit, now = _fire([t], cooldown_s, last.get(k))
                last[k] = now
                keep.append(hit[0])
            yield b[pd.Series(keep, index=b.index)]

    return src.repartition("key").sortWithinPartitions("key", "ts", "event_id").mapInPandas(run, ALERT_SCHEMA)


def alerts_stream(df: DataFrame, key: str, condition: str, cooldown_s: int) -> DataFrame:
    """The same on a stream, with the last alert of each key as state."""
    src = df.filter(condition).select(F.col("event_id"), F.col(key).cast("string").alias("key"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"))

    def step(k, frames, state):
        last = state.get[0] if state.exists else None
        for b in frames:
            b = b.sort_values(["ts", "event_id"])
            hits, last = _fire(b["ts"].tolist(), cooldown_s, last)
            if last is not None:
                state.update((int(last),))
            yield b[pd.Series(hits, index=b.index)][["event_id", "key", "ts"]]

    return src.groupBy("key").applyInPandasWithState(step, ALERT_SCHEMA, "last long", "append", "NoTimeout")

"""Statistics of data quality: field statistics, coverage, percentiles, histograms, counters, indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null
from ..session import cut


def field_stats(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Per field: present, valid, invalid, missing, valid_rate in percent, from check structs (is_valid, normalized, reason)."""
    aggs = []
    for name, check in checks.items():
        aggs += [F.count_if(check["reason"] != "missing").alias(f"{name}#p"), F.count_if(check["is_valid"]).alias(f"{name}#v"), F.count("*").alias(f"{name}#n")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"`{n}#p`").alias("present"), F.col(f"`{n}#v`").alias("valid"), F.col(f"`{n}#n`").alias("total")) for n in checks])
    t = one.select(F.inline(rows))
    return t.select("field", "present", "valid", (F.col("present") - F.col("valid")).alias("invalid"), (F.col("total") - F.col("present")).alias("missing"), F.round(F.when(F.col("present") > 0, F.col("valid") / F.col("present") * 100).otherwise(0.0), 2).alias("valid_rate"))


def reason_histogram(df: DataFrame, check: Column) -> DataFrame:
    return df.select(check["reason"].alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row for each column: filled rows and their share in percent."""
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(blank_to_null(F.col(c).cast("string")).isNotNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("filled")) for c in columns])
    return one.select("_n", F.inline(rows)).select("field", "filled", F.round(F.when(F.col("_n") > 0, F.col("filled") / F.col("_n") * 100).otherwise(0.0), 2).alias("pct"))


def ranked(df: DataFrame, group: str | None, value: str) -> DataFrame:
    """(group, value, n, upto, total): the different values with their counts, and how many values lie up to each.

    Exact and spread: the values are partitioned by range, counted within their range, and
    only the totals of the ranges are summed across. Null and NaN values are left out.
    """
    g = F.col(group) if group else F.lit(0)
    counts = df.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(g.alias("g"), F.col(value).alias("v")).agg(F.count("*").alias("n"))
    ranges = cut(counts.repartitionByRange("g", "v").withColumn("r", F.spark_partition_id()))
    parts = ranges.groupBy("g", "r").agg(F.sum("n").alias("m"))
    over = Window.partitionBy("g").orderBy("r")
    parts = parts.withColumns({"before": F.sum("m").over(over) - F.col("m"), "total": F.sum("m").over(Window.partitionBy("g"))}).drop("m")
    inside = F.sum("n").over(Window.partitionBy("g", "r").orderBy("v"))
    return ranges.withColumn("inside", inside).join(parts, ["g", "r"]).select("g", "v", "n", (F.col("before") + F.col("inside")).alias("upto"), "total")


def at_rank(rank: Column) -> Column:
    """The value at a rank counted from 0, as an aggregate over `ranked` rows."""
    return F.min(F.when(F.col("upto") > rank, F.col("v")))


def linear(p: float) -> Column:
    """Linear percentile as an aggregate over `ranked` rows."""
    at = (F.col("total") - 1) * F.lit(float(p))
    low, high = at_rank(F.floor(at)), at_rank(F.ceil(at))
    part = F.max(at - F.floor(at))
    return low.cast("double") + (high - low).cast("double") * part


def percentiles(df: DataFrame, column: str, points: dict[str, float]) -> DataFrame:
    """Mean and linear percentiles."""
    rows = ranked(df, None, column)
    return rows.agg(F.round(F.sum(F.col("v") * F.col("n")) / F.sum("n"), 4).alias("mean"), *[F.round(linear(p), 4).alias(n) for n, p in points.items()])


def latency_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    rows = ranked(df, group, value)
    return rows.groupBy(F.col("g").alias(group)).agg(
        F.sum("n").alias("n"), F.round(F.min("v"), 3).alias("min_ms"), F.round(F.max("v"), 3).alias("max_ms"), F.round(F.sum(F.col("v") * F.col("n")) / F.sum("n"), 3).alias("avg_ms"),
        *[F.round(linear(p), 3).alias(f"p{int(p * 100)}_ms") for p in (0.5, 0.9, 0.99)],
    )


def index_percentile(df: DataFrame, group: str, value: str, p: int) -> DataFrame:
    """The value at position floor(n p / 100) of the sorted values (not interpolated)."""
    want = F.least(F.floor(F.col("total") * p / 100), F.col("total") - 1)
    return ranked(df, group, value).groupBy(F.col("g").alias(group)).agg(at_rank(want).alias("value"))


def buckets(score: Column, edges: list[tuple[float, str]], last: str) -> Column:
    out = F.when(score.isNull(), F.lit(None))
    for edge, name in edges:
        out = out.when(score < edge, name)
    return out.otherwise(last)


def histogram10(score: Column) -> Column:
    return F.least(F.lit(9), F.greatest(F.lit(0), F.floor(score / 10))).cast("int")


def weighted_mean(df: DataFrame, value: str, weight: str) -> DataFrame:
    return df.agg(F.round(F.sum(F.col(value) * F.col(weight)) / F.sum(weight), 6).alias("weighted_mean"))


def against_targets(df: DataFrame, targets: dict[str, float]) -> DataFrame:
    """A one-row frame of indicators against their targets, and whether all are met."""
    met = {n: F.coalesce(F.col(n) >= t, F.lit(False)) for n, t in targets.items()}
    return df.select(*[F.col(n) for n in targets], *[m.alias(f"{n}_met") for n, m in met.items()], reduce(lambda a, b: a & b, met.values()).alias("all_met"))


def frequent_words(df: DataFrame, column: str, share: float = 0.2) -> DataFrame:
    """Words that stand in at least max(1, share) of the texts."""
    words = df.filter(F.col(column).isNotNull()).select(F.explode(F.array_distinct(F.filter(F.split(F.lower(column), r"[^\p{L}]+"), lambda w: F.length(w) > 2))).alias("word"))
    n = df.filter(F.col(column).isNotNull()).count()
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= max(1, share * n))


def field_report(df: DataFrame, field: str, check: Column, raw: Column, order: str, most: int = 5) -> DataFrame:
    """(reason, n, examples): every reason a field is not valid for, with the first values in row order."""
    rows = df.select(check["reason"].alias("reason"), raw.alias("raw"), F.col(order).alias("_o")).filter("reason <> 'valid'")
    count = rows.groupBy("reason").agg(F.count("*").alias("n"))
    # The first rows of a reason are found as the least `most` of each partition before anything is gathered.
    first = rows.filter("raw is not null").withColumn("_p", F.spark_partition_id()).withColumn("_n", F.row_number().over(Window.partitionBy("reason", "_p").orderBy("_o"))).filter(F.col("_n") <= most)
    first = first.withColumn("_n", F.row_number().over(Window.partitionBy("reason").orderBy("_o"))).filter(F.col("_n") <= most).groupBy("reason").agg(F.transform(F.array_sort(F.collect_list(F.struct("_o", "raw"))), lambda x: x["raw"]).alias("examples"))
    return count.join(first, "reason", "left").select(F.lit(field).alias("field"), "reason", "n", "examples")


def full_buckets(df: DataFrame, score: str, edges: list[tuple[float, str]], last: str) -> DataFrame:
    """(bucket, n) of all buckets, 0 where none falls into one."""
    spark = df.sparkSession
    names = spark.createDataFrame([(n,) for _, n in edges] + [(last,)], "bucket string")
    n = df.filter(F.col(score).isNotNull()).groupBy(buckets(F.col(score), edges, last).alias("bucket")).agg(F.count("*").alias("n"))
    return names.join(n, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).alias("n"))


def flag_counts(df: DataFrame, flags: str, negative: list[str]) -> DataFrame:
    """(flag, n) of the negative flags, the commonest first."""
    return df.select(F.explode(flags).alias("flag")).filter(F.col("flag").isin(negative)).groupBy("flag").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "flag")


def extract_values(c: Column) -> Column:
    """Values of a text that may hold a JSON list, a JSON object or a `;` or `,` list; blanks and nan are none."""
    t = F.trim(c)
    listed = F.when(t.startswith("["), F.from_json(F.regexp_replace(t, "'", '"'), "array<string>")).when(t.startswith("{"), F.map_values(F.from_json(t, "map<string,string>")))
    items = F.coalesce(listed, F.split(F.regexp_replace(t, r"[\[\]]", ""), "[;,]"))
    return F.filter(F.transform(items, lambda x: F.regexp_replace(x, r"^[\s\x{a0}]+|[\s\x{a0}]+$", "")), lambda x: x.isNotNull() & (x != "") & ~F.lower(x).isin("nan", "none", "null"))


def precision(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """(field, present, pct, n_values, valid, precision): columns -> validator of one value of their lists (a lambda)."""
    aggs = []
    for c, ok in columns.items():
        v = extract_values(F.col(c))
        aggs += [F.count_if(F.size(v) > 0).alias(f"{c}#p"), F.sum(F.greatest(F.size(v), F.lit(0))).alias(f"{c}#n"), F.sum(F.greatest(F.size(F.filter(v, ok)), F.lit(0))).alias(f"{c}#v")]
    one = df.agg(F.count("*").alias("_n"), *aggs)
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"`{c}#p`").alias("present"), F.col(f"`{c}#n`").alias("n_values"), F.col(f"`{c}#v`").alias("valid")) for c in columns])
    share = lambda a, b: F.round(F.when(b > 0, a * 100.0 / b).otherwise(0.0), 2)
    return one.select("_n", F.inline(rows)).select("field", "present", share(F.col("present"), F.col("_n")).alias("pct"), "n_values", "valid", share(F.col("valid"), F.col("n_values")).alias("precision"))


def request_counters(df: DataFrame, group: str, failed: Column, value: str) -> DataFrame:
    """(group, requests, errors, error_rate, total) with rates in percent."""
    n, bad = F.count("*"), F.count_if(failed)
    return df.groupBy(group).agg(n.alias("requests"), bad.alias("errors"), F.round(bad * 100.0 / n, 4).alias("error_rate"), F.round(F.sum(value), 4).alias("total"))


def greatest_in_json(df: DataFrame, json: str, key: str) -> DataFrame:
    """(key, top): the greatest number under every key that matches, at any depth of the JSON texts."""
    pair = rf'"({key})"\s*:\s*(-?\d+(?:\.\d+)?)'
    keys, values = F.regexp_extract_all(json, F.lit(pair), F.lit(1)), F.regexp_extract_all(json, F.lit(pair), F.lit(2))
    return df.select(F.explode(F.arrays_zip(keys.alias("key"), values.alias("value"))).alias("x")).groupBy("x.key").agg(F.max(F.col("x.value").cast("double")).alias("top"))

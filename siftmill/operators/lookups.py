"""Lookup joins: by a first and a second key, with defaults, one to many, and by several keys in turn."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup_in_turn(base: DataFrame, right: DataFrame, keys: list[tuple[str, str]], take: list[str]) -> DataFrame:
    """Columns of the right row that the first key finds, else the next key, and so on.

    keys: (column of base, column of right). A right row is taken whole: its columns are
    never mixed with those of another. Of several right rows of one key the least (in the
    order of the taken columns) stands. Null keys find nothing; rows without any match
    keep nulls.
    """
    out = base
    for i, (left, key) in enumerate(keys):
        one = right.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"_k{i}")).agg(F.min(F.struct(*take)).alias(f"_r{i}"))
        out = out.join(one, F.col(left) == F.col(f"_k{i}"), "left").drop(f"_k{i}")
    row = F.coalesce(*[F.col(f"_r{i}") for i in range(len(keys))])
    return out.select(*base.columns, *[row[c].alias(c) for c in take])


def lookup_or(base: DataFrame, right: DataFrame, key: str, defaults: dict[str, object]) -> DataFrame:
    """Left join on a key that is unique on the right; columns of rows without match get their defaults."""
    hit = right.select(key, *defaults, F.lit(True).alias("_hit"))
    joined = base.join(hit, key, "left")
    fill = {c: F.when(F.col("_hit"), F.col(c)).otherwise(F.lit(v)) for c, v in defaults.items()}
    return joined.select(*base.columns, *[v.alias(c) for c, v in fill.items()])


def first_joined(right: DataFrame, key: str, value: str, order: list[str], most: int, sep: str = "; ") -> DataFrame:
    """(key, value): the first `most` different values of a key, joined, in the order given.

    Values are made distinct before they are gathered, and only the first ranks are
    gathered, so a frequent key never collects its group.
    """
    from pyspark.sql import Window

    once = right.filter(F.col(value).isNotNull() & F.col(key).isNotNull()).groupBy(key, value).agg(F.min(F.struct(*order)).alias("_o"))
    ranked = once.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy("_o", value))).filter(F.col("_n") <= most)
    rows = ranked.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_n", value))).alias("_l"))
    return rows.select(key, F.array_join(F.transform("_l", lambda x: x[value]), sep).alias(value))


def first_key(columns: list[str]) -> Column:
    """`column:value` of the first column that is filled, or null."""
    return F.coalesce(*[F.when(F.trim(F.col(c).cast("string")) != "", F.concat(F.lit(f"{c}:"), F.trim(F.col(c).cast("string")))) for c in columns])


def needs(df: DataFrame, columns: list[str]) -> Column:
    """True where none of the columns that exist is filled."""
    have = [c for c in columns if c in df.columns]
    return ~reduce(lambda a, b: a | b, [F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False)) for c in have], F.lit(False))

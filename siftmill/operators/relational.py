"""Filters, joins, dedup, set operations, top-k on data frames."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from ..functions.text import blank_to_null


def pick_first(df: DataFrame, names: Iterable[str]) -> str | None:
    """First column that exists, exactly or whatever its case."""
    lower = {c.lower(): c for c in reversed(df.columns)}
    return next((c if c in df.columns else lower[c.lower()] for c in names if c in df.columns or c.lower() in lower), None)


def merge_synonyms(df: DataFrame, groups: dict[str, list[str]]) -> DataFrame:
    """A column for each group with the first value that is not missing among those present."""
    out = {}
    for name, synonyms in groups.items():
        present = [s for s in synonyms if s in df.columns]
        out[name] = F.coalesce(*[blank_to_null(F.col(f"`{s}`").cast("string")) for s in present]) if present else F.lit(None).cast("string")
    return df.withColumns(out)


def ensure_column(df: DataFrame, target: str, aliases: list[str], kind: str = "string") -> DataFrame:
    if target in df.columns:
        return df
    found = pick_first(df, aliases)
    return df.withColumn(target, F.col(f"`{found}`") if found else F.lit(None).cast(kind))


def reorder(df: DataFrame, first: list[str]) -> DataFrame:
    head = [c for c in first if c in df.columns]
    return df.select(*[f"`{c}`" for c in head + [c for c in df.columns if c not in head]])


def default_fill(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)) if column in df.columns else F.lit(value))


def filter_expr(df: DataFrame, text: str) -> DataFrame:
    """Filter by a boolean expression (`==`, `and`, `True` allowed); other types are refused."""
    sql = text.replace("==", "=")
    if not isinstance(df.select(F.expr(sql).alias("x")).schema["x"].dataType, BooleanType):
        raise ValueError(f"not a boolean expression: {text}")
    return df.filter(F.expr(sql))


def top_k(df: DataFrame, by: list[Column], n: int) -> DataFrame:
    return df.orderBy(*by).limit(n)


def keep_first(df: DataFrame, keys: list[str], order: list[str], keep_empty: bool = True) -> DataFrame:
    """One row for each key tuple, the first in the order; rows without any key stay if asked for.

    The winner is found by a partial aggregate of its order, so a frequent key is
    combined before the shuffle; ties of the order keep one row only if it is unique.
    """
    filled = [F.coalesce(F.trim(F.col(k).cast("string")), F.lit("")) for k in keys]
    empty = reduce(lambda a, b: a & b, [f == "" for f in filled])
    names = [f"_k{i}" for i in range(len(keys))]
    marked = df.withColumns(dict(zip(names, filled))).withColumn("_e", empty)
    full = marked.filter("not _e") if keep_empty else marked
    best = full.groupBy(*names).agg(F.min(F.struct(*order)).alias("_o"))
    won = full.withColumn("_o", F.struct(*order)).join(best, [*names, "_o"], "left_semi").drop("_o")
    out = won.unionByName(marked.filter("_e")) if keep_empty else won
    return out.drop(*names, "_e")


def mark_duplicates(df: DataFrame, column: str, flag: str) -> DataFrame:
    """True where a value that is not missing stands in several rows."""
    key = blank_to_null(F.col(column).cast("string"))
    many = df.groupBy(key.alias("_v")).agg(F.count("*").alias("_n")).filter("_v is not null and _n > 1").select("_v", F.lit(True).alias("_d"))
    return df.withColumn("_v", key).join(many, "_v", "left").withColumn(flag, F.coalesce("_d", F.lit(False))).drop("_v", "_d")


def duplicate_combinations(df: DataFrame, keys: list[str]) -> DataFrame:
    """For every combination of keys: rows with all of them, different tuples, surplus rows, their rate."""
    vals = [blank_to_null(F.col(k).cast("string")).alias(k) for k in keys]
    base = df.select(*vals)
    parts = []
    for n in range(1, len(keys) + 1):
        for combo in combinations(keys, n):
            have = base.filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in combo]))
            g = have.groupBy(*combo).agg(F.count("*").alias("n"))
            parts.append(g.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("applicable"), F.count("*").alias("n_unique")).withColumn("combo", F.lit("+".join(combo))))
    out = reduce(DataFrame.unionByName, parts)
    return out.select("combo", "applicable", "n_unique", (F.col("applicable") - F.col("n_unique")).alias("duplicates"), F.round(F.when(F.col("applicable") > 0, (F.col("applicable") - F.col("n_unique")) / F.col("applicable")).otherwise(0.0), 6).alias("rate"))


def left_join_fallback(base: DataFrame, right: DataFrame, first: str, second: str, fill: list[str]) -> DataFrame:
    """Left join on the first key; what is still null is filled by a join on the second key
    with right rows that have no first key. Right sides are unique by key (caller's duty)."""
    a = right.filter(F.col(first).isNotNull()).select(first, *[F.col(c).alias(f"{c}_1") for c in fill])
    b = right.filter(F.col(first).isNull() & F.col(second).isNotNull()).select(second, *[F.col(c).alias(f"{c}_2") for c in fill])
    out = base.join(a, first, "left").join(b, second, "left")
    return out.select(*base.columns, *[F.coalesce(f"{c}_1", f"{c}_2").alias(c) for c in fill])


def seeded_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """n rows in the order of a hash of the key: the same rows for the same seed."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(n)


def entity_union(df: DataFrame, key: str, scalars: list[str], lists: list[str], order: list[str]) -> DataFrame:
    """Per key: the first scalar that is not null in the order, and the sorted union of list columns."""
    first = [F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in scalars]
    union = df.groupBy(key).agg(*first)
    for c in lists:  # values are made distinct before they are gathered
        items = df.select(key, F.explode(c).alias("v")).filter("v is not null").distinct().groupBy(key).agg(F.array_sort(F.collect_list("v")).alias(c))
        union = union.join(items, key, "left").withColumn(c, F.coalesce(c, F.array().cast("array<string>")))
    return union


def require(df: DataFrame, groups: dict[str, list[str]]) -> dict[str, str]:
    """The column of each group that exists, whatever its case; KeyError for a group without any."""
    found = {name: pick_first(df, names) for name, names in groups.items()}
    missing = [n for n, c in found.items() if c is None]
    if missing:
        raise KeyError(f"no column for: {', '.join(missing)}")
    return found


def resolve(df: DataFrame, name: str) -> str | None:
    """The column of a name regardless of case, accents, blanks, hyphens and underscores."""
    import unicodedata

    def plain(x: str) -> str:
        return "".join(c for c in unicodedata.normalize("NFKD", x).lower() if c.isalnum())

    return next((c for c in df.columns if plain(c) == plain(name)), None)


def sort_by(df: DataFrame, columns: list[str], ascending: bool | list[bool] = True, tie: str | None = None) -> DataFrame:
    """Sort by columns, each up or down, nulls last; KeyError for a column that is missing. `tie` settles equal rows."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"no column: {', '.join(missing)}")
    ups = ascending if isinstance(ascending, list) else [ascending] * len(columns)
    order = [F.col(c).asc_nulls_last() if up else F.col(c).desc_nulls_last() for c, up in zip(columns, ups)]
    return df.orderBy(*order, *([F.col(tie)] if tie else []))


def fill_blanks(df: DataFrame, guesses: dict[str, str]) -> DataFrame:
    """Existing values stay; blank and missing ones take the guess of another column."""
    return df.withColumns({c: F.coalesce(blank_to_null(F.col(c)), F.col(g)) for c, g in guesses.items()})

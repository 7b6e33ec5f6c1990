"""Numbers, ranges, dates, vectors and fuzzy comparison."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def employees(c: Column) -> Column:
    """Mean of the mid points of the ranges or numbers in a text."""
    starts = F.regexp_extract_all(c, F.lit(r"(\d+)(?:\s*[–-]\s*(\d+))?"), F.lit(1))
    ends = F.regexp_extract_all(c, F.lit(r"(\d+)(?:\s*[–-]\s*(\d+))?"), F.lit(2))
    mids = F.zip_with(starts, ends, lambda a, b: (a.try_cast("double") + F.coalesce(F.nullif(b, F.lit("")), a).try_cast("double")) / 2)
    return F.when(F.size(mids) > 0, F.aggregate(mids, F.lit(0.0), lambda x, y: x + y) / F.size(mids))


def revenue(c: Column) -> Column:
    """Amount with k, m or b behind it; decimal comma; currency sign ignored."""
    t = F.lower(F.replace(c, F.lit("€"), F.lit("")))
    n = F.replace(F.regexp_extract(t, r"([\d.,]+)\s*([kmb]?)", 1), F.lit(","), F.lit(".")).try_cast("double")
    s = F.regexp_extract(t, r"([\d.,]+)\s*([kmb]?)", 2)
    return n * F.when(s == "k", 1e3).when(s == "m", 1e6).when(s == "b", 1e9).otherwise(1.0)


def size_bucket(c: Column) -> Column:
    """Five classes of the largest number in a text of employees."""
    n = F.array_max(F.transform(F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("long")))
    return F.when(n <= 10, "1-10").when(n <= 50, "11-50").when(n <= 200, "51-200").when(n <= 500, "201-500").when(n.isNotNull(), "500+")


def size_class(c: Column) -> Column:
    """Eight classes: by a staff code, else by the greatest number of a text, else null."""
    from .dimensions import staff_class

    n = F.array_max(F.transform(F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("long")))
    by = F.when(n.isNull(), F.lit(None).cast("string"))
    for most, name in ((10, "1-10"), (50, "11-50"), (200, "51-200"), (500, "201-500"), (1000, "501-1000"), (5000, "1001-5000"), (10000, "5001-10000")):
        by = by.when(n <= most, name)
    return F.coalesce(staff_class(c), by.otherwise("10000+"))


def recent(c: Column, as_of: Column, days: int = 14) -> Column:
    """Is a date at most so many days before the given one (and not after it)?"""
    return F.coalesce(F.datediff(as_of, parse_date(c)).between(0, days), F.lit(False))


def parse_date(c: Column) -> Column:
    t = F.trim(c)
    return F.coalesce(*[F.try_to_timestamp(t, F.lit(f)).cast("date") for f in ("yyyy-MM-dd", "dd/MM/yyyy", "yyyy/MM/dd", "dd-MM-yyyy", "yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssXXX", "dd/MM/yyyy HH:mm")])


def recency(c: Column, as_of: Column) -> Column:
    """1 for at most 2 years, then .85, .65, .45, .25 and .1 by 5, 10, 15, 20 years; 0 without a date."""
    y = F.greatest(F.lit(0.0), F.datediff(as_of, parse_date(c)) / F.lit(365.25))
    return F.when(y <= 2, 1.0).when(y <= 5, 0.85).when(y <= 10, 0.65).when(y <= 15, 0.45).when(y <= 20, 0.25).when(y.isNotNull(), 0.1).otherwise(0.0)


def cosine(a: Column, b: Column) -> Column:
    """0 where a norm is zero or a vector is missing."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.coalesce(F.when((norm(a) > 0) & (norm(b) > 0), dot / (norm(a) * norm(b))), F.lit(0.0))


def nearest(queries: DataFrame, rows: DataFrame, key: str, vector: str, k: int, block: int = 4096) -> DataFrame:
    """(q_id, key, cosine): the k nearest rows of each query by cosine, itself left out; ties go to the lesser key.

    Queries and rows are drawn into blocks by a hash of their keys; every two blocks are
    multiplied in one task, which keeps k rows for each query, so that what is sorted at
    the end has k rows for each query and block. Null vectors are left out; a vector of
    norm 0 has cosine 0 with all.
    """
    q, r = queries.filter(F.col(vector).isNotNull()), rows.filter(F.col(vector).isNotNull())
    nq, nr = max(1, -(-q.count() // block)), max(1, -(-r.count() // block))
    part = lambda n: F.pmod(F.xxhash64(key), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    both = q.select(part(nq).alias("a"), every(nr).alias("b"), F.lit(True).alias("q"), F.col(key).alias("i"), F.col(vector).alias("v")).unionByName(
        r.select(every(nq).alias("a"), part(nr).alias("b"), F.lit(False).alias("q"), F.col(key).alias("i"), F.col(vector).alias("v"))
    )

    def best(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        one, two = frame[frame["q"]], frame[~frame["q"]]
        if len(one) and len(two):
            unit = lambda f: (lambda m: m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12))(np.array(f["v"].tolist(), np.float64))
            ids, own = two["i"].to_numpy(), one["i"].to_numpy()
            sim = np.round(unit(one) @ unit(two).T, 9)
            sim[own[:, None] == ids[None, :]] = -2
            for i, x in enumerate(own):
                top = np.lexsort((ids, -sim[i]))[:k]
                top = top[sim[i][top] > -2]
                out.append(pd.DataFrame({"q_id": x, key: ids[top], "cosine": sim[i][top]}))
        return pd.concat(out) if out else pd.DataFrame({"q_id": [], key: [], "cosine": []})

    found = both.groupBy("a", "b").applyInPandas(best, f"q_id long, {key} long, cosine double")
    w = Window.partitionBy("q_id").orderBy(F.desc("cosine"), key)
    return found.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k).select("q_id", key, F.round("cosine", 6).alias("cosine"))


def bits_lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for ch in b:
        u = s & masks.get(ch, 0)
        s = (s + u) | (s - u)
    return len(a) - bin(s & full).count("1")


def ratio(a: str, b: str) -> float:
    """Indel similarity 0..100."""
    return 100.0 * 2 * bits_lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_set_ratio(a: str, b: str) -> float:
    x, y = set(a.split()), set(b.split())
    if not x or not y:
        return 0.0
    both, l, r = " ".join(sorted(x & y)), " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if both and (not l or not r):
        return 100.0
    p, q = (both + " " + l).strip(), (both + " " + r).strip()
    return max(ratio(p, q), ratio(both, p) if both else 0.0, ratio(both, q) if both else 0.0)


def partial_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter text against windows of the longer."""
    s, t = (a, b) if len(a) <= len(b) else (b, a)
    if not s:
        return 0.0
    return max(ratio(s, t[i : i + len(s)]) for i in range(max(1, len(t) - len(s) + 1)))


def _vectorised(f):
    @F.pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else round(f(x, y), 6) for x, y in zip(a, b)], dtype=float)

    return run


fuzzy_ratio = _vectorised(ratio)
fuzzy_token_set = _vectorised(token_set_ratio)
fuzzy_token_sort = _vectorised(lambda a, b: ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))
fuzzy_partial = _vectorised(partial_ratio)

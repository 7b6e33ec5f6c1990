"""Writers: parquet, CSV (with byte order mark for spreadsheets), JSON, small HTML reports, upserts."""

from __future__ import annotations

import html
import json
import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").option("compression", "snappy")
    (w.partitionBy(*partition) if partition else w).parquet(path)


def write_csv(df: DataFrame, folder: str, append: bool = False) -> None:
    df.write.mode("append" if append else "overwrite").option("header", True).csv(folder)


def write_spreadsheet(df: DataFrame, path: str, most: int = 100_000) -> None:
    """One local CSV file in UTF-8 with byte order mark, for top-k exports of a bounded number of rows."""
    rows = df.limit(most + 1).toPandas()
    if len(rows) > most:
        raise ValueError("too many rows for a spreadsheet; use write_csv")
    part = f"{path}.part"
    rows.to_csv(part, index=False, encoding="utf-8-sig")
    os.replace(part, path)


def write_json(df: DataFrame, folder: str) -> None:
    df.write.mode("overwrite").json(folder)


def write_summary(values: dict, path: str) -> None:
    part = f"{path}.part"
    with open(part, "w", encoding="utf-8") as f:
        json.dump(values, f, ensure_ascii=False, indent=2, default=str)
    os.replace(part, path)


def html_report(title: str, tables: dict[str, DataFrame], most: int = 1000) -> str:
    """HTML of small aggregate tables (the first `most` rows of each)."""
    out = [f"<html><head><meta charset='utf-8'><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>"]
    for name, df in tables.items():
        rows = df.limit(most).collect()
        head = "".join(f"<th>{html.escape(c)}</th>" for c in df.columns)
        body = "".join("<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in r) + "</tr>" for r in rows)
        out.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{body}</table>")
    return "".join(out) + "</body></html>"


def svg_histogram(counts: list[int], width: int = 400, height: int = 120) -> str:
    top = max([*counts, 1])
    w = width / max(len(counts), 1)
    bars = "".join(f"<rect x='{i * w:.1f}' y='{height - height * c / top:.1f}' width='{w * 0.9:.1f}' height='{height * c / top:.1f}'/>" for i, c in enumerate(counts))
    return f"<svg width='{width}' height='{height}'>{bars}</svg>"


def upsert(old: DataFrame, new: DataFrame, key: str, version: str, ttl_before=None) -> DataFrame:
    """The newest row of each key of both frames; rows older than `ttl_before` are dropped."""
    both = old.unionByName(new, allowMissingColumns=True)
    if ttl_before is not None:
        both = both.filter(F.col(version) >= ttl_before)
    cols = [c for c in both.columns if c != key]
    return both.groupBy(key).agg(F.max_by(F.struct(*cols), version).alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in cols])

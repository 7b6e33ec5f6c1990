"""Filling fixed-capacity containers with items of varying length.

Method: first-fit decreasing with a tournament tree over the free space of the open
containers, run independently in randomised groups of documents. Sizes are tokens of a
public tokenizer; an item is split only where it alone exceeds the capacity.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, spread


@dataclass(frozen=True)
class PackConf:
    """capacity in tokens; group: mean number of pieces packed together (the groups are
    random, so each is a sample of all sizes); vocabulary: path of a rank file."""

    capacity: int = 2048
    group: int = 5000
    vocabulary: str = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
    seed: int = 17


class Tournament:
    """Free space of containers in a max tree; finds the first container that fits."""

    def __init__(self, most: int):
        self.size = 1
        while self.size < max(most, 1):
            self.size *= 2
        self.tree = [0] * (2 * self.size)

    def set(self, k: int, free: int) -> None:
        i = k + self.size
        self.tree[i] = free
        i //= 2
        while i:
            best = max(self.tree[2 * i], self.tree[2 * i + 1])
            if self.tree[i] == best:
                break
            self.tree[i] = best
            i //= 2

    def first(self, need: int) -> int:
        """Lowest container with at least `need` free, or -1."""
        if self.tree[1] < need:
            return -1
        i = 1
        while i < self.size:
            i = 2 * i if self.tree[2 * i] >= need else 2 * i + 1
        return i - self.size


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Container of every item (sizes at most the capacity); ties keep the given order."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    tree, opened = Tournament(len(sizes)), 0
    out = [0] * len(sizes)
    for i in order:
        k = tree.first(sizes[i]) if sizes[i] else (0 if opened else -1)
        if k < 0:
            k, opened = opened, opened + 1
            tree.set(k, capacity - sizes[i])
        else:
            tree.set(k, tree.tree[k + tree.size] - sizes[i])
        out[i] = k
    return out


_encoders: dict[str, object] = {}


def _encoder(path: str):
    if path not in _encoders:
        import tiktoken

        try:
            from public_tokenizers import PATTERN as pattern
        except ImportError:
            pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def pieces(documents: DataFrame, conf: PackConf) -> DataFrame:
    """(doc_id, piece_no, tokens): a piece for every capacity's worth of tokens of a text.

    Null texts are left out; an empty text is one piece of 0 tokens.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = _encoder(conf.vocabulary)
        for b in batches:
            n = [len(t) for t in enc.encode_ordinary_batch(b["text"].tolist(), num_threads=1)]
            parts = [[conf.capacity] * (k // conf.capacity) + ([k % conf.capacity] if k % conf.capacity or not k else []) for k in n]
            yield pd.DataFrame({"doc_id": b["doc_id"].repeat([len(p) for p in parts]).to_numpy(), "piece_no": [i for p in parts for i in range(1, len(p) + 1)], "tokens": [x for p in parts for x in p]})

    docs = documents.filter("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return spread(docs, "doc_id").mapInPandas(run, "doc_id long, piece_no int, tokens int")


def pack(documents: DataFrame, conf: PackConf = PackConf()) -> DataFrame:
    """(doc_id, piece_no, tokens, container): containers of at most `capacity` tokens.

    Full pieces fill a container of their own and never enter a group. Groups are drawn
    by a hash of document and piece, so no source or length can make one large. Repeated
    rows are items of their own; an empty table gives an empty result.
    """
    sized = cut(pieces(documents, conf))
    full = sized.filter(F.col("tokens") >= conf.capacity).withColumn("container", F.concat_ws("-", F.lit("f"), "doc_id", "piece_no"))
    rest = sized.filter(F.col("tokens") < conf.capacity)
    groups = max(1, -(-rest.count() // conf.group))
    drawn = rest.withColumn("g", F.pmod(F.xxhash64(F.lit(conf.seed), "doc_id", "piece_no"), F.lit(groups)))

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "piece_no"])
        bins = first_fit_decreasing(frame["tokens"].tolist(), conf.capacity)
        g = frame["g"].iloc[0]
        return frame.assign(container=[f"g{g}-{b}" for b in bins])[["doc_id", "piece_no", "tokens", "container"]]

    packed = drawn.groupBy("g").applyInPandas(one, "doc_id long, piece_no int, tokens int, container string")
    return packed.unionByName(full.select("doc_id", "piece_no", "tokens", "container"))


def usage(packed: DataFrame, conf: PackConf = PackConf()) -> DataFrame:
    """One row: containers, tokens and the share of their space that is used."""
    return packed.agg(F.count_distinct("container").alias("containers"), F.sum("tokens").alias("tokens")).withColumn("fill", F.round(F.col("tokens") / (F.col("containers") * conf.capacity), 6))

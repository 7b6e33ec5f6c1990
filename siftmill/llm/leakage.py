"""Evaluation passages leaking into training text.

Method: q-gram lemma filter. Shared character q-grams are counted in overlapping
bands of diagonals (position in the document minus position in the item); bands
that reach the count which a passage within the edit budget must leave are kept
and verified by a banded alignment of words.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

Q = 8  # letters of a q-gram: one machine word holds it exactly


@dataclass(frozen=True)
class LeakConf:
    """words: shortest passage; one word in `per_change` may differ; band: half width in
    characters; shared: q-grams that a band must hold; block: items handled in one pass."""

    words: int = 20
    per_change: int = 8
    band: int = 48
    block: int = 2000
    shared: int = 30


def words_of(text: str) -> list[str]:
    """Words without case, accents, punctuation and markup; apostrophes join their parts."""
    if "<" in text:
        text = re.sub(r"<[^<>]{1,200}>", " ", text)
    if "&" in text:
        text = html.unescape(text)
    text = text.replace("­", "").replace("​", "").replace("œ", "oe").replace("Œ", "oe").replace("æ", "ae")
    text = re.sub(r"(?<=[^\W\d_])-\s*\n\s*(?=[^\W\d_])", "", text)
    text = unicodedata.normalize("NFKD", text.lower())
    if not text.isascii():
        text = "".join(c for c in text if not unicodedata.combining(c))
    text = re.sub(r"['’‘ʼ´`]\s?(?=\w)", "", text)
    return re.sub(r"[^\w]+|_", " ", text).split()


def _grams(data: bytes) -> np.ndarray:
    b = np.frombuffer(data, np.uint8).astype(np.uint64)
    n = len(b) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(Q):
        h = (h << np.uint64(8)) | b[k : k + n]
    return h


def _pack(words: list[str]) -> bytes:
    return (" " + " ".join(words) + " ").encode("ascii", "replace")


class ItemIndex:
    """q-grams of the items with their places, behind a bitmap."""

    def __init__(self, items: list[tuple[int, str]], conf: LeakConf = LeakConf()):
        self.ids = [i for i, _ in items]
        self.words = [words_of(t or "") for _, t in items]
        self.bounds = [self._bounds(w, conf) for w in self.words]
        self.least = np.array([b[2].min() for b in self.bounds])
        grams, owner, place = [], [], []
        for k, w in enumerate(self.words):
            g = _grams(_pack(w))
            grams.append(g)
            owner.append(np.full(len(g), k, np.int64))
            place.append(np.arange(len(g)))
        cat = lambda x, t: np.concatenate(x) if x else np.zeros(0, t)
        g, self.owner, self.place = cat(grams, np.uint64), cat(owner, np.int64), cat(place, np.int64)
        order = np.argsort(g, kind="stable")
        g, self.owner, self.place = g[order], self.owner[order], self.place[order]
        self.keys, self.first, self.count = np.unique(g, return_index=True, return_counts=True)
        self.bits = np.zeros(1 << 20, bool)
        self.bits[self._slot(self.keys)] = True

    @staticmethod
    def _bounds(words: list[str], conf: LeakConf) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first gram, past the last, least shared) of every shortest passage of an item.

        A changed word spoils its own letters and Q - 1 around it; each passage is charged
        its longest words. A passage at the budget holds a stretch of the shortest length
        within the rounded-up budget; an item no longer than that is one passage.
        """
        size = min(conf.words, len(words))
        at = np.cumsum([0] + [len(w) + 1 for w in words])
        first, last = at[: len(words) - size + 1], at[size:]
        changes = size // conf.per_change + (len(words) > size)
        lengths = np.array([[len(w) for w in words[i : i + size]] for i in range(len(first))], np.int64)
        lost = (np.sort(lengths, axis=1)[:, size - changes :] + Q - 1).sum(axis=1)
        return first, np.maximum(last + 1 - Q + 1, first), np.maximum(last + 1 - first - Q + 1 - lost, 1)

    def reaches(self, k: int, places: np.ndarray) -> bool:
        """Do shared q-grams at these places of item k reach the bound of any passage?"""
        first, last, least = self.bounds[k]
        cover = np.zeros(int(last[-1]) + 2 if len(last) else 1, np.int64)
        cover[places[places < len(cover)]] = 1
        run = np.concatenate([[0], np.cumsum(cover)])
        return bool((run[np.minimum(last, len(run) - 1)] - run[first] >= least).any())

    @staticmethod
    def _slot(g: np.ndarray) -> np.ndarray:
        return ((g * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    def hits(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, place in item, place in document) of every shared q-gram."""
        g = _grams(data)
        at = np.flatnonzero(self.bits[self._slot(g)]) if len(g) else np.zeros(0, np.int64)
        none = np.zeros(0, np.int64)
        if not len(at) or not len(self.keys):
            return none, none, none
        pos = np.minimum(np.searchsorted(self.keys, g[at]), len(self.keys) - 1)
        real = self.keys[pos] == g[at]
        at, pos = at[real], pos[real]
        n = self.count[pos]
        flat = np.repeat(self.first[pos] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum()) if len(n) else none
        return self.owner[flat], self.place[flat], np.repeat(at, n)


def holds_passage(item: list[str], doc: list[str], conf: LeakConf) -> bool:
    """Does the text hold a passage of the item within the edit budget? Exact, by alignment.

    reach[e] is the number of item words of the longest aligned stretch that ends at a
    pair of places with e errors (changed, missing or added words). A passage of any
    length that keeps the budget holds one of less than twice the shortest length that
    keeps it too, so few errors need to be followed.
    """
    least = min(conf.words, len(item))
    if not least:
        return False
    most = (2 * least - 1) // conf.per_change
    m = len(doc)
    code = {w: k for k, w in enumerate(dict.fromkeys(item))}
    d = np.array([code.get(w, -1) for w in doc], np.int32)
    need = np.maximum(least, conf.per_change * np.arange(most + 1))
    none = -(10**6)
    reach = np.zeros((most + 1, m + 1), np.int32)
    reach[1:] = none
    for w in item:
        same = d == code[w]
        new = np.full((most + 1, m + 1), none, np.int32)
        new[0, 0] = 0
        new[0, 1:] = np.where(same, reach[0, :-1] + 1, 0)
        for e in range(1, most + 1):
            new[e, 1:] = np.where(same, reach[e, :-1], reach[e - 1, :-1]) + 1
            np.maximum(new[e], reach[e - 1] + 1, out=new[e])
            np.maximum(new[e, 1:], new[e - 1, :-1], out=new[e, 1:])
        if (new.max(axis=1) >= need).any():
            return True
        reach = new
    return False


def leaked(text: str | None, index: ItemIndex, conf: LeakConf) -> list[int]:
    """Ordinals of the items of which the text holds a passage."""
    if not text:
        return []
    words = words_of(text)
    data = _pack(words)
    owner, place, at = index.hits(data)
    if not len(owner):
        return []
    found: list[int] = []
    starts = np.cumsum([1] + [len(w) + 1 for w in words])  # first byte of each word
    for k in np.flatnonzero(np.bincount(owner, minlength=len(index.ids)) >= index.least):
        mine = owner == k
        if not index.reaches(k, place[mine]):
            continue
        p, a = place[mine], at[mine]
        item = index.words[k]
        diag = a - p
        need = min(conf.shared, max(1, int(index.bounds[k][2].min())))
        hit = False
        seen: set[tuple[int, int]] = set()
        for shift in (0, conf.band):
            band = (diag + shift + (1 << 20)) // (2 * conf.band)
            values, inverse, counts = np.unique(band, return_inverse=True, return_counts=True)
            for b in np.flatnonzero(counts >= need):
                inside = inverse == b
                if not index.reaches(k, p[inside]):
                    continue
                lo = max(0, int((a[inside] - p[inside]).min()) - conf.band)
                hi = int((a[inside] - p[inside]).max()) + len(_pack(item)) + conf.band
                i, j = int(np.searchsorted(starts, lo)), int(np.searchsorted(starts, hi))
                if (i, j) in seen:
                    continue
                seen.add((i, j))
                if holds_passage(item, words[i:j], conf):
                    hit = True
                    break
            if hit:
                break
        if hit:
            found.append(int(k))
    return found


def find_leaks(documents: DataFrame, items: DataFrame, conf: LeakConf = LeakConf()) -> DataFrame:
    """(doc_id, item_id): documents that hold a passage of an item.

    The items are the stated query set: they are read in blocks of `conf.block`, each
    block passes once over all documents, nothing is shuffled but the documents'
    spread over tasks. Null and empty texts, items without words and empty tables give
    no row; copies of a document are each reported; extra columns are ignored.
    """
    rows = items.select(F.col("item_id").cast("long"), "text").filter("text is not null").orderBy("item_id")
    spark = documents.sparkSession
    total = rows.count()
    out = None
    docs = spread(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("length(text) > 0"), "doc_id")
    for start in range(0, max(total, 1), conf.block):
        block = [(r[0], r[1]) for r in rows.offset(start).limit(conf.block).collect()]

        def run(batches: Iterator[pd.DataFrame], block=block) -> Iterator[pd.DataFrame]:
            index = ItemIndex(block, conf)
            for b in batches:
                got = [leaked(t, index, conf) for t in b["text"]]
                yield pd.DataFrame({"doc_id": b["doc_id"].repeat([len(g) for g in got]).to_numpy(), "item_id": [index.ids[k] for g in got for k in g]}).astype("int64")

        part = docs.mapInPandas(run, "doc_id long, item_id long")
        out = part if out is None else out.unionByName(part)
    return out

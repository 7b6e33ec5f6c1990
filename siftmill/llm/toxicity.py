"""Abusive, hateful or sexual content.

Method: a counterfactual-regularised classifier. A logistic model over hashed word,
word-pair and letter features of sentences is fitted to document labels by multiple
instance rounds; identity terms in the training sentences are swapped and changes of
the score are penalised, so that naming a group does not raise it.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import spread

# Terms that name groups of people; swapped with each other in training.
IDENTITY = (
    "femmes hommes femme homme etrangers immigres immigre etranger musulmans juifs chretiens noirs blancs arabes gitans roms homosexuels gays lesbiennes handicapes vieux jeunes "
    "women men woman man immigrants foreigners muslims jews christians blacks whites gays disabled elderly tersalans tersalan vornois ostreves ostreve kalmediens kalmedien"
).split()
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})

_TOKEN = re.compile(r"[^\W_]+(?:[*@$!][^\W_]+)*[*]?|\*[^\W_]+", re.UNICODE)
_SPACED = re.compile(r"\b(?:[^\W\d_][ .\-_*]){3,}[^\W\d_]\b")
_SPLIT = re.compile(r"(?<=[.!?…])[\"»)]*\s+|\n+")


@dataclass(frozen=True)
class ToxicConf:
    """positives, negatives: bound of the labelled documents that the fit may take (the
    rest of the labels is left for measuring). buckets: hashed features. swap: weight of
    the counterfactual penalty. swaps: terms swapped in for each sentence. review: score from which a document goes to review."""

    positives: int = 3000
    negatives: int = 8000
    buckets: int = 1 << 18
    steps: int = 120
    rounds: int = 2
    l2: float = 0.1
    support: int = 5
    swap: float = 1.0
    swaps: int = 4
    span: int = 24
    review: float = 0.65


def tokens(text: str) -> list[str]:
    """Words without accents and disguise: letters spaced out, digits for letters, drawn-out letters."""
    text = _SPACED.sub(lambda m: re.sub(r"[ .\-_*]", "", m.group(0)), text)
    text = unicodedata.normalize("NFKD", text.lower().replace("œ", "oe"))
    text = "".join(c for c in text if not unicodedata.combining(c))
    out = []
    for t in _TOKEN.findall(text):
        if t.isdigit():
            out.append("0")
            continue
        if not t.isalpha():
            t = t.translate(LEET)
        out.append(re.sub(r"(.)\1{2,}", r"\1", t))
    return out


def segments(text: str, span: int = 24) -> list[list[str]]:
    """Sentences as token lists, and overlapping halves of the long ones, so that text run together is seen."""
    out = []
    half = span // 2
    for s in _SPLIT.split(text):
        t = tokens(s)
        if t and len(t) <= span:
            out.append(t)
        if len(t) > half + half // 2:
            out.extend(t[i : i + half] for i in range(0, len(t) - half // 2, half // 2))
    return out


class Features:
    """Hashed features of a token list."""

    def __init__(self, buckets: int):
        self.buckets = buckets
        self.memo: dict[str, tuple[int, np.ndarray]] = {}

    def token(self, t: str) -> tuple[int, np.ndarray]:
        got = self.memo.get(t)
        if got is None:
            word = zlib.crc32(t.encode())
            padded = f"<{t}>"
            parts = [f"4{padded[i : i + 4]}" for i in range(len(padded) - 3)] if len(t) > 3 else []
            got = word, np.array([word % self.buckets] + [zlib.crc32(p.encode()) % self.buckets for p in parts], np.int64)
            if len(self.memo) < 300_000:
                self.memo[t] = got
        return got

    def of(self, toks: list[str]) -> np.ndarray:
        each = [self.token(t) for t in toks]
        pairs = [(a[0] * 31 + b[0] * 7 + 1) % self.buckets for a, b in zip(each, each[1:])]
        return np.unique(np.concatenate([e[1] for e in each] + [np.array(pairs, np.int64)]))


class Model:
    """Weights, bias, and the words by which starred letters are restored."""

    def __init__(self, conf: ToxicConf, weights: np.ndarray, bias: float, words: list[str]):
        self.conf, self.weights, self.bias, self.words = conf, weights, bias, words
        self.features = Features(conf.buckets)
        self.known: dict[tuple[int, str], list[str]] = {}
        for w in words:
            self.known.setdefault((len(w), w[0]), []).append(w)
        self.memo: dict[str, float] = {}

    def restore(self, toks: list[str]) -> list[str]:
        if not any("*" in t for t in toks):
            return toks
        out = []
        for t in toks:
            if "*" in t:
                rx = re.compile(re.escape(t).replace(r"\*", "."))
                pool = self.known.get((len(t), t[0]), []) if t[0] != "*" else [w for (n, _), ws in self.known.items() if n == len(t) for w in ws]
                t = next((w for w in pool if rx.fullmatch(w)), t.replace("*", ""))
            out.append(t)
        return out

    def score_tokens(self, toks: list[str]) -> float:
        toks = self.restore(toks)
        if not toks:
            return 0.0
        ids = self.features.of(toks)
        z = self.bias + float(self.weights[ids].sum()) / np.sqrt(len(ids))
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    def score(self, text: str | None) -> float:
        """Greatest score of the text's sentences; null and empty texts score 0."""
        if not text:
            return 0.0
        best = 0.0
        for toks in segments(text, self.conf.span):
            key = " ".join(toks)
            s = self.memo.get(key)
            if s is None:
                s = self.score_tokens(toks)
                if len(self.memo) < 100_000:
                    self.memo[key] = s
            best = max(best, s)
        return best


class _Rows:
    """Feature lists as one sparse matrix over the features that occur, rows scaled by the root of their size."""

    def __init__(self, lists: list[np.ndarray], active: np.ndarray):
        self.n, self.d = len(lists), len(active)
        size = np.array([len(x) for x in lists], np.int64)
        self.filled = np.flatnonzero(size)
        self.starts = np.concatenate([[0], np.cumsum(size)[:-1]])[self.filled] if self.n else size
        self.cols = np.searchsorted(active, np.concatenate(lists)) if self.n else np.zeros(0, np.int64)
        self.scale = 1 / np.sqrt(np.maximum(size, 1))
        order = np.argsort(self.cols, kind="stable")
        self.rows = np.repeat(np.arange(self.n), size)[order]
        self.used, self.heads = np.unique(self.cols[order], return_index=True)

    def dot(self, w: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        if len(self.filled):
            out[self.filled] = np.add.reduceat(w[self.cols], self.starts)
        return out * self.scale

    def back(self, g: np.ndarray) -> np.ndarray:
        out = np.zeros(self.d)
        if len(self.used):
            out[self.used] = np.add.reduceat((g * self.scale)[self.rows], self.heads)
        return out


def _swaps(sentences: list[list[str]], feats: Features, most: int) -> tuple[list[int], list[np.ndarray]]:
    """For sentences with identity terms: (index, features with the terms swapped).

    The terms swapped in are the commonest of the training sentences, so that the
    penalty reaches the words that the labels may have coloured.
    """
    terms = set(IDENTITY)
    seen: dict[str, int] = {}
    for s in sentences:
        for t in set(s) & terms:
            seen[t] = seen.get(t, 0) + 1
    common = sorted(seen, key=lambda t: (-seen[t], t))
    common += [t for t in IDENTITY if t not in seen]
    at, out = [], []
    for i, s in enumerate(sentences):
        mine = set(s) & terms
        if mine:
            for other in [t for t in common if t not in mine][:most]:
                at.append(i)
                out.append(feats.of([other if t in mine else t for t in s]))
    return at, out


def _logistic(lists: list[np.ndarray], y: np.ndarray, weight: np.ndarray, at: np.ndarray, other: list[np.ndarray], conf: ToxicConf) -> tuple[np.ndarray, float]:
    """Weighted logistic regression with the counterfactual penalty, by Adam over all rows.

    at, other: rows and their features with the identity terms swapped; the squared
    change of a row's logit is charged, the mean over its swaps.
    """
    total = weight.sum()
    full = np.zeros(conf.buckets)
    if not total:
        return full, -30.0  # nothing to learn from: nothing is toxic
    active = np.unique(np.concatenate([*lists, *other]))
    x, pairs = _Rows(lists, active), _Rows(other, active)
    w, b, m1, m2, c1, c2 = np.zeros(len(active)), 0.0, 0.0, 0.0, 0.0, 0.0
    share = weight[at] / np.bincount(at, minlength=len(lists))[at] if pairs.n else weight[:0]
    for t in range(1, conf.steps + 1):
        logit = x.dot(w)
        p = 1 / (1 + np.exp(-np.clip(logit + b, -30, 30)))
        g = weight * (p - y) / total
        gb = g.sum()
        gw = conf.l2 * w / total
        if pairs.n and conf.swap:
            h = 2 * conf.swap * (logit[at] - pairs.dot(w)) * share / total
            g = g + np.bincount(at, weights=h, minlength=x.n)
            gw -= pairs.back(h)
        gw += x.back(g)
        m1, m2 = 0.9 * m1 + 0.1 * gw, 0.999 * m2 + 0.001 * gw * gw
        c1, c2 = 0.9 * c1 + 0.1 * gb, 0.999 * c2 + 0.001 * gb * gb
        step = 0.3 * min(1.0, 3 * (1 - t / (conf.steps + 1)))
        w -= step * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-7)
        b -= step * (c1 / (1 - 0.9**t)) / (np.sqrt(c2 / (1 - 0.999**t)) + 1e-7)
    full[active] = w
    return full, b


def fit(texts: list[str], labels: list[int], conf: ToxicConf = ToxicConf()) -> Model:
    """Fit the sentence model to document labels.

    A sentence's first target is the share of toxic documents among those it stands in,
    so that common neutral sentences stay near the base rate. In each round two models,
    each fitted on half of the documents, judge the sentences of the other half; those
    found clean count as clean from then on.
    """
    feats = Features(conf.buckets)
    count: dict[str, list[float]] = {}
    keys: list[list[str]] = []
    for text, label in zip(texts, labels):
        mine = list(dict.fromkeys(" ".join(s) for s in segments(text or "", conf.span)))
        keys.append(mine)
        for k in mine:
            count.setdefault(k, [0.0, 0.0])[label] += 1
    order = {k: i for i, k in enumerate(count)}
    vocabulary: dict[str, float] = {}
    for k, (neg, pos) in count.items():
        for t in set(k.split()):
            if "*" not in t and len(t) > 2:
                vocabulary[t] = vocabulary.get(t, 0) + pos - neg
    words = [t for t, v in sorted(vocabulary.items(), key=lambda x: (-x[1], x[0])) if v > 0]
    model = Model(conf, np.zeros(conf.buckets), 0.0, words)
    sentences = [model.restore(k.split()) for k in order]
    lists = [feats.of(s) for s in sentences]
    at, other = _swaps(sentences, feats, conf.swaps)
    bags = [np.array([order[k] for k in mine], np.int64) for mine in keys]
    # Features seen in few documents (names, above all) are left out.
    support = np.zeros(conf.buckets, np.int32)
    for bag in bags:
        if len(bag):
            support[np.unique(np.concatenate([lists[i] for i in bag]))] += 1
    rare = support < conf.support
    # Sentences that differ in rare features only are one row from here on.
    rows: dict[bytes, int] = {}
    to_row = np.array([rows.setdefault(x[~rare[x]].tobytes(), len(rows)) for x in lists], np.int64)
    where = np.full(len(rows), -1)
    where[to_row[::-1]] = np.arange(len(lists))[::-1]
    lists = [lists[i][~rare[lists[i]]] for i in where]
    bags = [np.unique(to_row[bag]) if len(bag) else bag for bag in bags]
    keep = [j for j, i in enumerate(at) if where[to_row[i]] == i]
    at, other = [int(to_row[at[j]]) for j in keep], [other[j][~rare[other[j]]] for j in keep]
    sentences = lists
    label = np.array(labels)
    toxic = np.ones(len(sentences), bool)  # sentences that may count as toxic

    def one(members: np.ndarray) -> tuple[np.ndarray, float]:
        """A model from some documents: a sentence's target is the share of toxic documents it stands in."""
        pos, neg = np.zeros(len(sentences)), np.zeros(len(sentences))
        for d in members:
            (pos if labels[d] else neg)[bags[d]] += 1
        use = np.flatnonzero(pos + neg > 0)
        back = np.full(len(sentences), -1)
        back[use] = np.arange(len(use))
        mine = [j for j, i in enumerate(at) if back[i] >= 0]
        total = pos + neg
        y = np.where(toxic, pos, 0) / np.maximum(total, 1)
        return _logistic([lists[i] for i in use], y[use], total[use], back[[at[j] for j in mine]].astype(np.int64), [other[j] for j in mine], conf)

    active = np.unique(np.concatenate([*lists, np.zeros(0, np.int64)])).astype(np.int64)
    x = _Rows(lists, active)
    folds = np.arange(len(labels)) % 2
    for k in range(conf.rounds):
        # Each half judges the sentences of the other, so that no sentence vouches for itself.
        p = np.zeros(len(sentences))
        seen = np.zeros(len(sentences))
        for f in (0, 1):
            w, b = one(np.flatnonzero(folds != f))
            z = 1 / (1 + np.exp(-np.clip(x.dot(w[active]) + b, -30, 30)))
            here = np.unique(np.concatenate([bags[d] for d in np.flatnonzero(folds == f)] or [np.zeros(0, np.int64)])).astype(np.int64)
            p[here] += z[here]
            seen[here] += 1
        toxic = p / np.maximum(seen, 1) > (0.35 if k == 0 else 0.5)
        if not toxic.any() and label.any():
            toxic[:] = True
            break
    w, b = one(np.arange(len(labels)))
    return Model(conf, w, b, words)


_fitted: dict[str, Model] = {}


def fit_once(sample: list[tuple[int, str, int]], conf: ToxicConf = ToxicConf()) -> Model:
    """The model of a sample; the same sample is fitted once in a driver's life."""
    key = hashlib.sha256(repr((conf, sorted((i, y, zlib.crc32(t.encode())) for i, t, y in sample))).encode()).hexdigest()
    if key not in _fitted:
        _fitted.clear()
        _fitted[key] = fit([t for _, t, _ in sample], [y for _, _, y in sample], conf)
    return _fitted[key]


def labelled(documents: DataFrame, labels: DataFrame, conf: ToxicConf = ToxicConf()) -> list[tuple[int, str, int]]:
    """Bounded sample of labelled documents: (doc_id, text, label).

    A document's label is the mean over annotators, nulls and draws left out. The
    sample is taken in the order of a hash of the id, the bound is a parameter.
    """
    votes = labels.filter("toxic is not null").groupBy("doc_id").agg(F.avg("toxic").alias("v")).filter("v <> 0.5").withColumn("label", (F.col("v") > 0.5).cast("int"))
    rows = votes.join(documents.select("doc_id", "text").filter("length(text) > 0"), "doc_id").select("doc_id", "text", "label")
    out = []
    for label, most in ((1, conf.positives), (0, conf.negatives)):
        out += [(r[0], r[1], r[2]) for r in rows.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).collect()]
    return out


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, source, score) for every document; null and empty texts score 0."""
    spark = documents.sparkSession
    sent = spark.sparkContext.broadcast((model.conf, model.weights.astype(np.float32), model.bias, model.words))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        mine = Model(*sent.value)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "source": b["source"], "score": [mine.score(t) for t in b["text"]]})

    cols = [F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text")]
    return spread(documents.select(*cols), "doc_id").mapInPandas(run, "doc_id long, source string, score double")


def rates_by_source(scores: DataFrame, conf: ToxicConf = ToxicConf()) -> DataFrame:
    """Documents, documents for review and their share by source; a null source is `unknown`."""
    hit = (F.col("score") >= conf.review).cast("long")
    return scores.groupBy(F.coalesce("source", F.lit("unknown")).alias("source")).agg(
        F.count("*").alias("n_docs"), F.sum(hit).alias("n_review"), F.round(F.avg(hit), 6).alias("rate")
    )

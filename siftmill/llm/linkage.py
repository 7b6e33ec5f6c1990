"""Connected components, and average-linkage clustering on a sparse similarity graph.

Clusters only merge along pairs that reach the threshold, so the graph of those pairs
falls into components that can be clustered apart: small ones inside tasks, in Arrow
batches; components above a stated size in Spark rounds, where no component is ever
brought into one task. Both merge reciprocal nearest neighbours with the same order of
ties and give the same clusters. Joins of the rounds are merge joins by hint: many small
broadcast tables in a row would fill the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, tasks


def components(edges: DataFrame) -> DataFrame:
    """(id, comp): every node of the edges (a, b long) with the least id it is connected to.

    Least labels spread along the edges, hook the labels they meet and follow the labels
    themselves, so their reach doubles with each round; it ends when no label changes. No
    edges give no rows.
    """
    pairs = edges.select("a", "b").filter("a <> b")
    both = cut(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("a"), F.min("b")).alias("comp")))
    while True:
        # Every edge tells the label of one end to the other end, and to the node that the other end is labelled with.
        at = lambda k: labels.select(F.col("id").alias(k), F.col("comp").alias(f"l{k}")).hint("merge")
        told = both.join(at("a"), "a").join(at("b"), "b").filter("lb < la").select(F.explode(F.array("a", "la")).alias("id"), F.col("lb").alias("near"))
        near = told.groupBy("id").agg(F.min("near").alias("near"))
        step = labels.join(near.hint("merge"), "id", "left").select("id", "comp", F.least("comp", "near").alias("next"))
        far = labels.select(F.col("id").alias("next"), F.col("comp").alias("far"))
        moved = cut(step.join(far.hint("merge"), "next").select("id", F.col("comp").alias("old"), F.least("next", "far").alias("comp")))
        labels = moved.select("id", "comp")
        if moved.filter("comp <> old").isEmpty():
            return labels


def linked(pairs: dict[tuple[int, int], float], threshold: float) -> dict[int, int]:
    """Average linkage in memory: member -> cluster of every node of the pairs (a, b) -> similarity."""
    links: dict[int, dict[int, float]] = {}
    for (a, b), s in pairs.items():
        links.setdefault(a, {})[b] = s
        links.setdefault(b, {})[a] = s
    size = dict.fromkeys(links, 1)
    into = {a: a for a in links}
    best: dict[int, tuple] = {}
    stale = set(links)
    while True:
        for a in stale:
            top = max(((round(s / (size[a] * size[b]), 9), -min(a, b), -max(a, b), b) for b, s in links[a].items()), default=None)
            if top and top[0] >= threshold:
                best[a] = top
            else:
                best.pop(a, None)
        merges = [(a, t[3]) for a, t in best.items() if a < t[3] and best.get(t[3], (0, 0, 0, None))[3] == a]
        if not merges:
            break
        stale = set()
        for a, b in merges:
            for c, s in links.pop(b).items():
                del links[c][b]
                if c != a:
                    links[a][c] = links[a].get(c, 0.0) + s
                    links[c][a] = links[a][c]
            size[a] += size.pop(b)
            into[b] = a
            best.pop(b, None)
            stale.add(a)
            stale.update(links[a])
        stale = {a for a in stale if a in links}
    out = {}
    for a in into:
        c = a
        while into[c] != c:
            c = into[c]
        out[a] = c
    return out


def whole(batches: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames that hold all rows of their keys, from batches sorted by the key."""
    held: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        last = b[key].iloc[-1]
        head, tail = b[b[key] != last], b[b[key] == last]
        if held and (len(head) or held[-1][key].iloc[-1] != last):
            yield pd.concat([*held, head] if len(head) else held, ignore_index=True)
            held = []
        elif len(head):
            yield head.reset_index(drop=True)
        held.append(tail)
    if held:
        yield pd.concat(held, ignore_index=True)


def by_component(rows: DataFrame, pairs_of: Callable[[object, pd.DataFrame], dict[tuple[int, int], float]], make: Callable[[], object], threshold: float, each: int) -> DataFrame:
    """(id, cluster) of components that fit a task: rows (comp, id, ...) are read component by component.

    pairs_of(state, frame) gives the similarities of one component's pairs; make() builds
    the state once a task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        state = make()
        for frame in whole(batches, "comp"):
            ids, clusters = [], []
            at = frame["comp"].to_numpy()
            bounds = [0, *(i for i in range(1, len(at)) if at[i] != at[i - 1]), len(at)]
            for i, j in zip(bounds, bounds[1:]):
                part = frame.iloc[i:j]
                got = linked(pairs_of(state, part), threshold)
                mine = part["id"].tolist()
                ids += mine
                clusters += [got.get(x, x) for x in mine]
            yield pd.DataFrame({"id": ids, "cluster": clusters}).astype("int64")

    n = tasks(rows.sparkSession, rows.count(), each)
    return rows.repartition(n, "comp").sortWithinPartitions("comp", "id").mapInPandas(run, "id long, cluster long")


def salted_join(left: DataFrame, right: DataFrame, key: str, by: str, chunk: int) -> DataFrame:
    """Inner join on a key; keys with more than `chunk` rows on the right are split by a hash
    of the right's column `by`, and the left's rows go to every part."""
    hot = right.groupBy(key).agg(F.ceil(F.count("*") / chunk).cast("int").alias("_n")).filter("_n > 1")
    parts = lambda d: d.join(hot.hint("merge"), key, "left").withColumn("_n", F.coalesce("_n", F.lit(1)))
    a = parts(left).withColumn("_s", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n")
    b = parts(right).withColumn("_s", F.pmod(F.xxhash64(by), F.col("_n")).cast("int")).drop("_n")
    return a.join(b.hint("merge"), [key, "_s"]).drop("_s")


def average_linkage(nodes: DataFrame, edges: DataFrame, threshold: float) -> DataFrame:
    """(id, cluster) for nodes (id) and edges (a, b, sim), each pair once; absent pairs count 0.

    Two clusters merge while their mean similarity reaches the threshold. Ties go to the
    lesser ids. Empty edges leave every node alone. The rounds run until no pair is left.
    """
    once = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("sim").cast("double").alias("sum")).filter("a <> b").groupBy("a", "b").agg(F.max("sum").alias("sum"))
    one = F.lit(1).cast("long")
    # Both directions of every pair, with the similarity sum over its members and both sizes.
    links = cut(once.select("a", "b", "sum", one.alias("na"), one.alias("nb")).unionByName(once.select(F.col("b").alias("a"), F.col("a").alias("b"), "sum", one.alias("na"), one.alias("nb"))))
    merged = []
    while True:
        mean = F.round(F.col("sum") / (F.col("na") * F.col("nb")), 9)
        # Equal means are ordered by the pair itself, the same for both ends, so a best pair is always reciprocal.
        order = F.struct(mean.alias("mean"), (-F.least("a", "b")).alias("lo"), (-F.greatest("a", "b")).alias("hi"))
        best = links.filter(mean >= threshold).groupBy("a").agg(F.max_by(F.struct("b", (F.col("na") + F.col("nb")).alias("n")), order).alias("m")).select("a", "m.b", "m.n")
        found = best.groupBy(F.least("a", "b").alias("into"), F.greatest("a", "b").alias("old")).agg(F.count("*").alias("ends"), F.max("n").alias("n")).filter("ends = 2")
        pairs = cut(found.select("into", "old", "n"))
        if pairs.isEmpty():
            break
        merged.append(pairs.select("old", "into"))
        to = pairs.select(F.explode(F.array(F.struct(F.col("into").alias("k"), "into", "n"), F.struct(F.col("old").alias("k"), "into", "n"))).alias("x")).select("x.k", "x.into", "x.n")
        ta, tb = to.toDF("a", "ia", "sa"), to.toDF("b", "ib", "sb")
        moved = links.join(ta.hint("merge"), "a", "left").join(tb.hint("merge"), "b", "left").select(
            F.coalesce("ia", "a").alias("a"), F.coalesce("ib", "b").alias("b"), "sum", F.coalesce("sa", "na").alias("na"), F.coalesce("sb", "nb").alias("nb")
        )
        links = cut(moved.filter("a <> b").groupBy("a", "b").agg(F.sum("sum").alias("sum"), F.max("na").alias("na"), F.max("nb").alias("nb")))
    if not merged:
        return nodes.select("id", F.col("id").alias("cluster"))
    # Every merged cluster points to what it went into: follow the pointers, doubling their reach.
    moves = merged[0]
    for more in merged[1:]:
        moves = moves.unionByName(more)
    moves, reach = cut(moves), 1
    while reach < len(merged):
        moves = cut(moves.join(moves.select(F.col("old").alias("into"), F.col("into").alias("next")).hint("merge"), "into", "left").select("old", F.coalesce("next", "into").alias("into")))
        reach *= 2
    return nodes.join(moves.withColumnRenamed("old", "id").hint("merge"), "id", "left").select("id", F.coalesce("into", "id").alias("cluster"))

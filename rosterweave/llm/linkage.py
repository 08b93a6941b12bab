"""Average-linkage clustering of a thresholded similarity graph.

Clusters cannot reach beyond a connected component of the graph. The similarity of two
members, linked or not, is the cosine over all their grams. Components up to a bound are
clustered each as a dense matrix, many to a task. A larger one is merged in rounds by
joins: all pairs of clusters that are each other's nearest by average similarity merge at
once, which for average linkage gives the same tree as merging the nearest pair first, and
no component is gathered anywhere. The average similarity of two clusters is the product
of the sums of their unit vectors, divided by their sizes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rosterweave.llm.components import components
from rosterweave.llm.ngrams import GRAMS, Weights, cosine_links, shared
from rosterweave.storage import cut, discard, figure


def average_linkage(sim: np.ndarray, threshold: float) -> np.ndarray:
    """Cluster numbers of the rows of a similarity matrix, by nearest-neighbour chains; two
    clusters merge while the mean similarity of their members is at least ``threshold``."""
    n = len(sim)
    s = sim.astype(float).copy()
    np.fill_diagonal(s, -1.0)
    size, owner, alive = np.ones(n), np.arange(n), np.ones(n, bool)
    chain: list[int] = []
    done = np.zeros(n, bool)
    while True:
        if not chain:
            open_ = np.flatnonzero(alive & ~done)
            if not len(open_):
                return owner
            chain = [int(open_[0])]
        a = chain[-1]
        b = int(np.argmax(s[a]))
        if len(chain) > 1 and s[a, chain[-2]] >= s[a, b]:
            b = chain[-2]
        if s[a, b] < threshold:
            # nothing is near enough to the end of the chain, now or after other merges
            done[a] = True
            s[a, :] = s[:, a] = -1.0
            chain.pop()
        elif len(chain) > 1 and b == chain[-2]:
            chain = chain[:-2]
            merged = (size[a] * s[a] + size[b] * s[b]) / (size[a] + size[b])
            merged[(s[a] < 0) | (s[b] < 0)] = -1.0
            merged[a] = -1.0
            s[a, :] = s[:, a] = merged
            s[b, :] = s[:, b] = -1.0
            size[a] += size[b]
            alive[b] = False
            owner[owner == b] = a
        else:
            chain.append(b)


def _dense(held, threshold: float) -> Callable[[pd.DataFrame], pd.DataFrame]:  # noqa: ANN001
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        weights, rows = Weights(held.value), rows.sort_values("comp", kind="stable")
        ids, texts, comp = rows["id"].to_numpy(), rows["text"].tolist(), rows["comp"].to_numpy()
        out = ids.copy()
        bounds = [0, *(np.flatnonzero(comp[1:] != comp[:-1]) + 1).tolist(), len(ids)]
        for start, end in zip(bounds, bounds[1:], strict=False):
            nodes, vecs = ids[start:end], [weights.vector(t) for t in texts[start:end]]
            if len(nodes) == 2:
                x = {g: w for w, g in vecs[0]}
                if sum(w * x.get(g, 0.0) for w, g in vecs[1]) >= threshold:
                    out[start:end] = nodes.min()
                continue
            index: dict[int, int] = {}
            x = np.zeros((len(nodes), len({g for v in vecs for _, g in v})))
            for i, v in enumerate(vecs):
                for w, g in v:
                    x[i, index.setdefault(g, len(index))] = w
            owner = average_linkage(x @ x.T, threshold)
            low = {c: nodes[owner == c].min() for c in set(owner)}
            out[start:end] = [low[c] for c in owner]
        return pd.DataFrame({"id": ids, "cluster": out})

    return run


def _vectors(nodes: DataFrame, weights: Weights) -> DataFrame:
    """``(id, gram, x)``: the coordinates of the unit vectors of ``nodes(id, text)``."""
    held = shared(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w = Weights(held.value)
        for batch in batches:
            rows = [(i, g, x) for i, text in zip(batch["id"], batch["text"], strict=True) for x, g in w.vector(text)]
            yield pd.DataFrame(rows, columns=["id", "gram", "x"])

    return nodes.select("id", "text").mapInPandas(run, "id long, gram long, x double")


def _by_rounds(links: DataFrame, threshold: float, vectors: DataFrame | None = None, max_rounds: int = 200) -> DataFrame:
    """``(id, cluster)`` of ``links(a, b, sim)``; pairs that are not linked have similarity 0.

    With ``vectors``, a cut table ``(id, gram, x)`` of unit vectors, every pair has the cosine
    of its vectors, and ``links`` are all pairs of one component from ``threshold`` on. They
    suffice to start from: a merged cluster is never nearer to another than the nearer of its
    parts, so a pair of clusters at the threshold stems from a pair at the threshold.
    """
    nodes = links.select(F.explode(F.array("a", "b")).alias("id")) if vectors is None else vectors.select("id")
    member = cut(nodes.distinct().select("id", F.col("id").alias("cluster")), "member")
    between = cut(links.select("a", "b", F.col("sim").alias("total")), "between")
    for _ in range(max_rounds):
        size = member.groupBy("cluster").count()
        mean = between.join(size.select(F.col("cluster").alias("a"), F.col("count").alias("na")), "a").join(size.select(F.col("cluster").alias("b"), F.col("count").alias("nb")), "b")
        mean = mean.withColumn("mean", F.col("total") / (F.col("na") * F.col("nb"))).where(F.col("mean") >= threshold)
        both = mean.select("a", "b", "mean").unionByName(mean.select(F.col("b").alias("a"), F.col("a").alias("b"), "mean"))
        # ties go by a hash of the pair, which both ends see alike, so that equal links still pair up
        tie = F.xxhash64(F.least("a", "b"), F.greatest("a", "b"))
        best = both.groupBy("a").agg(F.max_by("b", F.struct("mean", tie.alias("t"))).alias("b"))
        merge = cut(best.join(best.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"]).where("a < b").select(F.col("b").alias("cluster"), F.col("a").alias("into")), "merge")
        if merge.isEmpty():
            return member
        moved = cut(member.join(merge, "cluster", "left").select("id", F.coalesce("into", "cluster").alias("cluster")), "member")
        step = between if vectors is None else mean.select("a", "b", "total")
        for end in ("a", "b"):
            step = step.join(merge.select(F.col("cluster").alias(end), F.col("into").alias("_i")), end, "left").withColumn(end, F.coalesce("_i", end)).drop("_i")
        step = step.where("a <> b").groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("total").alias("total"))
        if vectors is not None:
            sums = cut(moved.join(vectors, "id").groupBy("cluster", "gram").agg(F.sum("x").alias("x")), "sums")
            of = lambda end: sums.select(F.col("cluster").alias(end), "gram", F.col("x").alias(f"x{end}"))
            step = step.select("a", "b").join(of("a"), "a").join(of("b"), ["b", "gram"]).groupBy("a", "b").agg(F.sum(F.col("xa") * F.col("xb")).alias("total"))
        joined = cut(step, "between")
        discard(member), discard(between), discard(merge)
        if vectors is not None:
            discard(sums)
        member, between = moved, joined
    raise RuntimeError(f"linkage did not settle in {max_rounds} rounds")


def cluster(nodes: DataFrame, weights: Weights, links: DataFrame, threshold: float, dense_nodes: int = 1500, nodes_per_task: int = 20_000) -> DataFrame:
    """``(id, cluster)`` for every node that has a link; ``cluster`` is its least id.

    ``nodes`` has ``(id, text)``, ``links`` is a cut table ``(a, b)`` of pairs. Clusters lie
    within the components of the links, and within those every pair counts by its cosine,
    linked or not. Components of more than ``dense_nodes`` nodes are merged in rounds, which
    begin with all their pairs at the threshold, with the same result.
    """
    comp = cut(components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))).select(F.col("node").alias("id"), F.col("group_id").alias("comp")), "comp")
    sized = cut(comp.groupBy("comp").count(), "sizes", most=F.max("count"))
    total, most = figure(comp, "rows"), figure(sized, "most") or 0
    texts = nodes.select("id", "text")
    middle = comp if most <= dense_nodes else comp.join(sized.where(F.col("count") <= dense_nodes), "comp")
    tasks = max(12, total // nodes_per_task)
    out = middle.join(texts, "id").select("id", "text", "comp", F.pmod(F.xxhash64("comp"), F.lit(tasks)).alias("_t")).groupBy("_t").applyInPandas(_dense(shared(weights), threshold), "id long, cluster long")
    if most > dense_nodes:
        large = cut(comp.join(sized.where(F.col("count") > dense_nodes), "comp").join(texts, "id").select("id", "comp", "text"), "large")
        inside = cut(cosine_links(large.select("id", F.col("comp").cast("string").alias("block"), "text"), shared(weights), threshold, near=False, sizes=GRAMS), "inside")
        out = out.unionByName(_by_rounds(inside, threshold, cut(_vectors(large, weights), "vectors")))
    return out

"""Pairs of names of one phone that are nearly the same.

The names of a phone are compared all with all, as rows of a join where they are few. Those of
a crowded phone are cut into blocks, and each pair of blocks is one group: the letters two
names can have in common at most are one product of matrices, which leaves few pairs for the
common subsequence itself. No pair is lost by that, as the bound is never too low.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rosterweave.functions.text import _lcs, indel_ratio, may_reach
from rosterweave.operators.joins import bounded_broadcast
from rosterweave.storage import cut, figure

BLOCK = 4096
# Letters and two-grams are counted in so many buckets, letters up to so often.
LETTERS, OFTEN, GRAMS = 48, 4, 128
CHUNK, MANY = 1024, 1 << 16


def _bucket(x: str) -> int:
    return ord(x) % LETTERS


def _counts(names: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """How often each name has the letters and the two-grams of each bucket."""
    letters, grams = np.zeros((len(names), LETTERS), np.int32), np.zeros((len(names), GRAMS), np.uint8)
    for i, n in enumerate(names):
        for x in n:
            letters[i, _bucket(x)] += 1
        for p, q in zip("^" + n, n + "$", strict=True):
            g = (ord(p) * 31 + ord(q)) % GRAMS
            grams[i, g] = min(int(grams[i, g]) + 1, 255)
    return letters, grams


def _candidates(left: list[str], right: list[str], threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs that may reach ``threshold``: their letters in common, and then their
    two-grams, are as many as a common subsequence of that length needs."""
    (la, ga), (lb, gb) = _counts(left), _counts(right)
    na, nb = la.sum(1), lb.sum(1)

    def vectors(counts: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        unary = (counts[:, :, None] > np.arange(OFTEN)).reshape(len(n), -1)
        beyond = n - unary.sum(1)  # of two names the lesser counts, which half of both bounds
        return unary.astype(np.float32), (beyond / 2 - threshold * n / 200).astype(np.float32)[:, None]

    (ua, wa), (ub, wb) = vectors(la, na), vectors(lb, nb)
    a, b = np.hstack([ua, wa, np.ones_like(wa)]), np.hstack([ub, np.ones_like(wb), wb]).T
    slack = 0.05 + 1e-6 * float(max(na.max(), nb.max()))  # for rounding in single precision
    capped = max(int(ga.max()), int(gb.max())) == 255
    for at in range(0, len(left), CHUNK):
        i, j = np.nonzero(a[at : at + CHUNK] @ b >= -slack)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), MANY):
            x, y = i[k : k + MANY], j[k : k + MANY]
            common = np.ceil(threshold * (na[x] + nb[y]) / 200 - 1e-9).astype(np.int64)
            lost_a, lost_b = na[x] - common, nb[y] - common
            least = np.maximum(na[x] + 1 - 2 * lost_a - lost_b, nb[y] + 1 - 2 * lost_b - lost_a)
            keep = np.full(len(x), True) if capped else np.minimum(ga[x], gb[y]).sum(1, dtype=np.int64) >= least
            yield x[keep], y[keep]


def _compare(threshold: float) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(group: pd.DataFrame) -> pd.DataFrame:
        first, second = int(group["bi"].iloc[0]), int(group["bj"].iloc[0])
        side = lambda k: group[group["block"] == k]
        one, two = side(first), side(second)
        left, right, ia, ib = one["name"].tolist(), two["name"].tolist(), one["ix"].tolist(), two["ix"].tolist()
        out = []
        if left and right:
            for xs, ys in _candidates(left, right, threshold, first == second):
                for x, y in zip(xs.tolist(), ys.tolist(), strict=True):
                    p, q = left[x], right[y]
                    both = len(p) + len(q)
                    score = 200.0 * _lcs(p, q) / both if both else 100.0
                    if score >= threshold:
                        out.append((p, q, ia[x], ib[y], score) if p < q else (q, p, ib[y], ia[x], score))
        return pd.DataFrame(out, columns=["na", "nb", "ia", "ib", "score"])

    return run


def near_names(names: DataFrame, threshold: float = 85.0, hot: int = 256) -> DataFrame:
    """``(na, nb, ia, ib, score)``: pairs of different names of one phone whose ratio is at least
    ``threshold``, each once. ``names`` is a cut table ``(phone, name, ix)`` without repeats.

    The names of a phone that has more than ``hot`` are compared in blocks of about
    ``BLOCK``, so a crowded phone is as many groups as it has pairs of blocks.
    """
    n = F.ceil(F.col("n") / BLOCK).cast("int")
    sizes = names.groupBy("phone").agg(F.count("*").alias("n")).where(F.col("n") > hot).select("phone", n.alias("blocks"))
    crowd = cut(sizes, "crowd", groups=F.sum((F.col("blocks") * (F.col("blocks") + 1) / 2).cast("long")))
    few = names.join(bounded_broadcast(crowd), "phone", "left_anti")
    a, b = (few.select("phone", F.col("name").alias(f"n{x}"), F.col("ix").alias(f"i{x}")) for x in "ab")
    met = a.join(b, "phone").where("na < nb").where(may_reach(F.col("na"), F.col("nb"), threshold)).select("na", "nb", "ia", "ib").distinct()
    near = met.withColumn("score", indel_ratio(F.col("na"), F.col("nb"))).where(F.col("score") >= threshold)
    if not figure(crowd, "rows"):
        return near
    mine = F.pmod(F.xxhash64("name"), "blocks").cast("int")
    placed = names.join(bounded_broadcast(crowd), "phone").withColumn("block", mine)
    placed = placed.select("phone", "name", "ix", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    placed = placed.select("phone", F.least("block", "other").alias("bi"), F.greatest("block", "other").alias("bj"), "block", "name", "ix")
    spread = placed.repartition(min(int(figure(crowd, "groups")), 2000), "phone", "bi", "bj")
    dense = spread.groupBy("phone", "bi", "bj").applyInPandas(_compare(threshold), "na string, nb string, ia long, ib long, score double")
    return near.unionByName(dense).distinct()

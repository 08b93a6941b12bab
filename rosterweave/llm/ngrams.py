"""Weighted character n-gram vectors and the sparse cosine join within blocks."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rosterweave.operators.joins import bounded_broadcast
from rosterweave.storage import cut, figure

BUCKETS = 1 << 18
GRAMS = (2, 3)
LINK_GRAMS = (3,)
SIGNS, TURN = 64, 1 << 63  # the signs of a tail fit a long when they are shifted, which turns the highest bit over
LOCAL = 4096  # nodes of a block up to which one task compares them
DENSE = 256  # and up to which it does so as a dense matrix
POSTED = {"gram": pa.int32(), "x": pa.float32(), "norm": pa.float32(), "top": pa.float32(), "more": pa.int16(), "signs": pa.int64()}
CROWD = 16_384  # nodes of a gram in one block from which its pairs are spread over tasks


def gram_buckets(text: str, sizes: tuple[int, ...] = GRAMS) -> list[int]:
    """Buckets of the distinct grams of a text with marked ends."""
    t = f"^{text}$"
    if t.isascii():
        t = t.encode()
        return sorted({zlib.crc32(t[i : i + k]) % BUCKETS for k in sizes for i in range(max(1, len(t) - k + 1))})
    return sorted({zlib.crc32(t[i : i + k].encode()) % BUCKETS for k in sizes for i in range(max(1, len(t) - k + 1))})


class Weights:
    """Weight of each gram bucket: 1 + ln(N / df) / ln N over all nodes, so that rare grams
    lead without outweighing the rest of a name that has a typing error. The number of
    buckets bounds what travels to the executors, whatever the alphabet."""

    def __init__(self, w: np.ndarray) -> None:
        self.w = w
        self.listed: list[float] = []  # single numbers are read faster from a list

    @staticmethod
    def counted(df: dict[int, int], total: int) -> Weights:
        w = np.full(BUCKETS, 2.0, np.float32)
        for bucket, n in df.items():
            w[bucket] = 1 + math.log(max(1.0, total / n)) / math.log(max(2, total))
        return Weights(w)

    def vector(self, text: str, sizes: tuple[int, ...] = GRAMS) -> list[tuple[float, int]]:
        """``(weight, bucket)`` of unit length, heaviest first, equal weights by bucket, which is
        one order for all texts."""
        self.listed = w = self.listed or self.w.tolist()
        raw = [(w[b], b) for b in gram_buckets(text, sizes)]
        norm = math.sqrt(sum(w * w for w, _ in raw))
        return sorted(((w / norm, b) for w, b in raw), reverse=True)


def _buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = np.fromiter((b for t in batch["text"] for b in gram_buckets(t)), np.int64)
        bucket, n = np.unique(found, return_counts=True)
        yield pd.DataFrame({"b": bucket, "n": n})


def gram_weights(nodes: DataFrame) -> Weights:
    """Weights from all texts of ``(text)``, tables cut before; counted in the batches first."""
    rows = nodes.select("text").mapInPandas(_buckets, "b long, n long").groupBy("b").agg(F.sum("n").alias("n")).collect()
    return Weights.counted({r.b: r.n for r in rows}, nodes.count())


def cosine_at(held, sizes: tuple[int, ...] = LINK_GRAMS, remember: int = 20_000):  # noqa: ANN001, ANN201
    """Column function of two texts and a gram of both: their cosine if it is the first gram that
    they have in common, else null, so that a pair that meets at many grams counts at one."""

    @F.pandas_udf("double")
    def run(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        w = Weights(held.value)
        known: dict[str, dict[int, float]] = {}

        def vec(t: str) -> dict[int, float]:
            if t not in known:
                if len(known) >= remember:
                    known.clear()
                known[t] = {g: x for x, g in w.vector(t, sizes)}
            return known[t]

        for a, b, gram in batches:
            out = []
            for x, y, at in zip(a, b, gram, strict=True):
                p, q = vec(x), vec(y)
                if len(q) < len(p):
                    p, q = q, p
                # grams have one order in all vectors
                first = next((g for g in p if g in q), None)
                out.append(sum(v * q.get(g, 0.0) for g, v in p.items()) if first == at else None)
            yield pd.Series(out, dtype="float64")

    return run.asNondeterministic()  # else it may move below the test


def shared(weights: Weights):  # noqa: ANN201
    """The array of the weights as a broadcast variable."""
    from pyspark.sql import SparkSession

    return SparkSession.getActiveSession().sparkContext.broadcast(weights.w)


def postings(nodes: DataFrame, held, threshold: float, sizes: tuple[int, ...] = LINK_GRAMS) -> DataFrame:  # noqa: ANN001
    """``(id, text, *keep, gram, x, norm, top, more, signs)`` of ``nodes(id, text, *keep)``: for each gram
    of a text that may be the first one in common with another at the threshold, its weight,
    and of the tail of lighter grams behind it the norm, the greatest weight, how many more
    grams than signs it has, and its signs.

    Grams have one order in all vectors, heaviest first. A gram is posted while its tail,
    itself included, can reach the threshold, so a pair at the threshold has its first common
    gram posted by both.
    """
    kept = nodes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, least = Weights(held.value), threshold * threshold - 1e-9
        for batch in batches:
            rows, of = [], []
            for n, text in enumerate(batch.column("text").to_pylist()):
                vector = weights.vector(text, sizes)
                sign, tail = 0, []  # signs of the tails, from the last gram on
                for _, bucket in reversed(vector):
                    tail.append(sign)
                    sign |= 1 << (bucket * 0x9E3779B1 >> 7) % SIGNS
                mass, rest, end = 1.0, len(vector), len(of)
                for at, (x, bucket) in enumerate(vector):
                    if mass < least:
                        break
                    mass, rest = max(0.0, mass - x * x), rest - 1
                    signs = tail[rest]
                    rows.append((bucket, x, math.sqrt(mass), vector[at + 1][0] if rest else 0.0, rest - signs.bit_count(), signs - TURN))
                of += [n] * (len(rows) - end)
            columns = zip(*rows, strict=True) if rows else [()] * len(POSTED)
            which = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns, POSTED.values()), *[batch.column(c).take(which) for c in kept]], names=[*POSTED, *kept])

    types = dict(nodes.dtypes)
    return nodes.mapInArrow(run, "gram int, x float, norm float, top float, more short, signs long, " + ", ".join(f"`{c}` {types[c]}" for c in kept))


def meet(left: DataFrame, right: DataFrame, held, threshold: float, crowd: int, test: Column | None = None, keep: tuple[str, ...] = (), sizes: tuple[int, ...] = LINK_GRAMS) -> DataFrame:  # noqa: ANN001
    """``(a, b, sim, *keep)``: ids of ``left`` and ``right`` with a cosine ``sim`` of their texts ``ta`` and
    ``tb`` of at least ``threshold`` for which ``test`` holds, which is looked at first; each pair
    once. Both sides are postings with a column ``block``; ``crowd`` is the greatest number of
    nodes of a block, ``keep`` are columns of ``right``.

    A pair is caught where its first common gram meets. There the cosine is at most the
    product of the two weights and what the tails can add: at most the product of their
    norms, and the number of grams they may share, as their signs tell, times their greatest
    weights. So no pair is lost. A gram that many nodes of a block have is spread over tasks.
    The texts travel with the postings: pairs that may reach the threshold grow faster than
    the rows, so they are tested where they meet, and none is written but the ones found.
    """
    keys = ["block", "gram"]
    if crowd > CROWD:
        hot = right.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > CROWD).select(*keys, F.ceil(F.col("n") / CROWD).cast("int").alias("parts"))
        hot = bounded_broadcast(cut(hot, "hot"))
        parts = lambda df: df.join(hot, keys, "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        left = parts(left).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        right = parts(right).withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int"))
        keys = [*keys, "part"]
    measures = ("x", "norm", "top", "more", "signs")
    side = lambda df, end, *more: df.select(*keys, F.col("id").alias(end), F.col("text").alias(f"t{end}"), *[F.col(c).alias(f"{c}_{end}") for c in measures], *more)
    signs = lambda end: F.col(f"signs_{end}").bitwiseXOR(F.lit(-TURN))
    common = F.bit_count(signs("a").bitwiseAND(signs("b")))
    most = F.col("x_a") * F.col("x_b") + F.least(F.col("norm_a") * F.col("norm_b"), (common + F.least("more_a", "more_b")) * F.col("top_a") * F.col("top_b"))
    met = side(left, "a").join(side(right, "b", *keep), keys).where("a <> b").where(most >= threshold - 1e-5)
    if test is not None:
        met = met.where(test)
    return met.withColumn("sim", cosine_at(held, sizes)("ta", "tb", "gram")).where(F.col("sim") >= threshold).select("a", "b", "sim", *keep)


def crowd_of(nodes: DataFrame, *block: str) -> int:
    return nodes.groupBy(*block).count().agg(F.max("count")).first()[0] or 0


NEAR = "levenshtein(ta, tb, 1 + greatest(length(ta), length(tb)) div 3) >= 0"


def _over(vectors: list[list[tuple[float, int]]], least: float) -> Iterator[tuple[int, int]]:
    """Numbers i < j of the vectors whose product is at least ``least``, as far as single
    precision tells; ``least`` has room for that."""
    n, index = len(vectors), {}
    row = np.repeat(np.arange(n), [len(v) for v in vectors])
    col = np.array([index.setdefault(g, len(index)) for v in vectors for _, g in v])
    x = np.array([w for v in vectors for w, _ in v], np.float32)
    if n <= DENSE:
        dense = np.zeros((n, len(index)), np.float32)
        dense[row, col] = x
        yield from zip(*(at.tolist() for at in np.nonzero(np.triu(dense @ dense.T, 1) >= least)), strict=True)
        return
    order = np.argsort(col, kind="stable")
    ends = np.searchsorted(col[order], np.arange(1, len(index)))
    members, weights = np.split(row[order], ends), np.split(x[order], ends)
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]).tolist()
    for i, (start, end) in enumerate(zip(starts, [*starts[1:], len(row)], strict=True)):
        grams = col[start:end].tolist()
        dots = np.bincount(np.concatenate([members[g] for g in grams]), np.concatenate([weights[g] * w for g, w in zip(grams, x[start:end], strict=True)]), n)
        for j in (np.flatnonzero(dots[i + 1 :] >= least) + i + 1).tolist():
            yield i, j


def _within(nodes: DataFrame, held, threshold: float, sizes: tuple[int, ...], nodes_per_task: int = 20_000) -> DataFrame:  # noqa: ANN001
    """``(a, b, ta, tb, sim)``: as :func:`meet`, for blocks of which each fits one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = list(batches)
        if not got:
            return
        rows, w = pd.concat(got).sort_values(["block", "id"]), Weights(held.value)
        for _, own in rows.groupby("block", sort=False):
            if len(own) < 2:
                continue
            ids, texts, out = own["id"].tolist(), own["text"].tolist(), []
            vectors = [w.vector(t, sizes) for t in texts]
            known = [{g: x for x, g in v} for v in vectors]
            for i, j in _over(vectors, threshold - 1e-4):
                p, q = (known[j], known[i]) if len(known[j]) < len(known[i]) else (known[i], known[j])
                sim = sum(v * q.get(g, 0.0) for g, v in p.items())
                if sim >= threshold:
                    out.append((ids[i], ids[j], texts[i], texts[j], sim))
            if out:
                yield pd.DataFrame(out, columns=["a", "b", "ta", "tb", "sim"])

    tasks = max(12, (figure(nodes, "rows") or nodes.count()) // nodes_per_task)
    return nodes.select("id", "block", "text").repartition(tasks, "block").mapInPandas(run, "a long, b long, ta string, tb string, sim double")


def cosine_links(nodes: DataFrame, held, threshold: float, near: bool = True, sizes: tuple[int, ...] = LINK_GRAMS) -> DataFrame:  # noqa: ANN001
    """``(a, b, sim)``: all pairs of nodes of one block, a < b, with a cosine over grams of
    ``sizes`` of at least ``threshold`` and, if ``near``, at most one edit and a third of the longer text between
    them: texts with syllables in common that are no spellings of one name are further apart.

    ``nodes`` is a cut table ``(id, block, text)`` with ids of type long. A block of at most
    ``LOCAL`` nodes is compared in one task, where a pair costs little; the pairs of larger
    blocks are spread over tasks by their grams, with the same result.
    """
    most = crowd_of(nodes, "block")
    small = nodes
    if most > LOCAL:
        large = cut(nodes.groupBy("block").count().where(F.col("count") > LOCAL).select("block"), "large_blocks")
        small = nodes.join(bounded_broadcast(large), "block", "left_anti")
    found = _within(small, held, threshold, sizes)
    found = (found.where(NEAR) if near else found).select("a", "b", "sim")
    if most <= LOCAL:
        return found
    posted = postings(nodes.join(bounded_broadcast(large), "block", "left_semi").select("id", F.xxhash64("block").alias("block"), "text"), held, threshold, sizes)
    test = F.expr(f"a < b and {NEAR}") if near else F.expr("a < b")
    return found.unionByName(meet(posted, posted, held, threshold, most, test, sizes=sizes))


def linked(nodes: DataFrame, threshold: float) -> tuple[Weights, DataFrame]:
    """The weights of the nodes and their links as a cut table."""
    weights = gram_weights(nodes)
    return weights, cut(cosine_links(nodes, shared(weights), threshold), "links")

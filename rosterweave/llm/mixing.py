"""Mixing sources to target weights by Pareto order sampling.

The mix is as large as the caps on repetition allow all targets to be met (or as large as
asked). A source gets as many whole copies as fit into its target; the rest is a sample
without replacement: each document has an inclusion probability that grows with its size,
documents whose probability reaches one are certain, and the others are ranked by random
odds divided by inclusion odds. The sample is the head of that order, of fixed size in
tokens. The cut of the order is found by refining histograms of the rank variable, so no
source is ever sorted or gathered, however large its part of the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from rosterweave.storage import cut


def _odds_rank(seed: int):  # noqa: ANN202
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col("_id")), 11).cast("double") + 0.5) / float(1 << 53)
    p = F.col("_p")
    return F.log(u / (1 - u)) - F.log(p / (1 - p))


def mix(docs: DataFrame, targets: DataFrame, total_tokens: int | None = None, seed: int = 7, size_power: float = 0.5, bins: int = 512, rounds: int = 64) -> tuple[DataFrame, DataFrame]:
    """The mix ``(doc_id, source, n_tokens, copies)`` and its report.

    ``docs`` is ``(doc_id, source, n_tokens)`` with distinct ids, ``targets`` the short list
    ``(source, target_share, max_repeats)``. Documents of other sources, of a null source
    and without tokens are not used. A target source without a document is reported with 0,
    and the shares of the others keep their proportion. The report is ``(source,
    target_share, available_tokens, target_tokens, mixed_tokens, actual_share, documents,
    most_copies)``. The same seed gives the same mix whatever the order of the rows.
    """
    spark = docs.sparkSession
    goal = {r.source: (float(r.target_share), int(r.max_repeats)) for r in targets.collect() if r.source is not None and r.target_share and r.max_repeats}
    used = cut(docs.where(F.col("source").isin(*goal) & (F.col("n_tokens") > 0)).select(F.col("doc_id").alias("_id"), "source", F.col("n_tokens").cast("long").alias("_n")), "sized") if goal else docs.limit(0).select(F.col("doc_id").alias("_id"), "source", F.col("n_tokens").alias("_n"))
    have = {r.source: r.t for r in used.groupBy("source").agg(F.sum("_n").alias("t")).collect()}
    share = {s: goal[s][0] for s in have}
    scale = sum(share.values()) or 1.0
    share = {s: v / scale for s, v in share.items()}
    most = min((goal[s][1] * have[s] / share[s] for s in have), default=0.0)
    size = most if total_tokens is None else min(most, float(total_tokens))
    plan = {}
    for s in have:
        want = min(share[s] * size, float(goal[s][1] * have[s]))
        copies = int(want / have[s] + 1e-9)
        plan[s] = (copies, max(0.0, want - copies * have[s]), want)

    # inclusion probability factor * size ** power, one for those that reach it
    factor, limit, sure = {}, {s: math.inf for s in have}, {s: 0.0 for s in have}
    for _ in range(200):
        caps = _literal(spark, {s: (limit[s],) for s in have}, ("_limit",))
        sums = {r.source: r for r in used.join(F.broadcast(caps), "source").groupBy("source").agg(F.sum(F.when(F.col("_n") < F.col("_limit"), F.pow(F.col("_n").cast("double"), 1 + size_power))).alias("m"), F.sum(F.when(F.col("_n") >= F.col("_limit"), F.col("_n"))).alias("sure")).collect()} if have else {}
        settled = True
        for s in have:
            left = plan[s][1] - float(sums[s].sure or 0)
            factor[s] = max(0.0, left) / sums[s].m if sums[s].m else 0.0
            at = (1 / factor[s]) ** (1 / size_power) if factor[s] else math.inf
            if left > 0 and at < limit[s] - 1e-9 and math.ceil(at) < limit[s]:
                limit[s], settled = float(math.ceil(at)), False
        if settled:
            break
    else:
        raise RuntimeError("the inclusion probabilities did not settle")
    p = F.when(F.col("_n") >= F.col("_limit"), F.lit(1.0)).otherwise(F.col("_factor") * F.pow(F.col("_n").cast("double"), size_power))
    params = _literal(spark, {s: (limit[s], factor[s]) for s in have}, ("_limit", "_factor"))
    keyed = used.join(F.broadcast(params), "source").withColumn("_p", F.least(p, F.lit(1.0)))
    low, high = -2000.0, 2000.0
    rank = F.when(F.col("_p") >= 1.0, F.lit(low)).when(F.col("_p") <= 0.0, F.lit(high)).otherwise(_odds_rank(seed))
    ranked = cut(keyed.select("_id", "source", "_n", rank.alias("_q")), "ranked")

    span = {s: [low, high, 0.0] for s in have}  # the crossing lies in [low, high); tokens before low
    ends: dict[str, float] = {s: (low if plan[s][1] <= 0 else math.nan) for s in have}
    for _ in range(rounds):
        open_ = {s: (span[s][0], span[s][1]) for s in have if math.isnan(ends[s])}
        if not open_:
            break
        at = F.floor((F.col("_q") - F.col("_lo")) / ((F.col("_hi") - F.col("_lo")) / bins))
        inside = ranked.join(F.broadcast(_literal(spark, open_, ("_lo", "_hi"))), "source").where("_q >= _lo and _q < _hi")
        found: dict[str, list] = {}
        for r in inside.groupBy("source", F.least(at, F.lit(bins - 1)).alias("k")).agg(F.sum("_n").alias("t"), F.min("_q").alias("first"), F.max("_q").alias("last"), F.count("*").alias("n")).collect():
            found.setdefault(r.source, []).append(r)
        for s, (lo, hi) in open_.items():
            before = span[s][2]
            ends[s] = hi
            for r in sorted(found.get(s, []), key=lambda r: r.k):
                if before + r.t > plan[s][1]:
                    if r.n == 1 or r.first == r.last:
                        take = before + r.t - plan[s][1] < plan[s][1] - before
                        ends[s] = math.nextafter(r.last, math.inf) if take else r.first
                    else:
                        span[s], ends[s] = [r.first, math.nextafter(r.last, math.inf), before], math.nan
                    break
                before += r.t
    if unsettled := [s for s in have if math.isnan(ends[s])]:
        raise RuntimeError(f"the cut of the order was not found for {unsettled}")
    final = _literal(spark, {s: (float(plan[s][0]), ends[s]) for s in have}, ("_copies", "_end"))
    mixed = ranked.join(F.broadcast(final), "source").withColumn("copies", (F.col("_copies") + F.when(F.col("_q") < F.col("_end"), 1).otherwise(0)).cast("int"))
    mixed = mixed.where("copies > 0").select(F.col("_id").alias("doc_id"), "source", F.col("_n").alias("n_tokens"), "copies")
    rows = [(s, goal[s][0], int(have.get(s, 0)), float(plan[s][2]) if s in plan else 0.0) for s in goal]
    asked = spark.createDataFrame(rows, "source string, target_share double, available_tokens long, target_tokens double")
    got = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("copies")).alias("mixed"), F.count("*").alias("documents"), F.max("copies").alias("most_copies"))
    report = asked.join(got, "source", "left").withColumn("_all", F.sum("mixed").over(_everything()))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    report = report.select("source", "target_share", "available_tokens", F.round("target_tokens", 3).alias("target_tokens"), zero("mixed").cast("long").alias("mixed_tokens"), F.round(F.coalesce(F.col("mixed") / F.col("_all"), F.lit(0.0)), 6).alias("actual_share"), zero("documents").cast("long").alias("documents"), zero("most_copies").cast("int").alias("most_copies"))
    return mixed, report


def _everything():  # noqa: ANN202
    """Window over the report, which has one row for each target source."""
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(1))


def _literal(spark, rows: dict[str, tuple], names: tuple[str, ...]) -> DataFrame:  # noqa: ANN001
    schema = "source string, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame([(s, *map(float, v)) for s, v in rows.items()], schema)

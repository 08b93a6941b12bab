"""Best representative of each duplicate group: Bayesian fusion with copy detection.

Each usable value of a field is a claim of its source. Rounds estimate, from aggregates
only, (1) the posterior of every claimed value from the votes of its sources, weighted by
their accuracy, (2) the accuracy of every source from the posteriors of what it claims, and
(3) for every pair of sources the probability that one copies the other: sharing values of
low posterior is evidence for copying, sharing true ones hardly is. A vote is discounted
where a more accurate supporter of the same value is probably its origin. Values that no
other value contests count by the set of their sources, of which there are few.

The surviving value has the greatest posterior. Its log odds are the votes and a prior of
recency: the data state that people's current values are the latest ones, so a value that
the latest claim of the field does not make is behind by more than all votes can weigh.
Votes decide between values claimed at the latest moment.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterweave.storage import cut, discard, figure

# Texts that stand for a missing value, name a field or the document, or are tests.
STAND_INS = (
    "-", "--", "---", ".", "..", "...", "?", "??", "???", "x", "xx", "xxx", "n/a", "na", "n.a.", "n.a", "nil", "none", "null", "nan",
    "unknown", "unspecified", "undefined", "tbd", "tbc", "tba", "to be added", "to be confirmed", "to be announced", "not given",
    "not available", "not applicable", "not provided", "not specified", "not stated", "no name", "noname", "no city", "no headline", "name withheld", "withheld",
    "missing", "empty", "blank", "see resume", "see cv", "see above", "asdf", "test", "test test", "testing", "test user", "test candidate", "test entry", "dummy", "sample",
    "name", "full name", "fullname", "candidate", "candidate name", "unknown candidate", "applicant", "unknown applicant", "anonymous", "anonymous candidate",
    "resume", "résumé", "cv", "curriculum vitae", "curriculum", "lebenslauf", "document", "untitled", "headline", "title", "job title", "summary",
    "city", "town", "location", "country", "first last", "firstname lastname", "first name", "last name", "vacant", "confidential",
)
FIELDS = ("full_name", "headline", "years_experience", "location_city")


def squeezed(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"[\s ]+", " "), r"^ | $", "")


def bare(s: Column) -> Column:
    """A squeezed text without brackets and punctuation around it."""
    return F.regexp_replace(s, r"^[\s\[({<*_\"'.:-]+|[\s\])}>*_\"'.:-]+$", "")


def usable_text(s: Column, b: Column) -> Column:
    """True if a text, squeezed and bare, is neither blank nor a stand-in, a field or
    document name, or a test entry."""
    known = F.lit(list(STAND_INS))
    return F.coalesce(~F.array_contains(known, s) & ~F.array_contains(known, b) & s.rlike(r"\p{L}") & ~s.rlike(r"^(applicant|candidate|test|user|person|sample|dummy)[ _#-]*(no\.? ?)?\d*$"), F.lit(False))


def usable_years(c: Column) -> Column:
    return F.coalesce(~F.isnan(c) & c.between(0.0, 60.0), F.lit(False))


def claims_of(rows: DataFrame) -> DataFrame:
    """``(group_id, field_name, value, profile_id, src, ts)``: one row for each usable value."""
    fields = F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("shown")) for f in FIELDS])
    raw = rows.select("group_id", "profile_id", F.coalesce("src_file", F.lit("")).alias("src"), F.col("updated_at").alias("ts"), F.explode(fields).alias("c")).select("group_id", "c.*", "profile_id", "src", "ts").where("shown is not null")
    texts = raw.withColumn("value", squeezed(F.col("shown"))).withColumn("bare", bare(F.col("value")))
    number = F.expr("try_cast(shown as double)")
    good = F.when(F.col("field_name") == "years_experience", usable_years(number)).otherwise(usable_text(F.col("value"), F.col("bare")))
    return texts.where(good).select("group_id", "field_name", "value", "shown", "profile_id", "src", "ts")


SOURCE_PAIRS = 2_000_000  # pairs of sources with a value in common, whose statistics the driver holds


def _votes(accuracy: dict[str, float], copying: dict[tuple[str, str], float], wrong: int):  # noqa: ANN202
    """Column function of a set of sources: the sum of their discounted votes."""
    spark = SparkSession.getActiveSession()
    held = spark.sparkContext.broadcast((accuracy, copying))

    def run(sets: pd.Series) -> pd.Series:
        acc, copied = held.value
        known: dict[tuple, float] = {}

        def weight(sources: tuple) -> float:
            total, ranked = 0.0, sorted(sources, key=lambda s: (-acc[s], s))
            for at, s in enumerate(ranked):
                vote = math.log(wrong * acc[s] / (1 - acc[s]))
                for o in ranked[:at]:
                    vote *= 1 - 0.8 * copied.get((min(s, o), max(s, o)), 0.0)
                total += vote
            return total

        out = []
        for sources in map(tuple, sets):
            if sources not in known:
                known[sources] = weight(sources)
            out.append(known[sources])
        return pd.Series(out, dtype="float64")

    return F.pandas_udf(run, "double")


def _posteriors(values: DataFrame, votes, key: list[str], wrong: int, bound: float, prior: Column | None = None) -> DataFrame:  # noqa: ANN001
    """``values`` with ``weight`` and ``posterior`` among the values of their key, with room for
    ``wrong`` values that nobody claims. ``values`` has its number per key as ``n``; no weight
    is beyond ``bound``, and where that leaves the range of numbers, weights are taken from
    the greatest of their key."""
    voted = values.withColumn("weight", votes("srcs"))
    voted = voted if prior is None else voted.withColumn("weight", F.col("weight") + prior)
    if bound < 600:
        voted = voted.withColumn("_top", F.lit(0.0))
    else:
        voted = voted.join(voted.groupBy(*key).agg(F.max("weight").alias("_top")), key)
    mass = voted.withColumn("_e", F.exp(F.col("weight") - F.col("_top")))
    unseen = F.greatest(F.lit(wrong + 1) - F.first("n"), F.lit(0)) * F.exp(F.least(-F.first("_top"), F.lit(700.0)))
    base = mass.groupBy(*key).agg((F.sum("_e") + unseen).alias("_all"))
    return mass.join(base, key).withColumn("posterior", F.col("_e") / F.col("_all")).drop("_top", "_e", "_all")


def _bound(accuracy: dict[str, float], wrong: int) -> float:
    """What all votes together cannot exceed, for or against."""
    return 1 + sum(abs(math.log(wrong * a / (1 - a))) for a in accuracy.values())


def _sources(contested: DataFrame, alone: DataFrame, wrong: int, prior_copy: float, max_rounds: int, tolerance: float) -> tuple[dict, dict]:
    """Accuracy of each source and probability of copying of each pair, in rounds until no
    accuracy moves by ``tolerance``. ``contested`` are values ``(*key, value, srcs, n)`` beside
    others of their key, ``alone`` the sets ``(srcs, times)`` of the sources of the other values."""
    key = ["group_id", "field_name"]
    pairs = lambda c: F.flatten(F.transform(c, lambda a: F.transform(F.filter(c, lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    every = contested.select("srcs", F.lit(1).cast("long").alias("times")).unionByName(alone.select("srcs", "times"))
    accuracy = {r.src: 0.8 for r in every.select(F.explode("srcs").alias("src")).distinct().collect()}
    # how often two sources speak about one field of one group
    met = contested.groupBy(*key).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("srcs")))).alias("srcs")).select("srcs", F.lit(1).cast("long").alias("times"))
    met = met.unionByName(alone.select("srcs", "times")).where("size(srcs) > 1").select(F.explode(pairs(F.col("srcs"))).alias("p"), "times").groupBy("p.a", "p.b").agg(F.sum("times").alias("n"))
    met = cut(met, "met")
    if figure(met, "rows") > SOURCE_PAIRS:
        raise ValueError(f"{figure(met, 'rows')} pairs of sources are more than the driver holds")
    together = {(r.a, r.b): r.n for r in met.collect()}
    copying: dict[tuple[str, str], float] = {}
    for turn in range(max_rounds):
        votes = _votes(accuracy, copying, wrong)
        fought = _posteriors(contested, votes, key, wrong, _bound(accuracy, wrong)).select("srcs", F.lit(1).cast("long").alias("times"), "posterior")
        lone = alone.withColumn("weight", votes("srcs")).select("srcs", "times", (1 / (1 + wrong * F.exp(-F.col("weight")))).alias("posterior"))
        scored = cut(fought.unionByName(lone), "scored")
        said = scored.select(F.explode("srcs").alias("src"), "times", "posterior").groupBy("src").agg((F.sum(F.col("times") * F.col("posterior")) / F.sum("times")).alias("a"))
        now = {r.src: min(0.99, max(0.05, r.a)) for r in said.collect()}
        moved = max((abs(now[s] - accuracy[s]) for s in now), default=0.0)
        accuracy = now if turn < 5 else {s: (now[s] + accuracy[s]) / 2 for s in now}
        shared = scored.where("size(srcs) > 1").select(F.explode(pairs(F.col("srcs"))).alias("p"), "times", "posterior").groupBy("p.a", "p.b").agg(F.sum(F.col("times") * F.col("posterior")).alias("t"), F.sum(F.col("times") * (1 - F.col("posterior"))).alias("f"))
        copying = {(r.a, r.b): _dependence(r.t, r.f, max(0.0, together.get((r.a, r.b), 0) - r.t - r.f), (accuracy[r.a] + accuracy[r.b]) / 2, wrong, prior_copy) for r in shared.collect()}
        discard(scored)
        if moved < tolerance:
            return accuracy, copying
    raise RuntimeError(f"the accuracies did not settle in {max_rounds} rounds")


def fuse(claims: DataFrame, wrong: int = 10, prior_copy: float = 0.2, max_rounds: int = 50, tolerance: float = 1e-3) -> DataFrame:
    """``(group_id, field_name, profile_id, value, posterior)``: the survivor of each field.

    ``claims`` is the table of :func:`claims_of`. A group without a usable value in a field
    has no row for it. The value of the greatest posterior survives, taken from its latest
    claim; ties go to the least profile_id. Claims without a time come before all others.
    Repeated claims of one source count as one vote. An empty table gives an empty result.
    Claims, groups and rows may be of any number; the driver holds what is known of each
    source and of each pair of sources that share a value, up to ``SOURCE_PAIRS``, beyond
    which an error is raised. So it is if the accuracies do not settle.
    """
    key = ["group_id", "field_name"]
    head = F.max(F.struct(F.col("ts").isNotNull().alias("dated"), "ts", (-F.col("profile_id")).alias("back"), F.col("shown").alias("value"))).alias("head")
    values = cut(claims.groupBy(*key, "value").agg(F.array_sort(F.collect_set("src")).alias("srcs"), head), "values")
    latest = values.groupBy(*key).agg(F.count("*").alias("n"), F.max(F.struct("head.dated", "head.ts")).alias("latest"))
    values = cut(values.join(latest, key).withColumn("current", F.struct("head.dated", "head.ts").eqNullSafe(F.col("latest"))).drop("latest"), "claimed")
    contested = values.where("n > 1").select(*key, "value", "srcs", "n")
    alone = cut(values.where("n = 1").groupBy("srcs").agg(F.count("*").alias("times")), "alone")
    accuracy, copying = _sources(contested, alone, wrong, prior_copy, max_rounds, tolerance)
    behind = 2 * _bound(accuracy, wrong)
    scored = _posteriors(values, _votes(accuracy, copying, wrong), key, wrong, 1.5 * behind, F.when(F.col("current"), 0.0).otherwise(-behind))
    best = scored.groupBy(*key).agg(F.max(F.struct("posterior", "head.back", F.col("head.value").alias("value"))).alias("b"))
    return best.select(*key, (-F.col("b.back")).alias("profile_id"), "b.value", F.round("b.posterior", 6).alias("posterior"))


def _dependence(same_true: float, same_false: float, different: float, a: float, wrong: int, prior: float, copies: float = 0.8) -> float:
    """Probability that two sources of accuracy ``a`` are dependent, from what they share."""
    e = 1 - a
    free = (a * a, e * e / wrong, 1 - a * a - e * e / wrong)
    bound = (copies * a + (1 - copies) * free[0], copies * e + (1 - copies) * free[1], (1 - copies) * free[2])
    n = same_true + same_false + different
    scale = min(1.0, 50 / n) if n else 0.0
    odds = sum(k * math.log(max(f, 1e-12) / max(b, 1e-12)) for k, f, b in zip((same_true, same_false, different), free, bound, strict=True)) * scale
    return 1 / (1 + (1 - prior) / prior * math.exp(max(-50.0, min(50.0, odds))))

"""Mapping free-entered values to a canonical list by token-level repair and soft TF-IDF.

Distinct values are cut into segments and tokens. Every distinct token (and every pair of
neighbours and whole segment written together) is joined to the reference vocabulary by edit
distance: both sides are expanded to their deletion neighbourhoods, so the join is an equi
join, and the true distance, which counts a swap of neighbours as one, is checked on the few
pairs that meet. Repaired tokens are then combined: soft TF-IDF cosine ranks the phrases of
all entries, and the best entry is taken if its score passes the threshold.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rosterweave.llm.aliases import ALIASES, OTHERS, REMARK_WORDS
from rosterweave.operators.joins import bounded_broadcast, lookup_join
from rosterweave.storage import cut

LONGEST = 64  # characters of a token or name that may have a typing error
_NOISE = re.compile(r"\b\d+\s*(?:\+\s*)?(?:years?|yrs?)\b(?:\s+of\b)?|\*{2,}")
_TOKEN = re.compile(r"[a-z0-9]+(?:\+\+|#)?(?:\d+)?\+?")


def folded(text: str) -> str:
    text = unicodedata.normalize("NFKD", text.replace("ł", "l").replace("ø", "o").replace("ß", "ss"))
    return "".join(c for c in text if not unicodedata.combining(c)).lower()


def tokens_of(text: str, kind: str) -> list[str]:
    """Tokens that carry meaning. If only remark words are there, they are kept."""
    found = _TOKEN.findall(_NOISE.sub(" ", folded(text)))
    kept = [t for t in found if t not in _REMARKS.get(kind, ())]
    return kept or found


_REMARKS = {kind: frozenset(words.split()) for kind, words in REMARK_WORDS.items()}


def segments_of(text: str, kind: str) -> list[list[str]]:
    """Tokens of the whole value first, then of its parts between commas, slashes and brackets."""
    parts = [p for p in re.split(r"[,/()\[\]|;:]|\s[-–]\s", text) if len(p.strip()) > 1]
    out = [tokens_of(text, kind)] + ([tokens_of(p, kind) for p in parts] if parts and parts != [text] else [])
    return [s for i, s in enumerate(out) if s and s not in out[:i]]


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for kind, value in zip(batch["kind"], batch["value"], strict=True):
            for no, tokens in enumerate(segments_of(value, kind)):
                n = len(tokens)
                units = [(t, i, 1) for i, t in enumerate(tokens)] + [(tokens[i] + tokens[i + 1], i, 2) for i in range(n - 1)]
                if n > 2:
                    units.append(("".join(tokens), 0, n))
                rows += [(kind, value, no, n, *u) for u in units]
        yield pd.DataFrame(rows, columns=["kind", "value", "segment", "n", "unit", "at", "span"])


def vocabulary(entries: list[tuple[int, str, str]], aliases: dict = ALIASES, others: dict = OTHERS) -> list[tuple[str, int, int, str, float, float, bool]]:
    """Rows ``(kind, phrase_id, entry_id, token, weight, norm2, label)`` of all phrases.

    A phrase of several tokens occurs also as one token written together.
    """
    phrases = []
    for entry_id, kind, label in entries:
        names = [label] + [a for a in aliases.get(kind, {}).get(label, "").split(", ") if a]
        for i, name in enumerate(names):
            tokens = _TOKEN.findall(folded(name))
            kept = [t for t in tokens if t not in _REMARKS.get(kind, ())] or tokens
            phrases.append((kind, entry_id, kept, i == 0))
            if len(kept) > 1:
                phrases.append((kind, entry_id, ["".join(kept)], i == 0))
    phrases += [(kind, 0, _TOKEN.findall(name), False) for kind, names in others.items() for name in names]
    import math
    from collections import defaultdict

    seen = defaultdict(set)
    for kind, entry_id, tokens, _ in phrases:
        for t in tokens:
            seen[kind, t].add(entry_id)
    total = {kind: len({e for k, e, _, _ in phrases if k == kind}) for kind, _, _, _ in phrases}
    out = []
    for no, (kind, entry_id, tokens, label) in enumerate(phrases):
        weight = {t: math.log(1 + total[kind] / len(seen[kind, t])) * (0.4 if len(t) == 1 else 1.0) for t in tokens}
        norm2 = sum(w * w for w in weight.values())
        out += [(kind, no, entry_id, t, w, norm2, label) for t, w in weight.items()]
    return out


def osa(a: str, b: str) -> int:
    """Edit distance in which a swap of two neighbours counts as one."""
    # what both begin or end with costs nothing
    end = min(len(a), len(b))
    start = next((i for i in range(end) if a[i] != b[i]), end)
    a, b = a[start:], b[start:]
    end = min(len(a), len(b))
    tail = next((i for i in range(end) if a[-1 - i] != b[-1 - i]), end)
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not a or not b:
        return len(a) + len(b)
    before, row = [], list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        older, before, row = before, row, [i]
        for j, y in enumerate(b, 1):
            d = min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, older[j - 2] + 1)
            row.append(d)
    return row[-1]


def _distance(a: str, b: str) -> Column:
    """Column of the edit distance of two text columns."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([osa(p, q) for p, q in zip(x, y, strict=True)], dtype="int32")

    return F.pandas_udf(run, "int")(a, b)


def _deletions(col: str):
    """The text and all texts with one or two characters left out; one for up to four, none for
    up to two and for more than ``LONGEST``, which are compared as they are."""
    c = F.col(col)
    fits = F.length(c) <= LONGEST
    less = lambda x: F.transform(F.sequence(F.lit(1), F.length(x)), lambda i: F.concat(F.substring(x, F.lit(1), i - 1), F.substr(x, i + 1)))
    one = F.when(fits & (F.length(c) > 2), less(c)).otherwise(F.array().cast("array<string>"))
    two = F.when(fits & (F.length(c) > 4), F.flatten(F.transform(less(c), less))).otherwise(F.array().cast("array<string>"))
    return F.array_distinct(F.concat(F.array(c), one, two))


def near_texts(rare: DataFrame, often: DataFrame) -> DataFrame:
    """``(text, n, fixed, often, d)``: texts of ``rare(text, n)`` with different ones of
    ``often(fixed, often)`` that are one edit away, or two for five characters and more."""
    met = rare.select("text", "n", F.explode(_deletions("text")).alias("_k")).join(bounded_broadcast(cut(often.select("fixed", "often", F.explode(_deletions("fixed")).alias("_k")), "often")), "_k")
    pairs = met.where("text <> fixed").select("text", "n", "fixed", "often").distinct().withColumn("d", _distance("text", "fixed"))
    return pairs.where("d <= if(least(length(text), length(fixed)) > 4, 2, 1)")


def repair(units: DataFrame, words: DataFrame) -> DataFrame:
    """``(kind, unit, token, sim)``: the words of the vocabulary near each distinct unit.

    Words of six characters and more are found up to distance 2, of four and five up to 1,
    labels of three up to 1, others only as they are.
    """
    near = units.select("kind", "unit", F.explode(_deletions("unit")).alias("_k")).join(bounded_broadcast(words.select("kind", "token", "label", F.explode(_deletions("token")).alias("_k")), 64 << 20), ["kind", "_k"])
    pairs = near.select("kind", "unit", "token", "label").distinct()
    pairs = pairs.withColumn("d", F.when(F.col("unit") == F.col("token"), F.lit(0)).otherwise(_distance("unit", "token")))
    short, long = F.least(F.length("unit"), F.length("token")), F.length("token")
    most = F.when(long >= 6, 2).when((long >= 4) & (short >= 3), 1).when((long == 3) & F.col("label") & (short >= 2), 1).otherwise(0)
    return pairs.where(F.col("d") <= most).select("kind", "unit", "token", (1 - F.col("d") / F.greatest(F.length("unit"), long)).alias("sim"))


def map_values(values: DataFrame, entries: DataFrame, threshold: float = 0.62, unknown_weight: float = 3.0, aliases: dict = ALIASES, others: dict = OTHERS) -> DataFrame:
    """``(kind, value, entry_id, score)`` for every distinct ``(kind, value)``.

    ``entry_id`` is 0 where no entry of the kind is meant, so blank and stand-in texts give
    0; null values give no row. A typing error is rather one in a label than in another name
    of an entry, so repaired other names rank a little lower. Ties go to the whole value before its parts, then to the
    least entry_id. ``entries`` is the canonical list ``(entry_id, kind, label)``; it is read
    on the driver, as a list people keep by hand, and its vocabulary is broadcast only at a
    measured size. Empty tables give an empty result; other columns are not read.
    """
    spark = values.sparkSession
    rows = vocabulary([(r.entry_id, r.kind, r.label) for r in entries.select("entry_id", "kind", "label").collect() if r.label], aliases, others)
    vocab = cut(spark.createDataFrame(rows, "kind string, phrase int, entry_id int, token string, weight double, norm2 double, label boolean"), "vocabulary")
    words = vocab.groupBy("kind", "token").agg(F.max("label").alias("label"))
    values = values.select("kind", "value").where("value is not null").distinct()
    units = cut(values.mapInPandas(_parse, "kind string, value string, segment int, n int, unit string, at int, span int"), "units")
    near = cut(repair(units.select("kind", "unit").distinct(), words), "repaired")

    met = lookup_join(units, near.groupBy("kind", "unit").agg(F.collect_list(F.struct("token", "sim")).alias("near")), ["kind", "unit"], "inner")
    met = met.select("kind", "value", "segment", "n", "at", "span", F.explode("near").alias("m")).select("*", "m.token", "m.sim")
    hits = met.join(bounded_broadcast(vocab), ["kind", "token"])
    seg = ["kind", "value", "segment", "n", "phrase", "entry_id", "norm2", "label"]
    best = hits.groupBy(*seg, "token", "weight").agg(F.max(F.struct("sim", "span", (-F.col("at")).alias("at"))).alias("b"))
    score = best.groupBy(*seg).agg(
        F.sum(F.col("weight") ** 2 * F.col("b.sim")).alias("dot"),
        F.sum(F.col("weight") ** 2).alias("own2"),
        F.size(F.array_distinct(F.flatten(F.collect_list(F.sequence(-F.col("b.at"), -F.col("b.at") + F.col("b.span") - 1))))).alias("covered"),
    )
    score = score.withColumn("score", F.col("dot") / F.sqrt((F.col("own2") + F.greatest(F.col("n") - F.col("covered"), F.lit(0)) * unknown_weight**2) * F.col("norm2")) - F.when(F.col("segment") > 0, 0.05).otherwise(0.0) - F.when(~F.col("label") & (F.col("dot") < F.col("own2") - 1e-9), 0.03).otherwise(0.0))
    top = score.groupBy("kind", "value").agg(F.max(F.struct(F.round("score", 9).alias("score"), (-F.col("segment")).alias("s"), (-F.col("entry_id")).alias("e"))).alias("t"))
    ranked = top.select("kind", "value", F.col("t.score").alias("score"), F.when(F.col("t.score") >= threshold, -F.col("t.e")).otherwise(0).alias("entry_id"))
    return values.join(ranked, ["kind", "value"], "left").select("kind", "value", F.coalesce("entry_id", F.lit(0)).alias("entry_id"), F.coalesce("score", F.lit(0.0)).alias("score"))


def map_records(records: DataFrame, entries: DataFrame, **options) -> DataFrame:
    """``(kind, record_id, entry_id)`` for records ``(kind, record_id, value)`` whose value is
    neither null nor letter for letter a label of its kind. Repeated record ids give a row
    each; take them out before."""
    labels = entries.select("kind", F.col("label").alias("value")).distinct()
    cases = cut(records.select("kind", "record_id", "value").where("value is not null").join(bounded_broadcast(labels), ["kind", "value"], "left_anti"), "cases")
    mapped = cut(map_values(cases.select("kind", "value"), entries, **options).select("kind", "value", "entry_id"), "mapped")
    return lookup_join(cases, mapped, ["kind", "value"], "inner").select("kind", "record_id", "entry_id")

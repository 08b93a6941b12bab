"""Confidence of skills and of whole merged records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rosterweave.functions.text import let

# Fixed values of the confidence model.
SOURCE_WEIGHT = {".csv": 1.0, "document": 0.85, "other": 0.80}
SKILL_BASE = (0.70, 0.90, 0.95)
FIELD_WEIGHTS = (1.5, 1.5, 2.0, 1.0, 1.0)


def source_weight(source: Column) -> Column:
    low = F.lower(source)
    return F.when(low.endswith(".csv"), SOURCE_WEIGHT[".csv"]).when(low.rlike(r"\.(pdf|docx|txt)$"), SOURCE_WEIGHT["document"]).otherwise(SOURCE_WEIGHT["other"])


def _mean(values: Column) -> Column:
    return F.when(F.size(values) > 0, F.aggregate(values, F.lit(0.0), lambda a, x: a + x) / F.size(values)).otherwise(0.0)


def skill_confidence(sources: Column) -> Column:
    """Base score by the number of different sources, times their mean weight. The sources are
    read once, into their weights."""

    def rated(weights: Column) -> Column:
        n = F.size(weights)
        base = F.when(n >= 3, SKILL_BASE[2]).when(n == 2, SKILL_BASE[1]).otherwise(SKILL_BASE[0])
        total = sum((F.size(F.filter(weights, lambda x: x == w)) * w for w in SOURCE_WEIGHT.values()), F.lit(0.0))
        # ties go up also where the binary product lies a hair below
        return F.round(F.when(n > 0, base * (total / n) + 1e-9).otherwise(0.0), 4)

    return let(F.transform(F.array_distinct(sources), lambda s: source_weight(s)), rated)


def _has(c: Column) -> Column:
    return F.coalesce(c.cast("string") != "", F.lit(False)).cast("double")


def score(merged: DataFrame) -> DataFrame:
    """``merged`` with skills as ``(name, confidence, sources)`` and ``overall_confidence``."""
    each = F.when(F.size("skill_sources") == F.size("skills"), F.arrays_zip(F.col("skills").alias("name"), F.col("skill_sources").alias("sources")))
    skills = F.transform(each, lambda s: F.struct(s["name"].alias("name"), skill_confidence(F.when(F.size(s["sources"]) > 0, s["sources"]).otherwise(F.col("merged_sources"))).alias("confidence"), s["sources"].alias("sources")))
    contact = lambda c: F.when(F.size(c) > 0, F.least(F.lit(1.0), 0.85 + 0.15 * (F.size(c) - 1))).otherwise(0.0)
    job = lambda e: 0.5 + 0.2 * _has(e["company"]) + 0.15 * _has(e["title"]) + 0.15 * _has(e["start"]) * _has(e["end"])
    school = lambda e: 0.5 + 0.2 * _has(e["institution"]) + 0.2 * _has(e["degree"]) + F.when(F.coalesce(e["end_year"], F.lit(0)) != 0, 0.1).otherwise(0.0)
    part = lambda c, f: F.when(F.size(c) > 0, _mean(F.transform(c, f))).otherwise(0.3)
    out = merged.withColumn("skills", skills).drop("skill_sources")
    n = F.size("skills")
    skill = F.when(n > 0, F.least(F.lit(1.0), _mean(F.transform("skills", lambda s: s["confidence"])) + F.least(F.lit(0.05), n / 10.0 * 0.05))).otherwise(0.3)
    parts = (contact("emails"), contact("phones"), part("experience", job), part("education", school), skill)
    total = sum((w * p for w, p in zip(FIELD_WEIGHTS, parts, strict=True)), F.lit(0.0))
    return out.withColumn("overall_confidence", F.round(total / sum(FIELD_WEIGHTS), 4))


def provenance_confidence(scored: DataFrame) -> DataFrame:
    """``(cluster_id, field, value, source, method, confidence)`` of every provenance entry.

    Entries meet the skills of their record as rows: carried in each row instead, the skills of
    a large record would be written once for each of its entries."""
    rows = scored.select("cluster_id", F.explode("provenance").alias("p")).select("cluster_id", "p.*")
    known = scored.select("cluster_id", F.explode("skills").alias("s")).groupBy("cluster_id", F.lit("skills").alias("field"), F.col("s.name").alias("value")).agg(F.max("s.confidence").alias("known"))
    confidence = F.when(F.col("field") == "skills", F.coalesce("known", skill_confidence(F.array("source")))).when(F.col("source") == "none", 0.0).otherwise(source_weight(F.col("source")))
    return rows.join(known, ["cluster_id", "field", "value"], "left").select("cluster_id", "field", "value", "source", "method", confidence.alias("confidence"))

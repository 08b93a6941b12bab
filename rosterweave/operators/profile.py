"""Canonical profiles: identifier, nested fields, ranges, distinct provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rosterweave.functions.text import pytrim


def candidate_id(emails: Column, full_name: Column, phones: Column) -> Column:
    """Sixteen hex digits of a hash of the first address, else of name and first phone, else of
    the name; null without either, also if only a phone is known."""
    name = F.nullif(F.lower(pytrim(full_name)), F.lit(""))
    key = F.coalesce(F.nullif(F.lower(pytrim(F.get(emails, F.lit(0)))), F.lit("")), F.concat(name, F.coalesce(F.get(phones, F.lit(0)), F.lit(""))))
    return F.substring(F.sha2(key, 256), 1, 16)


def distinct_provenance(provenance: Column) -> Column:
    """Field, source and method of each entry, the first of equal ones; entries without one of the three are left out."""
    own = F.transform(provenance, lambda p: F.struct(p["field"].alias("field"), p["source"].alias("source"), p["method"].alias("method")))
    good = F.filter(own, lambda p: (F.coalesce(p["field"], F.lit("")) != "") & (F.coalesce(p["source"], F.lit("")) != "") & (F.coalesce(p["method"], F.lit("")) != ""))
    made = F.array(F.struct(F.lit("candidate_id").alias("field"), F.lit("pipeline").alias("source"), F.lit("generated").alias("method")))
    return F.array_distinct(F.concat(good, made))


def profiles(scored: DataFrame) -> DataFrame:
    """One profile for each merged record that has an identifier and keeps the ranges: years
    from 0 to 60, end years from 1900 to 2100, no blank skill."""
    schools = F.transform("education", lambda e: F.struct(e["institution"].alias("institution"), e["degree"].alias("degree"), e["field"].alias("field"), F.lit(None).cast("string").alias("cgpa"), F.lit(None).cast("int").alias("start_year"), e["end_year"].alias("end_year")))
    schools = F.filter(schools, lambda e: e["end_year"].isNull() | e["end_year"].between(1900, 2100))
    out = scored.select(
        "cluster_id", candidate_id(F.col("emails"), F.col("full_name"), F.col("phones")).alias("candidate_id"), F.coalesce("full_name", F.lit("")).alias("full_name"), "emails", "phones",
        F.struct(F.col("location_city").alias("city"), F.col("location_region").alias("region"), F.col("location_country").alias("country")).alias("location"), "links", "headline", "years_experience",
        F.filter("skills", lambda s: pytrim(s["name"]) != "").alias("skills"), "experience", schools.alias("education"), distinct_provenance(F.col("provenance")).alias("provenance"), "overall_confidence",
    )
    return out.where(F.col("candidate_id").isNotNull() & (F.col("years_experience").isNull() | F.col("years_experience").between(0, 60)))


def provenance_of(profiles_: DataFrame, field: str) -> DataFrame:
    return profiles_.select("candidate_id", F.explode(F.filter("provenance", lambda p: p["field"] == field)).alias("p")).select("candidate_id", "p.*")


def sources_for_field(profiles_: DataFrame, field: str) -> DataFrame:
    """``(cluster_id, candidate_id, sources)``: the different sources of a field, in order; profiles
    without an entry for it are left out."""
    found = F.array_distinct(F.transform(F.filter("provenance", lambda p: p["field"] == field), lambda p: p["source"]))
    return profiles_.select("cluster_id", "candidate_id", found.alias("sources")).where(F.size("sources") > 0)


def accessors(profiles_: DataFrame) -> DataFrame:
    """``profiles_`` with ``primary_email``, ``primary_phone`` and ``skill_names``; null and empty
    where there is none."""
    return profiles_.withColumn("primary_email", F.get("emails", F.lit(0))).withColumn("primary_phone", F.get("phones", F.lit(0))).withColumn("skill_names", F.transform("skills", lambda s: s["name"]))


def provenance_summary(profiles_: DataFrame) -> DataFrame:
    """``(cluster_id, field, entries)``: ``method@source`` of each field, in order."""
    rows = profiles_.select("cluster_id", F.posexplode("provenance").alias("at", "p"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", F.concat_ws("@", "p.method", "p.source").alias("e")))), lambda x: x["e"])
    return rows.groupBy("cluster_id", F.col("p.field").alias("field")).agg(F.array_join(ordered, "|").alias("entries"))

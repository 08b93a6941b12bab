"""Queries of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterweave.llm.canonical import map_records
from rosterweave.llm.components import group_by_contact
from rosterweave.llm.contacts import contact_rows
from rosterweave.llm.fusion import FIELDS, claims_of, fuse
from rosterweave.llm.name_variants import spelling_groups, variant_pairs
from rosterweave.llm.matching import match_people, person_rows
from rosterweave.llm.mixing import mix
from rosterweave.llm.packing import fill_report, pack
from rosterweave.llm.page_spam import find_spam
from rosterweave.llm.pii import find_pii, train_on
from rosterweave.llm.tokens import token_counts
from rosterweave.sources.tables import once, table
from rosterweave.storage import cut

Query = Callable[[SparkSession, str], DataFrame]


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    rec = once(table(spark, sf_dir, "recruiter"), "rec_id", "name", "email", "phone", "location_city", "location_country", "current_company", "linkedin", "github")
    pro = once(table(spark, sf_dir, "candidate_profile"), "profile_id", "full_name", "emails", "phones", "location_city", "location_country", "linkedin", "github")
    # a set has the values of a row that was delivered twice once
    jobs = table(spark, sf_dir, "experience").where("exp_id is not null and company is not null").groupBy("profile_id").agg(F.collect_set("company").alias("companies"))
    place = [F.col("location_city").alias("city"), F.col("location_country").alias("country")]
    none = F.array().cast("array<string>")
    left = person_rows(rec, "R", "rec_id", "name", F.array("email"), F.array("phone"), ["linkedin", "github"], [*place, F.when(F.col("current_company").isNull(), none).otherwise(F.array("current_company")).alias("companies")])
    right = person_rows(pro.join(jobs, "profile_id", "left"), "P", "profile_id", "full_name", F.col("emails"), F.col("phones"), ["linkedin", "github"], [*place, F.coalesce("companies", none).alias("companies")])
    return match_people(left.unionByName(right), table(spark, sf_dir, "shared_contact"), table(spark, sf_dir, "canon_entry"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p1_matches(spark, sf_dir).select("rec_id", "profile_id").distinct()


def p1_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of the same person with their confidence."""
    return _matches(spark, sf_dir).select(F.shiftright("left", 1).alias("rec_id"), F.shiftright("right", 1).alias("profile_id"), "confidence")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = [("skill", "skill", "skill_id", "name"), ("title", "experience", "exp_id", "title"), ("country", "candidate_profile", "profile_id", "location_country")]
    parts = [once(table(spark, sf_dir, t), i, c).select(F.lit(kind).alias("kind"), F.col(i).alias("record_id"), F.col(c).alias("value")) for kind, t, i, c in cases]
    return map_records(reduce(DataFrame.unionByName, parts), table(spark, sf_dir, "canon_entry"))


def _profile_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = once(table(spark, sf_dir, "candidate_profile"), "profile_id", "emails", "phones")
    contacts = cut(contact_rows(profiles, "profile_id", F.col("emails"), F.col("phones"), table(spark, sf_dir, "shared_contact")), "contacts")
    return group_by_contact(contacts, "profile_id")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile_groups(spark, sf_dir)


def _survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = once(table(spark, sf_dir, "candidate_profile"), "profile_id", *FIELDS, "src_file", "updated_at")
    return fuse(claims_of(rows.join(_profile_groups(spark, sf_dir), "profile_id")))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _survivors(spark, sf_dir).select("group_id", "field_name", "profile_id")


def p4_survivor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One surviving record for each group, with the confidence of each field."""
    aggs = [F.max(F.when(F.col("field_name") == f, F.col(c))).alias(f if c == "value" else f"{f}_confidence") for f in FIELDS for c in ("value", "posterior")]
    return _survivors(spark, sf_dir).groupBy("group_id").agg(*aggs)


def _spellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cases = [("company", "experience"), ("institution", "education"), ("full_name", "candidate_profile")]
    names = [table(spark, sf_dir, t).select(F.lit(c).alias("kind"), F.col(c).alias("name")).distinct() for c, t in cases]
    return spelling_groups(reduce(DataFrame.unionByName, names))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_pairs(_spellings(spark, sf_dir))


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling with the identifier of its group."""
    return _spellings(spark, sf_dir)


def _pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    notes = once(table(spark, sf_dir, "recruiter"), "rec_id", "notes").select(F.lit("recruiter.notes").alias("field_name"), F.col("rec_id").alias("record_id"), F.col("notes").alias("text"))
    jobs = once(table(spark, sf_dir, "experience"), "exp_id", "summary").select(F.lit("experience.summary").alias("field_name"), F.col("exp_id").alias("record_id"), F.col("summary").alias("text"))
    texts = notes.unionByName(jobs)
    return find_pii(texts, train_on(texts), "field_name", "record_id")


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pii(spark, sf_dir).select("field_name", "record_id", F.explode("spans").alias("s")).select("field_name", "record_id", "s.*").distinct()


def p7_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text with typed placeholders for its personal information."""
    return _pii(spark, sf_dir).select("field_name", "record_id", "redacted")


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Container of every document for every specification."""
    sizes = token_counts(table(spark, sf_dir, "documents"), "doc_id", "text")
    return pack(sizes, table(spark, sf_dir, "container_spec"))


def p8_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_report(cut(p8_containers(spark, sf_dir), "packed"), table(spark, sf_dir, "container_spec"))


def _mix(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return mix(token_counts(table(spark, sf_dir, "documents"), "doc_id", "text", "source"), table(spark, sf_dir, "mix_target"))


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the mix with their number of copies."""
    return _mix(spark, sf_dir)[0]


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mix(spark, sf_dir)[1]


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_spam(table(spark, sf_dir, "documents")).where("spam >= 0.5").select("doc_id").distinct()


def queries() -> dict[str, Query]:
    return {"p1_found": p1_found, "p1_matches": p1_matches, "p2_found": p2_found, "p3_found": p3_found, "p4_found": p4_found, "p4_survivor": p4_survivor, "p6_found": p6_found, "p6_groups": p6_groups, "p7_found": p7_found, "p7_redacted": p7_redacted, "p8_containers": p8_containers, "p8_fill": p8_fill, "p9_mix": p9_mix, "p9_shares": p9_shares, "p10_found": p10_found}


def oracle_sql() -> dict[str, str]:
    return {}

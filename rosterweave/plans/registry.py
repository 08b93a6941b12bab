"""Queries of the core and, where SQL can express them, their equivalents for the oracle.

Every query reads whole tables. Arrays are shown as texts joined by ``|``, so that both
sides compare alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterweave.functions import extract as X, normalize as N
from rosterweave.functions.text import pytrim
from rosterweave.operators import check as C, merge as M, profile as P, project as J, resolve as R, score as S, validate as V
from rosterweave.operators.split_values import split_values
from rosterweave.plans import oracle as Q
from rosterweave.plans.counters import run_counters
from rosterweave.sources.files import EXPORT_COLUMNS, missing_headers, read_csvs, resume_records, usable
from rosterweave.sources.people import exports, profiles, raw_records
from rosterweave.sources.tables import once, table
from rosterweave.storage import cut, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

# A configuration that shows each feature of the projection language.
CUSTOM = {
    "fields": [
        {"path": "full_name", "type": "string", "required": True},
        {"path": "primary_email", "from": "emails[0]", "type": "string", "required": True},
        {"path": "phone", "from": "phones[0]", "type": "string", "normalize": "E164"},
        {"path": "skills", "from": "skills[].name", "type": "string[]", "normalize": "canonical"},
        {"path": "headline", "type": "string"},
        {"path": "years_experience", "type": "number"},
    ],
    "include_confidence": True, "include_provenance": False, "on_missing": "null",
}


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split_values(once(table(spark, sf_dir, "recruiter"), "rec_id", "skills"), "rec_id", "skills")


def _joined(c: str) -> F.Column:
    return F.array_join(F.col(c), "|").alias(c)


def _one(t: str, key: str, column: str, f, name: str) -> Query:  # noqa: ANN001
    return lambda spark, d: once(table(spark, d, t), key, column).select(key, f(F.col(column)).alias(name))


_HELD: dict[tuple[str, str, str], DataFrame] = {}


def _stage(spark: SparkSession, d: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table of a stage, written once for all queries of a session. The tables of a data
    set are taken not to change while a session reads them."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _HELD:
        _HELD[key] = cut(build(), name)
    return _HELD[key]


def _validated(spark: SparkSession, d: str) -> DataFrame:
    return _stage(spark, d, "validated", lambda: V.validate(raw_records(spark, d)))


def _keyed(spark: SparkSession, d: str) -> DataFrame:
    return _stage(spark, d, "keyed", lambda: R.keys(_validated(spark, d)))


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return _stage(spark, d, "edges", lambda: R.edges(_keyed(spark, d)))


def _clustered(spark: SparkSession, d: str) -> DataFrame:
    return _stage(spark, d, "clustered", lambda: R.clusters(_validated(spark, d), _edges(spark, d)))


def _merged(spark: SparkSession, d: str) -> DataFrame:
    return _stage(spark, d, "merged", lambda: M.merge(_clustered(spark, d)))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    return _stage(spark, d, "scored", lambda: S.score(_merged(spark, d)))


def _profiles(spark: SparkSession, d: str) -> DataFrame:
    return _stage(spark, d, "profiles", lambda: P.profiles(_scored(spark, d)))


def skills_split(spark: SparkSession, d: str) -> DataFrame:
    r = once(table(spark, d, "recruiter"), "rec_id", "skills")
    return r.select("rec_id", F.array_join(N.skills(N.split_skills(F.col("skills"))), "|").alias("skills"))


def experience_dates(spark: SparkSession, d: str) -> DataFrame:
    e = once(table(spark, d, "experience"), "exp_id", "start_ym", "end_ym")
    read = lambda c: F.when(~N.is_open_end(F.col(c)), N.date(F.col(c))).alias(c)
    return e.select("exp_id", read("start_ym"), read("end_ym"))


def source_types(spark: SparkSession, d: str) -> DataFrame:
    p = once(table(spark, d, "candidate_profile"), "profile_id", "src_file")
    return p.groupBy("src_file").agg(F.count("*").alias("n")).select("src_file", "n", V.source_type(F.col("src_file")).alias("source_type"))


def profile_contacts(spark: SparkSession, d: str) -> DataFrame:
    """Valid addresses of every profile, in order."""
    p = once(table(spark, d, "candidate_profile"), "profile_id", "emails")
    return p.select("profile_id", F.array_join(F.filter(F.transform("emails", lambda e: N.email(e)), lambda x: x.isNotNull()), "|").alias("emails"))


def union_sources(spark: SparkSession, d: str) -> DataFrame:
    return raw_records(spark, d).groupBy("source").agg(F.count("*").alias("n"), F.sum(F.when(pytrim(F.coalesce("full_name", F.lit(""))) != "", 1).otherwise(0)).alias("named"))


def validation_log(spark: SparkSession, d: str) -> DataFrame:
    v = _validated(spark, d)
    return v.select("record_ix", F.posexplode("validation_log").alias("place", "r")).select("record_ix", "place", "r.*")


def extract_emails(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", X.emails(F.col("text")).alias("emails"))
    return docs.where(F.size("emails") > 0).select("doc_id", _joined("emails"))


def extract_links(spark: SparkSession, d: str) -> DataFrame:
    """The first link of every document that is of neither network."""
    docs = table(spark, d, "documents").select("doc_id", X.link(F.col("text"), "portfolio").alias("portfolio"))
    return docs.where("portfolio is not null")


def extract_phones(spark: SparkSession, d: str) -> DataFrame:
    """Phones as typed in the notes of recruiters; the documents have none."""
    notes = once(table(spark, d, "recruiter"), "rec_id", "notes").select("rec_id", X.phones(F.col("notes")).alias("phones"))
    return notes.where(F.size("phones") > 0).select("rec_id", _joined("phones"))


def split_sections(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", *[X.section(t, s).alias(s.lower()) for s in ("HEADER", "SKILLS", "EXPERIENCE", "EDUCATION")])


def resume_heads(spark: SparkSession, d: str) -> DataFrame:
    """Name and place that the head of each document gives."""
    heads = table(spark, d, "documents").select("doc_id", X.section(F.col("text"), "HEADER").alias("h"))
    return heads.select("doc_id", X.name(F.col("h")).alias("full_name"), X.city(F.col("h")).alias("city"), X.home_country(F.col("h")).alias("country"))


def resume_skills(spark: SparkSession, d: str) -> DataFrame:
    """Known skills of the skill section of each document that has one."""
    docs = table(spark, d, "documents").select("doc_id", X.listed_skills(X.section(F.col("text"), "SKILLS")).alias("skills"))
    return docs.where("skills is not null").select("doc_id", _joined("skills"))


def tenure(spark: SparkSession, d: str) -> DataFrame:
    """Years in all jobs of each record, as of June 2025."""
    return _validated(spark, d).select("record_ix", X.tenure_years(F.col("experience"), F.lit("2025-06-01").cast("date")).alias("years"))


def normalize_dispatch(spark: SparkSession, d: str) -> DataFrame:
    """The normalisers of a projection, by name."""
    r = once(table(spark, d, "recruiter"), "rec_id", "phone", "email", "title", "location_country")
    of = lambda key, c: N.normalizer(key)(c).alias(key.lower())
    return r.select("rec_id", of("E164", F.col("phone")), of("email", F.col("email")), of("canonical", F.col("title")), of("country", F.col("location_country")), of("national", N.phone(F.col("phone"))))


def missing_columns(spark: SparkSession, d: str) -> DataFrame:
    """Columns of an export that two tables lack, as one text for each."""
    rows = [(t, "|".join(missing_headers(table(spark, d, t).columns))) for t in ("recruiter", "candidate_profile")]
    return spark.createDataFrame(rows, "table_name string, missing string")


def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """The exports written as CSV files and read again by their headers."""
    r = once(table(spark, d, "recruiter"), "rec_id", *EXPORT_COLUMNS)
    folder = f"{shared_dir(spark)}/exports-{uuid.uuid4().hex}"
    r.select(*EXPORT_COLUMNS, F.col("rec_id").cast("string").alias("github_id")).withColumn("github", F.col("github_id")).drop("github_id").write.csv(folder, header=True, escape='"', emptyValue="", lineSep="\n")
    got = read_csvs(spark, [folder.removeprefix("file://")])
    return got.select(F.col("github").cast("long").alias("rec_id"), "full_name", "email", "phone", "location_city", "skills_text", "notes")


def resumes(spark: SparkSession, d: str) -> DataFrame:
    """Raw records that the extraction reads from the documents."""
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("record_ix"), F.lit("documents.txt").alias("source"), "text")
    r = usable(resume_records(docs, F.lit("2025-06-01").cast("date"), 0))
    return r.select("record_ix", "full_name", _joined("emails"), _joined("phones"), "headline", "years_experience", _joined("skills_list"), F.to_json("experience").alias("experience"), F.to_json("education").alias("education"))


def email_edges(spark: SparkSession, d: str) -> DataFrame:
    return R.email_edges(_keyed(spark, d))


def match_keys(spark: SparkSession, d: str) -> DataFrame:
    return _keyed(spark, d).select("record_ix", _joined("emails"), _joined("phones"), "name")


def phone_name_edges(spark: SparkSession, d: str) -> DataFrame:
    return R.phone_name_edges(_keyed(spark, d)).select("src", "dst", F.round("score", 6).alias("score"))


def match_reasons(spark: SparkSession, d: str) -> DataFrame:
    return R.reasons(_keyed(spark, d), _edges(spark, d))


def email_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Clusters by addresses alone."""
    return R.components(R.email_edges(_keyed(spark, d))).select(F.col("node").alias("record_ix"), F.col("root").alias("cluster_id"))


def clusters(spark: SparkSession, d: str) -> DataFrame:
    return _clustered(spark, d).select("record_ix", "cluster_id")


def cluster_sizes(spark: SparkSession, d: str) -> DataFrame:
    sizes = clusters(spark, d).groupBy("cluster_id").agg(F.count("*").alias("size"))
    return sizes.groupBy("size").agg(F.count("*").alias("clusters"))



def merge_scalars(spark: SparkSession, d: str) -> DataFrame:
    """Scalars merged over the records of an address, each address being a cluster."""
    return M.merge(_address_clusters(spark, d)).select("cluster_id", "n", *M.SCALARS)


def _address_clusters(spark: SparkSession, d: str) -> DataFrame:
    v = _validated(spark, d).where("email is not null")
    first = v.groupBy("email").agg(F.min("record_ix").alias("cluster_id"))
    return v.join(first, "email")


def merge_lists(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).select("cluster_id", _joined("emails"), _joined("phones"), _joined("skills"))


def merged_sources(spark: SparkSession, d: str) -> DataFrame:
    return M.merge(_address_clusters(spark, d)).select("cluster_id", _joined("merged_sources"))


def merge_links(spark: SparkSession, d: str) -> DataFrame:
    return M.merge(_address_clusters(spark, d)).select("cluster_id", *[F.col(f"links.{k}").alias(k) for k in M.LINKS])


def cluster_scalars(spark: SparkSession, d: str) -> DataFrame:
    """As ``merge_scalars``, over the resolved clusters, which SQL does not express."""
    return _merged(spark, d).select("cluster_id", "n", *M.SCALARS)


def cluster_sources(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).select("cluster_id", _joined("merged_sources"))


def cluster_links(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).select("cluster_id", *[F.col(f"links.{k}").alias(k) for k in M.LINKS])


def merge_blocks(spark: SparkSession, d: str) -> DataFrame:
    m = _merged(spark, d)
    return m.select("cluster_id", F.size("experience").alias("jobs"), F.size("education").alias("schools"))


def provenance(spark: SparkSession, d: str) -> DataFrame:
    return _merged(spark, d).select("cluster_id", F.posexplode("provenance").alias("place", "p")).select("cluster_id", "place", "p.*")


def provenance_detail(spark: SparkSession, d: str) -> DataFrame:
    return S.provenance_confidence(_scored(spark, d))


def provenance_summary(spark: SparkSession, d: str) -> DataFrame:
    return P.provenance_summary(_profiles(spark, d))


def provenance_sources(spark: SparkSession, d: str) -> DataFrame:
    """Sources that the skills of each profile come from."""
    return P.sources_for_field(_profiles(spark, d), "skills").select("cluster_id", _joined("sources"))


def profile_accessors(spark: SparkSession, d: str) -> DataFrame:
    return P.accessors(_profiles(spark, d)).select("cluster_id", "primary_email", "primary_phone", _joined("skill_names"))


def batch_counters(spark: SparkSession, d: str) -> DataFrame:
    """What each stage of a run kept and lost, with the custom configuration."""
    parsed = J.parse_config(CUSTOM)
    checked = C.check(J.project(_profiles(spark, d), parsed, "cluster_id"), parsed)
    return run_counters(_validated(spark, d), _merged(spark, d), _profiles(spark, d), checked)


def skill_confidence(spark: SparkSession, d: str) -> DataFrame:
    """Confidence of every skill of the profiles, from the sources of the profiles that have it."""
    s = once(table(spark, d, "skill"), "skill_id", "name", "src_file").where("src_file is not null").select(N.skill(F.col("name")).alias("name"), "src_file").where("name is not null")
    return s.groupBy("name").agg(F.array_sort(F.collect_set("src_file")).alias("sources")).select("name", S.skill_confidence(F.col("sources")).alias("confidence"))


def overall_confidence(spark: SparkSession, d: str) -> DataFrame:
    return _scored(spark, d).select("cluster_id", "overall_confidence")


def candidate_ids(spark: SparkSession, d: str) -> DataFrame:
    v = _validated(spark, d)
    return v.select("record_ix", P.candidate_id(F.col("emails"), F.col("full_name"), F.col("phones")).alias("candidate_id"))


def profiles_built(spark: SparkSession, d: str) -> DataFrame:
    p = _profiles(spark, d)
    return p.select("cluster_id", "candidate_id", "full_name", "headline", "years_experience", F.size("skills").alias("n_skills"), F.col("location.country").alias("country"), "overall_confidence")


def _projected(config: dict | None) -> Query:
    def query(spark: SparkSession, d: str) -> DataFrame:
        parsed = J.parse_config(config)
        rows = C.check(J.project(_profiles(spark, d), parsed, "cluster_id"), parsed)
        shown = [F.to_json(c).alias(c) if t.startswith(("array", "struct")) else F.col(c) for c, t in rows.dtypes]
        return rows.select(*shown)

    return query


def project_omit(spark: SparkSession, d: str) -> DataFrame:
    config = J.parse_config(CUSTOM | {"on_missing": "omit"})
    return J.project_json(_profiles(spark, d), config, "cluster_id")


TYPED = {
    "fields": [
        {"path": "headline", "type": "number"}, {"path": "years", "from": "years_experience", "type": "string", "required": True}, {"path": "skills", "type": "string[]"},
        {"path": "location", "type": "object"}, {"path": "links", "type": "object[]"}, {"path": "mail", "from": "emails[0]", "type": "string", "required": True}, {"path": "name", "from": "full_name", "type": "unheard of"},
    ],
}


def check_output(spark: SparkSession, d: str) -> DataFrame:
    """Violations and warnings of a configuration that declares some types wrongly."""
    parsed = J.parse_config(TYPED)
    rows = C.check(J.project(_profiles(spark, d), parsed, "cluster_id"), parsed)
    return rows.select("cluster_id", _joined("violations"), _joined("warnings"), "should_abort")


def valid_output(spark: SparkSession, d: str) -> DataFrame:
    parsed = J.parse_config(CUSTOM)
    rows = C.valid_only(C.check(J.project(_profiles(spark, d), parsed, "cluster_id"), parsed))
    return rows.withColumn("skills", F.array_join("skills", "|"))


def queries() -> dict[str, Query]:
    return {
        "p5_found": p5_found,
        "normalize_email": _one("recruiter", "rec_id", "email", N.email, "email"),
        "normalize_phone": _one("recruiter", "rec_id", "phone", N.phone, "phone"),
        "format_phone_national": _one("recruiter", "rec_id", "phone", lambda c: N.phone_national(N.phone(c)), "phone"),
        "normalize_country": _one("candidate_profile", "profile_id", "location_country", N.country, "country"),
        "normalize_skill": _one("skill", "skill_id", "name", N.skill, "name"),
        "normalize_date": _one("experience", "exp_id", "start_ym", N.date, "start_ym"),
        "validate_years": _one("recruiter", "rec_id", "years_experience", N.years, "years"),
        "validate_url": _one("recruiter", "rec_id", "linkedin", N.url, "linkedin"),
        "skills_split": skills_split, "experience_dates": experience_dates, "source_type": source_types, "profile_contacts": profile_contacts, "union_sources": union_sources,
        "validation_log": validation_log, "rejections_by_field": lambda s, d: V.rejections(_validated(s, d)),
        "usable_records": lambda s, d: usable(profiles(s, d)).select("record_ix"), "csv_remap": lambda s, d: exports(s, d).select("record_ix", "source", "full_name", "skills_text"),
        "extract_emails": extract_emails, "extract_phones": extract_phones, "extract_links": extract_links, "split_sections": split_sections, "resume_heads": resume_heads, "resume_skills": resume_skills, "resume_records": resumes, "tenure": tenure,
        "normalize_dispatch": normalize_dispatch, "missing_columns": missing_columns, "csv_round_trip": csv_round_trip,
        "match_keys": match_keys, "email_edges": email_edges, "phone_name_edges": phone_name_edges, "match_reasons": match_reasons, "email_clusters": email_clusters, "clusters": clusters, "cluster_sizes": cluster_sizes,
        "merge_scalars": merge_scalars, "merge_lists": merge_lists, "merged_sources": merged_sources, "merge_links": merge_links, "merge_blocks": merge_blocks,
        "cluster_scalars": cluster_scalars, "cluster_sources": cluster_sources, "cluster_links": cluster_links,
        "provenance": provenance, "provenance_detail": provenance_detail, "provenance_summary": provenance_summary, "provenance_sources": provenance_sources, "skill_confidence": skill_confidence, "overall_confidence": overall_confidence,
        "candidate_id": candidate_ids, "profiles": profiles_built, "profile_accessors": profile_accessors, "batch_counters": batch_counters, "project_default": _projected(None), "project_custom": _projected(CUSTOM), "project_error": _projected(CUSTOM | {"on_missing": "error"}), "project_omit": project_omit,
        "check_output": check_output, "valid_output": valid_output,
    }


def oracle_sql() -> dict[str, str]:
    return Q.oracle_sql()

"""Raw records of people from the tables of a data set, in the shape of the engine's input.

Exports of recruiters come first, profiles follow; ``record_ix`` keeps that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterweave.schema import EDUCATION, EXPERIENCE, RAW
from rosterweave.sources.tables import once, table

PROFILE_BASE = 1_000_000_000_000


def aligned(df: DataFrame) -> DataFrame:
    """``df`` with exactly the columns of a raw record; absent ones are null."""
    from pyspark.sql.types import StructType

    have = {c.lower() for c in df.columns}
    fields = StructType.fromDDL(RAW).fields
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])


def exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = once(table(spark, sf_dir, "recruiter"), "rec_id", "src_file", "name", "email", "phone", "location_city", "location_country", "linkedin", "github", "years_experience", "skills", "current_company", "title", "notes")
    return aligned(r.select(F.col("rec_id").alias("record_ix"), F.col("src_file").alias("source"), F.col("name").alias("full_name"), "email", "phone", "location_city", "location_country", "linkedin", "github", "years_experience", F.col("skills").alias("skills_text"), "current_company", "title", "notes"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Profiles with their jobs, schools and skills in order of position."""
    p = once(table(spark, sf_dir, "candidate_profile"), "profile_id", "src_file", "full_name", "emails", "phones", "linkedin", "github", "portfolio", "location_city", "location_region", "location_country", "headline", "years_experience")
    listed = lambda df, key, item, name: df.groupBy("profile_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", key, item.alias("v")))), lambda x: x.v).alias(name))
    jobs = once(table(spark, sf_dir, "experience"), "exp_id", "profile_id", "pos", "company", "title", "start_ym", "end_ym", "summary")
    jobs = listed(jobs, "exp_id", F.struct("company", "title", F.col("start_ym").alias("start"), F.col("end_ym").alias("end"), "summary"), "experience")
    schools = listed(table(spark, sf_dir, "education"), "edu_id", F.struct("institution", "degree", "field", "cgpa", "start_year", "end_year"), "education")
    skills = listed(once(table(spark, sf_dir, "skill"), "skill_id", "profile_id", "pos", "name").where("name is not null"), "skill_id", F.col("name"), "skills_list")
    for part in (jobs, schools, skills):
        p = p.join(part, "profile_id", "left")
    return aligned(p.withColumn("record_ix", F.col("profile_id") + PROFILE_BASE).withColumnRenamed("src_file", "source").withColumn("experience", F.col("experience").cast(EXPERIENCE)).withColumn("education", F.col("education").cast(EDUCATION)))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sources, exports first."""
    return exports(spark, sf_dir).unionByName(profiles(spark, sf_dir))

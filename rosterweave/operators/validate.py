"""Validation of raw records: every field normalised, what cannot be read null and logged."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from rosterweave.functions import normalize as N
from rosterweave.functions.text import let, present
from rosterweave.schema import EDUCATION, EXPERIENCE, REJECTION


def source_type(source: Column) -> Column:
    low = F.lower(source)
    return F.when(low.endswith(".csv"), "structured").when(low.rlike(r"\.(pdf|docx|txt)$"), "unstructured").otherwise("other")


def _rejection(field: str | Column, raw: Column, reason: str) -> Column:
    return F.struct((F.lit(field) if isinstance(field, str) else field).alias("field"), F.substring(raw.cast("string"), 1, 120).alias("raw_value"), F.col("source"), F.lit(reason).alias("reason"))


def _refused(field: str, raw: Column, clean: Column, reason: str) -> Column:
    bad = (F.coalesce(raw, F.lit("")) != "") & clean.isNull()
    return F.when(bad, F.array(_rejection(field, raw, reason))).otherwise(F.array().cast(REJECTION))


def _read_each(raw: Column, read: Callable[[Column], Column]) -> Column:
    """``(raw, v)`` of each text of a list, ``v`` as ``read`` has it."""
    return F.transform(raw, lambda x: F.struct(x.alias("raw"), read(x).alias("v")))


def _values(pairs: Column) -> Column:
    return F.filter(F.transform(pairs, lambda x: x["v"]), lambda v: v.isNotNull())


def _refused_each(field: str, pairs: Column, reason: str) -> Column:
    bad = F.filter(F.coalesce(pairs, F.array().cast("array<struct<raw:string,v:string>>")), lambda x: (x["raw"] != "") & x["v"].isNull())
    return F.transform(bad, lambda x: _rejection(field, x["raw"], reason))


def _job_date(raw: Column) -> Column:
    """``(v, bad)`` of a typed date: the month, null at an open end, and whether it cannot be read."""
    return let(F.struct(N.date(raw).alias("v"), N.is_open_end(raw).alias("open")), lambda d: F.struct(F.when(~d["open"], d["v"]).alias("v"), ((raw != "") & ~d["open"] & d["v"].isNull()).alias("bad")))


def _job_log(dated: Column) -> Column:
    entry = lambda x, k, i: F.when(x[f"{k}_read"]["bad"], _rejection(F.format_string(f"experience[%d].{k}", i), x["job"][k], "unparseable date"))
    return F.flatten(F.transform(dated, lambda x, i: F.array_compact(F.array(entry(x, "start", i), entry(x, "end", i)))))


def validate(raw: DataFrame) -> DataFrame:
    """Validated records, one for each raw record, never fewer.

    A single ``email`` or ``phone`` falls back to the first of its list; a list is built from
    the single value where it is null. ``validation_log`` has what was refused and why. Empty
    texts are null; an empty table gives an empty result.

    The work is in stages, so that each typed value is read once: values first, then what the
    record and its log show of them.
    """
    none = F.array().cast("array<string>")
    links = ("linkedin", "github", "portfolio")
    contacts = {"email": ("emails", N.email), "phone": ("phones", N.phone)}
    one = raw
    for c, (many, read) in contacts.items():
        one = one.withColumn(f"_{many}", _read_each(F.col(many), read))
        own = F.when(F.coalesce(F.col(c), F.lit("")) != "", F.struct(F.col(c).alias("raw"), read(F.col(c)).alias("v")))
        one = one.withColumn(f"_{c}", F.coalesce(own, F.get(f"_{many}", F.lit(0))))
    for c, read in {"location_country": N.country, "years_experience": N.years, **dict.fromkeys(links, N.url)}.items():
        one = one.withColumn(f"_{c}", read(F.col(c)))
    jobs = F.coalesce("experience", F.array().cast(EXPERIENCE))
    one = one.withColumn("_jobs", F.transform(jobs, lambda e: F.struct(e.alias("job"), _job_date(e["start"]).alias("start_read"), _job_date(e["end"]).alias("end_read"))))
    one = one.withColumn("_skills", N.skills(F.coalesce("skills_list", F.when(F.col("skills_text").isNotNull(), N.split_skills(F.col("skills_text"))), none)))

    reasons = {"email": "not a valid email address", "phone": "unparseable as a valid phone number"}
    log = F.concat(
        *[part for c, (many, _) in contacts.items() for part in (_refused(c, F.col(f"_{c}.raw"), F.col(f"_{c}.v"), reasons[c]), _refused_each(f"{many}[]", F.col(f"_{many}"), reasons[c]))],
        _refused("location_country", F.col("location_country"), F.col("_location_country"), "unrecognized country name/code"),
        *[_refused(k, present(F.col(k)), F.col(f"_{k}"), "not a URL") for k in links],
        _refused("years_experience", F.col("years_experience"), F.col("_years_experience"), "not a number from 0 to 60"),
        _job_log(F.col("_jobs")),
    )
    keep = lambda c: F.nullif(c, F.lit("")).alias(c)
    listed = lambda c, many: F.when(F.col(many).isNotNull(), _values(F.col(f"_{many}"))).when(F.col(f"_{c}.v").isNotNull(), F.array(f"_{c}.v")).otherwise(none).alias(many)
    shown = [x for c, (many, _) in contacts.items() for x in (F.col(f"_{c}.v").alias(c), listed(c, many))]
    experience = F.transform("_jobs", lambda x: x["job"].withField("start", x["start_read"]["v"]).withField("end", x["end_read"]["v"]))
    return one.select(
        "record_ix", "source", source_type(F.col("source")).alias("source_type"), *shown, keep("full_name"), keep("location_city"), keep("location_region"), F.col("_location_country").alias("location_country"),
        *[F.col(f"_{k}").alias(k) for k in links], keep("headline"), F.col("_years_experience").alias("years_experience"), F.col("_skills").alias("skills"), experience.alias("experience"),
        F.coalesce("education", F.array().cast(EDUCATION)).alias("education"), keep("current_company"), keep("title"), keep("notes"), log.cast(REJECTION).alias("validation_log"),
    )


def rejections(validated: DataFrame) -> DataFrame:
    """``(field, n)``: how many values each field lost."""
    return validated.select(F.explode("validation_log").alias("r")).groupBy("r.field").agg(F.count("*").alias("n"))

"""Merging the records of a cluster field by field, with provenance.

Scalars come from the preferred kind of source, blocks from the first resume that has one,
links from the first record with one: each is a minimum, so a cluster of any size is reduced
where its records lie. Values of lists are rows until equal ones are one, so what a task
gathers of a cluster are the different values that its merged record shows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rosterweave.schema import EDUCATION, EXPERIENCE, PROVENANCE

# Merged fields with the kind of source that wins, and the words of provenance below.
SCALARS = {"full_name": "csv", "location_city": "csv", "location_region": "csv", "location_country": "csv", "headline": "resume", "years_experience": "resume"}
BLOCKS = {"experience": EXPERIENCE, "education": EDUCATION}
LINKS = ("linkedin", "github", "portfolio")
LISTS = ("emails", "phones", "skills")
KIND = {"csv": "structured", "resume": "unstructured"}


def _entry(field: str, value: Column, source: Column, method: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), value.cast("string").alias("value"), source.alias("source"), method.alias("method"))


def _base(kind: Column) -> Column:
    return F.when(kind == "structured", "csv_direct").otherwise("regex_extract")


def _aggregates() -> list[Column]:
    ix, out = F.col("record_ix"), []
    for name, prefer in SCALARS.items():
        v = F.col(name)
        row = F.struct(v.alias("v"), F.col("source").alias("s"), F.col("source_type").alias("k"))
        out.append(F.min_by(row, F.when(v.isNotNull(), F.struct(F.when(F.col("source_type") == KIND[prefer], 0).otherwise(1), ix))).alias(f"best_{name}"))
        out.append(F.min_by(row, F.when(v.isNotNull(), ix)).alias(f"first_{name}"))
        out.append((F.min(v) != F.max(v)).alias(f"differ_{name}"))
    for name in BLOCKS:
        full = (F.size(name) > 0) & F.col("source_type").isin("structured", "unstructured")
        rank = F.when(full, F.struct(F.when(F.col("source_type") == "unstructured", 0).otherwise(1), ix))
        out.append(F.min_by(F.struct(F.col(name).alias("v"), F.col("source").alias("s"), F.col("source_type").alias("k")), rank).alias(f"best_{name}"))
        out.append(F.count(F.when(full, 1)).alias(f"n_{name}"))
    for name in LINKS:
        row = F.struct(F.col(name).alias("v"), F.col("source").alias("s"), F.col("source_type").alias("k"))
        out.append(F.min_by(row, F.when(F.col(name).isNotNull(), ix)).alias(f"first_{name}"))
    out.append(F.min_by(F.struct(*LISTS, "source", "source_type"), ix).alias("_own"))
    out.append(F.count("*").alias("n"))
    return out


def _list_values(clustered: DataFrame) -> DataFrame:
    """``(cluster_id, emails, phones, skills, merged_sources)`` of each cluster of several records:
    the different values of each list in order, as structs of value, source and kind of source, skills also with all sources.

    Equal values are the same whatever their case, phones also if they end in the same ten
    digits, where Indian numbers come first.
    """
    item = lambda name, v, pos: F.struct(F.lit(name).alias("name"), v.alias("v"), pos.alias("pos"))
    items_of = lambda c: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda v, i: item(c, v, i))
    items = F.concat(*[items_of(c) for c in LISTS], F.array(item("merged_sources", F.col("source"), F.lit(0))))
    several = clustered.groupBy("cluster_id").agg(F.count("*").alias("n")).where("n > 1").select("cluster_id")
    rows = clustered.select("cluster_id", "record_ix", "source", "source_type", *LISTS).join(several, "cluster_id", "left_semi").select("cluster_id", "record_ix", F.col("source").alias("s"), F.col("source_type").alias("k"), F.explode(items).alias("x")).select("cluster_id", "record_ix", "s", "k", "x.*")
    phone = F.col("name") == "phones"
    key = F.when(phone, F.substring("v", -10, 10)).when(F.col("name") == "merged_sources", F.col("v")).otherwise(F.lower("v"))
    rows = rows.select("cluster_id", "name", key.alias("key"), "s", F.struct((phone & ~F.coalesce(F.col("v").startswith("+91"), F.lit(False))).alias("abroad"), "record_ix", "pos").alias("at"), F.struct("v", "s", "k").alias("x"))
    by_source = rows.groupBy("cluster_id", "name", "key", "s").agg(F.min("at").alias("at"), F.min_by("x", "at").alias("x"))
    values = by_source.groupBy("cluster_id", "name", "key").agg(F.min("at").alias("at"), F.min_by("x", "at").alias("x"), F.array_sort(F.collect_list(F.struct("at", "s"))).alias("by"))
    one = F.struct("at", "x.v", "x.s", "x.k", F.when(F.col("name") == "skills", F.col("by.s")).alias("sources"))
    of = lambda c: F.array_sort(F.collect_list(F.when(F.col("name") == c, one))).alias(c)
    return values.groupBy("cluster_id").agg(*[of(c) for c in (*LISTS, "merged_sources")])


def _scalar_provenance(name: str) -> Column:
    best, first, several = F.col(f"best_{name}"), F.col(f"first_{name}"), F.col("n") > 1
    won = F.when(best["k"] == "structured", "merge_conflict_csv_won").otherwise("merge_conflict_resume_won")
    preferred = best["k"] == KIND[SCALARS[name]]
    fixed = F.when(preferred, F.lit(f"merge_conflict_{SCALARS[name]}_won")).otherwise(won)
    none = F.when(several, F.array(_entry(name, F.lit(None), F.lit("none"), F.lit("default"))))
    conflict = F.array(_entry(name, best["v"], best["s"], fixed))
    plain = F.array(_entry(name, first["v"], first["s"], _base(first["k"])))
    return F.coalesce(F.when(first.isNull(), none).when(several & F.col(f"differ_{name}"), conflict).otherwise(plain), F.array()).cast(PROVENANCE)


def _list_provenance(name: str) -> Column:
    word = F.lit(name == "skills")
    method = lambda x: F.when((x["k"] == "unstructured") & (word | (F.col("n") > 1)), "resume_keyword").otherwise(_base(x["k"]))
    return F.transform(f"kept_{name}", lambda x: _entry(name, x["v"], x["s"], method(x))).cast(PROVENANCE)


def _block_provenance(name: str) -> Column:
    best, several = F.col(f"best_{name}"), F.col("n") > 1
    method = F.when(best["k"] == "structured", "csv_direct").when(several & (F.col(f"n_{name}") > 1), "merge_conflict_resume_won").otherwise("regex_extract")
    none = F.when(several, F.array(_entry(name, F.lit(None), F.lit("none"), F.lit("default")))).otherwise(F.array().cast(PROVENANCE))
    return F.when(best.isNull(), none).otherwise(F.array(_entry(name, F.lit(None), best["s"], method))).cast(PROVENANCE)


def _link_provenance(name: str) -> Column:
    first = F.col(f"first_{name}")
    return F.when(first.isNull(), F.array()).otherwise(F.array(_entry(f"links.{name}", first["v"], first["s"], _base(first["k"])))).cast(PROVENANCE)


def merge(clustered: DataFrame) -> DataFrame:
    """One merged record for each ``cluster_id``.

    A cluster of one record keeps its lists as they are, with no row for each value; one of several unites them, each
    value once whatever its case, and collapses phones. ``skill_sources`` has for each kept
    skill the sources that name it. An empty table gives an empty result.
    """
    g = clustered.groupBy("cluster_id").agg(*_aggregates()).join(_list_values(clustered), "cluster_id", "left")
    several = F.col("n") > 1
    for name in LISTS:
        own = F.transform(f"_own.{name}", lambda v: F.struct(v.alias("v"), F.col("_own.source").alias("s"), F.col("_own.source_type").alias("k")))
        united = F.transform(name, lambda x: F.struct(x["v"].alias("v"), x["s"].alias("s"), x["k"].alias("k")))
        g = g.withColumn(f"kept_{name}", F.when(several, united).otherwise(F.coalesce(own, F.array().cast("array<struct<v:string,s:string,k:string>>"))))
    g = g.withColumn("skill_sources", F.when(several, F.col("skills.sources")).otherwise(F.transform("kept_skills", lambda x: F.array(x["s"]))))
    many = F.concat(*[_list_provenance(c) for c in LISTS], *[_scalar_provenance(c) for c in SCALARS])
    one = F.concat(*[_scalar_provenance(c) for c in SCALARS], *[_list_provenance(c) for c in LISTS])
    tail = F.concat(*[_block_provenance(c) for c in BLOCKS], *[_link_provenance(c) for c in LINKS])
    return g.select(
        "cluster_id", "n", *[F.coalesce(F.when(several, F.col(f"best_{c}")["v"]), F.col(f"first_{c}")["v"]).alias(c) for c in SCALARS],
        *[F.transform(f"kept_{c}", lambda x: x["v"]).alias(c) for c in LISTS], "skill_sources",
        *[F.coalesce(F.col(f"best_{c}")["v"], F.array().cast(t)).alias(c) for c, t in BLOCKS.items()],
        F.struct(*[F.col(f"first_{c}")["v"].alias(c) for c in LINKS], F.array().cast("array<string>").alias("other")).alias("links"),
        F.when(several, F.col("merged_sources.v")).otherwise(F.array("_own.source")).alias("merged_sources"), F.concat(F.when(several, many).otherwise(one), tail).alias("provenance"),
    )

"""Identity resolution: records of one person by a shared address, or a shared phone and a
name that is nearly the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rosterweave.functions.text import pytrim, sorted_tokens
from rosterweave.operators.near import near_names
from rosterweave.storage import cut, discard, figure

THRESHOLD = 85.0


def keys(validated: DataFrame) -> DataFrame:
    """``(record_ix, emails, phones, name)`` as compared: trimmed, addresses and names in lower case."""
    both = lambda many, one: F.filter(F.concat(F.coalesce(many, F.array().cast("array<string>")), F.array(one)), lambda x: x.isNotNull())
    return validated.select("record_ix", F.array_distinct(F.transform(both("emails", "email"), lambda x: F.lower(pytrim(x)))).alias("emails"), F.array_distinct(F.transform(both("phones", "phone"), pytrim)).alias("phones"), F.lower(pytrim(F.coalesce("full_name", F.lit("")))).alias("name"))


def email_edges(keyed: DataFrame) -> DataFrame:
    """``(src, dst, reason)``: each holder of an address to its first holder; equality is
    transitive within an address, so a star joins what pairs would."""
    held = keyed.select("record_ix", F.explode("emails").alias("email")).where("email <> ''")
    first = held.groupBy("email").agg(F.min("record_ix").alias("src"), F.max("record_ix").alias("last")).where("src < last").drop("last")
    return held.join(first, "email").where("record_ix > src").select("src", F.col("record_ix").alias("dst"), F.concat(F.lit("email_exact:"), "email").alias("reason"))


def phone_name_edges(keyed: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(src, dst, score)``: records that share a phone and have names of a ratio from
    ``threshold`` on. Records of one phone and one name are a star, and of the distinct names
    of a phone those are compared that have enough letters in common."""
    held = keyed.where("name <> ''").select("record_ix", F.explode("phones").alias("phone"), sorted_tokens(F.col("name")).alias("name")).where("phone <> ''")
    names = cut(held.groupBy("phone", "name").agg(F.min("record_ix").alias("ix"), F.max("record_ix").alias("last")), "names")
    same = held.join(names.where("ix < last").select("phone", "name", "ix"), ["phone", "name"]).where("record_ix > ix").select(F.col("ix").alias("src"), F.col("record_ix").alias("dst"), F.lit(100.0).alias("score"))
    near = near_names(names.select("phone", "name", "ix"), threshold).where("ia <> ib").select(F.least("ia", "ib").alias("src"), F.greatest("ia", "ib").alias("dst"), "score")
    return same.unionByName(near).groupBy("src", "dst").agg(F.max("score").alias("score"))


def edges(keyed: DataFrame) -> DataFrame:
    """``(src, dst, score)``: all edges, ``score`` null where an address joins the two."""
    both = email_edges(keyed).select("src", "dst", F.lit(None).cast("double").alias("score")).unionByName(phone_name_edges(keyed))
    return both.groupBy("src", "dst").agg(F.when(F.count("score") == F.count("*"), F.max("score")).alias("score"))


def reasons(keyed: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """``(src, dst, reason)`` of all edges, or those ``found``: the addresses that both records have, in order, which
    outrank a name, else the score of the names."""
    of = lambda end: keyed.select(F.col("record_ix").alias(end), F.col("emails").alias(f"e_{end}"))
    both = (found if found is not None else cut(edges(keyed), "edges")).join(of("src"), "src").join(of("dst"), "dst").withColumn("shared", F.array_sort(F.array_intersect(F.filter("e_src", lambda e: e != ""), "e_dst")))
    return both.select("src", "dst", F.when(F.size("shared") > 0, F.concat(F.lit("email_exact:"), F.array_join("shared", ","))).otherwise(F.format_string("name_phone_fuzzy:score=%d", F.floor("score"))).alias("reason"))


def components(pairs: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(node, root)`` of ``pairs(src, dst)``: labels fall to the least neighbour, then to the
    label of the label, which halves the way to the root each round."""
    both = cut(pairs.select("src", "dst").unionByName(pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).where("src <> dst").distinct(), "pairs")
    now = cut(both.groupBy(F.col("src").alias("node")).agg(F.least(F.min("dst"), F.first("src")).alias("root")), "labels")
    for _ in range(max_rounds):
        seen = both.join(now.select(F.col("node").alias("dst"), F.col("root").alias("r")), "dst").groupBy(F.col("src").alias("node")).agg(F.min("r").alias("r"))
        low = now.join(seen, "node").select("node", "root", F.least("root", "r").alias("low"))
        jump = now.select(F.col("node").alias("low"), F.col("root").alias("far"))
        then = cut(low.join(jump, "low").select("node", F.least("low", "far").alias("root"), (F.least("low", "far") < F.col("root")).alias("moved")), "labels", moved=F.count_if("moved"))
        moved = figure(then, "moved")
        discard(now)
        now = then.drop("moved")
        now._cut_path = then._cut_path
        if not moved:
            return now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def clusters(validated: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """Validated records with ``cluster_id``, the least ``record_ix`` of the person. Records
    that match none are alone; an empty table gives an empty result. ``found`` are the edges,
    if they are there already."""
    roots = components(found if found is not None else cut(edges(keys(validated)), "edges"))
    return validated.join(roots.select(F.col("node").alias("record_ix"), F.col("root").alias("cluster_id")), "record_ix", "left").withColumn("cluster_id", F.coalesce("cluster_id", "record_ix"))

"""Linking the variant spellings of organisations and persons.

Distinct spellings are read into a class and a text (line of business and core, given and
family name). Texts of one class are compared as weighted character n-gram vectors by a
sparse cosine join, links at the threshold are grouped by average linkage, and spellings
whose classes are open (no line of business, an initial, a nickname of several names) join
the groups that their text is near in any class they allow.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rosterweave.llm import name_parts as parts
from rosterweave.llm.linkage import cluster
from rosterweave.llm.canonical import near_texts
from rosterweave.llm.ngrams import cosine_links, crowd_of, gram_weights, meet, postings, shared
from rosterweave.operators.joins import BROADCAST_BYTES, bounded_broadcast, measured_bytes
from rosterweave.storage import cut, discard, figure

LEXICONS = {"company": parts.LINES, "institution": parts.SCHOOLS}


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    known: dict[str, dict] = {k: {} for k in LEXICONS}
    for batch in batches:
        rows = []
        for kind, name in zip(batch["kind"], batch["name"], strict=True):
            if kind in LEXICONS:
                got = parts.parse_organisation(name, LEXICONS[kind], known[kind])
                if got:
                    rows.append((kind, name, got[0], got[1], ""))
            else:
                got = parts.parse_person(name)
                if got:
                    rows.append((kind, name, *got))
        yield pd.DataFrame(rows, columns=["kind", "name", "cls", "text", "nick"])


def nickname_table() -> list[tuple[str, str]]:
    return [(n.lower(), given.lower()) for given, names in (p.strip().split(": ") for p in parts.NICKNAMES.split(";")) for n in names.split(" ")]


def _errors(counts: DataFrame, ratio: int) -> DataFrame:
    """``(text, fixed)``: for spellings that a far more frequent one is within two edits of,
    that one. ``counts`` is a cut table ``(text, n)``."""
    rare = counts.select("text", "n")
    often = counts.where(F.col("n") >= ratio).select(F.col("text").alias("fixed"), F.col("n").alias("often"))
    near = near_texts(rare, often).where(F.col("often") >= F.col("n") * ratio)
    return near.groupBy("text").agg(F.max_by("fixed", F.struct((-F.col("d")).alias("d"), "often", "fixed")).alias("fixed"))


def frequent_spelling(texts: DataFrame, ratio: int = 5) -> DataFrame:
    """``(text, spelling)`` for every distinct text: itself, or the far more frequent spelling
    that it is near to. ``texts`` is ``(text, n)`` without nulls, ``n`` being how often it occurs."""
    counts = cut(texts.groupBy("text").agg(F.sum("n").alias("n")), "texts")
    return counts.join(_errors(counts, ratio), "text", "left").select("text", F.coalesce("fixed", "text").alias("spelling"))


def given_classes(read: DataFrame, ratio: int = 5) -> DataFrame:
    """``(cls, given)``: the given names that a typed one may stand for.

    An error stands for the far more frequent spelling it is near to; a nickname stands for
    the names it is typed with in brackets or that the table of nicknames has.
    """
    spark = read.sparkSession
    people = read.where("kind = 'full_name' and length(cls) > 1")
    counts = cut(people.groupBy(F.col("cls").alias("text")).agg(F.count("*").alias("n")), "givens")
    best = _errors(counts, ratio).withColumnRenamed("text", "cls")
    counts = counts.withColumnRenamed("text", "cls")
    typed = spark.createDataFrame(nickname_table(), "fixed string, given string")
    seen = people.where("nick <> ''").groupBy(F.col("nick").alias("fixed"), F.col("cls").alias("given")).count()
    most = seen.groupBy("fixed").agg(F.max("count").alias("top"))
    seen = seen.join(most, "fixed").where("count * 2 >= top and count > 1").select("fixed", "given")
    nicks = cut(typed.unionByName(seen).distinct(), "nicknames")
    known = nicks.select(F.col("fixed").alias("cls")).unionByName(nicks.select(F.col("given").alias("cls"))).distinct().withColumn("is_known", F.lit(True))
    one = counts.join(best, "cls", "left").join(known, "cls", "left")
    one = one.select("cls", F.when(F.col("is_known"), F.col("cls")).otherwise(F.coalesce("fixed", "cls")).alias("fixed"))
    return one.join(nicks, "fixed", "left").select("cls", F.coalesce("given", "fixed").alias("given")).distinct()


def allowed_classes(loose: DataFrame, known: DataFrame, posted: DataFrame, held, threshold: float) -> DataFrame:  # noqa: ANN001
    """``(kind, first, text, cls)``: for open spellings ``loose(id, kind, first, text)`` the classes in
    which some text of ``known(id, kind, cls, text)`` reaches ``threshold``. ``posted`` are the
    postings of the known texts with their kind (``kind_b``) and class, which are looked up by
    their kind and initial (``lettered``) and, for spellings without an initial, by their kind
    alone (``kinded``)."""
    asked = cut(postings(loose.select("id", F.xxhash64("kind", "first").alias("block"), "text"), held, threshold), "asked")
    have = posted.withColumn("block", F.explode(F.array("lettered", "kinded")))
    few = measured_bytes(asked) <= BROADCAST_BYTES
    have = have if few else cut(have, "postings")  # else it is read once
    # a side that is broadcast needs no spreading of crowded grams
    met = meet(F.broadcast(asked) if few else asked, have, held, threshold, 0 if few else crowd_of(known, "kind"), keep=("kind_b", "cls"))
    met = cut(met.select("a", "kind_b", "cls").distinct(), "met")
    discard(asked), discard(have)
    found = loose.join(bounded_broadcast(met), F.col("id") == F.col("a"))
    return found.where("kind = kind_b and (first = '' or startswith(cls, first))").select("kind", "first", "text", "cls").distinct()


def spelling_groups(names: DataFrame, link: float = 0.36, merge: float = 0.42) -> DataFrame:
    """``(kind, name, group)``: every distinct spelling with the groups it belongs to, mostly one.

    ``names`` is ``(kind, name)``, kind being company, institution or full_name. Null and
    stand-in names are left out, repeated rows count once, and a name that is like no other
    has a group of its own. A spelling with an open class joins a group first by a text that
    a spelling of a class it allows has letter for letter, else in each class it allows that
    has a text near to its own; where there is none, open spellings are grouped among each
    other. An empty table gives an empty result.
    """
    read = cut(names.where("name is not null").select("kind", "name").distinct().mapInPandas(_read, "kind string, name string, cls string, text string, nick string"), "read")
    givens = cut(given_classes(read), "classes")
    full = read.where("kind = 'full_name' and length(cls) > 1").join(bounded_broadcast(givens), "cls").select("kind", "name", F.col("given").alias("cls"), "text")
    orgs = read.where("kind <> 'full_name' and cls <> ''").select("kind", "name", "cls", "text")
    sure = full.unionByName(orgs)
    open_ = read.where("cls = '' or (kind = 'full_name' and length(cls) = 1)").select("kind", "name", F.col("cls").alias("first"), "text")
    node = F.xxhash64("kind", "cls", "text").alias("id")
    known = cut(sure.select("kind", "cls", "text").distinct().select(node, "kind", "cls", "text"), "known")
    typed = open_.select("kind", "first", "text").distinct()
    exact = cut(typed.join(known, ["kind", "text"]).where("first = '' or startswith(cls, first)").select("kind", "first", "text", "cls"), "exact")
    loose = cut(typed.join(exact, ["kind", "first", "text"], "left_anti").select(F.xxhash64("kind", "first", "text").alias("id"), "kind", "first", "text"), "loose")
    weights = gram_weights(known.select("text").unionByName(loose.select("text")))
    held = shared(weights)
    block = F.concat_ws("|", "kind", "cls")
    posted = postings(known.select("id", F.xxhash64("kind", F.substring("cls", 1, 1)).alias("lettered"), F.xxhash64("kind", F.lit("")).alias("kinded"), F.col("kind").alias("kind_b"), "cls", "text"), held, link)
    found = allowed_classes(loose, known, posted, held, link)
    classes = cut(exact.unionByName(found), "allowed")
    alone = loose.join(classes, ["kind", "first", "text"], "left_anti").withColumn("cls", F.concat(F.lit("?"), "first"))
    own = classes.unionByName(alone.select("kind", "first", "text", "cls"))
    spelled = sure.unionByName(open_.join(own, ["kind", "first", "text"]).select("kind", "name", "cls", "text")).withColumn("id", node)
    extra = own.join(exact, ["kind", "first", "text"], "left_anti").select("kind", "cls", "text").distinct().select(node, "kind", "cls", "text")
    extra = extra.select("id", block.alias("block"), "text")
    nodes = cut(known.select("id", block.alias("block"), "text").unionByName(extra), "nodes")
    links = cut(cosine_links(nodes, held, link), "links")
    grouped = cut(cluster(nodes, weights, links, merge), "grouped")
    discard(links)
    placed = spelled.join(grouped, "id", "left").select("kind", "name", F.concat_ws("|", "kind", "cls", F.coalesce("cluster", "id").cast("string")).alias("group"))
    out = cut(placed.distinct(), "spelling")
    for done in (read, givens, known, exact, loose, classes, nodes, grouped):
        discard(done)
    return out


def variant_pairs(groups: DataFrame, crowd: int = 4096) -> DataFrame:
    """``(kind, name_a, name_b)``: all pairs of different spellings of one group, a < b by code
    points. The pairs are the stated result; a group of more than ``crowd`` spellings is paired
    by as many tasks as it has that many."""
    groups = groups if figure(groups, "rows") is not None else cut(groups, "groups")
    sizes = cut(groups.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > crowd).select("group", F.ceil(F.col("n") / crowd).cast("int").alias("parts")), "crowds")
    rows = groups.select("kind", "group", "name")
    keys, left, right = ["kind", "group"], rows, rows
    if figure(sizes, "rows"):
        keys.append("part")
        spread = rows.join(bounded_broadcast(sizes), "group", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        left = spread.withColumn("part", F.pmod(F.xxhash64("name"), "parts").cast("int"))
        right = spread.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    pairs = left.select(*keys, F.col("name").alias("name_a")).join(right.select(*keys, F.col("name").alias("name_b")), keys)
    return pairs.where("name_a < name_b").select("kind", "name_a", "name_b").distinct()

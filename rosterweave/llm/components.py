"""Consolidating pairwise matches into groups by alternating large-star and small-star.

Edges are kept as pairs ``u > v``. A large-star round links every larger neighbour of a
node to the smallest node of its neighbourhood, a small-star round does so for the node and
its smaller neighbours; both preserve the components and together turn each into a star
around its minimum. A round needs the minimum of each neighbourhood only, which partial
aggregation computes without gathering a neighbourhood anywhere; the join that hands the
minimum back to the edges of a hot node is split by adaptive execution, as the minimum side
has one row for each node.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rosterweave.storage import cut, discard, figure


def _oriented(edges: DataFrame) -> DataFrame:
    return edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _oriented(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.*")
    return _oriented(moved)


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(node, group_id)`` for every node of ``edges(u, v)``; ``group_id`` is the least node
    of its component.

    Repeated edges, either direction and loops are allowed; edges with a null end are
    ignored, and a node that has no edge to another node is not in the result. An empty
    table gives an empty result. Other columns of ``edges`` are not read. Rounds end when the
    edge set no longer changes; if ``max_rounds`` do not suffice an error is raised, never an
    unfinished grouping.
    """
    # the edge set is known by its size and the sum of its hashes, counted while it is written
    print_ = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    now = cut(_oriented(edges.select("u", "v").where("u is not null and v is not null")), "edges", hashes=print_)
    for _ in range(max_rounds):
        large = cut(_large_star(now), "large")
        then = cut(_small_star(large), "small", hashes=print_)
        discard(now), discard(large)
        now, before = then, now
        if all(figure(now, f) == figure(before, f) for f in ("rows", "hashes")):
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("group_id")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("group_id")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def contact_links(contacts: DataFrame, id_col: str) -> DataFrame:
    """Edges ``(u, v)`` from each holder of a contact to its least holder: linear in the
    holders, where pairs would be quadratic. ``contacts`` is ``(id_col, contact)``."""
    low = contacts.groupBy("contact").agg(F.min(id_col).alias("v"), F.max(id_col).alias("top")).where("top > v").drop("top")
    return contacts.join(low, "contact").select(F.col(id_col).alias("u"), "v").where("u > v")


def group_by_contact(contacts: DataFrame, id_col: str) -> DataFrame:
    """``(id_col, group_id)`` of rows that share a contact with another row, directly or
    through other rows. ``contacts`` must be a table that is cheap to read again."""
    return components(contact_links(contacts, id_col)).withColumnRenamed("node", id_col)

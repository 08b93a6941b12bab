"""Filling containers of fixed capacity: Martello-Toth reduction, then best fit.

What a packing needs of the items is how many there are of each size, and sizes are bounded
by the capacity, so the packing is solved on a histogram: patterns of sizes with the number
of containers that have them. The reduction fixes sets that dominate every alternative for
their largest item; the remaining sizes are placed best fit, largest first, whole groups of
equal containers at a time. Items then find their container by their rank among the items
of the same size, which is counted in hash buckets, so a size shared by a third of all
items is ranked by many tasks.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from rosterweave.operators.joins import bounded_broadcast
from rosterweave.storage import cut, figure

STRETCH = 6  # ranks meet slots in stretches of 2 ** STRETCH
Pattern = tuple[tuple[int, ...], int]


def reduce_sizes(count: np.ndarray, capacity: int) -> list[Pattern]:
    """Fix dominating sets; ``count[s]`` items of size ``s`` are left in ``count``.

    For the largest item ``w``: alone if nothing fits with it; with the largest ``r`` that
    fits if both fill the container, or if no set of at most three items with ``w`` can hold
    more than ``r`` beside it and no fourth item fits.
    """
    fixed: list[Pattern] = []
    w = capacity
    while w > 0:
        n = int(count[w])
        if not n:
            w -= 1
            continue
        room = capacity - w
        count[w] -= 1  # the partner of an item is another item
        have = np.flatnonzero(count[1 : room + 1]) + 1
        count[w] += 1
        if not len(have):
            fixed.append(((w,), n))
            count[w] = 0
            continue
        r = int(have[-1])
        copies = n // 2 if r == w else min(n, int(count[r]))
        small = np.repeat(have[:3], np.minimum(count[have[:3]] - (have[:3] == w), 3))[:3]
        if w + r == capacity or len(small) < 2 or small[0] + small[1] > room:
            dominated = True
        elif len(small) == 3 and small.sum() <= room:
            dominated = False
        else:
            below = np.zeros(room + 1, int)
            below[have] = have
            below = np.maximum.accumulate(below)
            mate = below[room - have]
            twice = (mate == have) & (count[have] - (have == w) < 2)
            mate = np.where(twice, below[np.maximum(have - 1, 0)], mate)
            dominated = bool((np.where(mate > 0, have + mate, 0) <= r).all())
        if not dominated or not copies:
            w -= 1
            continue
        fixed.append(((w, r), copies))
        count[w] -= copies
        count[r] -= copies
    return fixed


def best_fit(count: np.ndarray, capacity: int, opened: list[Pattern]) -> list[Pattern]:
    """Place what is left, largest first, each item in the fullest container that takes it."""
    rooms: list[int] = []
    groups: dict[int, list[list]] = {}

    def put(sizes: tuple[int, ...], n: int) -> None:
        room = capacity - sum(sizes)
        if room not in groups:
            groups[room] = []
            insort(rooms, room)
        groups[room].append([sizes, n])

    for sizes, n in opened:
        put(sizes, n)
    for s in range(capacity, 0, -1):
        n = int(count[s])
        while n:
            at = bisect_left(rooms, s)
            if at == len(rooms):
                each = capacity // s
                if n >= each:
                    put((s,) * each, n // each)
                if n % each:
                    put((s,) * (n % each), 1)
                break
            room = rooms[at]
            sizes, have = groups[room].pop()
            if not groups[room]:
                del groups[room]
                rooms.pop(at)
            used = min(n, have)
            if used < have:
                put(sizes, have - used)
            put((*sizes, s), used)
            n -= used
        count[s] = 0
    merged: dict[tuple[int, ...], int] = {}
    for kinds in groups.values():
        for sizes, n in kinds:
            merged[sizes] = merged.get(sizes, 0) + n
    return sorted(merged.items())


def pack_histogram(sizes: dict[int, int], capacity: int) -> list[Pattern]:
    """``(sizes in a container, number of such containers)`` for items of sizes 1 to capacity."""
    count = np.zeros(capacity + 1, int)
    for s, n in sizes.items():
        count[s] += n
    return best_fit(count, capacity, reduce_sizes(count, capacity))


def _slots(rows: pd.DataFrame) -> pd.DataFrame:
    capacity, spec = int(rows["capacity"].iloc[0]), rows["spec_id"].iloc[0]
    patterns = pack_histogram(dict(zip(rows["size"], rows["n"], strict=True)), capacity)
    base, taken, out = int(rows["full"].iloc[0]), {}, []
    for sizes, n in patterns:
        for s in sizes:
            first = taken.get(s, 0)
            out.append((spec, s, first, n, base))
            taken[s] = first + n
        base += n
    return pd.DataFrame(out, columns=["spec_id", "size", "first", "n", "base"])


def pack(items: DataFrame, specs: DataFrame, id_col: str = "doc_id", size_col: str = "n_tokens", bucket_items: int = 50_000) -> DataFrame:
    """``(spec_id, id_col, piece, first_token, n_tokens, container_id)``.

    ``specs`` is ``(spec_id, capacity_tokens)``; one without a positive capacity has no rows.
    An item is whole (piece 0) unless it is larger than the capacity: then its pieces of full
    capacity have a container each and the last piece is packed like any item. Items of
    size 0 or null take no space and lie in container 0. Container numbers are dense from 0.
    Ids are expected to be distinct; the result does not depend on the order of the rows.
    """
    specs = specs.select("spec_id", F.col("capacity_tokens").cast("int").alias("capacity")).where("capacity > 0")
    sized = items.select(F.col(id_col).alias("_id"), F.coalesce(F.col(size_col), F.lit(0)).cast("long").alias("_size"))
    wide = cut(sized.select("_id", "_size", F.explode(_spec_array(specs)).alias("s")).select("_id", "_size", "s.*"), "sized")
    whole = F.floor(F.col("_size") / F.col("capacity"))
    rest = wide.select("_id", "spec_id", "capacity", (F.col("_size") - whole * F.col("capacity")).cast("int").alias("size"), F.when(F.col("_size") > F.col("capacity"), whole).otherwise(F.lit(0)).cast("int").alias("piece"), "_size").where((F.col("size") > 0) | (F.col("_size") == 0) | (F.col("_size") == F.col("capacity")))
    rest = rest.withColumn("size", F.when(F.col("_size") == F.col("capacity"), F.col("capacity")).otherwise(F.col("size")))
    over = wide.where("_size > capacity").select("_id", "spec_id", "capacity", whole.cast("int").alias("k"))

    total = figure(wide, "rows")
    buckets = max(1, total // bucket_items)
    rest = rest.withColumn("b", F.pmod(F.xxhash64("_id"), F.lit(buckets)))
    over = over.withColumn("b", F.pmod(F.xxhash64("_id"), F.lit(buckets)))

    # full pieces: container numbers from 0, offset by bucket and then counted within it
    full = over.groupBy("spec_id", "b").agg(F.sum("k").alias("k"))
    before = full.select("spec_id", "b", (F.sum("k").over(Window.partitionBy("spec_id").orderBy("b")) - F.col("k")).alias("start"))
    within = Window.partitionBy("spec_id", "b").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    pieces = over.join(before, ["spec_id", "b"]).withColumn("start", F.col("start") + F.coalesce(F.sum("k").over(within), F.lit(0)))
    pieces = pieces.select("spec_id", "_id", "capacity", "start", F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("piece"))
    pieces = pieces.select("spec_id", F.col("_id").alias(id_col), "piece", (F.col("piece").cast("long") * F.col("capacity")).alias("first_token"), F.col("capacity").cast("long").alias("n_tokens"), (F.col("start") + F.col("piece")).cast("long").alias("container_id"))

    counted = cut(rest.where("size > 0").groupBy("spec_id", "capacity", "size", "b").count(), "histogram")
    filled = full.groupBy("spec_id").agg(F.sum("k").alias("full"))
    histogram = counted.groupBy("spec_id", "capacity", "size").agg(F.sum("count").alias("n")).join(F.broadcast(filled), "spec_id", "left").withColumn("full", F.coalesce("full", F.lit(0)).cast("long"))
    kind = dict(specs.dtypes)["spec_id"]
    slots = histogram.groupBy("spec_id").applyInPandas(_slots, f"spec_id {kind}, size int, first long, n long, base long")
    # an item lies in the slot whose ranks hold its own; both meet in stretches of ranks
    stretches = F.explode(F.sequence(F.shiftright("first", STRETCH), F.shiftright(F.col("first") + F.col("n") - 1, STRETCH)))
    slots = cut(slots.withColumn("stretch", stretches), "slots")
    offset = counted.select("spec_id", "size", "b", (F.sum("count").over(Window.partitionBy("spec_id", "size").orderBy("b")) - F.col("count")).alias("start"))
    ranked = rest.where("size > 0").withColumn("_n", F.row_number().over(Window.partitionBy("spec_id", "size", "b").orderBy("_id")) - 1)
    ranked = ranked.join(offset, ["spec_id", "size", "b"]).withColumn("rank", F.col("start") + F.col("_n"))
    placed = ranked.withColumn("stretch", F.shiftright("rank", STRETCH)).join(bounded_broadcast(slots), ["spec_id", "size", "stretch"]).where("first <= rank and rank < first + n")
    placed = placed.select("spec_id", F.col("_id").alias(id_col), "piece", (F.col("piece").cast("long") * F.col("capacity")).alias("first_token"), F.col("size").cast("long").alias("n_tokens"), (F.col("base") + F.col("rank") - F.col("first")).cast("long").alias("container_id"))
    empty = wide.where("_size = 0").select("spec_id", F.col("_id").alias(id_col), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("first_token"), F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("container_id"))
    return placed.unionByName(pieces).unionByName(empty)


def _spec_array(specs: DataFrame):  # noqa: ANN202
    """The specifications as one literal: they are a short list kept by hand."""
    kind = dict(specs.dtypes)["spec_id"]
    rows = sorted({(r.spec_id, r.capacity) for r in specs.collect()})
    if not rows:
        return F.array().cast(f"array<struct<spec_id:{kind},capacity:int>>")
    return F.array(*[F.struct(F.lit(a).cast(kind).alias("spec_id"), F.lit(c).cast("int").alias("capacity")) for a, c in rows])


def fill_report(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """``(spec_id, containers, tokens, fill)``: how full the containers are."""
    used = packed.groupBy("spec_id").agg((F.max("container_id") + 1).alias("containers"), F.sum("n_tokens").alias("tokens"))
    return used.join(F.broadcast(specs.select("spec_id", "capacity_tokens")), "spec_id").select("spec_id", "containers", "tokens", F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("fill"))

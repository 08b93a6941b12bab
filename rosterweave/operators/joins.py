"""Joins against tables whose size is measured before a strategy is chosen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rosterweave.storage import cut, figure, row_width

BROADCAST_BYTES = 8 << 20
HOT_ROWS = 50_000


def _width(df: DataFrame) -> Column:
    """Bytes of one row; arrays and structs count as their JSON."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType))]
    parts = [F.coalesce(F.length(F.to_json(F.struct(f"`{c}`"))), F.lit(0)) + 16 for c in wide]
    return reduce(lambda a, b: a + b, parts, row_width(df.drop(*wide)))


def measured_bytes(df: DataFrame) -> int:
    """Size of a table as a sum over its rows, as it was counted when the table was cut, or
    counted now: call it on a cut or fixed table."""
    known = figure(df, "bytes")
    return known if known is not None else df.agg(F.coalesce(F.sum(_width(df).cast("long")), F.lit(0))).first()[0]


def bounded_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES, whole: DataFrame | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows one, else ``df`` as it is.
    ``whole`` is a table that ``df`` is a part of, whose size is taken instead."""
    return F.broadcast(df) if measured_bytes(whole if whole is not None else df) <= limit else df


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: list[str], how: str = "left", limit: int = BROADCAST_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join ``rows`` to ``lookup``, which has at most one row for each key.

    A lookup of at most ``limit`` measured bytes is broadcast. With a larger one, rows of hot
    keys (more than ``hot_rows`` rows and a thousandth of all, so a thousand keys at most) meet
    their part of the lookup by broadcast, the others by a shuffle, and rows with a null key
    by neither; so no task gets the rows of a key that holds a third of them.
    """
    if measured_bytes(lookup) <= limit:
        return rows.join(F.broadcast(lookup), keys, how)
    total = figure(rows, "rows")
    least = max(hot_rows, (total if total is not None else rows.count()) // 1000)
    hot = cut(rows.groupBy(*keys).count().where(F.col("count") > least).select(*keys), "hot")
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    out = rows.where(~null)
    if not figure(hot, "rows"):
        out = out.join(lookup, keys, how)
    else:
        few = F.broadcast(hot)
        cold = out.join(few, keys, "left_anti").join(lookup, keys, how)
        out = cold.unionByName(out.join(few, keys, "left_semi").join(F.broadcast(lookup.join(few, keys, "left_semi")), keys, how))
    if how == "left":
        out = out.unionByName(rows.where(null), allowMissingColumns=True)
    return out

"""String expressions that Spark lacks."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, functions as F

LINE_END = r"\R"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it, also
    inside the functions of arrays, where nothing is shared between branches."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pytrim(c: Column) -> Column:
    """Without any white space at both ends; Spark's trim knows only blanks."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def present(c: Column) -> Column:
    """Trimmed text, null if nothing is left."""
    return F.nullif(pytrim(c), F.lit(""))


def first_group(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of the first match, null without a match or if the group is empty."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def keep_first_by(values: Column, key: Callable[[Column], Column]) -> Column:
    """Elements whose key occurs for the first time, in order."""
    keys = F.transform(values, key)
    return F.filter(values, lambda x, i: F.array_position(keys, key(x)) == i + 1)


def _lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence. Bit i of ``row`` is off where the length
    grows at character i of ``a``; one addition carries a whole row of the table."""
    if not a or not b:
        return 0
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & at.get(y, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def lcs_length(a: Column, b: Column) -> Column:
    """Length of the longest common subsequence, in Arrow batches."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else _lcs(p, q) for p, q in zip(x, y, strict=True)], dtype="Int32")

    return F.pandas_udf(run, "int")(a, b)


def sorted_tokens(c: Column) -> Column:
    """White-space tokens in order of code points, joined by one blank."""
    return F.array_join(F.array_sort(F.filter(F.split(c, r"(?U)\s+"), lambda t: t != "")), " ")


def indel_ratio(a: Column, b: Column) -> Column:
    """Similarity from 0 to 100: twice the common subsequence over both lengths."""
    both = F.length(a) + F.length(b)
    return F.when(both == 0, F.lit(100.0)).when(a == b, F.lit(100.0)).otherwise(200.0 * lcs_length(a, b) / both)


def may_reach(a: Column, b: Column, least: float) -> Column:
    """False if the ratio of two texts is surely below ``least``: by their lengths, or as the
    edit distance is above what insertions and deletions alone may be at that ratio."""
    both = F.length(a) + F.length(b)
    most = F.floor(both * (100.0 - least) / 100.0 + 1e-9).cast("int")
    return (F.abs(F.length(a) - F.length(b)) <= most) & (F.call_function("levenshtein", a, b, most) >= 0)


def token_sort_ratio(a: Column, b: Column) -> Column:
    return indel_ratio(sorted_tokens(a), sorted_tokens(b))

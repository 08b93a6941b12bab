"""Several values packed in one field.

A text is cut into runs: ordinary characters, blanks, and single characters that may
delimit, quote or bracket. Writing one mark for each run gives the delimiter skeleton of
the text. The grammar is resolved once for each distinct skeleton into a list of run ranges,
and the ranges are applied to the runs of every text by position inside the JVM. Skeletons
of long lists in mixed notation are many, so the rules are broadcast only at a measured size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from rosterweave.operators.joins import lookup_join
from rosterweave.storage import cut

# Fixed values of the grammar.
JOINERS = ("and", "und", "et", "y")
DELIMITERS = ",;|·•\t\n/"
QUOTES = {'"': '"', "'": "'", "“": "”", "„": "“", "«": "»", "‘": "’"}
BRACKETS = {"(": ")", "[": "]", "{": "}"}
LIST_MARKS = "MN•·"

_SINGLE = ",;|·•\"'“”„«»‘’()\\[\\]{}"
RUN = (
    r"\r\n|[\n\r]|\t"
    r"|[^\S\n\r\t]+"
    r"|(?<=\s)(?i:" + "|".join(JOINERS) + r")(?=\s)"
    r"|(?<![^\s])\d{1,3}[.)](?=\s)"
    r"|(?<=\s)/(?=\s)"
    r"|(?<![^\s])[-*–](?=\s)"
    rf"|[{_SINGLE}]"
    rf"|[^\s{_SINGLE}]+"
)
VALUE_RULE = "array<struct<first:int,n:int,doubled:boolean>>"


def _mark(run: Column) -> Column:
    first = F.substring(run, 1, 1)
    return (
        F.when(first.isin(*"\n\r"), F.lit("\n"))
        .when(first == "\t", F.lit("\t"))
        .when(F.trim(run) == "", F.lit(" "))
        .when(run.isin(*",;|·•\"'“”„«»‘’()[]{}/"), run)
        .when(run.isin("-", "*", "–"), F.lit("M"))
        .when(F.lower(run).isin(*JOINERS), F.lit("J"))
        .when(run.rlike(r"^\d{1,3}[.)]$"), F.lit("N"))
        .when(run.rlike(r"^\s"), F.lit(" "))
        .otherwise(F.lit("x"))
    )


def resolve_skeleton(skeleton: str) -> list[tuple[int, int, bool]]:
    """Run ranges ``(first run from 1, number of runs, doubled quotes mean one)`` of the values."""
    lo, hi = 0, len(skeleton)

    def strip(a: int, b: int) -> tuple[int, int]:
        while a < b and skeleton[a] in " \n\t":
            a += 1
        while b > a and skeleton[b - 1] in " \n\t":
            b -= 1
        return a, b

    def closing(at: int, end: int) -> int:
        """Position of the bracket that closes the one at ``at``, or -1."""
        depth = []
        for i in range(at, end):
            if skeleton[i] in BRACKETS:
                depth.append(BRACKETS[skeleton[i]])
            elif depth and skeleton[i] == depth[-1]:
                depth.pop()
                if not depth:
                    return i
        return -1

    def quoted(at: int, end: int) -> int:
        """Position of the quote that closes the one at ``at``; -1 if it opens nothing."""
        mark, close = skeleton[at], QUOTES[skeleton[at]]
        i = at + 1
        while i < end:
            if skeleton[i] == close:
                if mark == '"' and i + 1 < end and skeleton[i + 1] == '"':
                    i += 2
                    continue
                j = i + 1
                while j < end and skeleton[j] == " ":
                    j += 1
                if j >= end or skeleton[j] in DELIMITERS or skeleton[j] in "J]})" or mark != "'":
                    return i
            i += 1
        return -1

    lo, hi = strip(lo, hi)
    while lo < hi and skeleton[lo] in BRACKETS and closing(lo, hi) == hi - 1:
        lo, hi = strip(lo + 1, hi - 1)

    fields, start, i, fresh, joins = [], lo, lo, True, []
    while i < hi:
        c = skeleton[i]
        if c in QUOTES and fresh and (end := quoted(i, hi)) > 0:
            i, fresh = end + 1, False
        elif c == "(" and (end := closing(i, hi)) > 0:
            i, fresh = end + 1, False
        elif c in DELIMITERS:
            fields.append((start, i, joins))
            i += 1
            start, fresh, joins = i, True, []
        else:
            if c == "J":
                joins.append(i)
                fresh = True
            elif c not in " MN":
                fresh = False
            i += 1
    fields.append((start, hi, joins))

    def value(a: int, b: int) -> tuple[int, int, bool] | None:
        a, b = strip(a, b)
        while a < b and skeleton[a] in LIST_MARKS and a + 1 < b and skeleton[a + 1] == " ":
            a, b = strip(a + 1, b)
        if b - a == 1 and skeleton[a] in "MN":
            return None
        doubled = False
        while b - a >= 2 and skeleton[a] in QUOTES and skeleton[b - 1] == QUOTES[skeleton[a]] and quoted(a, b) == b - 1:
            doubled |= skeleton[a] == '"'
            a, b = strip(a + 1, b - 1)
        return (a + 1, b - a, doubled) if b > a else None

    out = [(f, v) for f in fields if (v := value(f[0], f[1]))]
    if out and out[-1][0][2]:
        a, b, at = out[-1][0]
        left, right = value(a, at[-1]), value(at[-1] + 1, b)
        if right and (left or len(out) > 1):
            out[-1:] = [(None, v) for v in (left, right) if v]
    return [v for _, v in out]


def _resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        batch["rule"] = [[{"first": a, "n": n, "doubled": d} for a, n, d in resolve_skeleton(s)] for s in batch["skeleton"]]
        yield batch[["skeleton", "rule"]]


def split_values(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id_col, pos, skill_value)``: one row for each value packed in ``text_col``.

    ``pos`` counts from 1 over the values that are not empty. Blanks, enclosing quotes,
    brackets around the whole list and list marks are not part of a value; nothing inside
    quotes or round brackets is divided. A null or empty text gives no row; a text without
    a delimiter gives one. A quote that is never closed is an ordinary character. Rows of
    the same id are split each on its own, so repeated rows give repeated values; an empty
    table gives an empty result. Only the two named columns are read.
    """
    rows = df.select(F.col(id_col).alias("_id"), F.regexp_extract_all(F.col(text_col), F.lit(f"({RUN})"), F.lit(1)).alias("_runs")).where(F.size("_runs") > 0)
    # written once, as both the rules and the pieces are read from it
    rows = cut(rows.withColumn("skeleton", F.array_join(F.transform("_runs", _mark), "")), "runs")
    rules = cut(rows.select("skeleton").distinct().mapInPandas(_resolve, f"skeleton string, rule {VALUE_RULE}"), "rules")
    joined = lookup_join(rows, rules, ["skeleton"], "inner")
    pieces = joined.select("_id", "_runs", F.posexplode("rule").alias("_pos", "_r"))
    value = F.array_join(F.slice("_runs", F.col("_r.first"), F.col("_r.n")), "")
    value = F.when(F.col("_r.doubled"), F.regexp_replace(value, '""', '"')).otherwise(value)
    return pieces.select(F.col("_id").alias(id_col), (F.col("_pos") + 1).alias("pos"), value.alias("skill_value"))

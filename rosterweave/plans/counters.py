"""Counts of a run, stage by stage."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, functions as F


def observed(df: DataFrame, name: str, **counts) -> tuple[DataFrame, Observation]:  # noqa: ANN003
    """``df`` that counts its rows, and ``counts`` of them, on the way to whatever is done with it;
    the observation has the figures once that is done, without a pass of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.coalesce(F.sum(c), F.lit(0)).alias(k) for k, c in counts.items()]), seen


def run_counters(validated: DataFrame, merged: DataFrame, built: DataFrame, checked: DataFrame) -> DataFrame:
    """``(counter, n)``: records, rejected values, clusters, profiles built, clusters skipped and
    profiles that the configuration refuses. The four are tables of the stages."""
    one = lambda df, *counts: df.agg(*counts)
    row = reduce(DataFrame.crossJoin, [
        one(validated, F.count(F.lit(1)).alias("records"), F.coalesce(F.sum(F.size("validation_log")), F.lit(0)).alias("rejections")),
        one(merged, F.count(F.lit(1)).alias("clusters")), one(built, F.count(F.lit(1)).alias("built")), one(checked, F.count_if("should_abort").alias("aborted")),
    ])  # fmt: skip - one row each
    row = row.withColumn("skipped", F.col("clusters") - F.col("built"))
    return row.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, row.columns)), F.array(*row.columns))).alias("counter", "n"))

"""Parquet tables of one data set."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(df: DataFrame, key: str, *columns: str) -> DataFrame:
    """Rows delivered twice count once. The values of both deliveries are equal, so the
    needed columns are projected before the shuffle."""
    return df.select(key, *columns).where(df[key].isNotNull()).dropDuplicates([key])

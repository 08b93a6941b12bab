"""Durable intermediate tables.

Iterative operators cut their lineage by writing a parquet table below the folder that
``spark.checkpoint.dir`` names. That folder is shared by all executors, so a lost executor
costs a re-read and never a recomputation of the loop.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T


def shared_dir(spark: SparkSession) -> str:
    """Folder for cut tables: the session's ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, but only in local mode; on a
    cluster a machine-local folder would not be visible to the other executors.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        return conf.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="rosterweave-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    made = "file://" + folder
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def row_width(df: DataFrame) -> Column | None:
    """Bytes of one row, counted: strings by length, other single values as 8; None if a column
    is no single value."""
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.length(F.col(f"`{f.name}`")), F.lit(0)) + 16)
        elif isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)):
            return None
        else:
            parts.append(F.lit(8))
    return reduce(lambda a, b: a + b, parts, F.lit(8))


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, name: str = "t", **figures: Column) -> DataFrame:
    """Write ``df`` once and return a scan of what was written.

    ``figures`` are aggregates that are counted while the rows are written, with no pass of
    their own, and so are the rows and, of a table of single values, the bytes; see
    :func:`figure`. The shuffle files of the write are deleted with its end, as nothing reads
    them again; else they stay until the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    seen, width = Observation(), row_width(df)
    counted = {"rows": F.count(F.lit(1)), **figures}
    if width is not None:
        counted["bytes"] = F.coalesce(F.sum(width.cast("long")), F.lit(0))
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.observe(seen, *[c.alias(k) for k, c in counted.items()]).write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path, out._figures = path, seen.get
    return out


def figure(df: DataFrame, name: str):  # noqa: ANN201
    """A figure counted when ``df`` was cut; None for a table that was not cut, or without it."""
    return getattr(df, "_figures", {}).get(name)


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`cut`; a table of another kind is left alone."""
    path = getattr(df, "_cut_path", None)
    if path:
        spark = df.sparkSession
        jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
        jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)

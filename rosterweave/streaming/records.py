"""Validation of records as they arrive: it keeps no state, so it runs on a stream as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from rosterweave.operators.validate import validate


def validated_stream(raw: DataFrame) -> DataFrame:
    """Validated records of a stream of raw records."""
    return validate(raw)


def append_validated(raw: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write validated records of a stream to a parquet table, exactly once; all that has
    arrived is processed, then the query ends."""
    return validated_stream(raw).writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()

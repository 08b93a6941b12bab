"""Checks of projected records against their configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rosterweave.operators.project import Config

_NUMBERS = (T.DoubleType, T.FloatType, T.LongType, T.IntegerType, T.ShortType, T.DecimalType)


def type_matches(kind: T.DataType, declared: str | None) -> bool:
    """Whether a column's type is the declared one of the six words; other words pass."""
    array = isinstance(kind, T.ArrayType)
    tests = {
        "string": isinstance(kind, T.StringType), "string[]": array, "number": isinstance(kind, _NUMBERS), "object": isinstance(kind, (T.StructType, T.MapType)), "object[]": array, "boolean": isinstance(kind, T.BooleanType),
    }
    return tests.get(declared, True)


def check(projected: DataFrame, config: Config) -> DataFrame:
    """``projected`` with ``violations``, ``warnings`` and ``should_abort``."""
    violations: list[Column] = []
    warnings: list[Column] = []
    types = {f.name: f.dataType for f in projected.schema.fields}
    for spec in config.fields:
        have = spec.path in types
        value = F.col(f"`{spec.path}`") if have else F.lit(None)
        if spec.required:
            violations.append(F.when(value.isNull(), F.lit(f"required field missing: {spec.path}")))
        if have and not type_matches(types[spec.path], spec.type):
            said = F.when(value.isNotNull(), F.lit(f"type mismatch: {spec.path} is not {spec.type}"))
            (violations if spec.required else warnings).append(said)
    for name, on in (("overall_confidence", config.include_confidence), ("provenance", config.include_provenance)):
        if on and name not in types:
            warnings.append(F.lit(f"{name} expected but absent"))
    texts = lambda xs: F.array_compact(F.array(*xs)) if xs else F.array().cast("array<string>")
    out = projected.withColumn("violations", texts(violations)).withColumn("warnings", texts(warnings))
    return out.withColumn("should_abort", F.size("violations") > 0)


def valid_only(checked: DataFrame) -> DataFrame:
    return checked.where(~F.col("should_abort")).drop("violations", "warnings", "should_abort")

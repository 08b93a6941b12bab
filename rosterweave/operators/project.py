"""The projection language: a small configuration compiled into columns.

A field has ``path`` (its name in the output), optionally ``from`` (where it comes from:
``name``, ``name[N]``, ``name[].sub``, ``a.b``), ``type``, ``normalize``, ``required`` and
``on_missing`` (``null``, ``omit`` or ``error``).
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field as data_field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rosterweave.functions.normalize import normalizer


@dataclass(frozen=True)
class FieldSpec:
    path: str
    origin: str
    type: str | None = None
    normalize: str | None = None
    required: bool = False
    on_missing: str = "null"


@dataclass(frozen=True)
class Config:
    fields: list[FieldSpec] = data_field(default_factory=list)
    include_confidence: bool = True
    include_provenance: bool = True


DEFAULT_FIELDS = ("candidate_id", "full_name", "emails", "phones", "location", "links", "headline", "years_experience", "skills", "experience", "education")


def parse_config(config: dict | None) -> Config:
    if config is None:
        config = {"fields": [{"path": p} for p in DEFAULT_FIELDS]}
    if not config.get("fields"):
        raise ValueError("the configuration has no fields")
    overall = config.get("on_missing", "null")
    specs = {}
    for f in config["fields"]:
        specs.pop(f["path"], None)
        specs[f["path"]] = FieldSpec(f["path"], f.get("from") or f["path"], f.get("type"), f.get("normalize"), bool(f.get("required")), f.get("on_missing", overall))
    return Config(list(specs.values()), bool(config.get("include_confidence", True)), bool(config.get("include_provenance", True)))


def load_config(path: str | None) -> Config:
    if path is None:
        return parse_config(None)
    try:
        with open(path, encoding="utf-8") as f:
            return parse_config(json.load(f))
    except (OSError, json.JSONDecodeError) as e:
        raise ValueError(f"the configuration cannot be read: {path}") from e


def resolve(schema: T.StructType, origin: str) -> tuple[Column, T.DataType, bool] | None:
    """Column, type, and whether it can be missing; None for a path that leads nowhere."""
    types = {f.name: f.dataType for f in schema.fields}
    if m := re.fullmatch(r"(\w+)\[(\d+)\]", origin):
        kind = types.get(m[1])
        return (F.get(F.col(m[1]), F.lit(int(m[2]))), kind.elementType, True) if isinstance(kind, T.ArrayType) else None
    if m := re.fullmatch(r"(\w+)\[\]\.(\w+)", origin):
        kind = types.get(m[1])
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType) and m[2] in kind.elementType.names:
            sub = kind.elementType[m[2]].dataType
            return F.filter(F.transform(F.col(m[1]), lambda x: x[m[2]]), lambda x: x.isNotNull()), T.ArrayType(sub), False
        return None
    if m := re.fullmatch(r"(\w+)\.(\w+)", origin):
        kind = types.get(m[1])
        return (F.col(f"{m[1]}.{m[2]}"), kind[m[2]].dataType, True) if isinstance(kind, T.StructType) and m[2] in kind.names else None
    return (F.col(origin), types[origin], True) if origin in types else None


def _normalized(c: Column, kind: T.DataType, name: str | None) -> Column:
    f = normalizer(name) if name else None
    if f is None:
        return c
    if isinstance(kind, T.StringType):
        return f(c)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.filter(F.transform(c, lambda x: f(x)), lambda x: x.isNotNull())
    raise ValueError(f"{name} cannot be applied to {kind.simpleString()}")


def _extras(config: Config) -> list[Column]:
    return [F.col(c) for c, on in (("overall_confidence", config.include_confidence), ("provenance", config.include_provenance)) if on]


def project(profiles: DataFrame, config: Config, *keep: str) -> DataFrame:
    """Typed projection: a missing value is null in modes ``null`` and ``omit``; in mode
    ``error`` it drops the record."""
    out, needed = [], []
    for spec in config.fields:
        found = resolve(profiles.schema, spec.origin)
        value = F.lit(None).cast("string") if found is None else found[0]
        if spec.on_missing == "error" and (found is None or found[2]):
            needed.append(value.isNotNull())
        out.append((value if found is None else _normalized(value, found[1], spec.normalize)).alias(spec.path))
    rows = profiles
    for test in needed:
        rows = rows.where(test)
    return rows.select(*[F.col(k) for k in keep], *out, *_extras(config))


def project_json(profiles: DataFrame, config: Config, *keep: str) -> DataFrame:
    """``(*keep, json)``: as :func:`project`, but a missing value of mode ``omit`` has no key."""
    out = []
    rows = profiles
    for spec in config.fields:
        found = resolve(profiles.schema, spec.origin)
        value = F.lit(None).cast("string") if found is None else found[0]
        if spec.on_missing == "error" and (found is None or found[2]):
            rows = rows.where(value.isNotNull())
        shown = value if found is None else _normalized(value, found[1], spec.normalize)
        text = F.to_json(F.struct(shown.alias(spec.path)), {"ignoreNullFields": "false"})
        text = F.substring(text, F.lit(2), F.length(text) - 2)
        out.append(F.when(value.isNotNull(), text) if spec.on_missing == "omit" and (found is None or found[2]) else text)
    for extra in ("overall_confidence", "provenance"):
        if getattr(config, "include_confidence" if extra == "overall_confidence" else "include_provenance"):
            text = F.to_json(F.struct(extra), {"ignoreNullFields": "false"})
            out.append(F.substring(text, F.lit(2), F.length(text) - 2))
    return rows.select(*[F.col(k) for k in keep], F.concat(F.lit("{"), F.array_join(F.array_compact(F.array(*out)), ","), F.lit("}")).alias("json"))

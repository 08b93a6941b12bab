"""Files of exports and resumes."""

from __future__ import annotations

import csv
import logging
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rosterweave.functions import extract as X
from rosterweave.functions.text import present
from rosterweave.operators.joins import bounded_broadcast
from rosterweave.sources.people import aligned

# Headers of an export and the names of their fields.
HEADERS = {"name": "full_name", "candidate_name": "full_name", "skills": "skills_text", "skills_raw": "skills_text", "country": "location_country"}
EXPORT_COLUMNS = ("name", "email", "phone", "current_company", "title", "location_city", "location_country", "linkedin", "github", "years_experience", "skills", "notes")
# rows of one file are numbered below 2 ** FILE_BITS, files above; resumes come behind all exports
FILE_BITS = 33
RESUME_BASE = 1 << 62
LOG = logging.getLogger(__name__)


def expand(paths: list[str], extensions: tuple[str, ...]) -> list[str]:
    """Files named, and those below folders named whose extension is one of ``extensions``;
    sorted within a folder, each once, missing paths left out."""
    found: list[str] = []
    for path in paths:
        if os.path.isfile(path):
            found.append(os.path.normpath(path))
        for folder, folders, names in os.walk(path):
            folders.sort()
            found += [os.path.normpath(os.path.join(folder, n)) for n in sorted(names) if n.lower().endswith(extensions)]
    return list(dict.fromkeys(found))


def _header(path: str) -> list[str]:
    with open(path, encoding="utf-8-sig", errors="replace", newline="") as f:
        return [h.strip() for h in next(csv.reader(f), [])]


def missing_headers(header: list[str]) -> list[str]:
    """Columns of an export that ``header`` lacks, in order."""
    return sorted(set(EXPORT_COLUMNS) - set(header))


def read_csvs(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw records of all exports, all values text; ``record_ix`` goes by file, then by row.

    Short rows are filled with null, over-long rows left out; of two headers for one field the
    last counts; unknown headers are dropped, and absent ones are reported as a warning. Files
    with one header are one scan, however many they are; the driver reads header lines only.
    No file gives an empty result.
    """
    kinds: dict[tuple[str, ...], list[tuple[int, str]]] = {}
    for i, path in enumerate(expand(paths, (".csv",))):
        if header := _header(path):
            kinds.setdefault(tuple(header), []).append((i, path))
    out = aligned(spark.createDataFrame([], "record_ix long"))
    for header, files in kinds.items():
        if absent := missing_headers(list(header)):
            LOG.warning("%d files without %s, the first is %s", len(files), ", ".join(absent), files[0][1])
        columns = [f"c{i}" for i in range(len(header))]
        schema = ", ".join(f"{c} string" for c in [*columns, "overflow"])
        rows = spark.read.csv([p for _, p in files], header=True, multiLine=True, escape='"', mode="PERMISSIVE", schema=schema, enforceSchema=True)
        # a file of quoted line ends is read by one task, so the row count of the task orders its rows
        rows = rows.withColumn("_row", F.monotonically_increasing_id().bitwiseAND((1 << FILE_BITS) - 1)).withColumn("_file", F.url_decode(F.replace(F.regexp_replace("_metadata.file_path", "^file:/*", "/"), F.lit("+"), F.lit("%2B"))))
        known = spark.createDataFrame([(os.path.abspath(p), i, p) for i, p in files], "_file string, _no long, _path string")
        fields = {HEADERS.get(h, h): c for h, c in zip(header, columns, strict=True)}
        picked = rows.where("overflow is null").join(bounded_broadcast(known), "_file")
        picked = picked.select(F.shiftleft("_no", FILE_BITS).bitwiseOR(F.col("_row")).alias("record_ix"), F.col("_path").alias("source"), *[present(F.col(c)).alias(f) for f, c in fields.items() if f not in ("record_ix", "source")])
        out = out.unionByName(aligned(picked))
    return out


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Text of documents; a PDF needs an extractor on the workers and is null without one."""
    import io

    try:
        from pdfminer.high_level import extract_text
    except ImportError:
        extract_text = None

    def read(path: str, content: bytes) -> str | None:
        try:
            if path.lower().endswith(".pdf"):
                text = extract_text(io.BytesIO(content)) if extract_text else None
            else:
                text = content.decode("utf-8", errors="replace")
        except Exception:  # noqa: BLE001 - one unreadable document must not stop the batch
            text = None
        return text if text and text.strip() else None

    for batch in batches:
        yield pd.DataFrame({"path": batch["path"], "text": [read(p, c) for p, c in zip(batch["path"], batch["content"], strict=True)]})


def read_documents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, text)`` of document files; unreadable ones have a null text."""
    files = expand(paths, (".pdf", ".txt"))
    if not files:
        return spark.createDataFrame([], "path string, text string")
    return spark.read.format("binaryFile").load(files).select("path", "content").mapInPandas(_texts, "path string, text string")


def resume_records(documents: DataFrame, as_of: Column | None = None, offset: int = RESUME_BASE) -> DataFrame:
    """Raw records from ``(record_ix, source, text)``, one for each document with a text.

    Blocks are read once, in a step of their own, as headline and tenure depend on them.
    """
    text = documents.where("text is not null")
    head = text.select("record_ix", "source", "text", X.section(F.col("text"), "HEADER").alias("header"), X.section(F.col("text"), "SKILLS").alias("s"), X.section(F.col("text"), "EXPERIENCE").alias("e"), X.section(F.col("text"), "EDUCATION").alias("d"))
    blocks = head.withColumn("experience", X.jobs(F.coalesce("e", F.lit("")))).withColumn("education", X.schools(F.coalesce("d", F.lit(""))))
    t, h = F.col("text"), F.col("header")
    out = blocks.select(
        (F.col("record_ix") + offset).alias("record_ix"), "source", X.name(h).alias("full_name"), X.emails(t).alias("emails"), X.phones(t).alias("phones"), *[X.link(t, k).alias(k) for k in X.LINKS],
        X.city(h).alias("location_city"), X.home_country(h).alias("location_country"), X.headline(h, F.col("experience"), F.col("education")).alias("headline"),
        X.tenure_years(F.col("experience"), as_of if as_of is not None else F.current_date()).cast("string").alias("years_experience"), X.listed_skills(F.col("s")).alias("skills_list"), "experience", "education",
    )
    return aligned(out)


def usable(records: DataFrame) -> DataFrame:
    """Resumes that name a person or have an address."""
    return records.where(F.col("full_name").isNotNull() | (F.size("emails") > 0))

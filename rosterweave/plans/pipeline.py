"""The whole way from raw records to checked projections, and the command line."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from rosterweave.operators.check import check, valid_only
from rosterweave.operators.merge import merge
from rosterweave.operators.profile import profiles
from rosterweave.operators.project import Config, load_config, project, project_json
from rosterweave.operators.resolve import clusters
from rosterweave.operators.score import score
from rosterweave.operators.validate import validate
from rosterweave.sources.files import read_csvs, read_documents, resume_records, usable
from rosterweave.storage import cut


def build_profiles(raw: DataFrame) -> DataFrame:
    """Canonical profiles of raw records; the validated records are cut, as the resolution
    reads them several times."""
    return profiles(score(merge(clusters(cut(validate(raw), "validated")))))


def run(raw: DataFrame, config: Config) -> DataFrame:
    """Checked projection of raw records, in the order of ``cluster_id``."""
    return valid_only(check(project(build_profiles(raw), config, "cluster_id"), config))


def write_json_array(rows: DataFrame, path: str | None) -> None:
    """A JSON array of the column ``json`` in the order of ``cluster_id``. The one file is for
    people; larger results are written as parquet or lines. Rows are streamed, not gathered."""
    out = open(path, "w", encoding="utf-8") if path else sys.stdout  # noqa: SIM115
    try:
        out.write("[")
        for i, r in enumerate(rows.orderBy("cluster_id").select("json").toLocalIterator()):
            out.write((",\n" if i else "\n") + json.dumps(json.loads(r.json), indent=2, ensure_ascii=False))
        out.write("\n]\n" if rows else "]\n")
    finally:
        if path:
            out.close()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """0 if profiles were written, 1 if there is nothing to work on, 2 for wrong arguments."""
    parser = argparse.ArgumentParser(prog="rosterweave")
    parser.add_argument("--csv", nargs="+", default=[])
    parser.add_argument("--resume", nargs="+", default=[])
    parser.add_argument("--config")
    parser.add_argument("--output")
    try:
        args = parser.parse_args(argv)
        if not args.csv and not args.resume:
            parser.error("--csv or --resume is needed")
        config = load_config(args.config)
    except (SystemExit, ValueError) as e:
        if isinstance(e, ValueError):
            print(e, file=sys.stderr)
        return 0 if isinstance(e, SystemExit) and not e.code else 2
    spark = spark or SparkSession.builder.getOrCreate()
    documents = read_documents(spark, args.resume).select(F.monotonically_increasing_id().alias("record_ix"), F.regexp_replace("path", "^file:/*", "/").alias("source"), "text")
    raw = read_csvs(spark, args.csv).unionByName(usable(resume_records(documents)))
    if raw.isEmpty():
        print("no records", file=sys.stderr)
        return 1
    built = cut(build_profiles(raw), "profiles")
    if built.isEmpty():
        print("no profiles", file=sys.stderr)
        return 1
    kept = valid_only(check(project(built, config, "cluster_id"), config)).select("cluster_id")
    write_json_array(project_json(built, config, "cluster_id").join(kept, "cluster_id", "left_semi"), args.output)
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Merge snapshot files: python -m lodestar.plans.merge --inputs GLOB... --output FOLDER"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from lodestar.operators.folds import merge_summary
from lodestar.sources.jsonl import DECIDING, expand, line_report, merge_snapshots, read_jsonl, read_lines


def main(args: list[str], spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--inputs", nargs="+", required=True)
    parser.add_argument("--output", required=True)
    given = parser.parse_args(args)
    spark = spark or SparkSession.builder.getOrCreate()
    paths = expand(spark, given.inputs)
    if not paths:
        print("no input files", file=sys.stderr)
        return 1
    merge_snapshots(spark, paths, given.output)
    bad = line_report(read_lines(spark, paths), DECIDING).first()["n_bad"]
    if bad:
        print(f"{bad} lines could not be read", file=sys.stderr)
    summary = merge_summary(read_jsonl(spark, paths, DECIDING), "canonical_url").first()
    print(f"{summary['total']} read, {summary['unique_keys']} kept")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

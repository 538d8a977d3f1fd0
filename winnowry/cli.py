"""Command line: ``python -m winnowry.cli --input posts.csv --output labelled``."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from winnowry.operators.dedupe import report
from winnowry.plans.config import build, load_yaml, parser
from winnowry.plans.pipeline import run
from winnowry.sources.files import read_csv, structured_log, write_csv, write_json, write_mapping


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None, registry: dict | None = None) -> dict:
    options = parser().parse_args(argv)
    logging.basicConfig(level=options.log_level)
    config = build(options, load_yaml(options.config))
    spark = spark or SparkSession.builder.appName("winnowry").getOrCreate()
    posts = spark.read.parquet(options.input) if options.input.endswith(".parquet") else read_csv(spark, options.input)
    done = run(posts, config, registry)
    write_csv(done.rows, options.output)
    write_json(config.plain(), f"{options.output}.config.json")
    write_mapping(done.mapping, f"{options.output}.mapping")
    if config.dedupe_report:
        write_csv(report(done.clusters), config.dedupe_report)
    structured_log(logging.INFO, event="classification_summary", **done.report["inputs"])
    return done.report


if __name__ == "__main__":
    main()

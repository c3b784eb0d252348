"""Command line: ``python -m tidemark provider|risk|asset --raw DIR --root DIR --as-of DATE``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark.context import RunContext
from tidemark.plans.flows import DOMAINS, build, check, train
from tidemark.session import tune


def main() -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    parser.add_argument("domain", choices=sorted(DOMAINS))
    parser.add_argument("--raw", required=True, help="folder with the delimited extracts")
    parser.add_argument("--root", required=True, help="folder for layers, models and reports")
    parser.add_argument("--as-of", required=True, help="run date, YYYY-MM-DD")
    parser.add_argument("--gate", choices=("warn", "raise"), default="warn")
    parser.add_argument("--skip-model", action="store_true")
    options = parser.parse_args()

    spark = tune(SparkSession.builder.appName(f"tidemark-{options.domain}").getOrCreate())
    run = RunContext.of(options.as_of)
    domain = DOMAINS[options.domain]
    tables = build(spark, domain, options.raw, options.root, run)
    print("quality:", check(spark, domain, tables, options.root, run, options.gate))
    if not options.skip_model:
        print("model:", train(spark, domain, tables, options.root, run))


if __name__ == "__main__":
    main()

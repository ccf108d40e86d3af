"""python -m wardgrid COMMAND --input DIR --output DIR: the pipelines from the command line.

grid writes the hourly grid by split and shard, audited; events the event timelines by split; tokens the
token shards, vocabulary and index; query the result of a registered query."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import functions as F

from wardgrid.config import GridConfig, TokenConfig
from wardgrid.operators import tokens as token_operators
from wardgrid.plans import audits, grid_pipeline, token_pipeline
from wardgrid.session import get_spark, ship_package
from wardgrid.sources import sidecars, sinks, tensors
from wardgrid.sources.tables import table


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser("wardgrid", description=__doc__)
    parser.add_argument("command", choices=("grid", "events", "tokens", "query"))
    parser.add_argument("name", nargs="?", help="the query's name")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--seed", type=int, default=0)
    parser.add_argument("--overwrite", action="store_true")
    args = parser.parse_args(argv)
    spark = get_spark("wardgrid")
    ship_package(spark)
    read = lambda name: table(spark, args.input, name)
    if args.command == "query":
        from wardgrid.queries import QUERIES

        sinks.guard(spark, args.output, ["data"], args.overwrite)
        sinks.replace(QUERIES[args.name](spark, args.input), f"{args.output}/data")
    elif args.command == "grid":
        config = GridConfig(seed=args.seed)
        sinks.guard(spark, args.output, ["data", "schema.json", "feature_schema.json", "targets.json", "categorical_encoding", "audit"], args.overwrite)
        grid_pipeline.write_grid(grid_pipeline.build_grid(read("numericitems"), read("admissions"), read("items"), config), f"{args.output}/data", config)
        written = spark.read.parquet(f"{args.output}/data")
        found = audits.audit_grid(written, list(dict.fromkeys(config.tags.values())))
        sinks.write_csv(found, f"{args.output}/audit")
        units = {r["tag"]: {"kind": r["valuetype"], "unit": r["target_unit"]} for r in read("items").select("tag", "valuetype", "target_unit").collect()}
        sidecars.write_sidecars(spark, args.output, written.columns, units | {k: {"kind": "category", "unit": None} for k in config.categories}, config.categories)
        sinks.write_json(spark, {"columns": dict(written.dtypes), "seed": args.seed, "shares": dict(config.shares)}, f"{args.output}/schema.json")
        audits.check(found)
    else:
        config = TokenConfig(seed=args.seed)
        classified = token_pipeline.classified_events(read("numericitems"), read("listitems"), read("drugitems"), read("admissions"), config)
        sinks.guard(spark, args.output, ["events", "classified", "audit", "summary.json", "tokens", "vocabulary", "index"], args.overwrite)
        token_pipeline.write_events(classified, args.output, config)
        if args.command == "tokens":
            ids, vocabulary = token_pipeline.build_tokens(spark.read.parquet(f"{args.output}/events"), config)
            sinks.replace(vocabulary, f"{args.output}/vocabulary")
            shard = F.pmod(F.xxhash64("admissionid"), F.lit(16))
            folder = os.path.abspath(f"{args.output}/tokens") if "://" not in args.output else f"{args.output}/tokens"
            for name in config.shares:
                mine = ids.filter(F.col("split") == name).withColumn("shard", shard)
                done = tensors.write_tensors(mine, f"file://{folder}/{name}" if folder.startswith("/") else f"{folder}/{name}", ["admissionid"], {"tokens": "id", "times": "time"}, per_timeline={"timelines": "admissionid"})
                sinks.write_csv(done, f"{args.output}/tokens/{name}-files")
                sinks.replace(token_operators.timeline_index(mine, ["admissionid"], shard), f"{args.output}/index/split={name}")


if __name__ == "__main__":
    main()

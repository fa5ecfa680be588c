"""Command line: one phase, or all."""

from __future__ import annotations

import argparse
import dataclasses
import logging

from tidemark.config import load_config, s3_options
from tidemark.plans import pipeline
from tidemark.session import drop_scratch, spark_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__)
    p.add_argument("--config", default=None, help="YAML settings")
    p.add_argument("-v", "--verbose", action="store_true")
    sub = p.add_subparsers(dest="phase", required=True)
    for name in ("phase1", "phase2", "phase3", "phase4", "phase5", "all"):
        s = sub.add_parser(name)
        if name in ("phase1", "all"):
            s.add_argument("--raw-glob")
            s.add_argument("--raw-schema", help="columns and types of the messages, as in SQL; without, the files' schemas are merged")
        if name in ("phase4", "all"):
            s.add_argument("--cities", required=True, help="Parquet: name, admin1, cc, lat, lon[, population]")
            s.add_argument("--countries", required=True, help="Parquet: iso2, name")
        if name in ("phase5", "all"):
            s.add_argument("--existing-db")
    return p


def main(argv: list[str] | None = None):
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if args.verbose else logging.INFO)
    cfg = load_config(args.config)
    if getattr(args, "raw_glob", None):
        cfg = dataclasses.replace(cfg, data=cfg.data | {"raw_glob": args.raw_glob})
    if getattr(args, "raw_schema", None):
        cfg = dataclasses.replace(cfg, data=cfg.data | {"raw_schema": args.raw_schema})
    if getattr(args, "existing_db", None):
        cfg = dataclasses.replace(cfg, match=dataclasses.replace(cfg.match, existing_db_path=args.existing_db))
    shared = {"spark.checkpoint.dir": cfg.spark["checkpoint_dir"]} if cfg.spark.get("checkpoint_dir") else {}
    spark = spark_session(cfg.spark.get("app_name", "tidemark"), s3_options(cfg.s3) | shared)
    tables = lambda: (spark.read.parquet(args.cities), spark.read.parquet(args.countries))
    try:
        if args.phase == "all":
            return pipeline.run_all(spark, cfg, *tables())
        run = getattr(pipeline, f"run_{args.phase}")
        return run(spark, cfg, *(tables() if args.phase == "phase4" else ()))
    finally:
        drop_scratch(spark)


if __name__ == "__main__":
    main()

"""python -m gramsmith.cli stats|diff FILE...: reports over files of measures; catalog FOLDER OUTPUT: the catalog document."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from gramsmith.errors import CompositionError
from gramsmith.operators import catalog, compose, stats
from gramsmith.plans import report
from gramsmith.sources import recipes, seed
from gramsmith.sources.registry import Registry, Tables


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gramsmith")
    p.add_argument("--registry", help="folder of registry tables; the embedded ones if it isn't given")
    sub = p.add_subparsers(dest="command", required=True)
    s = sub.add_parser("stats", help="ratio, intervals and an example recipe")
    d = sub.add_parser("diff", help="the first file against the others together")
    c = sub.add_parser("catalog", help="the catalog of configured recipes as JSON")
    c.add_argument("folder", help="where the configured files are")
    c.add_argument("output")
    c.add_argument("--config", help="JSON: a list of id, title, category, description, csv_files and sources; the embedded one if it isn't given")
    for x in (s, d):
        x.add_argument("files", nargs="+")
        x.add_argument("-i", "--include", action="store_true", help="keep duplicates")
        x.add_argument("-m", "--merge", help="col[.part]+col[.part]:…")
    s.add_argument("-p", "--precision", type=int, default=2)
    s.add_argument("-r", "--recipe-precision", type=int, default=0)
    s.add_argument("-w", "--weight", type=int)
    s.add_argument("-v", "--verbose", action="store_true")
    s.add_argument("-c", "--confidence-interval", type=float, default=0.05)
    s.add_argument("-t", "--restrict", help="col=grams,…")
    s.add_argument("-z", "--ignore-zeros", help="col,…")
    d.add_argument("-p", "--precision", type=int, default=0)
    d.add_argument("-c", "--change", action="store_true", help="percentage change instead of difference")
    return p


def default_catalog() -> list[dict]:
    return [
        {"id": i, "title": title, "category": "crepes", "description": text, "csv_files": [name], "sources": [{"type": "text", "title": source, "ref": ref}]}
        for i, title, text, name, source, ref in seed.CATALOG
    ]


def run(spark: SparkSession, args: argparse.Namespace) -> str:
    registry = Registry.of(Tables.read(spark, args.registry)) if args.registry else Registry.seed(spark)
    if args.command == "catalog":
        config = json.loads(Path(args.config).read_text(encoding="utf-8")) if args.config else default_catalog()
        made = catalog.build_catalog(spark, registry, config, args.folder)
        catalog.write_catalog(spark, made, args.output)
        return f"Wrote {len(made)} recipes to {args.output}"
    merge = compose.parse_merge(args.merge)
    of = lambda files, zeros=(): stats.statistics(recipes.read(spark, registry, files), not args.include, merge, zeros)
    if args.command == "diff":
        if len(args.files) < 2:
            raise CompositionError("diff needs two files at least")
        return str(report.diff_report(of(args.files[:1]), of(args.files[1:]), args.change, args.precision))
    limits = compose.parse_restrictions(args.restrict)
    zeros = [compose.column_id(z) for z in args.ignore_zeros.split(",")] if args.ignore_zeros else []
    weight = args.weight if args.weight is not None else (sys.maxsize if limits else 100)
    return str(report.stats_report(of(args.files, zeros), not args.include, limits, args.confidence_interval, args.precision, args.recipe_precision, weight, args.verbose))


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("gramsmith").getOrCreate()
    try:
        print(run(spark, args))
    except CompositionError as e:
        print(f"Error: {e}", file=sys.stderr)
        return 1
    return 0


if __name__ == "__main__":
    sys.exit(main())

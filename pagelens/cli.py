"""Command line over stored tables: discover, audit, export, lookup, label, export-labels, sanitize-names. Ids X70, K9, S20-S24 of the survey.

    python -m pagelens.cli audit --map map.json --fetches fetches.parquet --table audits --report summary.md
"""

from __future__ import annotations

import argparse
import os
from datetime import datetime

from pyspark.sql import SparkSession

from . import tables
from .config import Settings, plz_mode
from .operators import dedupe, filters, joins, rows
from .operators.buckets import BucketedTable
from .operators.upsert import VersionedTable, append_outcomes
from .plans import audit, report
from .schemas import AUDIT, OUTCOME, struct
from .sinks import files
from .sources import dimensions, labels, places


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="pagelens")
    p.add_argument("--as-of", type=datetime.fromisoformat, default=None, help="the run's clock, ISO form")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("discover", "audit"):
        c = sub.add_parser(name)
        c.add_argument("--map", help="stored map dump (JSON)")
        c.add_argument("--places", help="stored place search answers (JSON)")
        c.add_argument("--district", help="postal code, number or name")
        c.add_argument("--limit", type=int, default=100)
        if name == "audit":
            c.add_argument("--fetches", required=True, help="fetched pages (Parquet)")
            c.add_argument("--psi", help="speed scores (Parquet)")
            c.add_argument("--table", required=True, help="folder of the audit table")
            c.add_argument("--tier", choices=("A", "B1", "B2", "B3", "C"))
            c.add_argument("--force", action="store_true", help="audit fresh rows too")
            c.add_argument("--patterns", help="branch patterns (YAML)")
            c.add_argument("--suffixes", help="public-suffix file")
            c.add_argument("--logs", default="logs")
            c.add_argument("--report", default="last_run_summary.md")
    c = sub.add_parser("export")
    c.add_argument("--table", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--format", choices=("csv", "json"), default="csv")
    c.add_argument("--tier", action="append", help="may be repeated")
    c.add_argument("--plz", action="append", help="may be repeated; goes before --district")
    c.add_argument("--district", action="append")
    c.add_argument("--plz-fallback", type=plz_mode, default="permissive")
    c.add_argument("--min-score", type=int, default=0)
    c.add_argument("--max-score", type=int, default=30)
    c.add_argument("--limit", type=int)
    c = sub.add_parser("label")
    c.add_argument("--csv", required=True)
    c.add_argument("--outcomes", required=True)
    c = sub.add_parser("export-labels")
    c.add_argument("--table", required=True)
    c.add_argument("--outcomes", required=True)
    c.add_argument("--output", required=True)
    c = sub.add_parser("sanitize-names")
    c.add_argument("--table", required=True)
    c = sub.add_parser("lookup")
    c.add_argument("--table", required=True)
    c.add_argument("place_id", nargs="+")
    for name in ("audit", "export", "export-labels", "sanitize-names", "lookup"):
        sub.choices[name].add_argument("--buckets", type=int, help="the audit table has so many hashed buckets; without it, numbered whole versions")
    return p


def _plz(spark: SparkSession, inputs: list[str]) -> list[str]:
    found = joins.resolved_districts(spark.createDataFrame([(x,) for x in inputs], "raw string"), dimensions.districts(spark), "raw").collect()
    unknown = [r.raw for r in found if r.district_plz is None]
    if unknown:
        raise SystemExit(f"unknown district: {', '.join(unknown)}")
    return [r.district_plz for r in found]


def _candidates(spark: SparkSession, args: argparse.Namespace):
    sources = [places.Source("osm", "map dump", args.map, places.map_dump), places.Source("places", "place search", args.places, places.places_dump)]
    plz = _plz(spark, [args.district])[0] if args.district else None
    found = places.first_that_works(sources, spark, plz)
    kept = filters.chain_candidates(found, dimensions.blacklist(spark), dimensions.whitelist(spark)).where("kept").drop("kept", "reason")
    return dedupe.first_seen(kept, "place_id", ["place_id"]).orderBy("place_id").limit(args.limit)


def _settings(as_of: datetime | None) -> Settings:
    base = Settings.from_mapping(os.environ)
    return Settings(**{**base.__dict__, "as_of": as_of or datetime.now()})


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("pagelens").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    settings = _settings(args.as_of)
    table = None
    if getattr(args, "table", None):
        table = BucketedTable(spark, args.table, struct(AUDIT), buckets=args.buckets) if args.buckets else VersionedTable(spark, args.table, struct(AUDIT))
    if args.command == "discover":
        for r in files.listing(joins.with_industry(_candidates(spark, args))).toLocalIterator():
            print(r.line)
    elif args.command == "audit":
        candidates = _candidates(spark, args)
        candidates = candidates if args.force else filters.stale(candidates, table.read(), settings)
        inputs = audit.Inputs(spark.read.parquet(args.fetches), spark.read.parquet(args.psi) if args.psi else None, suffixes=dimensions.suffix_rules(spark, args.suffixes) if args.suffixes else None)
        text = open(args.patterns, encoding="utf-8").read() if args.patterns else None
        with tables.scratch(spark):  # all that reads the audit's own tables happens inside
            result = audit.run(candidates.drop("source"), inputs, settings, dimensions.branch_patterns(text), only_tier=args.tier)
            logs = ((result.filtered_log, "filtered_chain_branches"), (result.collapsed_log, "collapsed_branches"), (result.duplicate_log, "duplicate_urls"))
            counts = [files.append_log(df, f"{args.logs}/{name}.csv") for df, name in logs]
            table.upsert(result.rows)
            report.write_summary(rows.export_rows(result.rows), args.report, settings.as_of, *counts)
    elif args.command == "export":
        wanted = args.plz or (_plz(spark, args.district) if args.district else None)
        exported = rows.export_rows(filters.checked(table.read(), settings.as_of.year))
        kept = filters.export_filter(filters.plz_filter(exported, wanted, args.plz_fallback), args.tier, None, args.min_score, args.max_score)
        {"csv": files.write_csv, "json": files.write_json}[args.format](filters.export_order(kept, args.limit), args.output)
    elif args.command == "lookup":
        keys = spark.createDataFrame([(k,) for k in args.place_id], "place_id string")
        found = table.lookup(keys) if args.buckets else table.read().join(keys, "place_id", "left_semi")
        for r in files.json_rows(rows.export_rows(found)).toLocalIterator():
            print(r.value)
    elif args.command == "label":
        append_outcomes(labels.read_labels(spark, args.csv, int(settings.as_of.timestamp() * 1000)), args.outcomes)
    elif args.command == "export-labels":
        outcomes = spark.read.schema(struct(OUTCOME)).parquet(args.outcomes)
        files.write_jsonl(files.label_lines(joins.labelled(outcomes, table.read())), args.output)
    else:
        changed = rows.renamed(table.read())
        n = changed.count()
        if n:
            table.upsert(changed)
        print(f"{n} names changed")


if __name__ == "__main__":
    main()

"""Command line: ``query`` over the chunk table of a run, one JSON line per row, and ``run`` over a table of pages.

Errors go to stderr with status 2; a run with a failed document ends with status 1.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pagewright.operators import retrieval
from pagewright.plans import config, models
from pagewright.plans import run as runs
from pagewright.sources import readers
from pagewright.sources.store import lines


def _query(spark: SparkSession, args: argparse.Namespace) -> int:
    rows = runs.tables(spark, args.root)["knowledge_chunks"].read()
    if args.vector:
        # Vectors are stored with the chunks; only the query is embedded.
        made = models.clients(config.from_yaml(args.config) if args.config else config.Config())
        found = retrieval.similar(rows.where("embedding is not null"), made.embedding().embed([args.query], query=True)[0], args.limit, chunk_kind=args.kind)
    else:
        found = retrieval.search_text(rows, args.query, args.limit, chunk_kind=args.kind).withColumn("score", F.lit(None).cast("double"))
    for row in lines(found.drop("embedding")).toLocalIterator():
        print(row["line"])
    return 0


def _run(spark: SparkSession, args: argparse.Namespace) -> int:
    chosen = config.from_yaml(args.config) if args.config else config.Config()
    # Files are parsed once: their pages are written before the run reads them again and again.
    pages = runs.parked(spark, args.root)(readers.pdf_pages(spark, args.pages), "source_pages") if args.pdf else spark.read.parquet(args.pages)
    summary = runs.run(spark, pages, args.root, chosen).first().asDict()
    print(json.dumps(summary, sort_keys=True, default=str))
    return 1 if summary["documents_failed"] else 0


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    query = commands.add_parser("query")
    query.add_argument("root", help="the folder of a run")
    query.add_argument("query")
    query.add_argument("--vector", action="store_true", help="by similarity instead of by substring")
    query.add_argument("--kind", choices=["page_evidence", "product"])
    query.add_argument("--limit", type=int, default=10)
    run = commands.add_parser("run")
    run.add_argument("pages", help="a Parquet table of pages, or a folder of PDF files")
    run.add_argument("--pdf", action="store_true", help="the pages are those of PDF files")
    run.add_argument("root", help="the folder of the run")
    for each in (query, run):
        each.add_argument("--config", help="a YAML file")
    args = parser.parse_args(argv)
    try:
        return {"query": _query, "run": _run}[args.command](SparkSession.builder.getOrCreate(), args)
    except runs.RunFailed as e:
        print(e, file=sys.stderr)
        return 1
    except ValueError as e:
        print(e, file=sys.stderr)
        return 2


if __name__ == "__main__":
    sys.exit(main())

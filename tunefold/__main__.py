"""Command line: run the catalogue job once, or keep a stream running.

    python -m tunefold --pages PATH --artists PATH [--method upsert]
    python -m tunefold --pages PATH --artists PATH --poll-seconds 86400
    python -m tunefold --show most_popular_tracks_with_duration

One-shot mode reads the landed pages, builds and loads the catalogue, publishes
the views and logs the run (start / success / fail). With ``--poll-seconds``
all tables are kept current by a file stream that runs every new landing through
the job (``processingTime`` trigger), the way the warehouse job re-ran on a timer.
Tables and views live under ``--root`` (default: a folder of ``--database``'s name
in the shared folder from ``spark.checkpoint.dir``), for this and later processes.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .operators.load import TableStore
from .plans.job import JobConfig, run_catalog_job
from .session import shared_dir
from .plans.views import SQL_FOLDER, read_view
from .streaming.upsert_stream import stream_catalog


def parse_args(argv: list[str]) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tunefold", description=__doc__.splitlines()[0])
    p.add_argument("--show", default=None, metavar="VIEW", help="print the first rows of a view and stop")
    p.add_argument("--pages", help="folder of landed playlist pages (JSON lines)")
    p.add_argument("--artists", help="folder of landed artist documents (JSON lines)")
    p.add_argument("--method", default="upsert", choices=("insert", "upsert", "overwrite"))
    p.add_argument("--database", default="tunefold")
    p.add_argument("--root", default=None, help="table folder (default: under spark.checkpoint.dir)")
    p.add_argument("--sql-folder", default=str(SQL_FOLDER), help="folder of the views' SQL files (default: the five views)")
    p.add_argument("--job-name", default="catalog")
    p.add_argument("--poll-seconds", type=int, default=None,
                   help="keep the tables current from new page files, one micro-batch per interval")
    p.add_argument("--no-raise", action="store_true", help="log a failed run and exit 0, as the old job did")
    args = p.parse_args(argv)
    if not args.show and not (args.pages and args.artists):
        p.error("--pages and --artists are needed")
    return args


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parse_args(sys.argv[1:] if argv is None else argv)
    spark = spark or SparkSession.builder.appName("tunefold").getOrCreate()
    root = args.root or f"{shared_dir(spark)}/tunefold-tables/{args.database}"
    store = TableStore(spark, root)
    if args.show:
        read_view(store, args.show, args.sql_folder).show(truncate=False)
        return {}
    cfg = JobConfig(args.pages, args.artists, load_method=args.method, job_name=args.job_name, sql_folder=args.sql_folder)
    rejected = run_catalog_job(spark, store, cfg, raise_on_error=not args.no_raise)
    print(json.dumps({"database": args.database, "rejected": rejected}))
    if args.poll_seconds:
        # A stable checkpoint beside the tables: a restarted command resumes after
        # the last committed micro-batch instead of re-reading every landed file.
        q = stream_catalog(spark, args.pages, args.artists, store, f"{root}/_stream_checkpoint", job_name=args.job_name,
                           processing_time=f"{args.poll_seconds} seconds", query_name=f"{args.database}_catalog")
        q.awaitTermination()
    return rejected or {}


if __name__ == "__main__":
    main()

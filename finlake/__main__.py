"""Command line: run a stage of the lake, or a lookup on the published tables.

    python -m finlake stage   --root ROOT --sf-dir DIR   # derive landing files from test tables
    python -m finlake ingest  --root ROOT                # landing CSV + event stream -> bronze
    python -m finlake silver  --root ROOT [--full]
    python -m finlake gold    --root ROOT [--full]
    python -m finlake publish --root ROOT [--full]
    python -m finlake all     --root ROOT [--sf-dir DIR]
    python -m finlake lookup  --root ROOT costs-daily --org 8 --services genai,storage \\
                              --start 2024-01-05 --end 2024-01-25

The session comes from the environment (spark-submit or a local master);
the cluster's ``spark.checkpoint.dir`` is used as the shared folder.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from finlake.functions.constants import (
    MART_CRITICAL_TICKETS,
    MART_GENAI_DAILY_BY_ORG,
    MART_ORG_DAILY_USAGE,
    MART_REVENUE_MONTH,
    MART_REVENUE_MONTH_LABEL,
)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="finlake", description=__doc__.splitlines()[0])
    p.add_argument("stage", choices=["stage", "ingest", "silver", "gold", "publish", "all", "lookup"])
    p.add_argument("lookup", nargs="?", default=None,
                   choices=["costs-daily", "top-months", "sla", "monthly-revenue", "genai", "top-services"])
    p.add_argument("--root", required=True, help="lake root on shared storage")
    p.add_argument("--sf-dir", help="folder of the test tables to derive landing files from")
    p.add_argument("--master", help="Spark master (default: from the environment)")
    p.add_argument("--full", action="store_true", help="rebuild and replace every table whole (all: from the landing files on)")
    p.add_argument("--org")
    p.add_argument("--services", help="comma-separated")
    p.add_argument("--start")
    p.add_argument("--end")
    p.add_argument("--year", type=int)
    p.add_argument("--month", type=int)
    p.add_argument("--as-of")
    p.add_argument("--n", type=int, default=5)
    p.add_argument("--rows", type=int, help="print at most so many rows of a lookup (default: all)")
    return p


def _lookup(spark, paths, args) -> None:
    from finlake.operators import lookups
    from finlake.sources import serving

    def table(name):
        return serving.read_published(spark, paths.serving, name)

    kind = args.lookup
    if kind == "costs-daily":
        services = args.services.split(",") if args.services else None
        df = lookups.lookup_costs_daily(table(MART_ORG_DAILY_USAGE), args.org, services, args.start, args.end)
    elif kind == "top-months":
        df = lookups.lookup_top_revenue_months(table(MART_REVENUE_MONTH_LABEL), args.org, args.n)
    elif kind == "sla":
        df = lookups.lookup_sla_evolution(table(MART_CRITICAL_TICKETS), args.start, args.end)
    elif kind == "monthly-revenue":
        df = lookups.lookup_monthly_revenue(table(MART_REVENUE_MONTH), args.org, args.year, args.month)
    elif kind == "genai":
        df = lookups.lookup_genai_tokens(table(MART_GENAI_DAILY_BY_ORG), args.org, args.start, args.end)
    elif kind == "top-services":
        as_of = args.as_of or dt.date.today().isoformat()
        df = lookups.top_services(table(MART_ORG_DAILY_USAGE), as_of, args.n, org=args.org)
    else:
        raise SystemExit("lookup needs a kind: costs-daily, top-months, sla, monthly-revenue, genai, top-services")
    rows = df if args.rows is None else df.limit(args.rows)
    print("\t".join(df.columns))
    for row in rows.toLocalIterator():  # a partition at a time
        print("\t".join("" if v is None else str(v) for v in row))


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from finlake.plans import pipeline as P
    from finlake.session import build_session

    spark = build_session(args.master)
    try:  # quiet Spark's INFO/WARN chatter on the console
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # Spark Connect sessions have no SparkContext
        pass
    paths = P.LakePaths.of(spark, args.root)
    run_ts = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    incremental = not args.full
    if args.stage == "stage":
        if not args.sf_dir:
            raise SystemExit("stage needs --sf-dir")
        P.stage_landing(spark, args.sf_dir, paths)
    elif args.stage == "ingest":
        P.ingest_all(spark, paths, run_ts)
    elif args.stage == "silver":
        P.build_silver(spark, paths, run_ts, incremental=incremental)
    elif args.stage == "gold":
        P.build_marts(spark, paths, incremental=incremental)
    elif args.stage == "publish":
        P.publish_all(spark, paths, incremental=incremental)
    elif args.stage == "all":
        P.run_all(spark, paths, run_ts, sf_dir=args.sf_dir, full_refresh=args.full)
    else:
        _lookup(spark, paths, args)
    return 0


if __name__ == "__main__":
    sys.exit(main())

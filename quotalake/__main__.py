"""Command line: run a report, publish the views, or run SQL over the star.

    python -m quotalake --tables DIR --list
    python -m quotalake --tables DIR --report revenue_by_state [--rows 50]
    python -m quotalake --tables DIR --report actual_vs_target --out OUT_DIR
    python -m quotalake --tables DIR --publish OUT_DIR [--materialize]
    python -m quotalake --tables DIR --sql "SELECT state, SUM(revenue) FROM sales s JOIN customers c USING (customer_id) GROUP BY state"

Runs on the session's master (``spark-submit`` on a cluster); outside
spark-submit a local session is started.  Output folders are overwritten.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession


def main(argv: list[str] | None = None) -> int:
    from quotalake.operators import reports
    from quotalake.plans.catalog import QUERIES
    from quotalake.plans.sql_tables import register_tables
    from quotalake.session import apply_defaults
    from quotalake.sources.native_star import NativeStar
    from quotalake.sources.star import Star

    ap = argparse.ArgumentParser(prog="quotalake", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--tables", required=True, help="folder with <table>.parquet inputs")
    ap.add_argument("--list", action="store_true", help="list the available reports")
    ap.add_argument("--report", help="report / view / build / audit name (see --list)")
    ap.add_argument("--sql", help="SQL over the reference-named tables and vw_* views")
    ap.add_argument("--publish", metavar="OUT_DIR", help="write the ten views as Parquet tables")
    ap.add_argument("--out", help="write the report to this Parquet folder instead of printing")
    ap.add_argument("--rows", type=int, default=20, help="rows to print")
    ap.add_argument("--materialize", action="store_true",
                    help="build the priced facts once (shared checkpoint folder) before reporting")
    ap.add_argument("--native", action="store_true",
                    help="the folder holds the star's own tables (customers, sales, ...), not orders and line items")
    args = ap.parse_args(argv)

    if args.list:
        print("\n".join(sorted(QUERIES)))
        return 0
    spark = SparkSession.builder.appName("quotalake").getOrCreate()
    apply_defaults(spark)
    star = (NativeStar if args.native else Star).from_parquet(spark, args.tables)
    if args.materialize:
        star = star.materialize()
    if args.publish:
        for name, path in reports.publish_views(star, args.publish).items():
            print(f"{name}\t{path}")
        return 0
    if args.sql:
        register_tables(star)
        reports.register_views(star)
        df = spark.sql(args.sql)
    elif args.report:
        if args.report not in QUERIES:
            print(f"unknown report {args.report!r}; use --list", file=sys.stderr)
            return 2
        df = QUERIES[args.report](star)
    else:
        ap.error("one of --list, --report, --sql or --publish is required")
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
        print(args.out)
    else:
        df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())

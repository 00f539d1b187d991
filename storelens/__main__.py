"""Run one analysis and print it or write it out (e.g. for a BI report).

    python -m storelens --list
    python -m storelens top_cities_by_avg_payment /root/testdata/sf0.01
    python -m storelens monthly_canceled_revenue_share DATA_DIR --out OUT_DIR --format csv
"""

from __future__ import annotations

import argparse
import sys

from storelens.plans.registry import QUERIES
from storelens.session import get_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="storelens", description=__doc__.splitlines()[0])
    ap.add_argument("key", nargs="?", help="analysis key (see --list)")
    ap.add_argument("data_dir", nargs="?", help="directory with the parquet tables")
    ap.add_argument("--list", action="store_true", help="list analysis keys")
    ap.add_argument("--out", help="write the result here instead of printing it")
    ap.add_argument("--overwrite", action="store_true", help="replace what is at --out")
    ap.add_argument("--format", default="parquet", choices=("parquet", "csv", "json"))
    ap.add_argument("--rows", type=int, default=20, help="rows to print without --out")
    args = ap.parse_args(argv)
    if args.list:
        print("\n".join(QUERIES))
        return 0
    if not args.key or not args.data_dir or args.key not in QUERIES:
        ap.error("give a known key and a data directory (see --list)")
    spark = get_session(app_name=f"storelens-{args.key}")
    df = QUERIES[args.key](spark, args.data_dir)
    if args.out:
        writer = df.write.mode("overwrite" if args.overwrite else "errorifexists")
        if args.format == "csv":
            writer = writer.option("header", "true")
        getattr(writer, args.format)(args.out)
    else:
        df.show(args.rows, truncate=False)
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())

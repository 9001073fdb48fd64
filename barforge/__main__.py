"""Command line: ``spark-submit barforge/__main__.py <command> ...`` or
``python -m barforge <command> ...``.

  master     constituents CSV -> master list (trimmed symbols + suffix)
  setup      create the control table and layer namespaces, print the report
  daily      incremental load + transform + checks (the scheduled job)
  transform  build / refresh silver and gold from bronze, print the checks
  stream     drain a landing folder into bronze as a file stream
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="barforge")
    sub = p.add_subparsers(dest="command", required=True)
    m = sub.add_parser("master")
    m.add_argument("--constituents", required=True, help="index constituents CSV (header row)")
    m.add_argument("--out", required=True, help="master list folder to write")
    m.add_argument("--suffix", default=".NS")
    s = sub.add_parser("setup")
    s.add_argument("--root", required=True)
    d = sub.add_parser("daily")
    d.add_argument("--root", required=True, help="lake folder (bronze, control, silver, gold)")
    d.add_argument("--master", required=True, help="master CSV file or folder")
    d.add_argument("--landing", required=True, help="landing parquet folder")
    d.add_argument("--retry-landing", help="what the retry sees (default: --landing)")
    d.add_argument("--run-date", type=dt.date.fromisoformat, default=dt.date.today())
    d.add_argument("--run-id")
    d.add_argument("--exchange-tz", required=True,
                   help="time zone in which a bar's day is counted, e.g. Asia/Kolkata")
    d.add_argument("--layout", choices=["month", "day"], default="month",
                   help="bronze partitioning (fixed once the table exists)")
    d.add_argument("--symbol-buckets", type=int, default=0,
                   help="also partition bronze by hash(symbol) into N buckets")
    t = sub.add_parser("transform")
    t.add_argument("--root", required=True)
    t.add_argument("--full", action="store_true", help="ignore the change set, rebuild all")
    st = sub.add_parser("stream")
    st.add_argument("--root", required=True)
    st.add_argument("--landing", required=True)
    st.add_argument("--exchange-tz", required=True,
                    help="time zone in which a bar's day is counted, e.g. Asia/Kolkata")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = _parser().parse_args(argv)
    from barforge.session import get_spark

    spark = spark or get_spark()
    if args.command == "master":
        from barforge.sources.master import master_symbols, read_constituents, write_master
        write_master(master_symbols(read_constituents(spark, args.constituents), args.suffix),
                     args.out)
        return 0
    root = args.root.rstrip("/")
    if args.command == "setup":
        from barforge.plans.setup import setup_lake
        setup_lake(spark, root).show(truncate=False)
    elif args.command == "daily":
        from barforge.plans.daily_job import run_daily_job
        from barforge.sources.landing import normalize_landing, read_landing
        from barforge.sources.master import read_master
        land = normalize_landing(read_landing(spark, args.landing), args.exchange_tz)
        retry = (normalize_landing(read_landing(spark, args.retry_landing), args.exchange_tz)
                 if args.retry_landing else None)
        from barforge.sources import storage
        layout = storage.day_partition() if args.layout == "day" else storage.month_partition()
        if args.symbol_buckets:
            layout = {**layout, **storage.symbol_buckets(args.symbol_buckets)}
        out = run_daily_job(spark, read_master(spark, args.master), land, root, args.run_date,
                            run_id=args.run_id, retry_landing_norm=retry, bronze_layout=layout)
        if out["summary"] is None:
            print("nothing fetched: bronze and control unchanged")
        else:
            out["summary"].show(truncate=False)
        out["quality"].show(50, truncate=False)
        return 1 if out["quality"].where("violations > 0").count() else 0
    elif args.command == "transform":
        from barforge.plans.transform import TransformPaths, run_transform
        report = run_transform(spark, f"{root}/bronze",
                               TransformPaths(silver=f"{root}/silver", gold=f"{root}/gold"),
                               changes_path=f"{root}/changes", full=args.full)
        report.show(50, truncate=False)
        return 1 if report.where("violations > 0").count() else 0
    elif args.command == "stream":
        from barforge.streaming import start_landing_stream
        start_landing_stream(spark, args.landing, f"{root}/bronze", exchange_tz=args.exchange_tz,
                             changes_path=f"{root}/changes").awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())

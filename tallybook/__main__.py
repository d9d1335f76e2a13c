"""Command line: the pipeline run and the statements view.

    python -m tallybook statements --tables /root/testdata/sf0.01 [--end-year 2023]
    python -m tallybook run --raw RAW_DIR --target WAREHOUSE [--format csv]
    python -m tallybook load --raw RAW_DIR --target WAREHOUSE --load 7 [--format csv]

``run`` is the whole refresh (load with rejects, snapshot tables, live view)
over raw folders RAW_DIR/{sales,purchases,payments,loans}. ``load`` applies a numbered
load of records by key (new ones, changes, and deletions: ``_op`` = ``D``) from the folders
that are there, and makes the statements from what has changed. All commands print
every year of the statements, or write them as CSV to ``--out``. The shuffle
width is sized from the input files.
"""

from __future__ import annotations

import argparse
import os

from .plans.pipeline import build_statements, default_years, run_pipeline
from .refresh import statements as kept
from .refresh.keyed import read_rejects
from .session import get_session, size_session
from .sources.adapter import ledger_from_driver
from .sources.loader import read_raw
from .sources.tables import path_exists


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(prog="tallybook")
    sub = ap.add_subparsers(dest="cmd", required=True)
    st = sub.add_parser("statements", help="statements over the driver's tables")
    st.add_argument("--tables", required=True)
    st.add_argument("--end-year", type=int, default=2023)
    rn = sub.add_parser("run", help="load raw files, write tables, create the view")
    rn.add_argument("--raw", required=True)
    rn.add_argument("--target", required=True)
    rn.add_argument("--format", default="csv")
    rn.add_argument("--end-year", type=int, default=2023)
    ld = sub.add_parser("load", help="apply a keyed load to the statements kept below the target")
    ld.add_argument("--load", type=int, required=True, help="the load's number: of a key the greatest counts")
    ld.add_argument("--raw", required=True)
    ld.add_argument("--target", required=True)
    ld.add_argument("--format", default="csv")
    ld.add_argument("--end-year", type=int, default=2023)
    for p in (st, rn, ld):
        p.add_argument("--out", default=None, help="write the statements here instead of printing them")
    ap.add_argument("--master", default=None, help="e.g. local[*]; omit on a cluster")
    args = ap.parse_args(argv)

    spark = get_session(args.master)
    size_session(spark, [args.tables if args.cmd == "statements" else args.raw])
    if args.cmd == "statements":
        df = build_statements(spark, ledger_from_driver(spark, args.tables), args.end_year)
    else:
        sources = {t: os.path.join(args.raw, t) for t in ("sales", "purchases", "payments", "loans")
                   if path_exists(spark, os.path.join(args.raw, t))}
    if args.cmd == "load":
        for name, path in sources.items():
            kept.apply_load(read_raw(spark, path, args.format, {}), args.target, name, args.load)
            print(f"{name}: {read_rejects(spark, os.path.join(args.target, 'raw', name), name).count()} rejected records")
        kept.maintain(spark, args.target)
        df = kept.current_statements(spark, args.target, default_years(spark), args.end_year)
    elif args.cmd == "run":
        out = run_pipeline(spark, sources, args.target, args.end_year, fmt=args.format)
        print(f"rejected records: {out['rejects'].count()}")
        df = out["dashboard_flux_analysis"]
    if args.out:
        df.coalesce(1).write.mode("overwrite").option("header", True).csv(args.out)
        return
    print("\t".join(df.columns))
    for row in df.toLocalIterator():  # a row per year
        print("\t".join("" if v is None else str(v) for v in row))


if __name__ == "__main__":
    main()

"""Command line:

``python -m wirelake analyze OUT_DIR CAPTURE [CAPTURE ...]``
``python -m wirelake stream LINES_DIR OUT_DIR [--interval 5] [--seconds 60]``
``python -m wirelake explain QUERY [SF_DIR]`` (formatted physical plan of a catalog query)
"""

from __future__ import annotations

import argparse

from wirelake.session import get_session


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="wirelake")
    sub = parser.add_subparsers(dest="command", required=True)
    a = sub.add_parser("analyze", help="features, clustering, report and dashboard data for captures")
    a.add_argument("out_dir")
    a.add_argument("captures", nargs="+")
    a.add_argument("--master", default=None)
    s = sub.add_parser("stream", help="sliding-window counters over a folder of line files")
    s.add_argument("lines_dir")
    s.add_argument("out_dir")
    s.add_argument("--interval", type=int, default=5)
    s.add_argument("--seconds", type=float, default=60.0)
    s.add_argument("--master", default=None)
    x = sub.add_parser("explain", help="formatted physical plan of a catalog query")
    x.add_argument("query")
    x.add_argument("sf_dir", nargs="?", default="/root/testdata/sf0.01")
    x.add_argument("--master", default=None)
    args = parser.parse_args(argv)
    spark = get_session(master=args.master)

    if args.command == "explain":
        from wirelake.plans.catalog import catalog

        catalog()[args.query](spark, args.sf_dir).explain("formatted")
    elif args.command == "analyze":
        from wirelake.plans.analysis import analyze_captures

        result = analyze_captures(spark, args.captures, args.out_dir)
        for name, df in result.panels.items():
            df.write.mode("overwrite").parquet(f"{args.out_dir}/panels/{name}")
        result.predictions.write.mode("overwrite").parquet(f"{args.out_dir}/panels/cluster_scatter")
        result.features.write.mode("overwrite").parquet(f"{args.out_dir}/features")
        print(f"report: {result.report_path}")
    else:
        from wirelake.plans.analysis import read_stream_analysis, start_stream_analysis
        from wirelake.sources.lines import read_line_stream
        from wirelake.streaming.windows import stop_gracefully

        queries = start_stream_analysis(read_line_stream(spark, args.lines_dir), args.out_dir, args.interval,
                                        console=True)
        spark.streams.awaitAnyTermination(args.seconds)
        for q in queries.values():
            stop_gracefully(q)
        for name, df in read_stream_analysis(spark, args.out_dir).items():
            df.write.mode("overwrite").parquet(f"{args.out_dir}/final/{name}")


if __name__ == "__main__":
    main()

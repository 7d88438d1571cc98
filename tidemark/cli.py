"""Command line for the batch job and the incremental normaliser.

    spark-submit tidemark/cli.py run --root s3a://bucket/risk [--runs latest|all] [--skip-trends-if-single] [--resume]
    spark-submit tidemark/cli.py catch-up --root s3a://bucket/risk --feed markets

``run`` executes every step in order and exits non-zero at the first failure;
``catch-up`` normalises every run landed since the previous call.
"""

from __future__ import annotations

import argparse
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tidemark")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="run the batch job")
    run.add_argument("--root", required=True, help="shared folder holding raw/, processed/, reports/ ...")
    run.add_argument("--runs", choices=["latest", "all"], default="latest")
    run.add_argument("--skip-trends-if-single", action="store_true")
    run.add_argument("--no-marts", action="store_true")
    run.add_argument("--resume", action="store_true", help="after a failed run: skip the outputs it finished")
    catch = sub.add_parser("catch-up", help="normalise newly landed runs (streaming, AvailableNow)")
    catch.add_argument("--root", required=True)
    catch.add_argument("--feed", choices=["markets", "protocols", "stablecoins"], required=True)
    args = parser.parse_args(argv)

    from tidemark.plans.job import Layout, run_job
    from tidemark.session import build_session

    spark = build_session()
    layout = Layout(args.root.rstrip("/"))
    if args.command == "run":
        results = run_job(spark, layout, runs=args.runs, skip_trends_if_single=args.skip_trends_if_single,
                               with_marts=not args.no_marts, resume=args.resume)
        for row in results.collect():
            print(f"{row['check']:16s} {row['target']:32s} rows={row['rows']} passed={row['passed']}")
    else:
        from tidemark.streaming.incremental import catch_up

        catch_up(spark, layout.raw(args.feed), layout.snapshots(args.feed),
                 f"{layout.root}/_checkpoints/{args.feed}", args.feed)
    return 0


if __name__ == "__main__":
    sys.exit(main())

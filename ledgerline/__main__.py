"""Command line: run the layer pipeline or one registered query.

  python -m ledgerline pipeline --sf-dir /data/sf1 --root /shared/lake [--as-of 2001-08-01]
  python -m ledgerline query customer_segments --sf-dir /data/sf1 [--out /shared/out]

``--root`` / ``--out`` must be shared storage visible to every executor.
Sources come from the testdata-shaped adapters; a JDBC deployment builds its
``sources`` mapping with ``ingest.read_source`` and calls ``pipeline.run``.
"""

from __future__ import annotations

import argparse
import json
import sys

from ledgerline.session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("pipeline", help="bronze -> silver -> gold, publish, checks")
    p.add_argument("--sf-dir", required=True)
    p.add_argument("--root", required=True)
    p.add_argument("--database", default="ledgerline_gold")
    p.add_argument("--as-of", default=None)
    p.add_argument("--gold-format", default="parquet")
    p.add_argument("--retain-versions", type=int, default=None, help="keep this many versions per layer table")
    q = sub.add_parser("query", help="run one registered query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--out", default=None, help="write parquet here instead of printing")
    q.add_argument("--show", type=int, default=20)
    for a in (p, q):
        a.add_argument("--master", default=None)
    args = ap.parse_args(argv)

    spark = build_session(args.master)
    if args.cmd == "pipeline":
        from ledgerline.plans import pipeline
        from ledgerline.sources import testdata

        sources = {name: (lambda b=b: b(spark, args.sf_dir)) for name, b in testdata.BRONZE_BUILDERS.items()}
        res = pipeline.run(
            spark,
            sources,
            args.root,
            args.database,
            args.as_of,
            gold_format=args.gold_format,
            retain_versions=args.retain_versions,
        )
        print(json.dumps({"version": res.version, "paths": res.paths}))
        res.checks.show(truncate=False)
        return 0
    from ledgerline.plans.registry import queries

    df = queries()[args.name](spark, args.sf_dir)
    if args.out:
        df.write.mode("errorifexists").parquet(args.out)
    else:
        df.show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())

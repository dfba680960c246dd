"""Command line: ``python -m starloom <command> ...``

  list                                  names of the registered queries
  query NAME SF_DIR [--out PATH] [--show N]
                                        run one query; write Parquet (staged
                                        publish) or print a preview
  refresh SF_DIR OUT_ROOT [--fail-on-error]
                                        full refresh of the warehouse (OP23)

The session comes from ``spark-submit`` / the environment; ``--master`` is
only for local runs.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="starloom")
    p.add_argument("--master", default=None, help="e.g. local[8]; omit under spark-submit")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    q = sub.add_parser("query")
    q.add_argument("name")
    q.add_argument("sf_dir")
    q.add_argument("--out")
    q.add_argument("--show", type=int, default=20)
    r = sub.add_parser("refresh")
    r.add_argument("sf_dir")
    r.add_argument("out_root")
    r.add_argument("--fail-on-error", action="store_true")
    args = p.parse_args(argv)

    from starloom.plans.queries import QUERIES

    if args.cmd == "list":
        print("\n".join(sorted(QUERIES)))
        return 0
    from starloom.session import get_session

    spark = get_session(args.master)
    if args.cmd == "query":
        df = QUERIES[args.name](spark, args.sf_dir)
        if args.out:
            from starloom.sinks.publish import publish
            res = publish(df, args.out)
            print(json.dumps({"path": res.path, "rows": res.rows, "backup": res.backup}))
        else:
            df.show(args.show, truncate=False)
        return 0
    from starloom.plans.warehouse import full_refresh

    report = full_refresh(spark, args.sf_dir, args.out_root, fail_on_error=args.fail_on_error)
    print(json.dumps(report))
    return 0 if report.get("failed_checks", 0) == 0 or not args.fail_on_error else 1


if __name__ == "__main__":
    sys.exit(main())

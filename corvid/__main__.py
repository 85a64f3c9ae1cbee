"""Command line: run a registered query or SQL text.

  python -m corvid list
  python -m corvid run daily_activity --sf /root/testdata/sf0.01 [--out path --format parquet]
  python -m corvid sql "select ..." --sf DIR [--filter .. --select .. --order-by .. --limit N
                                                --drop N --take N --count]
Without ``--out`` a result is shown (first rows) or, for ``sql``, printed as a
result document; with ``--out`` it is written by the executors.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="corvid")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list")
    r = sub.add_parser("run")
    r.add_argument("name")
    r.add_argument("--sf", default="/root/testdata/sf0.01")
    r.add_argument("--out")
    r.add_argument("--format", default="parquet")
    r.add_argument("--master")
    q = sub.add_parser("sql")
    q.add_argument("query")
    q.add_argument("--sf", default="/root/testdata/sf0.01")
    q.add_argument("--master")
    for opt in ("filter", "select", "order-by"):
        q.add_argument(f"--{opt}")
    for opt in ("limit", "drop", "take"):
        q.add_argument(f"--{opt}", type=int)
    q.add_argument("--distinct", action="store_true")
    q.add_argument("--count", action="store_true")
    q.add_argument("--schema", action="store_true")
    q.add_argument("--explain", action="store_true")
    a = p.parse_args(argv)

    from corvid.plans import catalog
    from corvid.plans.registry import REGISTRY
    if a.cmd == "list":
        for n, e in REGISTRY.items():
            print(f"{n:28s} {'sql' if e.sql else 'rows':5s} {' '.join(e.ids)}")
        return 0
    from corvid.session import get_spark
    spark = get_spark(a.master)
    if a.cmd == "run":
        df = catalog.queries()[a.name](spark, a.sf)
        if a.out:
            df.write.mode("overwrite").format(a.format).save(a.out)
        else:
            df.show(20, truncate=False)
        return 0
    from corvid.operators.shape import request
    from corvid.sources.tables import register_tables
    register_tables(spark, a.sf)
    res = request(spark, a.query, schema=a.schema, explain=a.explain, filter=a.filter,
                  select=a.select, distinct=a.distinct, order_by=a.order_by, limit=a.limit,
                  drop=a.drop, take=a.take, count=a.count)
    print(res if isinstance(res, (str, int)) else json.dumps(res, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())

"""Command line: run the jobs, or one registered query.

    python -m gapledger jobs  --base DIR --out DIR
    python -m gapledger query NAME --base DIR [--out DIR]
    python -m gapledger explain NAME --base DIR
"""

from __future__ import annotations

import argparse
import json

from .plans import jobs
from .plans.registry import QUERIES
from .session import get_session
from .sources.sinks import write_csv


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="gapledger")
    sub = ap.add_subparsers(dest="cmd", required=True)
    j = sub.add_parser("jobs")
    j.add_argument("--base", required=True)
    j.add_argument("--out", required=True)
    for name in ("query", "explain"):
        q = sub.add_parser(name)
        q.add_argument("name", choices=sorted(QUERIES))
        q.add_argument("--base", required=True)
        q.add_argument("--out")
    ap.add_argument("--master")
    a = ap.parse_args(argv)
    spark = get_session(master=a.master)
    if a.cmd == "jobs":
        print(json.dumps(jobs.run_all(spark, a.base, a.out), indent=2))
    elif a.cmd == "explain":
        QUERIES[a.name](spark, a.base).explain("formatted")
    else:
        df = QUERIES[a.name](spark, a.base)
        if a.out:
            write_csv(df, a.out)
            print(a.out)
        else:
            df.write.format("noop").mode("overwrite").save()
            print(json.dumps({"query": a.name, "columns": df.columns}))
    spark.stop()


if __name__ == "__main__":
    main()

"""Print compact physical plans of registered queries (before execution, as
planned from file statistics; AQE may re-plan joins at run time).

usage: python tools/show_plans.py [sf_dir] query ...
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def compact(plan: str, width: int = 150) -> str:
    out = []
    for line in plan.splitlines():
        line = re.sub(r"#\d+L?", "", line)
        line = re.sub(r", \[plan_id=\d+\]", "", line)
        out.append(line[:width])
    return "\n".join(out)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    from tessera.plans.queries import queries
    from tessera.session import local_session
    spark = local_session(8, 16)
    qs = queries()
    for name in names:
        df = qs[name](spark, sf_dir)
        print(f"### {name}\n```\n{compact(df._jdf.queryExecution().executedPlan().toString())}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()

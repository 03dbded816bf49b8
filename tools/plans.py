"""Print the final (post-AQE) physical plan tree of registered queries.

usage: python tools/plans.py [sf_dir] name ...   (writes markdown to stdout)
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def plan_tree(df) -> str:
    df.collect()  # run once so the adaptive plan is final
    jvm = df.sparkSession.sparkContext._jvm
    text = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree, details = [], {}
    for line in text.splitlines():
        if line.startswith("(") or "== Initial Plan ==" in line:
            break
        if line.strip():
            tree.append(line)
    current = None
    for line in text.splitlines():
        if line.startswith("("):
            current = line.strip()
        elif current and any(k in line for k in ("PushedFilters", "ReadSchema")):
            details.setdefault(current, []).append(line.strip())
    return "\n".join(tree) + "\n" + "\n".join(
        f"{k}: {'; '.join(v)}" for k, v in details.items() if "Scan" in k)


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    from corpusflow.plans.queries import QUERIES
    from corpusflow.session import get_session
    spark = get_session("local[8]", shuffle_partitions=16)
    for name in names:
        print(f"### {name}\n\n```\n{plan_tree(QUERIES[name].build(spark, sf_dir))}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()

"""Summarise the executed plan of every registered query (markdown table).

    python tools/plan_summary.py [/root/testdata/sf0.01]

Each query is collected and the adaptive plan that ran is read, once as Spark
chose it and once with broadcasts off (``spark.sql.autoBroadcastJoinThreshold=-1``;
explicitly bounded broadcasts stay).  Subqueries count; skipped stages do not.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from storelens.plans.registry import QUERIES  # noqa: E402
from storelens.session import get_session  # noqa: E402


def executed(spark, df) -> Counter:
    """Operators of the final plan of the query that was run, by name, each node once."""
    df.collect()
    query = df._jdf.queryExecution()
    if "isFinalPlan=false" in query.executedPlan().toString().split("\n", 1)[0]:
        raise RuntimeError("no final plan")
    text = spark._jvm.PythonSQLUtils.explainString(query, "formatted")
    nodes, cut = set(), None
    for line in text.split("\n"):
        depth = len(line) - len(line.lstrip(" :+-"))
        if cut is not None and depth >= cut:
            continue
        cut = depth if "== Initial Plan ==" in line else None
        tree = re.match(r"[ :+\-*]*([A-Z]\w+)[\w ]*? \((\d+)\)", line)
        if tree and not line.startswith("("):
            nodes.add(tree.groups())
    return Counter(name for name, _ in nodes)


def counts(plan: Counter) -> list[int]:
    return [plan["Scan"], plan["Exchange"], plan["ReusedExchange"], plan["BroadcastHashJoin"],
            plan["SortMergeJoin"] + plan["ShuffledHashJoin"],
            plan["BroadcastNestedLoopJoin"] + plan["CartesianProduct"], plan["Window"]]


def main() -> None:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=16)
    names = ["scans", "shuffles", "reused", "broadcast joins", "shuffle joins", "nested loops", "windows"]
    print("| key | " + " | ".join(names) + " | " + " | ".join(f"{n} (no broadcasts)" for n in names[:5]) + " |")
    print("|---" * (len(names) + 6) + "|")
    for key, fn in QUERIES.items():
        as_is = counts(executed(spark, fn(spark, root)))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        without = counts(executed(spark, fn(spark, root)))
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert as_is[5] == without[5] == 0, key
        print(f"| {key} | " + " | ".join(map(str, as_is + without[:5])) + " |", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()

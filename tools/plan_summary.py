"""Summarise the executed physical plan of named queries.

usage: python tools/plan_summary.py SF_DIR name [name ...]

Counts exchanges, broadcasts, sorts, window operators, aggregates and joins,
and lists the filters pushed into parquet scans, after running each query
through the ``noop`` sink (so AQE has settled its final plan).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candela.plans.catalog import registry  # noqa: E402
from candela.session import local_session  # noqa: E402

PATTERNS = [("exchanges", r"Exchange (hash|range|Single|round)"), ("broadcasts", r"BroadcastExchange"),
            ("sorts", r"\bSort \["), ("windows", r"Window \["), ("sort_aggs", r"SortAggregate"),
            ("hash_aggs", r"HashAggregate"), ("smj", r"SortMergeJoin"), ("bhj", r"BroadcastHashJoin"),
            ("top_k", r"TakeOrderedAndProject")]


def main() -> None:
    sf, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    queries = registry()
    for name in names:
        df = queries[name](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {k: len(re.findall(p, plan)) for k, p in PATTERNS}
        pushed = sorted(set(x for x in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if x))
        print(name, {k: v for k, v in counts.items() if v}, "pushed:", pushed)


if __name__ == "__main__":
    main()

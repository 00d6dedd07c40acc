"""Summarize the physical plans of the headline queries: shuffles, broadcasts, pushed filters.

Usage: python tools/plan_summary.py [sf_dir] [--formatted NAME]
Each query is run once (so adaptive execution settles its final plan), then its plan is inspected.
"""

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import HEADLINE  # noqa: E402
from meterline.session import build_session  # noqa: E402


def summary(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    jvm = df.sparkSession._jvm
    plan = jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    lines = plan.splitlines()
    shuffles = [re.sub(r"#\d+L?", "", m.group(1)) for m in
                (re.search(r"Arguments: (\w+partitioning\(.*?\d+\))", ln) for ln in lines) if m]
    return {
        "shuffles": shuffles,
        "broadcasts": sum("BroadcastExchange" in ln for ln in lines),
        "reused": sum("ReusedExchange" in ln for ln in lines),
        "pushed": sorted({m.group(1) for m in re.finditer(r"PushedFilters: \[([^\]]*)\]", plan)}),
    }


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.1"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    if "--formatted" in sys.argv:
        name = sys.argv[sys.argv.index("--formatted") + 1]
        HEADLINE[name](spark, sf).explain("formatted")
        return
    for name, fn in HEADLINE.items():
        s = summary(fn(spark, sf))
        print(f"{name}: {len(s['shuffles'])} shuffle(s) {s['shuffles']}; broadcasts {s['broadcasts']}; "
              f"pushed {s['pushed']}")


if __name__ == "__main__":
    main()

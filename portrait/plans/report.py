"""Physical-plan summary of every registered query, as it would plan at scale.

Run with ``python -m portrait.plans.report [sf_dir] > PLANS.md``.  Automatic
broadcast is switched off (``spark.sql.autoBroadcastJoinThreshold=-1``) so the
plans show what happens when dimension tables are too big to broadcast: only
the explicit, size-bounded broadcast hints remain and every other join is a
shuffle join.  Counts are taken from the initial adaptive plan.

Reading the table: intermediates that are checkpointed when the query is built
(top-K vocabulary, dense indexes, model training sets, sink round trips) show
up as scans, so their work is not counted here."""

from __future__ import annotations

import contextlib
import io
import re
import sys


def summarize(df) -> dict:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    p = buf.getvalue()
    ops = re.findall(r"^\(\d+\) (\w+)", p, flags=re.M)
    count = lambda name: sum(1 for o in ops if o == name)
    joins = sorted({m for m in re.findall(r"(SortMergeJoin|BroadcastHashJoin|ShuffledHashJoin)", p)})
    return {
        "shuffles": count("Exchange"),
        "broadcasts": count("BroadcastExchange"),
        "joins": ", ".join(joins) or "-",
        "partial_agg": "yes" if re.search(r"partial_", p) else "-",
        "window": "yes" if count("Window") else "-",
        "group_limit": "yes" if count("WindowGroupLimit") else "-",
        "python": "yes" if any(re.search(r"Python|InPandas|InArrow", o) for o in ops) else "-",
        "pushed_filters": "yes" if any(re.sub(r"IsNotNull\([^)]*\),? ?", "", f) for f in
                                       re.findall(r"PushedFilters: \[([^\]]*)\]", p)) else "-",
    }


def main(argv: list[str]) -> None:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from portrait.plans.oracle import ORACLE_SQL
    from portrait.plans.queries import QUERIES
    from portrait.session import build_session
    spark = build_session("local[8]", 16, app_name="portrait-plans")
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cols = ["shuffles", "broadcasts", "joins", "partial_agg", "window", "group_limit", "python", "pushed_filters"]
    print("# Query plans at scale\n")
    print(__doc__.strip().split("\n\n", 1)[1] if "\n\n" in __doc__ else "")
    print("\nModel-training queries are listed by their final scoring plan.\n")
    print("| query | oracle | " + " | ".join(cols) + " |")
    print("|---|---|" + "---|" * len(cols))
    for name, fn in QUERIES.items():
        s = summarize(fn(spark, sf))
        print(f"| {name} | {'SQL' if name in ORACLE_SQL else 'rows'} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)

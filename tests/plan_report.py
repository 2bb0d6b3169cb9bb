"""Write PLANS.md: physical operator trees (and scan pushdown / pruning lines)
of representative queries, from Spark's formatted explain output.

    python tests/plan_report.py [sf_dir]
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["connections", "fence_iqr", "prediction_stats", "rolling_mean", "roc_curve",
         "categorical_profile", "windowed_alarm"]


def plan_text(df) -> str:
    sc = df.sparkSession.sparkContext
    return sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarise(text: str) -> str:
    lines = text.splitlines()
    tree, details, cur = [], [], None
    for ln in lines:
        if ln.startswith("(") and ")" in ln:
            cur = ln
        elif cur is None and ln.strip():
            tree.append(ln)
        if cur and cur.split(")", 1)[1].strip().startswith("Scan") and \
                ln.startswith(("PushedFilters", "ReadSchema", "Location")):
            details.append(f"{cur.strip()}: {ln.strip()}")
    return "\n".join(tree + [""] + details)


def main(sf_dir="/root/testdata/sf0.1"):
    from tidewatch.session import get_session
    import __spark_entry__ as E
    spark = get_session("local[8]", shuffle_partitions=8)
    qs = E.queries()
    out = ["# Physical plans of representative queries",
           "", f"Generated by `tests/plan_report.py` at `{sf_dir}` (initial adaptive plans; "
           "AQE may still switch join strategies from runtime sizes). Fitted state and "
           "saved tables appear as literals and `Scan parquet` of the shared folder.", ""]
    for n in NAMES:
        out += [f"## {n}", "", "```", summarise(plan_text(qs[n](spark, sf_dir))), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as fh:
        fh.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main(*sys.argv[1:])

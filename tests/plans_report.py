"""Write PLANS.md: the final (adaptive) physical plans of the headline
queries at an sf directory.  Usage: python tests/plans_report.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ["holdout_roles", "popularity_eval", "signal_coverage", "dataset_summary", "lsh_pairs", "segment_topk",
           "reader_sets"]


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    import __spark_entry__ as E
    from affinity.session import build_session
    spark = build_session()
    spark.conf.set("spark.sql.maxMetadataStringLength", "160")
    out = ["# PLANS", "",
           f"Final adaptive physical plans (`executedPlan` after `collect`, AQE re-planned) at `{os.path.basename(sf_dir)}`,",
           "generated by `tests/plans_report.py`. Scratch paths and expression ids are shortened.", ""]
    from affinity.config import FIXTURE
    from affinity.operators import prep
    from affinity.sources import fx_interactions
    frames = [("role_assignment (prepare over the materialised sample)",
               lambda: prep.prepare(fx_interactions(spark, sf_dir), FIXTURE, materialize=True))]
    frames += [(name, lambda name=name: E.queries()[name](spark, sf_dir)) for name in QUERIES]
    for name, build in frames:
        df = build()
        df.collect()  # the plan of this execution, after AQE re-planning (isFinalPlan=true)
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("+- == Initial Plan ==")[0]  # keep the final (re-planned) plan
        plan = re.sub(r"#\d+L?", "", plan)
        plan = re.sub(r"file:/[^\],]*/(sampled|prepared)-[0-9a-f]+", r"<shared>/\1-*", plan)
        plan = re.sub(r"\[plan_id=\d+\]", "", plan)
        out += [f"## {name}", "", "```", plan.rstrip(), "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))


if __name__ == "__main__":
    main()

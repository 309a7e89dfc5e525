"""Write the physical plans of the headline queries to PLANS.md (evidence for pruning,
pushdown, join strategy and exchanges).  Usage: python tools/explain_plans.py [sf_dir]"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from notecohort.plans import registry  # noqa: E402
from notecohort.session import build_session  # noqa: E402

QUERIES = ["encounter_cohort", "metadata_encounter_join", "note_text_join", "findings_exploded",
           "notes_first_finding", "partition_assign", "first_batch_wins", "llm_patient_mode", "staging_timeline"]
# Shown once more as they are beyond the broadcast threshold.
SHUFFLED = ["encounter_cohort", "metadata_encounter_join", "note_text_join", "metadata_encounter_bucketed", "note_text_join_bucketed",
            "first_batch_wins"]
KEEP = re.compile(r"^[ :+|*()0-9-]*(\w*Exchange|\w*Join|\w*Scan|\w*Aggregate|Window|Generate|MapInPandas|"
                  r"Filter|Sort|AdaptiveSparkPlan|BroadcastExchange|Union)")


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    out = ["# Physical plans of the headline queries", "",
           f"Generated by `tools/explain_plans.py` on `{sf}`. Operator lines only (long expressions cut at 160",
           "characters). Upstream key sets and stage outputs appear as scans of tables written under the",
           "checkpoint folder.", ""]
    for name, joins in [(n, j) for j in ("", " (broadcasting off)") for n in (SHUFFLED if j else QUERIES)]:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1" if joins else "10m")
        df = registry.build(name, spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = [ln[:160] for ln in plan.split("\n") if KEEP.search(ln)]
        out += [f"## {name}{joins}", "", "```", *lines, "```", ""]
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

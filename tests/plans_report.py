"""Write PLANS.md: trimmed physical plans of key queries at sf0.1.

usage: python tests/plans_report.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
import tempfile
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shroud.plans.catalog import QUERIES  # noqa: E402
from shroud.session import local_session  # noqa: E402

KEYS = ["k_anonymity", "k_anonymity_path", "flag_k", "l_diversity_docs", "utility_matrix",
        "generalize_numeric", "pseudonymize", "course_combos"]
KEEP = re.compile(r"(Scan |ReadSchema|PushedFilters|Exchange|Join|HashAggregate|Expand|Window|"
                  r"InMemoryTableScan|BroadcastExchange|Generate|AdaptiveSparkPlan|Subquery)")


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8, checkpoint_dir=tempfile.mkdtemp(prefix="shroud-plans-"))
    spark.sparkContext.setLogLevel("ERROR")
    out = ["# Physical plans of key queries (sf0.1, initial AQE plans, trimmed)", "",
           "Generated by `python tests/plans_report.py`. Lines kept: scans with their",
           "read schema and pushed filters, exchanges, joins, aggregates, expands,",
           "generators and windows.", ""]
    for name in KEYS:
        buf = io.StringIO()
        with redirect_stdout(buf):
            QUERIES[name](spark, sf).explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n")[0]
        details = [ln for ln in text.splitlines() if ln.startswith(("ReadSchema", "PushedFilters"))]
        lines = [ln for ln in tree.splitlines() if KEEP.search(ln)]
        out += [f"## {name}", "", "```"] + lines + sorted(set(details)) + ["```", ""]
    open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w").write(
        "\n".join(out))


if __name__ == "__main__":
    main()

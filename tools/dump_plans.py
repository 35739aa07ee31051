"""Write the formatted physical plans of both jobs to docs/plans/.

Inputs are the sf0.01 adapter outputs written to parquet first (so the plans
show stored-table scans, as in production, not the test-data adapters).
Each step is shown as the job runs it: over the stage tables it reads (the
final cut and the allocated lines are materialised once and read back).

    python tools/dump_plans.py [sf_dir]
"""

from __future__ import annotations

import io
import os
import re
import sys
import tempfile
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from yoyflow.plans import renewal_pool as rp  # noqa: E402
from yoyflow.plans import revenue_extract as rx  # noqa: E402
from yoyflow.plans.registry import TEST_PARAMS, renewal_inputs  # noqa: E402
from yoyflow.plans.registry_extract import extract_inputs  # noqa: E402
from yoyflow.session import local_session  # noqa: E402
from yoyflow.sources.adapters import SparkInputs  # noqa: E402

OUT = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "plans")


class Stored:
    def __init__(self, spark, sf_dir):
        self.x, self.spark = SparkInputs(spark, sf_dir), spark
        self.root = tempfile.mkdtemp(prefix="yoyflow-plans-")
        self.frames = {}

    def __getitem__(self, name):
        if name not in self.frames:
            path = f"{self.root}/{name}"
            self.x[name].write.parquet(path)
            self.frames[name] = self.spark.read.parquet(path)
        return self.frames[name]


def formatted(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    stored = Stored(spark, sf)
    os.makedirs(OUT, exist_ok=True)
    st = rx.stages(extract_inputs(stored), TEST_PARAMS, materialize="table")
    inp = renewal_inputs(stored)
    pool = rp.build_pool(inp, TEST_PARAMS)
    cands = rp.candidate_subscriptions(inp.cpq_subscriptions, inp.raw_subscriptions, inp.opportunities)
    from yoyflow.operators.allocate import allocate_prior_value
    from yoyflow.operators.rollforward import roll_forward

    plans = {
        # each step as the job runs it: over the stage tables it reads
        "extract_1_raw_to_final_cut": rx.final_cut(st.data),
        "extract_2_allocate": allocate_prior_value(st.final, TEST_PARAMS),
        "extract_3_roll_forward": roll_forward(st.final, st.contracted, st.inp, TEST_PARAMS),
        "extract_4_combine": st.extract,
        "pool_1_build": pool,
        "pool_2_best_match": rp.best_matches(pool, inp.cpq_subscriptions, cands, rp.earliest_period(inp, TEST_PARAMS)),
        "pool_3_whole_job": rp.renewal_pool(inp, TEST_PARAMS),
    }
    for name, df in plans.items():
        text = formatted(df).replace(stored.root, "<stored inputs>")
        text = re.sub(r"file:\S*/yoyflow-stages/[^/\]]+/[0-9a-f]+", "<stage table>", text)
        text = re.sub(r"#\d+", "", text)  # expression ids vary from run to run
        with open(os.path.join(OUT, f"{name}.txt"), "w", encoding="utf-8") as fh:
            fh.write(text)
        print(name, len(text.splitlines()), "lines")


if __name__ == "__main__":
    main()

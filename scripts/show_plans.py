"""Print the physical plans of the main steps (for docs/PLANS.md).

Usage: python scripts/show_plans.py [sf_dir] > docs/PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from clickpipe.operators.assemble import labelled_data  # noqa: E402
from clickpipe.operators.sampling import exact_n_sample, hash_split  # noqa: E402
from clickpipe.plans.evaluate import auc_roc, metrics_table  # noqa: E402
from clickpipe.plans.workflow import rule_predictions, prepare  # noqa: E402
from clickpipe.session import local_session  # noqa: E402
from clickpipe.sources.fixtures import fixture_tables  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    tree = text.split("\n\n\n")[0]
    scans = re.findall(r"\(\d+\) Scan parquet.*?ReadSchema: [^\n]+", text, flags=re.S)
    return tree + "\n\n" + "\n\n".join(s.strip() for s in scans)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, shuffle_partitions=16)
    t = fixture_tables(spark, sf_dir)
    cases = {}
    train, _ = hash_split(labelled_data(**t))
    cases["training half: J1 + J2 + R2 + hash split (auto-broadcast on)"] = formatted(train)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    cases["training half, fact-sized inputs (auto-broadcast off; ads broadcast only by the "
          "row-count check)"] = formatted(hash_split(labelled_data(**t))[0])
    from clickpipe.operators.assemble import join_impressions_clicks
    from clickpipe.sources.tables import load_table, save_bucketed

    save_bucketed(t["event"], "event_by_display", "display_id", 16)
    save_bucketed(t["train"], "train_by_display", "display_id", 16)
    cases["J1 over tables bucketed by display_id (auto-broadcast off): no exchange"] = formatted(
        join_impressions_clicks(load_table(spark, "event", table="event_by_display"),
                                load_table(spark, "train", table="train_by_display")))
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rule = rule_predictions(prepare(t).test)
    cases["metrics table: one aggregate + stack"] = formatted(metrics_table(rule))
    cases["exact AUC: group by score, bucket offsets, window per bucket"] = formatted(auc_roc(rule))
    cases["exact-n sample (boundary bucket only is ranked)"] = formatted(
        exact_n_sample(t["event"], 0.09, ["display_id"]))
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Produced by `scripts/show_plans.py`; the plan tree and the parquet scans of each step.\n")
    for title, text in cases.items():
        print(f"## {title}\n\n```\n{text}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()

"""The plan-shape counter and the event-log summary."""

import json
import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import plan_report  # noqa: E402
import stage_times  # noqa: E402


def test_shape_counts_only_the_final_plan():
    plan = (
        "AdaptiveSparkPlan isFinalPlan=true\n+- == Final Plan ==\n"
        "   +- Window [x]\n   +- ShuffleQueryStage 0\n      +- Exchange hashpartitioning(k#1, 8)\n"
        "         +- FileScan parquet [k#1]\n"
        "+- == Initial Plan ==\n   +- Window [x]\n   +- Exchange hashpartitioning(k#1, 8)\n      +- FileScan parquet [k#1]\n"
    )
    s = plan_report.shape(plan)
    assert (s["shuffles"], s["windows"], s["scans"], s["python"]) == (1, 1, 1, 0)


def test_stage_summary_and_skew(scratch):
    events = [{"Event": "SparkListenerJobStart", "Job ID": 0, "Stage IDs": [0]}]
    for t, dur in enumerate([100, 100, 100, 500]):
        events.append(
            {
                "Event": "SparkListenerTaskEnd",
                "Stage ID": 0,
                "Task Info": {"Launch Time": 0, "Finish Time": dur},
                "Task Metrics": {"Shuffle Write Metrics": {"Shuffle Bytes Written": 10}},
            }
        )
    events.append({"Event": "SparkListenerStageCompleted", "Stage Info": {"Stage ID": 0, "Stage Name": "s"}})
    path = os.path.join(scratch, "events")
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(e) for e in events) + "\n")
    (row,) = stage_times.summarise(path)
    assert (row["job"], row["tasks"], row["max_ms"], row["median_ms"], row["skew"], row["shuffle_write"]) == (0, 4, 500, 100, 5.0, 40)

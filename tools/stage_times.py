"""Per-stage times of registered queries, read from Spark's event log (no UI, no server).

    python tools/stage_times.py SCRATCH_DIR [sf_dir] name [name ...]

The event log goes to SCRATCH_DIR (use a fresh folder per run). Each query runs twice
through the ``noop`` sink; the second run's stages are printed.
"""

from __future__ import annotations

import glob
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sheaf.plans.registry import queries  # noqa: E402
from sheaf.session import get_session  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    log_dir = args.pop(0)
    sf_dir = args.pop(0) if args and os.path.isdir(args[0]) else "/root/testdata/sf0.1"
    spark = get_session(
        "local[8]",
        shuffle_partitions=16,
        extra={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
        },
    )
    for name in args:
        for run in (1, 2):
            spark.sparkContext.setJobGroup(f"{name}#{run}", name)
            queries()[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.stop()
    log = [p for p in glob.glob(os.path.join(log_dir, "*")) if os.path.isfile(p)][0]
    group_of_stage, stages, task_ms = {}, {}, {}
    for line in open(log, encoding="utf-8"):
        event = json.loads(line)
        kind = event["Event"]
        if kind == "SparkListenerJobStart":
            group = (event.get("Properties") or {}).get("spark.jobGroup.id", "")
            for stage_id in event["Stage IDs"]:
                group_of_stage[stage_id] = group
        elif kind == "SparkListenerTaskEnd":
            info = event["Task Info"]
            task_ms.setdefault(event["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
        elif kind == "SparkListenerStageCompleted":
            info = event["Stage Info"]
            took = info.get("Completion Time", 0) - info.get("Submission Time", 0)
            stages[info["Stage ID"]] = (info["Number of Tasks"], took, info["Stage Name"][:50])
    for stage_id in sorted(stages):
        group = group_of_stage.get(stage_id, "")
        if group.endswith("#2"):
            tasks, took, label = stages[stage_id]
            times = sorted(task_ms.get(stage_id, [0]))
            spread_ms = f"task ms min/median/max {times[0]}/{times[len(times) // 2]}/{times[-1]}"
            print(f"{group[:-2]:28s} stage {stage_id:4d} tasks {tasks:4d} {took:6d} ms  {spread_ms}  {label}")


if __name__ == "__main__":
    main()

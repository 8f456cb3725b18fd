"""Task seconds and shuffled bytes of every bench step, from Spark's event log.

usage: python tools/task_times.py [SF_DIR]
Wall clock on a shared machine is noisy; this prints what the tasks of each
step took (executor run time and CPU time, second run), so steps can be
compared between commits.
"""
from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import bench  # noqa: E402
from starmart.plans.build import build_all  # noqa: E402
from starmart.session import get_session  # noqa: E402
from starmart.sources.fixtures import raw_transactions  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else bench.SF_DIR
    scratch = tempfile.mkdtemp(prefix="starmart-tasks-")
    os.mkdir(f"{scratch}/events")
    spark = get_session(
        f"local[{bench.CPUS}]", shuffle_partitions=2 * bench.CPUS,
        extra={"spark.driver.memory": "8g", "spark.checkpoint.dir": f"{scratch}/ckpt",
               "spark.sql.warehouse.dir": f"{scratch}/wh", "spark.eventLog.enabled": "true",
               "spark.eventLog.dir": f"file://{scratch}/events", "spark.eventLog.compress": "false",
               "spark.eventLog.rolling.enabled": "false"})
    spans: list[tuple[float, float, str]] = []

    def named(name, run):
        start = time.time()
        out = run()
        spans.append((start * 1000, time.time() * 1000, name))
        return out

    def build():
        return build_all(spark, raw_transactions(spark, sf_dir), as_of="2025-06-30")

    named("build (first)", build)
    b = named("build", build)
    named("quality_report (first)", b.report.collect)
    named("quality_report", b.report.collect)
    for name, run in bench.queries(spark, b).items():
        named(f"{name} (first)", run)
        named(name, run)
    spark.stop()

    steps: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    of_stage: dict[int, str] = {}
    for path in glob.glob(f"{scratch}/events/*"):
        for line in open(path):
            e = json.loads(line)
            if e["Event"] == "SparkListenerStageSubmitted":
                at = e["Stage Info"].get("Submission Time", 0)
                of_stage[e["Stage Info"]["Stage ID"]] = next((n for a, b, n in spans if a <= at <= b), "")
            elif e["Event"] == "SparkListenerTaskEnd":
                m, step = e.get("Task Metrics") or {}, steps[of_stage.get(e["Stage ID"], "")]
                step["run"] += m.get("Executor Run Time", 0) / 1e3
                step["cpu"] += m.get("Executor CPU Time", 0) / 1e9
                step["written"] += m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) / 1e6
                step["tasks"] += 1
    shown = {n for n in steps if n and not n.endswith("(first)")}
    shown = (shown - {"quality_report"}) | {"quality_report (first)"}
    print("| step | tasks | task s | CPU s | MB shuffled |")
    print("|---|---|---|---|---|")
    for name, x in steps.items():
        if name in shown:
            print(f"| {name} | {x['tasks']:.0f} | {x['run']:.2f} | {x['cpu']:.2f} | {x['written']:.2f} |")


if __name__ == "__main__":
    main()

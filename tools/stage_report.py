"""Per-query stage metrics from Spark's event log (written to a scratch folder).

usage: python tools/stage_report.py [sf_dir] > STAGES.md
For each registered query: jobs, stages, tasks, bytes read from files, shuffle bytes
written, and the largest task time against the median one (a skew indicator).
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    from actiontally.plans.catalog import QUERIES
    from actiontally.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="actiontally-eventlog-")
    spark = build_session("local[8]", shuffle_partitions=8, extra={
        "spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": log_dir, "spark.eventLog.compress": "false",
        "spark.eventLog.rolling.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    names = list(QUERIES)
    for name in names:
        spark.sparkContext.setJobDescription(name)
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    spark.stop()

    stage_query: dict[int, str] = {}
    jobs = defaultdict(int)
    stats = defaultdict(lambda: {"stages": 0, "tasks": 0, "read": 0, "shuffle": 0, "times": []})
    task_times = defaultdict(list)
    task_read: dict[int, int] = defaultdict(int)
    task_rows: dict[int, int] = defaultdict(int)
    task_shuffle: dict[int, int] = defaultdict(int)
    for path in [p for p in glob.glob(f"{log_dir}/**/*", recursive=True) if os.path.isfile(p)]:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description")
                    if desc in names:
                        jobs[desc] += 1
                        for sid in ev.get("Stage IDs", []):
                            stage_query[sid] = desc
                elif kind == "SparkListenerTaskEnd":
                    m = ev.get("Task Metrics") or {}
                    sid = ev["Stage ID"]
                    task_times[sid].append(int(m.get("Executor Run Time", 0)))
                    task_read[sid] += int((m.get("Input Metrics") or {}).get("Bytes Read", 0))
                    task_rows[sid] += int((m.get("Input Metrics") or {}).get("Records Read", 0))
                    task_shuffle[sid] += int((m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0))
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    q = stage_query.get(info["Stage ID"])
                    if q is None:
                        continue
                    s = stats[q]
                    s["stages"] += 1
                    s["tasks"] += info.get("Number of Tasks", 0)
                    s["times"].append(info["Stage ID"])
    for s in stats.values():
        s["read"] = sum(task_read[sid] for sid in s["times"])
        s["rows"] = sum(task_rows[sid] for sid in s["times"])
        s["shuffle"] = sum(task_shuffle[sid] for sid in s["times"])
    print("# Stage metrics of the registered queries\n")
    print(f"Generated by `python tools/stage_report.py {sf_dir}` from Spark's event log (local[8], 8 shuffle")
    print("partitions, AQE on). Includes the writes a query makes (lake, change log, compaction, streams).")
    print("Input MB is 0 where the file system keeps no byte statistics (the read-only test-data mount);")
    print("`skew` is the largest task time over the median task time of the query's widest stage.")
    print("Micro-batches of the stream queries run under the stream's own job description and are")
    print("not counted here; their rows cover the staging writes and the final read.\n")
    print("| query | jobs | stages | tasks | rows read | input MB | shuffle write MB | skew |")
    print("| --- | ---: | ---: | ---: | ---: | ---: | ---: | ---: |")
    for name in names:
        s = stats[name]
        skew = "-"
        widest = max(s["times"], key=lambda sid: len(task_times[sid]), default=None)
        if widest is not None and len(task_times[widest]) > 1:
            med = statistics.median(task_times[widest]) or 1
            skew = f"{max(task_times[widest]) / med:.1f}"
        print(f"| {name} | {jobs[name]} | {s['stages']} | {s['tasks']} | {s.get('rows', 0)} | {s['read'] / 1e6:.2f} | "
              f"{s['shuffle'] / 1e6:.2f} | {skew} |")


if __name__ == "__main__":
    main()

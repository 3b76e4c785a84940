"""Summarise a Spark event log: the most expensive stages by task time.

    BENCH_EVENT_LOG=/tmp/run-x/events BENCH_QUERIES=cf_recommend python bench.py
    python scripts/stage_times.py /tmp/run-x/events [top]

Reads the (zstd-compressed or plain) rolling event-log files and prints, per
stage: wall time, task count, shuffle rows read and written, and summed
executor run time.  No web UI or REST endpoint is involved.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    raw = open(path, "rb").read()
    try:
        import zstandard
        text = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read().decode()
    except Exception:  # noqa: BLE001 - not compressed
        text = raw.decode(errors="ignore")
    return text.splitlines()


def main() -> None:
    root = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    files = sorted(f for f in glob.glob(os.path.join(root, "**", "*"), recursive=True) if os.path.isfile(f))
    stages = []
    for f in files:
        for line in _lines(f):
            if '"SparkListenerStageCompleted"' not in line:
                continue
            info = json.loads(line)["Stage Info"]
            acc = {a.get("Name"): a.get("Value", 0) for a in info.get("Accumulables", [])}
            stages.append({
                "stage": info["Stage ID"],
                "wall": (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000,
                "tasks": info["Number of Tasks"],
                "rows_in": int(acc.get("internal.metrics.shuffle.read.recordsRead", 0) or 0),
                "rows_out": int(acc.get("internal.metrics.shuffle.write.recordsWritten", 0) or 0),
                "task_time": int(acc.get("internal.metrics.executorRunTime", 0) or 0) / 1000,
            })
    total = sum(s["task_time"] for s in stages)
    print(f"{len(stages)} stages, {total:.1f} s of task time")
    for s in sorted(stages, key=lambda s: -s["task_time"])[:top]:
        print(f"stage {s['stage']:4d}  wall {s['wall']:6.2f}s  tasks {s['tasks']:5d}  "
              f"shuffle in {s['rows_in']:11d}  out {s['rows_out']:11d}  task time {s['task_time']:7.1f}s")


if __name__ == "__main__":
    main()

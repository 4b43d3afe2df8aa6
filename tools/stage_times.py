"""Summarise a Spark event log per job group (bench.py tags each query as one group).

Usage: BENCH_EVENT_LOG=$(mktemp -d /tmp/run-XXXXXX) python bench.py
       python tools/stage_times.py <that folder>/<app event log file or folder>
Prints, per query: jobs, stages, tasks, summed stage time and the slowest stage.
"""

from __future__ import annotations

import json
import sys
from collections import defaultdict


def _lines(path: str):
    """A single event-log file, or a rolling log folder (``events_*`` parts, in order)."""
    import os

    if os.path.isdir(path):
        parts = sorted((p for p in os.listdir(path) if p.startswith("events_")),
                       key=lambda p: int(p.split("_")[1]))
        files = [os.path.join(path, p) for p in parts]
    else:
        files = [path]
    for fp in files:
        if fp.endswith(".zstd"):  # Spark's default event-log codec
            import io

            import zstandard
            with open(fp, "rb") as raw:
                yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            with open(fp) as f:
                yield from f


def main(path: str) -> None:
    job_group: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    stage_info: dict[int, tuple[str, int, float]] = {}
    for line in _lines(path):
        ev = json.loads(line)
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            group = (ev.get("Properties") or {}).get("spark.jobGroup.id", "-")
            job_group[ev["Job ID"]] = group
            for sid in ev.get("Stage IDs", []):
                stage_job[sid] = ev["Job ID"]
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                stage_info[info["Stage ID"]] = (info.get("Stage Name", ""), info.get("Number of Tasks", 0),
                                                (end - start) / 1000.0)
    per = defaultdict(lambda: {"jobs": set(), "stages": 0, "tasks": 0, "sec": 0.0, "slowest": (0.0, "")})
    for sid, (name, tasks, sec) in stage_info.items():
        group = job_group.get(stage_job.get(sid, -1), "-")
        p = per[group]
        p["jobs"].add(stage_job.get(sid))
        p["stages"] += 1
        p["tasks"] += tasks
        p["sec"] += sec
        if sec > p["slowest"][0]:
            p["slowest"] = (sec, name.split(" at ")[0])
    for group, p in sorted(per.items(), key=lambda kv: -kv[1]["sec"]):
        print(f"{group:22s} jobs={len(p['jobs']):3d} stages={p['stages']:3d} tasks={p['tasks']:5d} "
              f"stage_sec={p['sec']:7.2f} slowest={p['slowest'][0]:.2f}s {p['slowest'][1]}")


if __name__ == "__main__":
    main(sys.argv[1])

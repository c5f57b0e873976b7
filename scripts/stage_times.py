"""Summarise a Spark event log: wall time per job, busiest stages.

    python scripts/stage_times.py <event-log file or eventlog_v2_* folder> [top_n]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    """Lines of an event log file or rolling event-log folder (zstd or plain)."""
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        if f.endswith(".zstd"):
            import zstandard
            with open(f, "rb") as fh:
                reader = zstandard.ZstdDecompressor().stream_reader(fh)
                yield from io.TextIOWrapper(reader, encoding="utf-8")
        else:
            yield from open(f, encoding="utf-8")


def main(path: str, top: int = 15) -> None:
    jobs, stages = {}, {}
    for line in _lines(path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"]}
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif ev == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            dur = info.get("Completion Time", 0) - info.get("Submission Time", 0)
            stages[info["Stage ID"]] = (dur, info["Number of Tasks"], info["Stage Name"][:70])
    total = sum(j.get("end", j["start"]) - j["start"] for j in jobs.values())
    print(f"jobs={len(jobs)} stages={len(stages)} sum_job_ms={total}")
    for sid, (dur, n, name) in sorted(stages.items(), key=lambda x: -x[1][0])[:top]:
        print(f"stage {sid:4d} {dur:6d} ms tasks={n:4d} {name}")


if __name__ == "__main__":
    main(sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 15)

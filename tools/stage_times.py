"""Summarise a Spark event log: the slowest stages with their task counts.

Usage: python tools/stage_times.py <event log file or folder> [top]
"""

from __future__ import annotations

import io
import json
import os
import sys


def _events(path: str):
    """Events of a log file, or of every log file under a folder (Spark 4 writes
    rolling logs as ``eventlog_v2_*/events_*`` folders)."""
    if os.path.isdir(path):
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs if f.startswith(("events", "local-", "app-")))
    else:
        files = [path]
    for name in files:
        if name.endswith(".zstd"):
            import zstandard

            with open(name, "rb") as raw:
                text = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                lines = list(text)
        else:
            with open(name) as fh:
                lines = list(fh)
        for line in lines:
            if line.startswith("{"):
                yield json.loads(line)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages = []
    for ev in _events(path):
        if ev.get("Event") != "SparkListenerStageCompleted":
            continue
        info = ev["Stage Info"]
        start, end = info.get("Submission Time"), info.get("Completion Time")
        if start is None or end is None:
            continue
        stages.append(((end - start) / 1000.0, info["Stage ID"], info["Number of Tasks"], info["Stage Name"][:70]))
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total:.1f} s of stage time")
    for secs, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{secs:8.2f}s  stage {sid:5d}  tasks {tasks:6d}  {name}")


if __name__ == "__main__":
    main()

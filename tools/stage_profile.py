"""Summarise a Spark event log (no UI needed): slowest stages and jobs.

    BENCH_EVENTLOG=$(mktemp -d /tmp/evlog-XXXXXX) BENCH_ONLY=secured_scan python bench.py
    python tools/stage_profile.py "$BENCH_EVENTLOG" [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def events(log_dir: str):
    app = sorted(glob.glob(os.path.join(log_dir, "*")), key=os.path.getmtime)[-1]
    files = sorted(glob.glob(os.path.join(app, "events_*"))) if os.path.isdir(app) else [app]
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            with zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True) as r:
                raw = r.read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main():
    log_dir = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, jobs = [], 0
    for e in events(log_dir):
        if e["Event"] == "SparkListenerJobStart":
            jobs += 1
        elif e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            secs = (si.get("Completion Time", 0) - si.get("Submission Time", 0)) / 1000
            stages.append((secs, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:70]))
    print(f"jobs={jobs} stages={len(stages)} stage-seconds={sum(s[0] for s in stages):.1f}")
    for secs, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{secs:7.2f}s  stage {sid:<5} tasks={tasks:<5} {name}")


if __name__ == "__main__":
    main()

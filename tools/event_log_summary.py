"""Summarise a Spark event log: the slowest stages and time per job.

    BENCH_EVENT_LOG=/tmp/run-x BENCH_QUERIES=gold_enriched python bench.py
    python tools/event_log_summary.py /tmp/run-x [top_n]
"""

from __future__ import annotations

import glob
import json
import os
import sys


def _lines(f: str):
    if f.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
        import io

        import zstandard
        with open(f, "rb") as raw:
            reader = zstandard.ZstdDecompressor().stream_reader(raw)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        with open(f, encoding="utf-8") as fh:
            yield from fh


def load(path: str):
    files = [path] if os.path.isfile(path) else sorted(
        f for f in glob.glob(os.path.join(path, "**", "*"), recursive=True)
        if os.path.isfile(f) and not f.endswith((".crc", ".inprogress"))
        and "appstatus" not in os.path.basename(f))
    for f in files:
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def main(argv):
    path = argv[1]
    top = int(argv[2]) if len(argv) > 2 else 15
    stages, jobs = [], {}
    for ev in load(path):
        kind = ev.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            start, end = info.get("Submission Time"), info.get("Completion Time")
            if start and end:
                stages.append((end - start, info["Stage ID"], info["Number of Tasks"],
                               info["Stage Name"][:70]))
        elif kind == "SparkListenerJobStart":
            jobs[ev["Job ID"]] = [ev["Submission Time"], None]
        elif kind == "SparkListenerJobEnd" and ev["Job ID"] in jobs:
            jobs[ev["Job ID"]][1] = ev["Completion Time"]
    done = [(e - s) for s, e in jobs.values() if e]
    print(f"jobs: {len(done)}, total {sum(done) / 1000:.2f} s; stages: {len(stages)}, "
          f"total {sum(s[0] for s in stages) / 1000:.2f} s")
    print(f"{'ms':>8} {'stage':>6} {'tasks':>6}  name")
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms:>8} {sid:>6} {tasks:>6}  {name}")


if __name__ == "__main__":
    main(sys.argv)

"""Stage and job times from a Spark event log folder (plain or zstd).

    python tools/stage_times.py <event-log-dir> [top_n]

Run ``bench.py`` with ``BENCH_EVENT_LOG=<dir>`` first; the log is written
by Spark itself into that scratch folder (no UI or server involved).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def events(path):
    for f in sorted(p for p in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(p)):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "ignore").splitlines():
            try:
                yield json.loads(line)
            except ValueError:
                continue


def main(argv):
    top = int(argv[1]) if len(argv) > 1 else 15
    stages = []
    for e in events(argv[0]):
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            ms = si.get("Completion Time", 0) - si.get("Submission Time", 0)
            stages.append((ms, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:70]))
    total = sum(s[0] for s in stages)
    print(f"{len(stages)} stages, {total} ms in total")
    for ms, sid, n, name in sorted(stages, reverse=True)[:top]:
        print(f"{ms:7d} ms  stage {sid:4d}  {n:4d} tasks  {name}")


if __name__ == "__main__":
    main(sys.argv[1:])

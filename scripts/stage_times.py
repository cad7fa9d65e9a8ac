"""Summarise a Spark event log (plain or zstd, file or rolling folder): one line per
job with its wall time and, per stage, task count and wall time.

    python scripts/stage_times.py <event log file or folder> [min_ms]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "events_*"))) if os.path.isdir(path) else [path]
    for f in files:
        with open(f, "rb") as fh:
            head = fh.read(4)
            fh.seek(0)
            if head == b"\x28\xb5\x2f\xfd":  # zstd frame
                import zstandard

                stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
            else:
                stream = io.TextIOWrapper(fh, encoding="utf-8")
            yield from stream


def main() -> None:
    path = sys.argv[1]
    min_ms = int(sys.argv[2]) if len(sys.argv) > 2 else 0
    jobs: dict[int, dict] = {}
    stages: dict[int, tuple] = {}
    for line in _lines(path):
        e = json.loads(line)
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            props = e.get("Properties") or {}
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "stages": e["Stage IDs"], "site": props.get("callSite.short", "")}
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            stages[info["Stage ID"]] = (info["Number of Tasks"], info.get("Completion Time", 0) - info.get("Submission Time", 0))
    t0 = min((j["start"] for j in jobs.values()), default=0)
    for jid, j in sorted(jobs.items()):
        ms = j.get("end", j["start"]) - j["start"]
        if ms >= min_ms:
            ran = [f"{stages[s][0]}t/{stages[s][1]}ms" for s in j["stages"] if s in stages]
            print(f"job {jid:4d} at +{j['start'] - t0:7d} ms  {ms:6d} ms  {' '.join(ran):30s} {j['site'][:50]}")


if __name__ == "__main__":
    main()

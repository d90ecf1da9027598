"""Summarise a Spark event log: slowest stages with their task counts.

usage: python tools/stage_times.py <event log file or dir> [top]
(Enable with spark.eventLog.enabled=true and spark.eventLog.dir=<scratch dir>.)
"""

from __future__ import annotations

import json
import os
import sys


def _open(fp: str):
    if fp.endswith(".zstd"):  # Spark 4 compresses event logs with zstd by default
        import io
        import zstandard
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(open(fp, "rb")), encoding="utf-8")
    return open(fp, encoding="utf-8")


def stages(path: str):
    if os.path.isdir(path):
        files = sorted(os.path.join(d, f) for d, _, fs in os.walk(path) for f in fs
                       if not f.startswith(".") and not f.startswith("appstatus"))
    else:
        files = [path]
    out, desc = [], {}
    for fp in files:
        with _open(fp) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event") == "SparkListenerStageSubmitted":
                    props = ev.get("Properties") or {}
                    desc[ev["Stage Info"]["Stage ID"]] = props.get("spark.job.description") or ""
                if ev.get("Event") == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    sub, done = info.get("Submission Time"), info.get("Completion Time")
                    if sub and done:
                        label = desc.get(info["Stage ID"]) or info["Stage Name"]
                        out.append((done - sub, info["Stage ID"], info["Number of Tasks"], label[:90]))
    return out


if __name__ == "__main__":
    rows = stages(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    total = sum(r[0] for r in rows)
    print(f"{len(rows)} stages, {total / 1000:.1f} s summed stage time")
    for ms, sid, ntask, name in sorted(rows, reverse=True)[:top]:
        print(f"{ms / 1000:7.2f}s  stage {sid:4d}  tasks {ntask:4d}  {name}")

"""Per-job and per-stage wall times from a Spark event log (no UI needed).

    python tests/stage_times.py <event-log-file> [top]
"""

from __future__ import annotations

import io
import json
import sys


def _lines(path: str):
    if path.endswith(".zstd"):
        import zstandard

        with open(path, "rb") as f:
            reader = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True)
            yield from io.TextIOWrapper(reader, encoding="utf-8")
    else:
        yield from open(path, encoding="utf-8")


def stages(path: str):
    names, out, jobs = {}, [], []
    for line in _lines(path):
        e = json.loads(line)
        kind = e.get("Event")
        if kind == "SparkListenerStageCompleted":
            info = e["Stage Info"]
            dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1000
            out.append((dur, info["Stage ID"], info["Stage Name"][:60], info["Number of Tasks"]))
        elif kind == "SparkListenerJobStart":
            names[e["Job ID"]] = (e["Submission Time"], e.get("Properties", {}).get("spark.job.description", ""))
        elif kind == "SparkListenerJobEnd":
            start, desc = names.get(e["Job ID"], (0, ""))
            jobs.append(((e["Completion Time"] - start) / 1000, e["Job ID"], desc[:60]))
    return out, jobs


if __name__ == "__main__":
    st, jb = stages(sys.argv[1])
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    print(f"{len(jb)} jobs, {sum(j[0] for j in jb):.2f}s; {len(st)} stages")
    for d, sid, name, n in sorted(st, reverse=True)[:top]:
        print(f"  stage {sid:4d} {d:7.2f}s tasks={n:4d} {name}")

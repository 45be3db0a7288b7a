"""Slowest stages from a Spark event log: python tests/stage_times.py <event-log dir> [n]

Reads the (rolling, zstd) event log that ``BENCH_EVENT_LOG=1 python bench.py``
writes to its scratch folder.
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

import zstandard


def _lines(path: str):
    raw = open(path, "rb").read()
    if path.endswith(".zstd"):
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode().splitlines()


def main() -> int:
    root = sys.argv[1]
    n = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    stages, stage_desc = [], {}
    for path in sorted(glob.glob(os.path.join(root, "**", "events_*"), recursive=True)):
        for line in _lines(path):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                desc = (e.get("Properties") or {}).get("spark.job.description", "")
                for sid in e.get("Stage IDs", []):
                    stage_desc[sid] = desc
            elif e.get("Event") == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                ms = si.get("Completion Time", 0) - si.get("Submission Time", 0)
                stages.append((ms, si["Stage ID"], si["Number of Tasks"], si["Stage Name"][:50]))
    for ms, sid, tasks, name in sorted(stages, reverse=True)[:n]:
        print(f"{ms:7d} ms  stage {sid:4d}  tasks {tasks:4d}  {stage_desc.get(sid, '')[:40]:40s} {name}")
    per_query: dict[str, int] = {}
    for ms, sid, _, _ in stages:
        key = stage_desc.get(sid, "").rsplit(" pass ", 1)[0] or "(untagged)"
        per_query[key] = per_query.get(key, 0) + ms
    print("\nstage time per query (all passes):")
    for key, ms in sorted(per_query.items(), key=lambda kv: -kv[1])[:n]:
        print(f"{ms:7d} ms  {key}")
    print(f"{len(stages)} stages, {sum(s[0] for s in stages) / 1000:.1f} s stage time in total")
    return 0


if __name__ == "__main__":
    sys.exit(main())

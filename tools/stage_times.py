"""Summarise a Spark event log: per job and stage, tasks, task-time spread and shuffle bytes.

Usage: python tools/stage_times.py <event log file or folder>

A stage whose slowest task is far above its median task is skewed; a stage
with one task on a large input is not parallel. Run the bench with
``BENCH_EVENT_LOG=<scratch folder>`` to write the log.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
from collections import defaultdict


def _files(path: str):
    if not os.path.isdir(path):
        return [path]
    out = []
    for root, _, names in os.walk(path):
        out += [os.path.join(root, n) for n in sorted(names) if not n.startswith(("appstatus", "."))]
    return sorted(out)


def _lines(f: str):
    if f.endswith(".zstd"):
        import io

        import zstandard

        with open(f, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        with open(f) as fh:
            yield from fh


def load(path: str):
    for f in _files(path):
        for line in _lines(f):
            if line.strip():
                yield json.loads(line)


def summarise(path: str) -> list[dict]:
    tasks = defaultdict(list)
    shuffle_w = defaultdict(int)
    shuffle_r = defaultdict(int)
    names = {}
    job_of_stage = {}
    for ev in load(path):
        kind = ev.get("Event")
        if kind == "SparkListenerJobStart":
            for sid in ev.get("Stage IDs", []):
                job_of_stage[sid] = ev["Job ID"]
        elif kind == "SparkListenerStageCompleted":
            info = ev["Stage Info"]
            names[info["Stage ID"]] = info.get("Stage Name", "")
        elif kind == "SparkListenerTaskEnd":
            sid = ev["Stage ID"]
            info = ev.get("Task Info", {})
            tasks[sid].append(info.get("Finish Time", 0) - info.get("Launch Time", 0))
            m = ev.get("Task Metrics") or {}
            shuffle_w[sid] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
            r = m.get("Shuffle Read Metrics") or {}
            shuffle_r[sid] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
    out = []
    for sid, times in sorted(tasks.items()):
        out.append(
            {
                "job": job_of_stage.get(sid),
                "stage": sid,
                "tasks": len(times),
                "max_ms": max(times),
                "median_ms": statistics.median(times),
                "sum_ms": sum(times),
                # slowest task over the median task: far above 1 on a multi-task stage means skew
                "skew": round(max(times) / max(statistics.median(times), 1), 1) if len(times) > 1 else None,
                "shuffle_write": shuffle_w[sid],
                "shuffle_read": shuffle_r[sid],
                "name": names.get(sid, "")[:60],
            }
        )
    return out


def main() -> None:
    rows = summarise(sys.argv[1])
    print(f"{'job':>4} {'stage':>5} {'tasks':>5} {'max':>7} {'median':>7} {'skew':>5} {'sum':>8} {'shuf_w':>10} {'shuf_r':>10}  name")
    for r in rows:
        skew = "" if r["skew"] is None else r["skew"]
        print(
            f"{r['job']!s:>4} {r['stage']:>5} {r['tasks']:>5} {r['max_ms']:>7} {r['median_ms']:>7.0f} {skew!s:>5} "
            f"{r['sum_ms']:>8} {r['shuffle_write']:>10} {r['shuffle_read']:>10}  {r['name']}"
        )


if __name__ == "__main__":
    main()

"""Summarise stage times from a Spark event log (no UI, no server).

    export BENCH_EVENT_LOG_DIR=$(mktemp -d /tmp/run-XXXXXX)
    python bench.py && python tools/stage_times.py $BENCH_EVENT_LOG_DIR [top]

Reads every event log under the folder (plain or zstd-compressed, rolling or
single file) and prints the slowest stages: wall time, summed task run time,
task count, shuffle bytes read and written, and the job description.
"""

from __future__ import annotations

import io
import json
import sys
from pathlib import Path


def _lines(path: Path):
    with open(path, "rb") as raw:
        head = raw.read(4)
        raw.seek(0)
        if head == b"\x28\xb5\x2f\xfd":           # zstd frame magic
            import zstandard

            stream = io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
        else:
            stream = io.TextIOWrapper(raw, encoding="utf-8")
        yield from stream


def _metric(info: dict, name: str) -> int:
    return sum(int(a.get("Value", 0)) for a in info.get("Accumulables", []) if a.get("Name") == name)


def stages(folder: str) -> list[dict]:
    out = []
    job_desc: dict[int, str] = {}
    stage_job: dict[int, int] = {}
    for path in sorted(p for p in Path(folder).rglob("*") if p.is_file() and not p.name.startswith("appstatus")):
        for line in _lines(path):
            if not line.strip():
                continue
            try:
                event = json.loads(line)
            except json.JSONDecodeError:
                continue
            kind = event.get("Event")
            if kind == "SparkListenerJobStart":
                props = event.get("Properties") or {}
                job_desc[event["Job ID"]] = props.get("spark.job.description") or props.get("callSite.short", "")
                for sid in event.get("Stage IDs", []):
                    stage_job[sid] = event["Job ID"]
            elif kind == "SparkListenerStageCompleted":
                info = event["Stage Info"]
                sid = info["Stage ID"]
                out.append({
                    "stage": sid,
                    "wall_ms": info.get("Completion Time", 0) - info.get("Submission Time", 0),
                    "task_ms": _metric(info, "internal.metrics.executorRunTime"),
                    "tasks": info.get("Number of Tasks", 0),
                    "shuffle_read": _metric(info, "internal.metrics.shuffle.read.localBytesRead")
                    + _metric(info, "internal.metrics.shuffle.read.remoteBytesRead"),
                    "shuffle_write": _metric(info, "internal.metrics.shuffle.write.bytesWritten"),
                    "what": job_desc.get(stage_job.get(sid, -1), info.get("Stage Name", ""))[:60],
                })
    return out


def main() -> None:
    folder = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 else 15
    rows = stages(folder)
    print(f"{len(rows)} stages, {sum(r['wall_ms'] for r in rows) / 1000:.1f} s summed wall time")
    print(f"{'stage':>5} {'wall ms':>8} {'task ms':>8} {'tasks':>5} {'shuf rd':>9} {'shuf wr':>9}  job")
    for r in sorted(rows, key=lambda r: -r["wall_ms"])[:top]:
        print(f"{r['stage']:>5} {r['wall_ms']:>8} {r['task_ms']:>8} {r['tasks']:>5} "
              f"{r['shuffle_read']:>9} {r['shuffle_write']:>9}  {r['what']}")


if __name__ == "__main__":
    main()

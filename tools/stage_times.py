"""Summarise a Spark event log per job description (bench.py sets the
query name as description): wall time of its stages, tasks, shuffle bytes
and spill, and the slowest stage.

usage: python tools/stage_times.py <event-log folder or file>
"""

from __future__ import annotations

import collections
import json
import os
import sys


def _files(path):
    """Event-log files under ``path`` (plain or rolling ``eventlog_v2_*`` folders)."""
    if os.path.isfile(path):
        return [path]
    out = []
    for root, _, names in sorted(os.walk(path)):
        out += [os.path.join(root, n) for n in sorted(names)
                if not n.startswith(".") and not n.startswith("appstatus")]
    return out


def _open(path):
    if path.endswith(".zstd"):
        import io

        import zstandard
        raw = open(path, "rb")
        return io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), "utf-8")
    return open(path, encoding="utf-8")


def main():
    stage_desc, stats = {}, collections.defaultdict(lambda: collections.Counter())
    slowest = {}
    for f in _files(sys.argv[1]):
        with _open(f) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    desc = (ev.get("Properties") or {}).get("spark.job.description", "?")
                    for sid in ev.get("Stage IDs", []):
                        stage_desc[sid] = desc
                elif kind == "SparkListenerStageCompleted":
                    info = ev["Stage Info"]
                    desc = stage_desc.get(info["Stage ID"], "?")
                    dur = (info.get("Completion Time", 0) - info.get("Submission Time", 0)) / 1e3
                    acc = {a.get("Name"): a.get("Value") for a in info.get("Accumulables", [])}
                    c = stats[desc]
                    c["stages"] += 1
                    c["tasks"] += info.get("Number of Tasks", 0)
                    c["stage_s"] += dur
                    c["shuffle_write_mb"] += int(acc.get("internal.metrics.shuffle.write.bytesWritten", 0) or 0) / 2**20
                    c["spill_mb"] += int(acc.get("internal.metrics.memoryBytesSpilled", 0) or 0) / 2**20
                    if dur > slowest.get(desc, (0, ""))[0]:
                        slowest[desc] = (dur, info.get("Stage Name", "")[:60])
    print(f"{'query':28s} {'stages':>6s} {'tasks':>6s} {'stage s':>8s} {'shuf MB':>8s} "
          f"{'spill MB':>8s}  slowest stage")
    for desc, c in stats.items():
        s = slowest.get(desc, (0, ""))
        print(f"{desc[:28]:28s} {c['stages']:6d} {c['tasks']:6d} {c['stage_s']:8.2f} "
              f"{c['shuffle_write_mb']:8.1f} {c['spill_mb']:8.1f}  {s[0]:.2f}s {s[1]}")


if __name__ == "__main__":
    main()

"""Summarise a Spark event log (written with BENCH_EVENT_LOG=<folder>):
the slowest stages with task counts, shuffle bytes and spill.

    python tools/stage_times.py <event-log folder> [--top 15]
"""

from __future__ import annotations

import argparse
import glob
import json
import os


def events(folder: str):
    """Events of every log file under ``folder`` (plain or zstd, Spark 4's
    default compression)."""
    import io
    files = sorted(f for f in glob.glob(os.path.join(folder, "**", "events_*"), recursive=True)
                   if os.path.isfile(f) and not f.endswith(".crc"))
    for f in files:
        with open(f, "rb") as raw:
            if f.endswith(".zstd"):
                import zstandard
                stream = zstandard.ZstdDecompressor().stream_reader(raw)
            else:
                stream = raw
            for line in io.TextIOWrapper(stream, encoding="utf-8"):
                if line.strip():
                    yield json.loads(line)


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("folder")
    ap.add_argument("--top", type=int, default=15)
    a = ap.parse_args()
    rows = []
    for e in events(a.folder):
        if e.get("Event") != "SparkListenerStageCompleted":
            continue
        si = e["Stage Info"]
        acc = {x.get("Name"): x.get("Value") for x in si.get("Accumulables", [])}
        rows.append((si.get("Completion Time", 0) - si.get("Submission Time", 0), si["Stage ID"],
                     si["Number of Tasks"], acc.get("internal.metrics.shuffle.write.bytesWritten", 0),
                     acc.get("internal.metrics.memoryBytesSpilled", 0), si["Stage Name"][:60]))
    rows.sort(reverse=True)
    print(f"{len(rows)} stages, {sum(r[0] for r in rows) / 1000:.1f} s stage time, "
          f"{sum(r[3] for r in rows) / 1e6:.1f} MB shuffle written, "
          f"{sum(r[4] for r in rows) / 1e6:.1f} MB spilled")
    print("ms      stage  tasks  shuffle_write  spilled  name")
    for ms, sid, n, sw, sp, name in rows[:a.top]:
        print(f"{ms:<7} {sid:<6} {n:<6} {sw:<14} {sp:<8} {name}")


if __name__ == "__main__":
    main()

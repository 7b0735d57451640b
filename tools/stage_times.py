"""Print stage durations from a Spark event log (as written by bench.py with
BENCH_EVENT_LOG_DIR).  Usage: python tools/stage_times.py <event-log dir or file>
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def _lines(path: str):
    files = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True)) if os.path.isdir(path) else [path]
    for f in files:
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        yield from raw.decode("utf-8").splitlines()


def main() -> None:
    for line in _lines(sys.argv[1]):
        if '"SparkListenerStageCompleted"' not in line:
            continue
        info = json.loads(line)["Stage Info"]
        ms = info["Completion Time"] - info["Submission Time"]
        print(f"stage {info['Stage ID']:>4}  tasks {info['Number of Tasks']:>4}  {ms:>6} ms  {info['Stage Name'][:60]}")


if __name__ == "__main__":
    main()

"""The packed inputs are whole, and packing them takes a bounded part of a task's memory."""

from __future__ import annotations

import contextlib
import csv
import io
import os
import re
import zipfile
from pathlib import Path

from pyspark.sql import functions as F

from feedloom.plans import packing
from feedloom.sources import first_member_lines
from feedloom.workspace import settle


def memory_of_workers(peak=False):
    """MB that each Python worker of this process's session holds, or held at most since the last call without `peak`."""
    stats = {}
    for stat in Path("/proc").glob("[0-9]*/stat"):
        with contextlib.suppress(OSError):
            stats[int(stat.parent.name)] = int(stat.read_text().rpartition(")")[2].split()[1])
    found = {}
    for pid in stats:
        above = [pid]
        while above[-1] in stats:
            above.append(stats[above[-1]])
        with contextlib.suppress(OSError):
            if os.getpid() in above[1:] and b"pyspark.daemon" in Path(f"/proc/{pid}/cmdline").read_bytes():
                text = Path(f"/proc/{pid}/status").read_text()
                found[pid] = int(re.search(rf"{'VmHWM' if peak else 'VmRSS'}:\s+(\d+)", text)[1]) / 1024
                if not peak:
                    Path(f"/proc/{pid}/clear_refs").write_text("5")
    return found


def test_packing_holds_a_batch_of_lines_at_a_time(spark):
    """A task with a thousand archives, 60 MB of lines, in a worker that takes some 130 MB with what it imports."""
    rows = spark.range(1_000_000).select(F.lpad(F.col("id").cast("string"), 59, "0").alias("a"))
    before = memory_of_workers()
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        packed = settle(packing.archives(rows, F.concat(F.right("a", F.lit(3)), F.lit(".zip")), ["a"]), "zips")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    peaks = memory_of_workers(peak=True)
    assert peaks and max(peak - before.get(pid, 0) for pid, peak in peaks.items()) < 200
    lines = first_member_lines(packed, ["a"])
    assert lines.agg(F.count("*"), F.sum(F.col("line").cast("bigint"))).first()[:] == (1_000_000, 499_999_500_000)


def test_archives_are_packed_whole_across_batches(spark):
    """Lines of a path in several batches and several paths in one, quoted cells, a path without lines and a null one."""
    rows = spark.range(1000).select(F.col("id").alias("n"), F.format_string('é "%d", x', "id").alias("a"))
    path = F.when(F.col("n") != 5, F.when(F.col("n") < 400, "a.zip").otherwise(F.format_string("%d.zip", F.col("n") % 300)))
    line = F.when(F.col("n") != 999, F.to_csv(F.struct("n", "a")))
    single = F.when(F.col("n") == 999, "none.zip").otherwise(path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        packed = packing.archives(rows, single, ["n", "a"], line).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {None: ["5"], "none.zip": [], "a.zip": sorted(str(n) for n in range(400) if n != 5)}
    for n in range(400, 999):
        want.setdefault(f"{n % 300}.zip", []).append(str(n))
    assert len(packed) == len(want)
    for row in packed:
        with zipfile.ZipFile(io.BytesIO(row["content"])) as archive:
            assert archive.testzip() is None and archive.namelist() == ["data.csv", "other.csv"]
            text = archive.read("data.csv").decode()
        header, *cells = csv.reader(io.StringIO(text), escapechar="\\", doublequote=False)
        assert header == ["n", "a"] and text.endswith("\n")
        assert sorted(n for n, _ in cells) == sorted(want[row["path"]])
        assert all(a == f'é "{n}", x' for n, a in cells)

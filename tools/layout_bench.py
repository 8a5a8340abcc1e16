"""The point-store layout experiment: lead tag driver vs session, timed on a session-filtered read.

Usage: python tools/layout_bench.py [sf_dir] [scratch_dir]
Writes telemetry and lap points of the stand-in tables in both layouts under
``scratch_dir`` (by default a new folder under the session's ``spark.checkpoint.dir``), then times reading the race
sessions' speed samples and laps back, pivoting them and labelling every sample
with its sector (the shape of R6), and prints one JSON line with the medians and
the number of files each layout had to read.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def run_layout_experiment(spark, sf: str, scratch: str, runs: int = 3) -> dict:
    """Write the points in both layouts under ``scratch`` and time the session-filtered read."""
    from pyspark.sql import functions as F

    from paddock.operators.points import pivot_points, read_points, write_points
    from paddock.plans.point_reports import LAYOUTS, points_of
    from paddock.plans.reports import sector_samples
    from paddock.sources.standin import standin_tables

    t = standin_tables(spark, sf)
    races = [r[0] for r in t.sessions.where(F.col("session_name") == "Race").select("session_key").collect()]
    out = {"race_sessions": sorted(races)}
    for layout, lead in LAYOUTS.items():
        path = os.path.join(scratch, layout)
        pts = points_of(t.telemetrys, "telemetry", layout).unionByName(
            points_of(t.laps, "laps", layout), allowMissingColumns=True)
        write_points(pts, path, lead, mode="overwrite")

        def query():
            tags = {"session_key": races}
            fields = ["duration_sector_1", "duration_sector_2", "duration_sector_3"]
            tel = pivot_points(read_points(spark, path, ["telemetry"], tags, ["speed"]),
                               ["_time", "session_key", "driver_number"], ["speed"])
            lap = pivot_points(read_points(spark, path, ["laps"], tags, fields),
                               ["_time", "session_key", "driver_number"], fields)
            cast = [F.col("session_key").cast("int").alias("session_key"),
                    F.col("driver_number").cast("int").alias("driver_number")]
            tel = tel.select(*cast, F.col("_time").alias("date"), "speed")
            lap = lap.select(*cast, F.col("_time").alias("date_start"), *fields)
            return sector_samples(tel, lap)

        def once() -> float:
            t0 = time.perf_counter()
            query().write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t0

        once()
        secs = [once() for _ in range(runs)]
        df = query()
        n = len(df.collect())
        plan = df._jdf.queryExecution().executedPlan()
        files = sum(int(str(m.value())) for m in _metric_values(plan, "numFiles"))
        out[layout] = {"median_sec": round(statistics.median(secs), 3), "files_read": files, "rows": n}
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from paddock.session import checkpoint_dir, get_spark

    spark = get_spark("layout", shuffle_partitions=8, driver_memory="8g")
    # Scratch space in the shared folder the cluster names, never a machine-local one.
    scratch = sys.argv[2] if len(sys.argv) > 2 else os.path.join(
        checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="layout-")), "layout-bench", str(int(time.time())))
    print(json.dumps({"sf": sf, **run_layout_experiment(spark, sf, scratch)}))
    spark.stop()


def _metric_values(plan, name):
    """All SQL metrics called ``name`` in a physical plan tree (scan nodes report numFiles)."""
    found = []
    stack = [plan]
    while stack:
        node = stack.pop()
        metrics = node.metrics()
        if metrics.contains(name):
            found.append(metrics.apply(name))
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
        if node.getClass().getSimpleName() in ("AdaptiveSparkPlanExec",):
            stack.append(node.executedPlan())
        if hasattr(node, "plan") and node.getClass().getSimpleName().endswith("QueryStageExec"):
            stack.append(node.plan())
    return found


if __name__ == "__main__":
    main()

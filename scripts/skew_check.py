"""Show how a hot group is spread over tasks by the tiled pair join (``pairs_in_groups``).

A synthetic ratings table where one item is rated by every user (a third or more of all rows) goes
through ``pearson_pairs`` twice: with the default tiling and with tiling switched off (one tile per
group). Per-task output rows of the pair-join stage are read from Spark's event log (written to a
fresh scratch folder) and summarised as max / median.

usage: python scripts/skew_check.py [n_users] [tile_rows]
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    n_users = int(sys.argv[1]) if len(sys.argv) > 1 else 3000
    tile = int(sys.argv[2]) if len(sys.argv) > 2 else 500
    logdir = tempfile.mkdtemp(prefix="skew-eventlog-", dir="/tmp")

    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "16")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.dir", logdir)
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from lodestar.operators import groups as G
    from lodestar.operators import similarity as SIM

    users = spark.range(n_users).select(F.col("id").alias("user_id"))
    hot = users.select("user_id", F.lit(0).cast("bigint").alias("item_id"), (F.col("user_id") % 5 + 1).cast("double").alias("rating"))
    cold = users.select(
        "user_id",
        F.explode(F.sequence(F.lit(1), F.lit(10))).alias("j"),
    ).select("user_id", (1 + F.pmod(F.xxhash64("user_id", "j"), F.lit(2000))).alias("item_id"), (F.col("j") % 5 + 1).cast("double").alias("rating"))
    um = hot.unionByName(cold).groupBy("user_id", "item_id").agg(F.max("rating").alias("rating")).cache()
    total = um.count()

    real = G.pairs_in_groups
    results = {}
    for label, rows in (("tiled", tile), ("one tile per group", 10**9)):
        SIM.pairs_in_groups = lambda *a, _r=rows, **k: real(*a, **{**k, "tile_rows": _r})
        spark.sparkContext.setJobGroup(label, label)
        SIM.pearson_pairs(um).write.format("noop").mode("overwrite").save()
        results[label] = None
    SIM.pairs_in_groups = real
    spark.stop()

    # per-task output records of the stages that run the pair join (largest output per job group)
    files = [f for f in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(f)]
    events = [json.loads(line) for f in files for line in open(f) if line.startswith("{")]
    stage_group, stage_tasks = {}, {}
    for e in events:
        if e.get("Event") == "SparkListenerJobStart":
            grp = (e.get("Properties") or {}).get("spark.jobGroup.id")
            for sid in e.get("Stage IDs", []):
                stage_group[sid] = grp
        if e.get("Event") == "SparkListenerTaskEnd":
            m = e.get("Task Metrics") or {}
            out = (m.get("Shuffle Write Metrics") or {}).get("Shuffle Records Written", 0)
            stage_tasks.setdefault(e["Stage ID"], []).append(out)
    print(f"ratings {total}, hot item raters {n_users}, pairs of the hot item {n_users * (n_users - 1) // 2}")
    for label in results:
        stages = [(sid, t) for sid, t in stage_tasks.items() if stage_group.get(sid) == label]
        sid, tasks = max(stages, key=lambda st: max(st[1]))
        print(f"{label:22s} pair-join stage {sid}: tasks {len(tasks)}, max rows written {max(tasks)}, median {int(statistics.median(tasks))}")


if __name__ == "__main__":
    main()

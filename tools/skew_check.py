"""Skew check: one customer holds a third of all lines.

    python tools/skew_check.py [sf_dir] [scratch_dir] [--no-broadcast] [--hot-article]

Rebuilds the transactions with every line of a third of the orders (chosen
by order key) moved to a single customer ``HOT``, runs the dataset plan
through the ``noop`` sink with Spark's event log on, and prints for every
shuffle-reading stage the largest share of records any one task read
(scans are left out: their split follows the file layout). Nothing in the plan is
partitioned by customer alone, so no task should come close to a third.

``--hot-article`` moves the lines of a third of the orders to one article
``HOT`` instead.

``--no-broadcast`` plans every join as a shuffle join, as on a cluster where
no side is small, and scales AQE's skew thresholds down to this data size
(1 MB partitions, factor 2), so the hot customer's rows meet a real
sort-merge join and AQE's skew split.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

import zstandard

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from rebuy.plans.features import build_dataset  # noqa: E402
from rebuy.session import local_session  # noqa: E402


def _events(log_dir: str):
    for f in glob.glob(f"{log_dir}/**/events_*", recursive=True) + glob.glob(f"{log_dir}/*"):
        if os.path.isdir(f) or os.path.basename(f).startswith((".", "appstatus")):
            continue
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode().splitlines():
            yield json.loads(line)


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf_dir = args[0] if args else "/root/testdata/sf0.1"
    log_dir = args[1] if len(args) > 1 else tempfile.mkdtemp(prefix="rebuy-skew-")
    conf = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
            "spark.sql.shuffle.partitions": "32",
            # keep every shuffle partition, so shares are not blurred by coalescing
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    if "--no-broadcast" in sys.argv:
        conf.update({"spark.sql.autoBroadcastJoinThreshold": "-1",
                     "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                     "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1MB",
                     "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                     "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
                     "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"})
    spark = local_session(8, app="rebuy-skew", **conf)
    # the driver's mapping, with a third of the orders moved to HOT
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_quantity")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    p = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_brand")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    hot = F.pmod("l_orderkey", F.lit(3)) == 0
    hot_article = "--hot-article" in sys.argv
    tx = j.select(
        (F.col("o_custkey").cast("string") if hot_article else F.when(hot, F.lit("HOT")).otherwise(
            F.col("o_custkey").cast("string"))).alias("customer_id"),
        (F.when(hot, F.lit("HOT")).otherwise(F.col("p_brand")) if hot_article else F.col("p_brand")).alias("article_id"),
        F.to_date("o_orderdate").alias("order_date"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
    )
    total = tx.count()
    hot_rows = tx.where("customer_id = 'HOT' OR article_id = 'HOT'").count()
    t0 = time.perf_counter()
    build_dataset(tx).write.format("noop").mode("overwrite").save()
    wall = time.perf_counter() - t0
    spark.stop()

    per_stage: dict[int, list[int]] = {}
    written: dict[int, list[int]] = {}
    names: dict[int, str] = {}
    for e in _events(log_dir):
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            recs = m.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
            per_stage.setdefault(e["Stage ID"], []).append(recs)
            out = m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0)
            written.setdefault(e["Stage ID"], []).append(out)
        if e["Event"] == "SparkListenerStageCompleted":
            names[e["Stage Info"]["Stage ID"]] = e["Stage Info"]["Stage Name"][:40]
    worst = 0.0
    rows = []
    for sid, recs in sorted(per_stage.items()):
        tot = sum(recs)
        if tot < 10_000 or len(recs) < 2:
            continue
        share = max(recs) / tot
        worst = max(worst, share)
        rows.append((sid, len(recs), tot, share))
    for sid, n, tot, share in rows:
        print(f"stage {sid:4d} tasks={n:3d} records={tot:9d} max_task_share={share:.3f}")
    print(json.dumps({"lines": total, "hot_share": round(hot_rows / total, 3), "dataset_sec": round(wall, 2),
                      "worst_task_share": round(worst, 3),
                      "largest_shuffle_mb": round(max(map(sum, written.values())) / 1e6, 2),
                      "largest_task_write_mb": round(max(map(max, written.values())) / 1e6, 2)}))


if __name__ == "__main__":
    main()

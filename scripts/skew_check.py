"""Run skew-sensitive operators on a skewed copy of the data; report task balance.

Usage: python scripts/skew_check.py [sf_dir] [scratch_dir]

The copy gives one third of all line items the same part key and one third
of all orders the same customer (so one nation, one feature and one user
are hot). Each operator runs to completion on it, and the Spark event log
(written to the scratch folder; the UI stays off) gives, per stage, the
slowest task against the median task. A straggler stage would show a
slowest task far above its median and above the stages around it.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from quarry.operators import cluster as cl  # noqa: E402
from quarry.operators import incidence as ic  # noqa: E402
from quarry.operators import lsh  # noqa: E402
from quarry.operators import recommend as rec  # noqa: E402
from quarry.operators import relational as rel  # noqa: E402
from quarry.plans import bindings as b  # noqa: E402
from quarry.session import get_session  # noqa: E402
from quarry.sources.tables import TABLES, Tables  # noqa: E402


def make_skewed(spark, sf_dir: str, out: str) -> None:
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    hot = F.pmod(F.xxhash64("l_orderkey", "l_linenumber", "l_partkey"), F.lit(3)) == 0
    li.withColumn("l_partkey", F.when(hot, F.lit(1).cast("long")).otherwise(F.col("l_partkey"))) \
      .repartition(16).write.parquet(f"{out}/lineitem.parquet")
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    o.withColumn("o_custkey", F.when(F.pmod(F.col("o_orderkey"), F.lit(3)) == 0, F.lit(1).cast("long"))
                 .otherwise(F.col("o_custkey"))).repartition(16).write.parquet(f"{out}/orders.parquet")
    for t in TABLES:
        if t not in ("lineitem", "orders"):
            spark.read.parquet(f"{sf_dir}/{t}.parquet").repartition(4).write.parquet(f"{out}/{t}.parquet")


def stage_balance(log_dir: str) -> dict[int, tuple[int, float, float, str]]:
    """``{stage: (tasks, median ms, max ms, name)}`` from the event log."""
    spans: dict[int, list[float]] = {}
    names: dict[int, str] = {}
    for path in glob.glob(f"{log_dir}/**/*", recursive=True):
        if os.path.isdir(path) or "appstatus" in os.path.basename(path):
            continue
        with open(path, "rb") as f:
            raw = f.read()
        if path.endswith(".zstd"):
            import zstandard

            raw = zstandard.ZstdDecompressor().stream_reader(raw).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            if not line.strip():
                continue
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerTaskEnd":
                info = ev["Task Info"]
                spans.setdefault(ev["Stage ID"], []).append(info["Finish Time"] - info["Launch Time"])
            elif ev.get("Event") == "SparkListenerStageCompleted":
                si = ev["Stage Info"]
                names[si["Stage ID"]] = si.get("Stage Name", "")
    return {s: (len(v), statistics.median(v), max(v), names.get(s, "")) for s, v in spans.items()}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="quarry-skew-")
    logs = f"{scratch}/eventlog"
    os.makedirs(logs, exist_ok=True)
    spark = get_session("local[8]", 16, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
                                               "spark.checkpoint.dir": f"{scratch}/ckpt"})
    data = f"{scratch}/skewed"
    make_skewed(spark, sf, data)
    t = Tables(spark, data)
    timings = {}

    def run(name, fn):
        t0 = time.perf_counter()
        df = fn()
        rows = df.count()
        timings[name] = (rows, round(time.perf_counter() - t0, 2))

    run("top_k_groups", lambda: rel.top_k_groups(b.trees_weighted(t), "park", 10, weight="n"))
    run("means_and_interaction", lambda: rec.means_and_interaction(
        rec.train_test(b.ratings(t), "key", 123)[0]))
    inc = b.nation_parts(t).checkpoint()
    run("incidence_lookup", lambda: ic.lookup(inc, b.supplier_nation_parts(t)))
    run("kmeans", lambda: cl.classes(cl.kmeans(inc, cl.init_centroids(inc, 3, 123), 5)[0]))
    run("minhash_buckets", lambda: lsh.minhash_lsh(inc, ["feature"], 123, 5, 7)[2])
    run("baskets", lambda: b.order_items(t, "p_brand").groupBy("basket").agg(F.collect_set("item")))
    spark.stop()
    for k, (rows, sec) in timings.items():
        print(f"{k}: {rows} rows in {sec}s")
    worst = sorted(stage_balance(logs).items(), key=lambda kv: -(kv[1][2] / max(kv[1][1], 1.0)))
    print("stages with the largest max/median task time:")
    for s, (n, med, mx, name) in worst[:8]:
        print(f"  stage {s}: {n} tasks, median {med:.0f} ms, max {mx:.0f} ms  {name[:60]}")


if __name__ == "__main__":
    main()

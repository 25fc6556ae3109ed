"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query writes to Spark's no-op sink, so all rows are produced and none is sent to
Python. A time covers building the plan and running it; the best of $BENCH_REPEAT runs
counts. ``pairs_per_sec`` is the pricing plan's grid per second.
"""

from __future__ import annotations

import json
import os
import time

from stallworks.catalog import REGISTRY
from stallworks.session import local_session

HEADLINE = [f"q{i:02d}" for i in range(1, 18)] + ["agg03", "win05", "win07", "jon07", "snk01", "dq06"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    wanted = os.environ.get("BENCH_QUERIES")
    names = wanted.split(",") if wanted else HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_partkey").count().count()
    times: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeat):
            started = time.perf_counter()
            REGISTRY[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - started)
        times[name] = round(min(runs), 3)
    pairs = None
    if "q17" in times:
        brands = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_brand").distinct().count()
        pairs = brands * spark.read.parquet(f"{sf_dir}/customer.parquet").count()
    result = {
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cpus,
        "repeat": repeat,
    }
    if pairs:
        result["pricing_pairs"] = pairs
        result["pricing_pairs_per_sec"] = round(pairs / times["q17"])
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()

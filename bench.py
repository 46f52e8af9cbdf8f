"""Time the queries at $BENCH_SF_DIR and print one JSON line.

The two `_1m` entries run over about a million users derived from the customer
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import functions as F

from segmart.operators.insight import segment_insight
from segmart.plans import fixture, jobs
from segmart.plans.catalog import QUERIES
from segmart.session import build_session, staged

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
MILLION = 1_000_000


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def run(df) -> None:
    """Compute every row and column and keep none."""
    df.write.format("noop").mode("overwrite").save()


def million_landing(spark):
    """Landing rows of repeated customers under new keys, as a written table."""
    customers = fixture.table(spark, SF_DIR, "customer").select("c_custkey", "c_name")
    n_customers = customers.count()
    copies = -(-MILLION // n_customers)
    shift = F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("copy")
    keyed = customers.repartition(int(CPUS) * 2).select("*", shift).select(
        (F.col("c_custkey") + F.col("copy") * n_customers).alias("k"), "c_name"
    )
    users = fixture.users_from_keys(keyed, "k", "c_name")
    return staged(fixture.to_landing(fixture.to_documents(users)), "landing-1m")


def main() -> None:
    spark = build_session(
        "segmart bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bench-"))
    chosen = sys.argv[1:]
    run(QUERIES["clean_strict"](spark, SF_DIR))  # start-up cost stays out of the first time
    times = {}
    for name, query in QUERIES.items():
        if not chosen or name in chosen:
            times[name] = timed(lambda: run(query(spark, SF_DIR)))
    if not chosen or any(name.endswith("_1m") for name in chosen):
        landing = million_landing(spark)
        run(landing)
        users = []
        times["clean_strict_1m"] = timed(
            lambda: users.append(staged(jobs.cleaned(landing, "strict"), "users-1m"))
        )
        times["segment_insight_1m"] = timed(lambda: run(segment_insight(users[0])))
    print(json.dumps({
        "metric": "total query time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()

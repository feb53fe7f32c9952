"""Write a k-times larger copy of the test tables, derived from them by Spark.

Usage: python scripts/derive_scaled.py SRC_DIR OUT_DIR [K]

events: K copies with event ids offset and times shifted by 31 days per copy;
orders: K copies with order keys offset and dates shifted by 7 years per copy
(customer, nation, region are copied as they are, so each customer has K
"""

from __future__ import annotations

import os
import sys
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from barlake.session import build_session  # noqa: E402


def main() -> None:
    src, out = sys.argv[1], sys.argv[2]
    k = int(sys.argv[3]) if len(sys.argv) > 3 else 10
    spark = build_session("local[8]", shuffle_partitions=16)
    spark.sparkContext.setLogLevel("ERROR")
    ev = spark.read.parquet(f"{src}/events.parquet")
    n_ev = ev.agg(F.max("event_id") + 1).first()[0]
    events = reduce(
        lambda a, b: a.unionByName(b),
        [
            ev.withColumn("event_id", F.col("event_id") + i * n_ev).withColumn(
                "ts", F.timestamp_add("DAY", F.lit(31 * i), F.col("ts"))
            )
            for i in range(k)
        ],
    )
    events.repartition(8).write.mode("overwrite").parquet(f"{out}/events.parquet")
    od = spark.read.parquet(f"{src}/orders.parquet")
    n_od = od.agg(F.max("o_orderkey") + 1).first()[0]
    orders = reduce(
        lambda a, b: a.unionByName(b),
        [
            od.withColumn("o_orderkey", F.col("o_orderkey") + i * n_od).withColumn(
                "o_orderdate", F.timestamp_add("YEAR", F.lit(7 * i), F.col("o_orderdate"))
            )
            for i in range(k)
        ],
    )
    orders.repartition(8).write.mode("overwrite").parquet(f"{out}/orders.parquet")
    for name in ("customer", "nation", "region"):
        spark.read.parquet(f"{src}/{name}.parquet").write.mode("overwrite").parquet(f"{out}/{name}.parquet")
    spark.stop()


if __name__ == "__main__":
    main()

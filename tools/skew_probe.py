"""Skew probe: eager per-user aggregation vs the naive row-level FULL OUTER
join, on a generated fact table where one user holds a third of the rows.

    python tools/skew_probe.py 24000000 eager|naive

Not a registered query (it generates its input); it only measures the plan
choice made in ``tessera.operators.matrix.per_location``.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tessera.operators import matrix  # noqa: E402
from tessera.operators.matrix import Measure  # noqa: E402
from tessera.session import build_session  # noqa: E402


def main() -> None:
    n, which = int(sys.argv[1]), sys.argv[2]
    spark = build_session("local[8]", shuffle_partitions=64)
    hot = F.col("id") % 3 == 0
    facts = spark.range(n).select(
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 200000).alias("id"),
        (F.col("id") % 10).cast("double").alias("v"))
    users = spark.range(200000).select(
        "id", (F.col("id") % 5).cast("string").alias("user_location"))
    if which == "eager":
        df = matrix.per_location(facts, users,
                                 [Measure("rows", "rows"), Measure("s", "sum", F.col("v"))])
    else:
        df = facts.join(users, facts.id == users.id, "full_outer").groupBy("user_location") \
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("v").alias("s"))
    t0 = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    print(which, n, round(time.perf_counter() - t0, 2))


if __name__ == "__main__":
    main()

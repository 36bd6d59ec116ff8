"""FULL OUTER join of rows that survives a hot key (J-F).

Neither a broadcast nor AQE's skew split helps a FULL OUTER join, so a key that
holds a third of the rows makes one task do a third of the work.  Keys above a
share of the left rows (counted with partial aggregation; at most 1 / share of
them) are joined apart: their left rows get a salt, their right rows one copy
per salt.  A hot key has left rows, so none of its right rows is unmatched and
an outer join on the left side is enough.  NULL keys match nothing and go
round the join.  The rest is an ordinary FULL OUTER join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def full_outer(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
               salts: int = SALTS, share: float | None = None) -> DataFrame:
    """All columns of both sides (their names must differ), as of a FULL OUTER join on the keys.

    ``share`` (default: half of one shuffle partition's part): keys with more of
    the left rows are salted.
    """
    clash = set(left.columns) & set(right.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    spark = left.sparkSession
    share = share or 0.5 / max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    lk, rk = F.col(left_key), F.col(right_key)
    counts = left.where(lk.isNotNull()).groupBy(lk.alias("__hot")).count()
    total = left.count()
    # at most 1 / share keys pass
    hot = spark.createDataFrame(
        counts.where(F.col("count") > max(1.0, share * total)).select("__hot").collect(), counts.select("__hot").schema)
    hot = F.broadcast(hot)

    salt = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)).alias("__salt")
    hot_left = left.join(hot, lk == F.col("__hot"), "left_semi").select("*", salt)
    copies = right.join(hot, rk == F.col("__hot"), "left_semi").select(
        "*", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("__copy"))
    crowded = hot_left.join(copies, (lk == rk) & (F.col("__salt") == F.col("__copy")), "left").drop("__salt", "__copy")

    cold = lambda df, key: df.where(key.isNotNull()).join(hot, key == F.col("__hot"), "left_anti")
    plain = cold(left, lk).join(cold(right, rk), lk == rk, "full_outer")
    columns = [*left.columns, *right.columns]
    alone = [df.where(key.isNull()) for df, key in ((left, lk), (right, rk))]
    out = crowded.select(columns).unionByName(plain.select(columns))
    for df in alone:
        out = out.unionByName(df, allowMissingColumns=True)
    return out

"""Equi-joins with keys that are known to hold a large share of the rows.

A plain join is the rule: the adaptive planner splits oversized partitions of the left side of inner, semi and
anti joins while it runs, without a scan of its own. Salting is for keys the caller knows to be hot, say
from a statistic kept with the table, and for plans in which the planner cannot split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_SALT = "_salt"


def salted_join(large: DataFrame, unique: DataFrame, key: str, how: str, spread_by: list[str], hot: list) -> DataFrame:
    """Join ``large`` to ``unique`` (one row per key) on ``key``; rows of the ``hot`` keys are spread.

    They go over as many salts as there are shuffle partitions, by the hash of ``spread_by``, and the matching
    row of ``unique`` is repeated once per salt. All other keys have one salt. Works for inner, left_semi and
    left_anti joins alike, as each row of ``large`` still meets the one row of its key.
    """
    if not hot and how != "left_anti":
        return large.join(unique, key, how)
    salts = int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    is_hot: Column = F.coalesce(F.col(key).isin(hot), F.lit(False))
    # Rows without a key survive an anti-join only; spread too, they match nothing on any salt.
    scattered = is_hot | F.col(key).isNull() if how == "left_anti" else is_hot
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = large.withColumn(_SALT, F.when(scattered, spread).otherwise(F.lit(0)))
    right = unique.withColumn(_SALT, F.explode(copies))
    return left.join(right, [key, _SALT], how).drop(_SALT)

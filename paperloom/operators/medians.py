"""Exact medians per group by counting ranges, without sorting or gathering a group.

Each pass takes a few splitters of the range that still holds a group's middle row (an approximate sketch, combined in every
task), counts the rows between them, and keeps the one part with the middle in it. Splitters are values of the group, so a pass
either hits the middle or leaves a smaller range that excludes them. The last ``FEW`` rows of a range are put in order. Only
counts are shuffled before that, and what is known of the groups is a table with one or two rows per group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.session import land

#: Splitters per pass, and how many rows of a group are few enough to be put in order at the end.
SPLITTERS, FEW = 63, 1000
_ACCURACY = 1000


def _within(value: Column) -> Column:
    low, high = F.col("_low"), F.col("_high")
    return (low.isNull() | (value > low)) & (high.isNull() | (value < high))


def group_medians(df: DataFrame, groups: list[str], value: str, out: str = "median") -> DataFrame:
    """``groups`` and the median of ``value``, the mean of the two middle rows where their number is even.

    Rows without a value do not count, and a group without any has no row. ``df`` should be a table or landed rows, as it is
    read twice per pass; there are about log(rows) / log(64) passes.
    """
    rows = df.select(*groups, F.col(value).cast("double").alias("_value")).where("_value IS NOT NULL")
    n, keys = F.col("_n"), [*groups, "_rank"]
    middle = F.array_distinct(F.array(F.floor((n + 1) / 2), F.floor(n / 2) + 1))
    ranks = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n")).select(*groups, F.explode(middle).alias("_rank"))
    nothing = F.lit(None).cast("double")
    wanted = land(ranks.select(*keys, nothing.alias("_low"), nothing.alias("_high"), F.col("_rank").alias("_left")), "medians")
    shares = [(i + 1) / (SPLITTERS + 1) for i in range(SPLITTERS)]
    found = []
    while True:
        cuts = F.sort_array(F.array_distinct(F.percentile_approx("_value", shares, _ACCURACY))).alias("_cuts")
        ranges = rows.join(wanted, groups).where(_within(F.col("_value"))).groupBy(*keys, "_low", "_high", "_left").agg(cuts)
        ranges = land(ranges, "medians")
        part = F.size(F.filter("_cuts", lambda cut: cut < F.col("_value")))
        placed = rows.join(ranges, groups).where(_within(F.col("_value"))).withColumn("_part", part)
        is_cut = F.col("_value") == F.get("_cuts", F.col("_part"))
        counts = placed.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"), F.count_if(is_cut).alias("_last"))
        earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        running = counts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).join(ranges, keys)
        left = F.col("_left") - F.col("_before")
        hit = running.where((left > 0) & (left <= n))
        cut = F.get("_cuts", F.col("_part"))
        state = land(
            hit.select(
                *keys, F.coalesce(F.get("_cuts", F.col("_part") - 1), F.col("_low")).alias("_low"),
                F.coalesce(cut, F.col("_high")).alias("_high"), left.alias("_left"), F.when(left > n - F.col("_last"), cut).alias("_found"),
                (n - F.col("_last")).alias("_rows"),
            ),
            "medians",
        )
        found.append(state.where("_found IS NOT NULL"))
        wanted = state.where("_found IS NULL").drop("_found")
        most = wanted.agg(F.max("_rows")).first()[0]
        if most is None:
            break
        if most <= FEW:
            rest = rows.join(wanted, groups).where(_within(F.col("_value"))).groupBy(*keys, "_left").agg(F.sort_array(F.collect_list("_value")).alias("_all"))
            found.append(rest.select(*keys, F.get("_all", F.col("_left").cast("int") - 1).alias("_found")))
            break
        wanted = wanted.drop("_rows")
    middles = reduce(DataFrame.unionByName, [part.select(*keys, "_found") for part in found])
    return middles.groupBy(*groups).agg(F.avg("_found").alias(out))

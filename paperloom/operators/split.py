"""Seeded train/validation split of exact size without a global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

TRAIN_RATIO = 0.9
SPLIT_SEED = 42
# Five hex digits give about a million even slices, however many units there are.
_PREFIX_DIGITS = 5


def split_hash(unit: Column, seed: int) -> Column:
    """Position of a unit in the seeded order."""
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), unit), 256)


def train_cut(units: DataFrame, unit: str, train_ratio: float = TRAIN_RATIO, seed: int = SPLIT_SEED) -> DataFrame:
    """One row: number of units, train size, and the hash of the last train unit (NULL for none).

    Units are counted per hash prefix; the running sum over the prefixes, at most 16^5 rows, gives
    the slice in which the cut lies, and only that slice, about a millionth of all units, is ranked.
    """
    hashed = units.select(split_hash(F.col(unit), seed).alias("_hash"))
    prefix = F.substring("_hash", 1, _PREFIX_DIGITS).alias("_prefix")
    sizes = hashed.groupBy(prefix).agg(F.count(F.lit(1)).alias("_n"))
    running = sizes.withColumn("_upto", F.sum("_n").over(Window.orderBy("_prefix")))
    total = F.sum("_n")
    train_size = F.floor(F.coalesce(total, F.lit(0)) * F.lit(float(train_ratio))).cast("bigint")
    totals = sizes.agg(F.coalesce(total, F.lit(0)).alias("unit_count"), train_size.alias("train_count"))
    wanted = totals.select("train_count").scalar()
    slice_row = running.filter((F.col("_upto") >= wanted) & (F.col("_upto") - F.col("_n") < wanted))
    cut_prefix = slice_row.select("_prefix").scalar()
    rank_in_slice = slice_row.select(wanted - F.col("_upto") + F.col("_n")).scalar()
    ranked = hashed.withColumn("_prefix", prefix).filter(F.col("_prefix") == cut_prefix).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_prefix").orderBy("_hash"))
    )
    cut = ranked.filter(F.col("_rank") == rank_in_slice).agg(F.max("_hash")).scalar()
    return totals.withColumn("cut_hash", cut)


def assign_split(
    records: DataFrame,
    unit: str = "id",
    train_ratio: float = TRAIN_RATIO,
    seed: int = SPLIT_SEED,
    units: DataFrame | None = None,
) -> DataFrame:
    """Add ``split``: ``train`` for exactly ``floor(units * ratio)`` units, ``val`` for the others.

    ``units`` has one row per unit and defaults to the records themselves (unit = record). Use
    ``unit="paper_key"`` with ``units=records.select("paper_key").distinct()`` to keep all records of
    a paper together. The cut is fixed first, as one short row; the records then only compare hashes.
    """
    source = records if units is None else units
    cut = train_cut(source, unit, train_ratio, seed).first()
    if cut.train_count == 0 or cut.train_count == cut.unit_count:
        raise ValueError(f"{cut.unit_count} units at ratio {train_ratio} leave one side of the split empty")
    is_train = split_hash(F.col(unit), seed) <= F.lit(cut.cut_hash)
    return records.withColumn("split", F.when(is_train, "train").otherwise("val"))

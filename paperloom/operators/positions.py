"""Contiguous 1-based row numbers without sending all rows through one task.

Rows get a slot inside their own task; only one count per task (or per file block) is summed up in
order. That running sum is as small as the number of input splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from paperloom.session import land
from paperloom.sources.reviews_csv import ROW_BLOCK, ROW_FILE, ROW_SLOT

_TASK_SHIFT = 33
_TASK_ROWS_MASK = (1 << _TASK_SHIFT) - 1


def _starts(slotted: DataFrame, slice_cols: list[str]) -> DataFrame:
    """Rows before each slice, and its first slot; one row per slice.

    Landed, so its size is known: Spark broadcasts it below its threshold and joins by key above.
    """
    sizes = slotted.groupBy(*slice_cols).agg(
        F.count(F.lit(1)).alias("_rows"), F.min(ROW_SLOT).alias("_first_slot")
    )
    before = Window.orderBy(*slice_cols).rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    return land(sizes.select(*slice_cols, "_first_slot", start), "slice-starts")


def _numbered(slotted: DataFrame, slice_cols: list[str], out: str) -> DataFrame:
    position = F.col("_start") + F.col(ROW_SLOT) - F.col("_first_slot") + 1
    helper = {*slice_cols, ROW_SLOT}
    kept = [c for c in slotted.columns if c not in helper]
    return slotted.join(_starts(slotted, slice_cols), slice_cols).select(*kept, position.cast("long").alias(out))


def number_file_rows(positioned: DataFrame, out: str = "row_number") -> DataFrame:
    """Number rows of a scan in file order: file name, block, place within the block.

    ``positioned`` comes from ``read_csv_defensively(..., with_position=True)``; it is landed first,
    so the slots never change between the count and the numbering.
    """
    return _numbered(land(positioned, "scanned-rows"), [ROW_FILE, ROW_BLOCK], out)


def number_rows(df: DataFrame, order_by: list[str], out: str = "row_number") -> DataFrame:
    """Number rows by a unique order: a range-partitioned sort, then per-partition offsets.

    ``order_by`` must be unique per row (add a tie breaker), which also keeps the ranges even.
    """
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    slotted = land(ranged.withColumn(ROW_SLOT, F.monotonically_increasing_id()), "sorted-rows")
    sliced = slotted.withColumn("_task", F.shiftrightunsigned(ROW_SLOT, _TASK_SHIFT))
    return _numbered(sliced, ["_task"], out)

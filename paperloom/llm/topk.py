"""Exact top-k search by inner product: dual-tree cover-tree search over blocks.

Vectors become whole numbers, ``floor(scale * x)``. Data rows are dealt by hash into blocks and queries into
groups; each pair of block and group is searched by one task, which indexes both in cover trees and walks them
together, dropping node pairs whose bound is below the worst kth score of the query node. The best of all
blocks are then merged per query. Sizes of blocks and groups are fixed, so a task's memory is bounded,
and all blocks are searched, so the result is exact.

Scale: every query group meets every block; that is the work of an exact search, and blocks of ``block_rows``
make the rows sent ``queries * blocks + rows * groups`` rather than one per pair.

Defined cases: vectors that are null or hold null or non-finite components take no part; vectors meet
only vectors of their own length; a null id takes no part; a query never meets rows of its own id; other repeated
rows are candidates each; ties go to the smaller id; fewer than k candidates give fewer rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.llm.common import shipped
from paperloom.llm.cover_tree import top_products

RESULT = "query_id bigint, vec_id bigint, score bigint"


def usable(rows: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``id`` and ``v``, an array of whole numbers, of the rows that take part."""
    as_double = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = F.forall(as_double, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    chosen = rows.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & F.coalesce(finite, F.lit(False)))
    return chosen.select(
        F.col(key).cast("long").alias("id"), F.transform(as_double, lambda x: F.floor(scale * x).cast("long")).alias("v")
    )


def _matrix(column: pa.ChunkedArray, size: int) -> np.ndarray:
    values = column.combine_chunks()
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), size)


def search(
    rows: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256,
    block_rows: int = 8192, group_rows: int = 4096,
) -> DataFrame:
    """``query_id``, ``rank`` from 1, ``vec_id``, ``score``: the ``k`` best rows for each query row."""
    data = usable(shipped(rows), key, vector, scale)
    queries = usable(rows.where(is_query), key, vector, scale)
    blocks = max(1, -(-data.count() // block_rows))
    groups = max(1, -(-queries.count() // group_rows))
    sent_data = data.select(
        "id", "v", F.size("v").alias("size"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
    )
    sent_queries = queries.select(
        "id", "v", F.size("v").alias("size"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
        F.pmod(F.xxhash64("id"), F.lit(groups)).cast("int").alias("group"),
    )

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            size = left.column("size")[0].as_py()
            ids, other = left.column("id").to_numpy(), right.column("id").to_numpy()
            best = top_products(_matrix(left.column("v"), size), ids, _matrix(right.column("v"), size), other, k)
            found = [(int(ids[q]), int(other[d]), score) for q, d, score in best]
        columns = list(zip(*found, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    keys = ("block", "group", "size")
    partial = sent_queries.groupBy(*keys).cogroup(sent_data.groupBy(*keys)).applyInArrow(run, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )

"""Small report tables: read timings, format comparison, run manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.operators.medians import group_medians

BYTES_PER_MB = 1024 * 1024


def timing_stats(timings: DataFrame) -> DataFrame:
    """Mean, median, min and max of ``duration_ms`` by ``reader`` and ``format``.

    The exact median comes from counts of ranges (``group_medians``), so neither is a group held in one task nor are
    the rows sorted.
    """
    group = ["reader", "format"]
    stats = timings.groupBy(*group).agg(
        F.count(F.lit(1)).alias("run_count"), F.avg("duration_ms").alias("average_ms"), F.min("duration_ms").alias("min_ms"),
        F.max("duration_ms").alias("max_ms"),
    )
    return stats.join(group_medians(timings, group, "duration_ms", "median_ms"), group).select(
        *group,
        "run_count",
        *[F.round(c, 3).alias(c) for c in ("average_ms", "median_ms", "min_ms", "max_ms")],
    )


def format_comparison(stats: DataFrame, csv_bytes: Column, parquet_bytes: Column) -> DataFrame:
    """CSV against Parquet per reader: time difference and ratio, size difference and reduction."""
    wide = stats.groupBy("reader").pivot("format", ["csv", "parquet"]).agg(F.first("average_ms"))
    csv_mb, parquet_mb = csv_bytes / BYTES_PER_MB, parquet_bytes / BYTES_PER_MB
    csv_ms, parquet_ms = F.col("csv"), F.col("parquet")
    reduction = F.when(csv_mb != 0, (csv_mb - parquet_mb) / csv_mb * 100).otherwise(F.lit(0.0))
    return wide.select(
        "reader",
        csv_ms.alias("csv_avg_ms"),
        parquet_ms.alias("parquet_avg_ms"),
        F.round(csv_ms - parquet_ms, 3).alias("ms_delta"),
        F.round(csv_ms / parquet_ms, 3).alias("speedup_factor"),
        F.round(csv_mb, 3).alias("csv_size_mb"),
        F.round(parquet_mb, 3).alias("parquet_size_mb"),
        F.round(csv_mb - parquet_mb, 3).alias("mb_delta"),
        F.round(reduction, 3).alias("size_reduction_pct"),
    )


def record_totals(tasks: list[str], task: str = "task_type") -> list[Column]:
    """The record counts of a manifest, as aggregates over records with ``split`` and the task column."""
    return [
        F.count(F.lit(1)).alias("total_records"), *[F.count_if(F.col(task) == t).alias(t) for t in tasks],
        *[F.count_if(F.col("split") == part).alias(f"{part}_records") for part in ("train", "val")],
    ]


def manifest(
    source_rows: Column,
    chunk_count: Column,
    totals: DataFrame,
    settings: dict,
    files: dict[str, str],
    generated_at: Column | None = None,
) -> DataFrame:
    """One row that describes a payload run; ``totals`` is one row of ``record_totals``."""
    tasks = settings["tasks"]

    def fixed(*names: str) -> list[Column]:
        return [F.lit(settings[n]).alias(n) for n in names]

    return totals.select(
        (F.current_timestamp() if generated_at is None else generated_at).alias("generated_at"),
        F.struct(F.lit(settings["table"]).alias("table"), source_rows.alias("rows"), *fixed("max_papers")).alias(
            "source"
        ),
        F.struct(
            F.lit("sentence_based_with_overlap").alias("strategy"),
            *fixed("max_chunk_words", "chunk_overlap_words"),
            chunk_count.alias("chunk_count"),
        ).alias("chunking"),
        F.struct(
            F.array(F.lit("alpaca"), F.lit("chat")).alias("formats"),
            "total_records",
            F.struct(*tasks).alias("task_counts"),
            "train_records",
            "val_records",
            *fixed("train_ratio", "split_seed"),
        ).alias("payload"),
        F.struct(*[F.lit(path).alias(name) for name, path in files.items()]).alias("files"),
        F.struct(
            *fixed("min_input_words", "min_output_words"),
            F.array(*[F.lit(k) for k in ("instruction", "input", "output", "messages")]).alias("required_keys"),
        ).alias("validation"),
    )

"""File sinks and their readers: CSV, Parquet, JSON lines, reject samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_CSV = {"header": "true", "quote": '"', "escape": '"'}


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV with header; quotes, line breaks and outer spaces survive a round trip."""
    spaces = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    df.write.mode("overwrite").options(**_CSV, **spaces, compression=compression).csv(path)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.options(**_CSV, multiLine="true").schema(schema).csv(path)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def write_jsonl(df: DataFrame, path: str, partition_by: str | None = None, compression: str = "none") -> None:
    """One JSON object per line, fields in column order, NULLs written."""
    writer = df.write.mode("overwrite").options(ignoreNullFields="false", compression=compression)
    (writer.partitionBy(partition_by) if partition_by else writer).json(path)


def write_reject_sample(
    rejects: DataFrame,
    path: str,
    order_by: list[str],
    columns: list[str],
    limit: int = 100,
    skip_empty: bool = False,
) -> None:
    """The first rejects in arrival order as CSV; with ``skip_empty`` nothing when there are none."""
    sample = rejects.orderBy(*order_by).limit(limit).select(*columns)
    if not (skip_empty and sample.isEmpty()):
        write_csv(sample.coalesce(1), path)


def stored_bytes(spark: SparkSession, path: str) -> DataFrame:
    """One row with the total length of the files below ``path``; lists them without reading them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    size: Column = F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes")
    return files.select("length").agg(size)

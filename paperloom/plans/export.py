"""Dual export to CSV and Parquet, with row checks, sizes and a read comparison."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.folders import delete, read_text, replace_text, size
from paperloom.operators.keyed import KeyedTable
from paperloom.operators.reports import format_comparison, timing_stats
from paperloom.sinks.files import read_csv, stored_bytes, write_csv, write_parquet
from paperloom.sources.tables import export_projection, require_nonempty


def export_papers(
    spark: SparkSession, papers: DataFrame, csv_path: str, parquet_path: str, csv_compression: str = "none"
) -> DataFrame:
    """Write the export columns in both formats; returns rows and bytes per format.

    The rows are written to Parquet once and the CSV is made from that copy, so the source is scanned
    and sorted once. Raises when a copy does not hold every row.
    """
    rows = export_projection(require_nonempty(papers, "source table"))
    write_parquet(rows, parquet_path)
    stored = spark.read.schema(rows.schema).parquet(parquet_path)
    write_csv(stored, csv_path, csv_compression)

    def facts(name: str, copy: DataFrame, path: str) -> DataFrame:
        # Counting a key column keeps the CSV parser on whole records.
        counted = copy.agg(F.count("paper_key").alias("row_count"))
        size: Column = stored_bytes(spark, path).scalar()
        return counted.select(F.lit(name).alias("format"), "row_count", size.alias("size_bytes"))

    csv_copy = read_csv(spark, csv_path, rows.schema)
    report = facts("csv", csv_copy, csv_path).unionByName(facts("parquet", stored, parquet_path))
    counts = {r["format"]: r["row_count"] for r in report.collect()}
    if len(set(counts.values())) != 1:
        raise ValueError(f"Export row counts differ: {counts}")
    return report


def keep_exported(
    spark: SparkSession, papers: KeyedTable, csv_path: str, parquet_path: str, note_path: str, csv_compression: str = "none"
) -> bool:
    """Export the papers unless both copies are already there as they were made from the same rows; whether it had to.

    A small file beside the copies names the rows they were made of and their bytes. It is removed before anything is written, so
    an export that failed is made anew, as is one whose files have changed size.
    """
    sizes = lambda: {path: size(spark, path) for path in (csv_path, parquet_path)}
    made_of, noted = {"rows": papers.content(), "csv": csv_compression}, read_text(spark, note_path)
    if noted is not None and json.loads(noted) == made_of | {"bytes": sizes()}:
        return False
    delete(spark, note_path)
    export_papers(spark, papers.current(), csv_path, parquet_path, csv_compression)
    replace_text(spark, note_path, json.dumps(made_of | {"bytes": sizes()}))
    return True


def compare_formats(timings: DataFrame, export_report: DataFrame) -> DataFrame:
    """Comparison row per reader from read timings and the report of ``export_papers``."""

    def size_of(name: str) -> Column:
        return export_report.filter(F.col("format") == name).select("size_bytes").scalar()

    return format_comparison(timing_stats(timings), size_of("csv"), size_of("parquet"))

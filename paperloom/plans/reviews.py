"""Review ingest: scan, number, hash, type, split by rules, upsert, sample, check."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.operators.keyed import KeyedTable
from paperloom.operators.positions import number_file_rows
from paperloom.operators.quality import (
    CLEAN_REVIEW_COLUMNS, REASON, REJECT_REVIEW_COLUMNS, review_checks, split_by_reason, typed_reviews,
)
from paperloom.plans.tables import CLEAN_REVIEWS, RAW_REVIEWS, REJECTED_REVIEWS
from paperloom.functions.hashing import row_hash
from paperloom.session import land, scratch
from paperloom.sinks.files import write_reject_sample
from paperloom.sources.reviews_csv import normalize_header, read_csv_defensively, require_columns
from paperloom.sources.tables import require_nonempty


def raw_review_rows(raw: DataFrame, batch_id: str, source_url: str) -> DataFrame:
    """Audit rows of the unchanged text columns; the JSON also holds row number and hash.

    Works for any columns, so a file with a wrong header still lands here before it is refused.
    """
    content = [c for c in raw.columns if c != "row_number"]
    hashed = raw.withColumn("row_hash", row_hash(content, "row_number"))
    fields = [F.col(f"`{c}`").cast("string").alias(c) for c in hashed.columns]
    return hashed.select(
        "row_hash",
        F.lit(batch_id).alias("batch_id"),
        "row_number",
        F.lit(source_url).alias("source_url"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("row_data"),
    )


def clean_and_rejected(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two disjoint outcomes for a frame of numbered text rows."""
    clean, rejected = split_by_reason(typed_reviews(raw))
    return clean.select(*CLEAN_REVIEW_COLUMNS), rejected.select(*REJECT_REVIEW_COLUMNS)


def ingest_reviews(
    spark: SparkSession,
    csv_path: str,
    root: str,
    batch_id: str | None = None,
    source_url: str | None = None,
    sample_path: str | None = None,
    multi_line: bool = True,
    loaded_at: Column | None = None,
) -> DataFrame:
    """Load a review CSV into the three review tables below ``root``; returns the load checks.

    Running it again with the same file replaces rows by key and adds none.
    """
    batch_id = batch_id or str(uuid4())
    now = F.current_timestamp() if loaded_at is None else loaded_at
    with scratch(spark):
        tables = _load(spark, csv_path, root, batch_id, source_url or csv_path, sample_path, multi_line, now)
    return review_checks(*[table.current() for table in tables], batch_id)


def _load(
    spark: SparkSession, csv_path: str, root: str, batch_id: str, source_url: str, sample_path: str | None,
    multi_line: bool, now: Column,
) -> tuple[KeyedTable, KeyedTable, KeyedTable]:
    scanned = normalize_header(read_csv_defensively(spark, csv_path, multi_line))
    names = scanned.columns
    positioned = read_csv_defensively(spark, csv_path, multi_line, with_position=True)
    raw = number_file_rows(positioned.toDF(*names, *positioned.columns[len(names):]))
    require_nonempty(raw, "review file")
    raw_table, clean_table, reject_table = (t.open(spark, root) for t in (RAW_REVIEWS, CLEAN_REVIEWS, REJECTED_REVIEWS))
    raw_table.upsert(
        raw_review_rows(raw, batch_id, source_url), ["row_number"], f"{batch_id}-raw", {"ingested_at": now}
    )
    require_columns(raw)
    # The typed rows feed two tables and the sample: written once, read three times.
    scored = land(typed_reviews(raw), "scored-reviews").withColumn("batch_id", F.lit(batch_id))
    clean, rejected = split_by_reason(scored)
    clean_table.upsert(
        clean.select(*CLEAN_REVIEW_COLUMNS, "batch_id"), ["row_number"], f"{batch_id}-clean", {"cleaned_at": now}
    )
    reject_table.upsert(
        rejected.select(*REJECT_REVIEW_COLUMNS, "batch_id").withColumnRenamed(REASON, "reason"),
        ["row_number"], f"{batch_id}-rejected", {"rejected_at": now},
    )
    if sample_path:
        write_reject_sample(rejected, sample_path, ["row_number"], list(REJECT_REVIEW_COLUMNS))
    return raw_table, clean_table, reject_table

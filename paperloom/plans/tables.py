"""Stored tables: column layout, keys and required columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from paperloom.operators.keyed import KeyedTable


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: str
    keys: tuple[str, ...]
    required: tuple[str, ...]

    def open(self, spark: SparkSession, root: str) -> KeyedTable:
        return KeyedTable(spark, f"{root}/{self.name}", T.StructType.fromDDL(self.columns), self.keys)


RAW_REVIEWS = TableSpec(
    "raw_reviews",
    "row_hash string, batch_id string, row_number bigint, source_url string, row_data string, ingested_at timestamp",
    ("row_hash",),
    ("batch_id", "row_hash", "row_number", "source_url", "row_data", "ingested_at"),
)
CLEAN_REVIEWS = TableSpec(
    "clean_reviews",
    "review_key string, batch_id string, row_hash string, review_id bigint, clothing_id int, age int, title string, "
    "review_text string, rating int, recommended_ind int, positive_feedback_count int, division_name string, "
    "department_name string, class_name string, raw_payload string, cleaned_at timestamp",
    ("review_key",),
    (
        "review_key", "batch_id", "row_hash", "clothing_id", "review_text", "rating", "recommended_ind",
        "positive_feedback_count", "raw_payload", "cleaned_at",
    ),
)
REJECTED_REVIEWS = TableSpec(
    "rejected_reviews",
    "row_hash string, batch_id string, row_number bigint, reason string, raw_payload string, rejected_at timestamp",
    ("row_hash",),
    ("batch_id", "row_hash", "row_number", "reason", "raw_payload", "rejected_at"),
)
RAW_ENTRIES = TableSpec(
    "raw_arxiv_entries",
    "paper_key string, versioned_id string, batch_id string, page_number int, source_query string, "
    "source_start_at timestamp, row_hash string, raw_payload string, ingested_at timestamp",
    ("paper_key",),
    ("paper_key", "batch_id", "page_number", "source_query", "source_start_at", "row_hash", "raw_payload"),
)
CLEAN_PAPERS = TableSpec(
    "clean_papers",
    "paper_key string, versioned_id string, batch_id string, row_hash string, title string, summary string, "
    "published_at timestamp, updated_at timestamp, primary_category string, categories_json array<string>, "
    "author_count int, first_author string, authors_preview string, arxiv_url string, pdf_url string, "
    "comment string, journal_ref string, doi string, raw_payload string, loaded_at timestamp",
    ("paper_key",),
    (
        "paper_key", "batch_id", "row_hash", "title", "summary", "published_at", "updated_at",
        "primary_category", "categories_json", "author_count", "raw_payload", "loaded_at",
    ),
)
PAPER_AUTHORS = TableSpec(
    "paper_authors",
    "paper_key string, author_order int, author_name string, affiliation string, batch_id string, "
    "raw_payload string, loaded_at timestamp",
    ("paper_key", "author_order"),
    ("paper_key", "author_order", "author_name", "batch_id", "raw_payload", "loaded_at"),
)
REJECTED_ENTRIES = TableSpec(
    "rejected_arxiv_entries",
    "paper_key string, batch_id string, page_number int, row_hash string, reason string, raw_payload string, "
    "rejected_at timestamp",
    ("paper_key",),
    ("batch_id", "page_number", "row_hash", "reason", "raw_payload", "rejected_at"),
)
INGEST_STATE = TableSpec(
    "pipeline_state",
    "source_name string, watermark_published_at timestamp, watermark_paper_key string, last_batch_id string, "
    "updated_at timestamp",
    ("source_name",),
    ("source_name", "watermark_published_at", "watermark_paper_key", "last_batch_id", "updated_at"),
)

"""Ordered projections over stored tables, and guards on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom.operators.selection import nth_key, up_to

# Export columns in order.
EXPORT_COLUMNS = (
    "paper_key", "versioned_id", "batch_id", "title", "summary", "published_at", "updated_at",
    "primary_category", "categories_json", "author_count", "first_author", "authors_preview",
    "arxiv_url", "pdf_url", "comment", "journal_ref", "doi", "raw_payload", "loaded_at",
)
# Columns the instruction records are built from.
TEXT_COLUMNS = ("paper_key", "title", "summary", "primary_category", "published_at")


def export_projection(papers: DataFrame, order_by: str = "paper_key") -> DataFrame:
    """The export columns, nested ones as JSON text, in key order."""
    types = dict(papers.dtypes)
    columns = [
        F.to_json(c).alias(c) if types[c].startswith(("array", "struct", "map")) else F.col(c)
        for c in EXPORT_COLUMNS
    ]
    return papers.select(*columns).orderBy(order_by)


def text_projection(
    papers: DataFrame, order_by: str = "paper_key", max_papers: int = 0, ordered: bool = True
) -> DataFrame:
    """The text columns in key order; with ``max_papers`` only the first rows, with 0 every row.

    The cut is made at the key of the last row, found by counting ranges of keys (``nth_key``), so the rows stay spread over the
    tasks of the scan; keys are unique, and rows without one are left out of a cut. ``ordered=False`` leaves out the range
    sort where the consumer ignores order.
    """
    rows = papers.select(*TEXT_COLUMNS)
    if max_papers > 0:
        last = nth_key(papers, [order_by], max_papers)
        rows = rows.filter(F.col(order_by).isNotNull() if last is None else up_to(last, papers, [order_by]))
    return rows.orderBy(order_by) if ordered else rows


def require_nonempty(df: DataFrame, what: str = "source") -> DataFrame:
    """Raise when there is no row; looks at one row only."""
    if df.isEmpty():
        raise ValueError(f"The {what} has no rows")
    return df

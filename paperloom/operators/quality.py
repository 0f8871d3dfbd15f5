"""Row rules with reasons, the clean/reject split, and table constraints as checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions.hashing import row_hash
from paperloom.functions.text import BLANK_WORDS, strip
from paperloom.functions.values import to_number, truncate_to_int
from paperloom.sources.reviews_csv import REVIEW_COLUMNS, require_columns

REASON = "reject_reason"


def _reasons(*rules: tuple[Column, str]) -> Column:
    """All names of broken rules joined by ``;`` in the given order; ``""`` when none is broken."""
    return F.concat_ws(";", *[F.when(broken, F.lit(name)) for broken, name in rules])


def review_reasons() -> Column:
    """Broken rules of a review with its numbers as doubles and its text trimmed.

    The bounds are those of the number cut to an integer: 5.7 is a rating of 5, 0.9 one of 0. A value
    no integer column can hold is invalid.
    """
    clothing, rating, age = F.col("clothing_id"), F.col("rating"), F.col("age")
    recommended, feedback = F.col("recommended_ind"), F.col("positive_feedback_count")
    return _reasons(
        (_not_an_int(clothing), "missing_or_invalid_clothing_id"),
        (rating.isNull(), "missing_or_invalid_rating"),
        ((rating < 1) | (rating >= 6), "rating_out_of_range_1_to_5"),
        (recommended.isNull(), "missing_or_invalid_recommended_ind"),
        ((recommended <= -1) | (recommended >= 2), "recommended_ind_not_binary"),
        (feedback.isNull() | (feedback >= _INT_LIMIT), "missing_or_invalid_positive_feedback_count"),
        (feedback <= -1, "negative_positive_feedback_count"),
        (F.lower("review_text").isin(*BLANK_WORDS), "missing_review_text"),
        ((age < 13) | (age >= 101), "age_out_of_expected_range"),
    )


_INT_LIMIT = 2.0**31


def _not_an_int(number: Column) -> Column:
    return number.isNull() | (F.abs(number) >= _INT_LIMIT)


def paper_reasons() -> Column:
    """Broken rules of a feed record (see ``entry_records``)."""

    def empty(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit("")) == ""

    named = F.exists("authors", lambda a: a["author_name"] != "")
    return _reasons(
        (empty("paper_key"), "missing_paper_key"),
        (empty("title"), "missing_title"),
        (empty("summary"), "missing_summary"),
        (F.col("published_at").isNull(), "missing_or_invalid_published_at"),
        (F.col("updated_at").isNull(), "missing_or_invalid_updated_at"),
        (empty("primary_category"), "missing_primary_category"),
        (~F.coalesce(named, F.lit(False)), "authors_without_names"),
    )


_NUMERIC = ("clothing_id", "age", "rating", "recommended_ind", "positive_feedback_count")
_NULLABLE_TEXT = ("title", "division_name", "department_name", "class_name")


def typed_reviews(raw: DataFrame, position: str | None = "row_number") -> DataFrame:
    """Coerce the text columns of a conforming review frame and attach hash, key, payload, reasons.

    A fractional or infinite identifier falls back to the row hash. Two projections, so each text is
    parsed and trimmed once however many rules look at it.
    """
    require_columns(raw)
    content = [c for c in raw.columns if c != position]
    place = [position] if position else []
    parsed = raw.select(
        *place,
        row_hash(content, position).alias("row_hash"),
        to_number(F.col("unnamed_0")).alias("review_id"),
        *[to_number(F.col(c)).alias(c) for c in _NUMERIC],
        *[strip(F.col(c)).alias(c) for c in (*_NULLABLE_TEXT, "review_text")],
        F.to_json(F.struct(*[f"`{c}`" for c in content]), {"ignoreNullFields": "false"}).alias("raw_payload"),
    )
    review_id = F.when(F.col("review_id") == F.floor("review_id"), F.col("review_id").try_cast("bigint"))
    return parsed.select(
        F.coalesce(review_id.cast("string"), "row_hash").alias("review_key"),
        *place,
        "row_hash",
        review_id.alias("review_id"),
        *[truncate_to_int(F.col(c)).alias(c) for c in _NUMERIC],
        *[F.when(~F.lower(c).isin(*BLANK_WORDS), F.col(c)).alias(c) for c in _NULLABLE_TEXT],
        "review_text",
        "raw_payload",
        review_reasons().alias(REASON),
    )


def split_by_reason(scored: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """Rows without and rows with a reason; together they are all rows."""
    return scored.filter(F.col(reason) == "").drop(reason), scored.filter(F.col(reason) != "")


CLEAN_REVIEW_COLUMNS = (
    "review_key", "row_hash", "row_number", "review_id", *REVIEW_COLUMNS[1:], "raw_payload",
)
REJECT_REVIEW_COLUMNS = ("row_hash", "row_number", REASON, "raw_payload")


# --- constraint checks -------------------------------------------------------------------------


def count_rows(tables: dict[str, DataFrame], batch_id: str | None = None) -> DataFrame:
    """One row per table with its row count, all of one batch when ``batch_id`` is given."""
    counts = []
    for name, df in tables.items():
        rows = df if batch_id is None else df.filter(F.col("batch_id") == batch_id)
        counts.append(rows.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("name"), "row_count"))
    return reduce(DataFrame.unionByName, counts)


def null_violations(df: DataFrame, required: list[str]) -> DataFrame:
    """Number of rows with a NULL in any required column."""
    broken = reduce(Column.__or__, [F.col(c).isNull() for c in required])
    return df.agg(F.count_if(broken).alias("null_rows"))


def not_null_violations(df: DataFrame, required: list[str]) -> DataFrame:
    """Number of NULLs of each required column, as ``column_name``/``null_count`` rows; one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "null_count")


def duplicate_key_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of their key, 0 for an empty table."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")


def foreign_key_violations(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """Child rows whose parent is absent; ``parents`` has one row per key."""
    return children.join(parents.select(key), key, "left_anti")


def cascade_delete(children: DataFrame, kept_parents: DataFrame, key: str) -> DataFrame:
    """Child rows that remain after parents were deleted; ``kept_parents`` has one row per key."""
    return children.join(kept_parents.select(key), key, "left_semi")


def rating_distribution(reviews: DataFrame, limit: int = 5) -> DataFrame:
    """Rows per rating in rating order; the first ``limit`` ratings."""
    counts = reviews.groupBy("rating").agg(F.count(F.lit(1)).alias("rating_count"))
    return counts.orderBy("rating").limit(limit)


def review_checks(raw: DataFrame, clean: DataFrame, rejected: DataFrame, batch_id: str) -> DataFrame:
    """The checks after a review load as ``name``/``row_count`` rows."""
    batch = clean.filter(F.col("batch_id") == batch_id)
    counts = count_rows({"raw_count": raw, "clean_count": clean, "reject_count": rejected}, batch_id)
    nulls = null_violations(
        batch, ["review_key", "clothing_id", "review_text", "rating", "recommended_ind"]
    ).select(F.lit("clean_nulls").alias("name"), F.col("null_rows").alias("row_count"))
    duplicates = duplicate_key_rows(batch, ["review_key"]).select(
        F.lit("clean_duplicate_keys").alias("name"), F.col("duplicate_rows").alias("row_count")
    )
    ratings = rating_distribution(batch).select(
        F.concat(F.lit("rating_"), F.col("rating").cast("string")).alias("name"), F.col("rating_count").alias("row_count")
    )
    return counts.unionByName(nulls).unionByName(duplicates).unionByName(ratings)


def paper_checks(
    raw: DataFrame, clean: DataFrame, authors: DataFrame, rejected: DataFrame, batch_id: str
) -> DataFrame:
    """The checks after a feed load as ``name``/``row_count`` rows."""
    batch = clean.filter(F.col("batch_id") == batch_id)
    counts = count_rows(
        {"raw_count": raw, "clean_count": clean, "author_count": authors, "reject_count": rejected}, batch_id
    )
    required = [
        "paper_key", "title", "summary", "published_at", "updated_at", "primary_category", "author_count",
        "first_author",
    ]
    nulls = null_violations(batch, required).select(
        F.lit("clean_nulls").alias("name"), F.col("null_rows").alias("row_count")
    )
    duplicates = duplicate_key_rows(
        authors.filter(F.col("batch_id") == batch_id), ["paper_key", "author_order"]
    ).select(F.lit("author_duplicates").alias("name"), F.col("duplicate_rows").alias("row_count"))
    return counts.unionByName(nulls).unionByName(duplicates)

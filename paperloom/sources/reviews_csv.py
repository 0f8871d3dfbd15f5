"""Defensive CSV scan: every column is text, malformed lines are told apart, header names are made safe."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from paperloom.sources.csv_records import BLOCK, FILE, RECORD, SLOT, csv_records

# Texts that mean "no value" in a scanned field.
NULL_TOKENS = (
    "", "null", "NULL", "None", "none", "NaN", "nan",
    "N/A", "NA", "n/a", "#N/A", "#N/A N/A", "#NA", "<NA>",
    "-NaN", "-nan", "-1.#IND", "-1.#QNAN", "1.#IND", "1.#QNAN",
)
# Columns a review file must have after header normalisation.
REVIEW_COLUMNS = (
    "unnamed_0", "clothing_id", "age", "title", "review_text", "rating", "recommended_ind",
    "positive_feedback_count", "division_name", "department_name", "class_name",
)
BAD_LINE = "_bad_line"
ROW_SLOT, ROW_FILE, ROW_BLOCK = SLOT, FILE, BLOCK


def snake_case(name: str) -> str:
    """Lower snake case: runs of anything but ``a-z0-9`` become one ``_``, ends trimmed."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def normalize_header(df: DataFrame) -> DataFrame:
    """Rename all columns; a blank header, which Spark calls ``_c<i>``, becomes ``unnamed_<i>``."""
    names = [re.sub(r"^_c(\d+)$", r"unnamed_\1", c) for c in df.columns]
    return df.toDF(*[snake_case(n) for n in names])


def missing_columns(df: DataFrame, expected: tuple[str, ...] = REVIEW_COLUMNS) -> list[str]:
    return [c for c in expected if c not in df.columns]


def require_columns(df: DataFrame, expected: tuple[str, ...] = REVIEW_COLUMNS) -> DataFrame:
    """Raise, naming every missing column, when the frame does not conform."""
    absent = missing_columns(df, expected)
    if absent:
        raise ValueError("The review file lacks required columns: " + ", ".join(absent))
    return df


def null_tokens_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NULL_TOKENS), c)


def _field_count(raw_line: Column) -> Column:
    """Fields of a raw line: separators outside quoted sections, plus one."""
    bare = F.regexp_replace(raw_line, '"[^"]*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_csv_defensively(
    spark: SparkSession, path: str, multi_line: bool = True, with_position: bool = False
) -> DataFrame:
    """Scan a CSV file or folder as text columns.

    Lines with too many fields are skipped and short lines are padded with NULL. Lines that do not have exactly
    the fields of the header arrive with their raw text, whose separators are counted; all others do not
    pay for it. Every file must have the header of the first one; another header raises. (With two or more
    nameless columns Spark cannot compare headers, and files are taken by position.)

    ``multi_line`` keeps line breaks inside quotes: records are told apart over the blocks of a file (``csv_records``), which
    writes the lines once. Where no field has line breaks, switch it off; Spark then scans the files itself. Column
    pruning is off for that scan because it changes which lines look malformed.
    ``with_position`` adds the file, block and in-task slot of each row for ``number_file_rows``.
    """
    reader = (
        spark.read.option("header", True)
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("columnPruning", "false")
    )
    header = reader.csv(path).columns
    # Spark calls a nameless column _c<i>; in the file, and so in the comparison of headers, it has no name.
    in_file = ["" if name == f"_c{i}" else name for i, name in enumerate(header)]
    comparable = in_file.count("") < 2
    read = _parsed_records if multi_line else _scanned_lines
    scan = read(spark, reader, path, header, in_file if comparable else None)
    kept = F.col(BAD_LINE).isNull() | (_field_count(F.col(BAD_LINE)) <= len(header))
    # Always true; a scan of nothing but the raw text, as for a bare count, is refused.
    kept &= F.length(F.coalesce(F.col(f"`{header[0]}`"), F.lit(""))) >= 0
    values = [null_tokens_to_null(F.col(f"`{name}`")).alias(name) for name in header]
    rows = scan.filter(kept)
    if not with_position:
        return rows.select(*values)
    if multi_line:
        place = F.row_number().over(Window.partitionBy(FILE, BLOCK).orderBy(SLOT)).cast("long")
        return rows.select(*values, F.col(FILE).alias(ROW_FILE), F.col(BLOCK).alias(ROW_BLOCK), place.alias(ROW_SLOT))
    position = (
        F.col("_metadata.file_path").alias(ROW_FILE), F.col("_metadata.file_block_start").alias(ROW_BLOCK),
        F.monotonically_increasing_id().alias(ROW_SLOT),
    )
    return rows.select(*values, *position)


def _scanned_lines(spark: SparkSession, reader, path: str, header: list[str], in_file: list[str] | None) -> DataFrame:
    """The columns of the header and the raw text of lines with another number of fields, by Spark's own scan."""
    fields = [T.StructField(name, T.StringType()) for name in (*(in_file or header), BAD_LINE)]
    reader = reader.option("enforceSchema", in_file is None).option("columnNameOfCorruptRecord", BAD_LINE)
    return reader.schema(T.StructType(fields)).csv(path).toDF(*header, BAD_LINE)


def _parsed_records(spark: SparkSession, reader, path: str, header: list[str], in_file: list[str] | None) -> DataFrame:
    """As ``_scanned_lines``, from records that may hold line breaks, with their positions."""
    records = csv_records(spark, path)
    fields = [f"f{i}" for i in range(len(header))]
    options = {"quote": '"', "escape": '"', "columnNameOfCorruptRecord": BAD_LINE}
    parsed = F.from_csv(RECORD, ", ".join(f"{name} string" for name in (*fields, BAD_LINE)), options)
    rows = records.select(FILE, BLOCK, SLOT, "first", parsed.alias("_parsed"))
    if in_file is not None:
        wanted = F.array(*[F.lit(name.lower()) for name in in_file])
        found = F.array(*[F.lower(F.coalesce(f"_parsed.{name}", F.lit(""))) for name in fields])
        other = rows.filter(F.col("first") & ((found != wanted) | F.col(f"_parsed.{BAD_LINE}").isNotNull())).select(FILE).first()
        if other is not None:
            raise ValueError(f"The header of {other[FILE]} differs from that of the first file")
    columns = [F.col(f"_parsed.{name}").alias(column) for name, column in zip(fields, header, strict=True)]
    return rows.filter(~F.col("first")).select(*columns, f"_parsed.{BAD_LINE}", FILE, BLOCK, SLOT)

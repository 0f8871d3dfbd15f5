"""Instruction payload: chunks to records, validation, split, JSON-lines files and a manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from paperloom.operators import chunking, instructions as ins
from paperloom.operators.reports import manifest, record_totals
from paperloom.operators.split import SPLIT_SEED, TRAIN_RATIO, assign_split
from paperloom.session import land, scratch
from paperloom.sinks.files import write_jsonl
from paperloom.sources.tables import text_projection

RECORD_FIELDS = ("id", "task_type", "paper_key", "chunk_id", "instruction", "input", "output", "metadata")
CHAT_FIELDS = ("id", "task_type", "paper_key", "chunk_id", "messages", "metadata")
# Each chunk is the input of one record per task, in both formats; the copies follow each other, so little is left of them.
RECORD_COMPRESSION = "gzip"


def build_payload(
    spark: SparkSession,
    papers: DataFrame,
    out: str,
    table_name: str = "clean_papers",
    max_chunk_words: int = chunking.MAX_WORDS,
    chunk_overlap_words: int = chunking.OVERLAP_WORDS,
    min_input_words: int = chunking.MIN_INPUT_WORDS,
    min_output_words: int = ins.MIN_OUTPUT_WORDS,
    train_ratio: float = TRAIN_RATIO,
    split_seed: int = SPLIT_SEED,
    max_papers: int = 0,
    split_unit: str = "id",
) -> DataFrame:
    """Write both record formats below ``out``, split into train and val, and the manifest row.

    Chunks are landed once; records are narrow projections of them. Nothing is written before both
    record formats are validated. Files are laid out as ``<format>/split=train|val``, so the whole set is the
    folder itself and no record is stored twice per format.
    """
    with scratch(spark):
        schema = _write(
            spark, papers, out, table_name, max_chunk_words, chunk_overlap_words, min_input_words, min_output_words,
            train_ratio, split_seed, max_papers, split_unit,
        )
    return spark.read.schema(schema).json(f"{out}/manifest")


def _write(
    spark: SparkSession, papers: DataFrame, out: str, table_name: str, max_chunk_words: int, chunk_overlap_words: int,
    min_input_words: int, min_output_words: int, train_ratio: float, split_seed: int, max_papers: int, split_unit: str,
) -> StructType:
    """Write everything; the schema of the manifest row.

    Rows are counted while they are written, so the source is read once.
    """
    source_seen, chunks_seen, records_seen = Observation(), Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    source = text_projection(papers, max_papers=max_papers, ordered=False).observe(source_seen, rows)
    made = chunking.chunk_records(source, max_chunk_words, chunk_overlap_words, min_input_words)
    chunks = land(made.observe(chunks_seen, rows), "chunks")
    if not chunks_seen.get.get("rows"):
        if not source_seen.get.get("rows"):
            raise ValueError("The payload source has no rows")
        raise ValueError("No chunk of the source is long enough")
    alpaca = ins.alpaca_records(chunks)
    ins.validate_both(alpaca, min_input_words, min_output_words)
    units = None if split_unit == "id" else alpaca.select(split_unit).distinct()
    split = assign_split(alpaca, split_unit, train_ratio, split_seed, units)
    paths = {name: f"{out}/{name}" for name in ("alpaca", "chat")}
    tasks = list(ins.TASK_INSTRUCTIONS)
    written = split.select(*RECORD_FIELDS, "split").observe(records_seen, *record_totals(tasks))
    write_jsonl(written, paths["alpaca"], "split", RECORD_COMPRESSION)
    write_jsonl(ins.chat_records(split).select(*CHAT_FIELDS, "split"), paths["chat"], "split", RECORD_COMPRESSION)
    settings = {
        "table": table_name,
        "max_papers": max_papers,
        "max_chunk_words": max_chunk_words,
        "chunk_overlap_words": chunk_overlap_words,
        "train_ratio": train_ratio,
        "split_seed": split_seed,
        "min_input_words": min_input_words,
        "min_output_words": min_output_words,
        "tasks": tasks,
    }
    files = {
        f"{name}_{part}": path if part == "all" else f"{path}/split={part}"
        for name, path in paths.items()
        for part in ("all", "train", "val")
    }
    totals = spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in records_seen.get.items()])
    counted = [F.lit(seen.get["rows"]).cast("bigint") for seen in (source_seen, chunks_seen)]
    row = land(manifest(*counted, totals, settings, files), "manifest")
    write_jsonl(row.coalesce(1), f"{out}/manifest")
    return row.schema

"""Instruction records from chunks: two record shapes, and strict validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions.text import (
    bullet_points, flat_sentences, has_words, is_blank, leading_sentences, word_count,
)

# Task names and instruction texts, in record order.
TASK_INSTRUCTIONS = {
    "summarize": (
        "Summarize the research text below in 3-4 concise sentences. "
        "Keep factual details grounded in the source."
    ),
    "classify": (
        "Classify the research text below into one ArXiv-style primary category. "
        "Return only the category code."
    ),
    "keypoints": (
        "Extract 5 key points from the research text below. "
        "Return one bullet per point."
    ),
}
SUMMARY_SENTENCES = 4
KEY_POINTS = 5
MIN_INPUT_WORDS = 30
MIN_OUTPUT_WORDS = 3


def instruction_triples(chunks: DataFrame) -> DataFrame:
    """Three rows per chunk with ``task_type``, ``instruction`` and ``output`` next to the chunk columns."""
    sentences = F.col("_sentences")
    outputs = {
        "summarize": leading_sentences(sentences, F.col("chunk_text"), SUMMARY_SENTENCES),
        "classify": F.col("primary_category"),
        "keypoints": bullet_points(sentences, KEY_POINTS),
    }
    rows = [
        F.struct(F.lit(task).alias("task_type"), F.lit(text).alias("instruction"), outputs[task].alias("output"))
        for task, text in TASK_INSTRUCTIONS.items()
    ]
    split = chunks.withColumn("_sentences", flat_sentences(F.col("chunk_text")))
    return split.select(*chunks.columns, F.inline(F.array(*rows)))


def alpaca_records(chunks: DataFrame) -> DataFrame:
    """Flat instruction records, one per chunk and task."""
    return instruction_triples(chunks).select(
        F.concat_ws("_", "chunk_id", "task_type").alias("id"),
        "task_type",
        "paper_key",
        "chunk_id",
        "instruction",
        F.col("chunk_text").alias("input"),
        "output",
        F.struct("paper_key", "chunk_index", "task_type", "primary_category", "title").alias("metadata"),
    )


def chat_messages() -> Column:
    """The two messages of an instruction record."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    question = F.concat(F.lit("Instruction: "), F.col("instruction"), F.lit("\n\nInput:\n"), F.col("input"))
    return F.array(message("user", question), message("assistant", F.col("output")))


def chat_records(alpaca: DataFrame) -> DataFrame:
    """Two-message records derived row by row; extra columns such as ``split`` are kept."""
    fixed = ("id", "task_type", "paper_key", "chunk_id", "instruction", "input", "output", "metadata")
    return alpaca.select(
        "id",
        "task_type",
        "paper_key",
        "chunk_id",
        chat_messages().alias("messages"),
        "metadata",
        *[c for c in alpaca.columns if c not in fixed],
    )


def task_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("task_type").agg(F.count(F.lit(1)).alias("record_count"))


def average_output_words(records: DataFrame) -> DataFrame:
    return records.agg(F.round(F.avg(word_count(F.col("output"))), 2).alias("avg_output_words"))


def _alpaca_faults(min_input_words: int, min_output_words: int) -> dict[str, Column]:
    output = F.col("output")
    long_enough = F.when(F.col("task_type") == "classify", has_words(output, 1)).otherwise(
        has_words(output, min_output_words)
    )
    return {
        "empty_instruction": is_blank(F.col("instruction")),
        "empty_input": is_blank(F.col("input")),
        "empty_output": is_blank(F.col("output")),
        "input_too_short": ~has_words(F.col("input"), min_input_words),
        "output_too_short": ~long_enough,
    }


def _chat_faults() -> dict[str, Column]:
    first = F.try_element_at("messages", F.lit(1))
    second = F.try_element_at("messages", F.lit(2))

    def differs(c: Column, value: str) -> Column:
        return ~F.coalesce(c, F.lit("")).eqNullSafe(value)

    return {
        "message_count": F.coalesce(F.size("messages"), F.lit(0)) != 2,
        "first_role": differs(first["role"], "user"),
        "second_role": differs(second["role"], "assistant"),
        "empty_user_content": is_blank(first["content"]),
        "empty_assistant_content": is_blank(second["content"]),
    }


def _fault_counts(records: DataFrame, faults: dict[str, Column]) -> DataFrame:
    """``check_name``/``violations`` rows: no records, records beyond the first of their id, and each fault. One shuffle, by id.

    Faults are counted per id before the shuffle, so only ids and small counters move.
    """
    per_id = records.groupBy("id").agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(broken).alias(name) for name, broken in faults.items()]
    )
    totals = per_id.agg(
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_id"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in faults],
        F.when(F.count(F.lit(1)) == 0, 1).otherwise(0).cast("bigint").alias("no_records"),
    )
    return totals.unpivot([], ["no_records", "duplicate_id", *faults], "check_name", "violations")


def alpaca_fault_counts(
    records: DataFrame, min_input_words: int = MIN_INPUT_WORDS, min_output_words: int = MIN_OUTPUT_WORDS
) -> DataFrame:
    return _fault_counts(records, _alpaca_faults(min_input_words, min_output_words))


def chat_fault_counts(records: DataFrame) -> DataFrame:
    return _fault_counts(records, _chat_faults())


def _faulty(records: DataFrame, faults: dict[str, Column]) -> DataFrame:
    reason = F.concat_ws(";", *[F.when(broken, F.lit(name)) for name, broken in faults.items()])
    return records.withColumn("fault", reason).filter("fault <> ''")


def faulty_alpaca_records(
    records: DataFrame, min_input_words: int = MIN_INPUT_WORDS, min_output_words: int = MIN_OUTPUT_WORDS
) -> DataFrame:
    """The records that break a rule on their own, with the rule names in ``fault``."""
    return _faulty(records, _alpaca_faults(min_input_words, min_output_words))


def faulty_chat_records(records: DataFrame) -> DataFrame:
    return _faulty(records, _chat_faults())


def _raise_on(counts: DataFrame, what: str) -> None:
    broken = [f"{r.check_name}={r.violations}" for r in counts.filter("violations > 0").collect()]
    if broken:
        raise ValueError(f"Invalid {what} records: " + ", ".join(broken))


def validate_alpaca(
    records: DataFrame, min_input_words: int = MIN_INPUT_WORDS, min_output_words: int = MIN_OUTPUT_WORDS
) -> None:
    """Raise when there is no record, an id repeats or a record breaks a rule."""
    _raise_on(alpaca_fault_counts(records, min_input_words, min_output_words), "alpaca")


def validate_chat(records: DataFrame) -> None:
    _raise_on(chat_fault_counts(records), "chat")


def validate_both(
    records: DataFrame, min_input_words: int = MIN_INPUT_WORDS, min_output_words: int = MIN_OUTPUT_WORDS
) -> None:
    """Both validations of alpaca records and the chat records made of them, in one pass."""
    faults = {**_alpaca_faults(min_input_words, min_output_words), **_chat_faults()}
    _raise_on(_fault_counts(records.withColumn("messages", chat_messages()), faults), "instruction")

"""Catalog: chunking, instruction records, validation and split."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom.catalog import fixtures as fx
from paperloom.catalog.registry import query
from paperloom.functions.text import collapse_whitespace, flat_sentences
from paperloom.operators import chunking, instructions as ins
from paperloom.operators.reports import manifest, record_totals
from paperloom.operators.split import assign_split
from paperloom.plans.payload import CHAT_FIELDS, RECORD_COMPRESSION, RECORD_FIELDS
from paperloom.session import fresh_path, land
from paperloom.sinks.files import write_jsonl


def chunks(spark, sf_dir) -> DataFrame:
    return chunking.chunk_records(fx.papers(spark, sf_dir))


def alpaca(spark, sf_dir) -> DataFrame:
    return ins.alpaca_records(chunks(spark, sf_dir))


@query(
    "ch_source_text",
    """SELECT paper_key, CASE WHEN title <> '' THEN 'Title: ' || title || '. Summary: ' || summary
                              ELSE 'Summary: ' || summary END AS source_text FROM flat""",
    ("flat",),
)
def ch_source_text(spark, sf_dir):
    papers = fx.papers(spark, sf_dir)
    title, summary = (collapse_whitespace(F.col(c)) for c in ("title", "summary"))
    return papers.select("paper_key", title.alias("title"), summary.alias("summary")).select(
        "paper_key", chunking.source_text(F.col("title"), F.col("summary")).alias("source_text")
    )


@query(
    "ch_long_sentence",
    f"SELECT paper_key, CAST(i AS INT) AS sentence_index, CAST(k AS INT) AS window_index, piece "
    f"FROM ({fx.sql_pieces('sentences', 20, 5)})",
    ("sentences",),
)
def ch_long_sentence(spark, sf_dir):
    flat = ch_source_text(spark, sf_dir)
    sentences = flat.select(
        "paper_key", F.posexplode_outer(flat_sentences(F.col("source_text"))).alias("s", "sentence")
    )
    pieces = sentences.select(
        "paper_key", "s", F.posexplode_outer(chunking.sentence_pieces(F.col("sentence"), 20, 5)).alias("w", "p")
    )
    return pieces.select(
        "paper_key", (F.col("s") + 1).alias("sentence_index"), F.col("w").alias("window_index"), F.col("p.text").alias("piece")
    )


@query("ch_pack", "SELECT paper_key, chunk_index, chunk_text FROM chunks", ("chunks",))
def ch_pack(spark, sf_dir):
    flat = ch_source_text(spark, sf_dir)
    packed = flat.select(
        "paper_key", F.posexplode_outer(chunking.chunk_text(F.col("source_text"))).alias("p", "chunk_text")
    )
    return packed.select("paper_key", (F.col("p") + 1).alias("chunk_index"), "chunk_text")


@query(
    "ch_records",
    "SELECT chunk_id, paper_key, primary_category, title, chunk_index, chunk_text FROM chunk_records",
    ("chunk_records",),
)
def ch_records(spark, sf_dir):
    return chunks(spark, sf_dir)


@query("pl_triples", "SELECT chunk_id, task_type, instruction, output FROM alpaca", ("alpaca",))
def pl_triples(spark, sf_dir):
    return ins.instruction_triples(chunks(spark, sf_dir)).select("chunk_id", "task_type", "instruction", "output")


_FLAT_RECORD = "id, task_type, paper_key, chunk_id, instruction, input, output"


def flat_metadata(records: DataFrame) -> DataFrame:
    return records.select(*records.columns[:-1], "metadata.chunk_index", "metadata.primary_category", "metadata.title")


@query("pl_alpaca", f"SELECT {_FLAT_RECORD}, chunk_index, primary_category, title FROM alpaca", ("alpaca",))
def pl_alpaca(spark, sf_dir):
    return flat_metadata(alpaca(spark, sf_dir))


@query(
    "pl_chat",
    """SELECT id, 0 AS position, 'user' AS role,
              'Instruction: ' || instruction || chr(10) || chr(10) || 'Input:' || chr(10) || input AS content FROM alpaca
       UNION ALL SELECT id, 1, 'assistant', output FROM alpaca""",
    ("alpaca",),
)
def pl_chat(spark, sf_dir):
    chat = ins.chat_records(alpaca(spark, sf_dir))
    return chat.select("id", F.posexplode("messages").alias("position", "m")).select("id", "position", "m.role", "m.content")


_WORDS_IN = "CASE WHEN {0} = '' THEN 0 ELSE len(string_split(trim(regexp_replace({0}, '\\s+', ' ', 'g')), ' ')) END"
_FAULTS = (
    ("no_records", "CASE WHEN count(*) = 0 THEN 1 ELSE 0 END"),
    ("duplicate_id", "count(*) - count(DISTINCT id)"),
    ("empty_instruction", "count(*) FILTER (WHERE trim(instruction) = '')"),
    ("empty_input", "count(*) FILTER (WHERE trim(input) = '')"),
    ("empty_output", "count(*) FILTER (WHERE trim(output) = '')"),
    ("input_too_short", f"count(*) FILTER (WHERE {_WORDS_IN.format('input')} < 40)"),
    (
        "output_too_short",
        f"count(*) FILTER (WHERE {_WORDS_IN.format('output')} < CASE WHEN task_type = 'classify' THEN 1 ELSE 20 END)",
    ),
)


# Some ids occur three times.
_AGAIN = "SELECT * FROM alpaca WHERE task_type = 'keypoints' AND chunk_index = 1"
_REPEATED = f"(SELECT * FROM alpaca UNION ALL {_AGAIN} UNION ALL {_AGAIN})"


def _repeated(records: DataFrame) -> DataFrame:
    records = land(records, "records")
    again = records.filter("task_type = 'keypoints' AND metadata.chunk_index = 1")
    return records.unionByName(again).unionByName(again)


@query(
    "pl_validate_alpaca",
    " UNION ALL ".join(f"SELECT '{n}' AS check_name, CAST({e} AS BIGINT) AS violations FROM {_REPEATED}" for n, e in _FAULTS),
    ("alpaca",),
)
def pl_validate_alpaca(spark, sf_dir):
    # Limits above the defaults, so that there is something to find.
    return ins.alpaca_fault_counts(_repeated(alpaca(spark, sf_dir)), min_input_words=40, min_output_words=20)


@query(
    "pl_validate_chat",
    # Keypoint records lose their second message, summaries start with the wrong role, the others end with it.
    f"""SELECT unnest(['no_records', 'duplicate_id', 'message_count', 'first_role', 'second_role',
                      'empty_user_content', 'empty_assistant_content']) AS check_name,
              unnest([CASE WHEN count(*) = 0 THEN 1 ELSE 0 END, count(*) - count(DISTINCT id),
                      count(*) FILTER (WHERE task_type = 'keypoints'), count(*) FILTER (WHERE task_type = 'summarize'),
                      count(*) FILTER (WHERE task_type <> 'summarize'),
                      count(*) FILTER (WHERE instruction || input = ''),
                      count(*) FILTER (WHERE task_type = 'keypoints' OR trim(output) = '')]) AS violations FROM {_REPEATED}""",
    ("alpaca",),
)
def pl_validate_chat(spark, sf_dir):
    """Chat records of which each task breaks another rule, some of them repeated."""
    chat = ins.chat_records(_repeated(alpaca(spark, sf_dir)))
    task = F.col("task_type")
    role = F.when(task == "summarize", F.lit("assistant")).otherwise(F.lit("user"))
    renamed = F.transform("messages", lambda m: m.withField("role", role))
    broken = F.when(task == "keypoints", F.slice(renamed, 1, 1)).otherwise(renamed)
    return ins.chat_fault_counts(chat.withColumn("messages", broken))


@query("agg_task_counts", "SELECT task_type, count(*) AS record_count FROM alpaca GROUP BY task_type", ("alpaca",))
def agg_task_counts(spark, sf_dir):
    return ins.task_counts(alpaca(spark, sf_dir))


@query(
    "agg_output_words",
    f"SELECT round(avg({_WORDS_IN.format('output')}), 2) AS avg_output_words FROM alpaca",
    ("alpaca",),
)
def agg_output_words(spark, sf_dir):
    return ins.average_output_words(alpaca(spark, sf_dir))


@query("pl_split", "SELECT id, split FROM split", ("split",))
def pl_split(spark, sf_dir):
    landed = land(alpaca(spark, sf_dir).select("id"), "record-ids")
    return assign_split(landed).select("id", "split")


@query(
    "pl_membership",
    """SELECT f.format, s.split, s.id FROM split s CROSS JOIN (VALUES ('alpaca'), ('chat')) f(format)""",
    ("split",),
)
def pl_membership(spark, sf_dir):
    """Both formats written by split and read back."""
    records = land(chunks(spark, sf_dir), "chunks").transform(ins.alpaca_records)
    split = assign_split(records)
    parts = []
    for name, rows in (
        ("alpaca", split.select(*RECORD_FIELDS, "split")),
        ("chat", ins.chat_records(split).select(*CHAT_FIELDS, "split")),
    ):
        path = fresh_path(spark, name)
        write_jsonl(rows, path, "split", RECORD_COMPRESSION)
        back = spark.read.schema("id string, split string").json(path)
        parts.append(back.select(F.lit(name).alias("format"), "split", "id"))
    return parts[0].unionByName(parts[1])


@query(
    "sink_manifest",
    """SELECT (SELECT count(*) FROM papers) AS source_rows, (SELECT count(*) FROM chunk_records) AS chunk_count,
              count(*) AS total_records, count(*) FILTER (WHERE task_type = 'summarize') AS summarize,
              count(*) FILTER (WHERE task_type = 'classify') AS classify,
              count(*) FILTER (WHERE task_type = 'keypoints') AS keypoints,
              CAST(floor(count(*) * 0.9) AS BIGINT) AS train_records,
              count(*) - CAST(floor(count(*) * 0.9) AS BIGINT) AS val_records,
              350 AS max_chunk_words, 'sentence_based_with_overlap' AS strategy FROM alpaca""",
    ("papers", "alpaca"),
)
def sink_manifest(spark, sf_dir):
    papers = fx.papers(spark, sf_dir)
    landed = land(chunks(spark, sf_dir), "chunks")
    split = assign_split(ins.alpaca_records(landed))
    settings = {
        "table": "papers", "max_papers": 0, "max_chunk_words": 350, "chunk_overlap_words": 50, "train_ratio": 0.9,
        "split_seed": 42, "min_input_words": 30, "min_output_words": 3, "tasks": list(ins.TASK_INSTRUCTIONS),
    }
    n, totals = F.count(F.lit(1)).alias("n"), split.agg(*record_totals(settings["tasks"]))
    row = manifest(papers.agg(n).scalar(), landed.agg(n).scalar(), totals, settings, {"alpaca_all": "alpaca"})
    path = fresh_path(spark, "manifest")
    write_jsonl(row.coalesce(1), path)
    back = spark.read.schema(row.schema).json(path)
    return back.select(
        F.col("source.rows").alias("source_rows"),
        "chunking.chunk_count",
        "payload.total_records",
        "payload.task_counts.*",
        "payload.train_records",
        "payload.val_records",
        "chunking.max_chunk_words",
        "chunking.strategy",
    )

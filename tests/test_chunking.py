import random
import re

import pytest
from pyspark.sql import functions as F

from paperloom.operators import chunking, instructions as ins
from paperloom.operators.split import assign_split, train_cut


def windows(words, size, overlap):
    """Oversized sentence as word windows, from the definition: last window is the first to reach the end."""
    step, starts = max(1, size - overlap), [0]
    while starts[-1] + size < len(words):
        starts.append(starts[-1] + step)
    return [words[s:s + size] for s in starts]


def brute_force_chunks(text, size, overlap):
    flat = " ".join(text.split())
    queue = [w for s in re.split(r"(?<=[.!?])\s+", flat) if s for w in windows(s.split(), size, overlap)]
    done, open_words = [], []
    for piece in queue:
        if open_words and len(open_words) + len(piece) > size:
            done.append(open_words)
            open_words = (open_words[-overlap:] if overlap else []) + piece
        else:
            open_words = open_words + piece
    return [" ".join(c) for c in [*done, open_words] if c]


TEXTS = [
    "", "  ", "One.", "no terminator here", "What?. Really! Yes.", "a " * 40, "a b c. " * 30, "x. " * 25,
    ("w" * 3 + " ") * 9 + ". " + "tail end.",
]


def random_texts(count):
    rng = random.Random(7)
    for _ in range(count):
        words = [rng.choice(["a", "bb", "ccc.", "d!", "e?", "f"]) for _ in range(rng.randrange(1, 120))]
        yield rng.choice([" ", "\n", "  "]).join(words)


@pytest.mark.parametrize("size,overlap", [(10, 3), (10, 0), (5, 4), (3, 5), (1, 0), (50, 10)])
def test_chunks_equal_brute_force(spark, size, overlap):
    texts = [*TEXTS, *random_texts(150)]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = rows.select("i", chunking.chunk_text(F.col("t"), size, overlap).alias("c")).orderBy("i").collect()
    for row, text in zip(got, texts):
        assert row.c == brute_force_chunks(text, size, overlap), text
        assert all(len(c.split()) <= size + overlap for c in row.c)


def papers(spark):
    long = " ".join(f"Sentence number {i} has some words in it." for i in range(200))
    rows = [("p1", "A  title", long, "en"), ("p2", " ", "Short one.", "en"), ("p3", "t", None, "en"),
            (" ", "t", long, "en"), ("p4", None, long, "\t"), ("p5", None, long, "fr")]
    return spark.createDataFrame(rows, "paper_key string, title string, summary string, primary_category string")


def test_chunk_records_keep_index_gaps_and_skip_blank_sources(spark):
    source = papers(spark)
    every = chunking.chunk_records(source, 20, 5, min_input_words=1)
    long_enough = chunking.chunk_records(source, 20, 5, min_input_words=20)
    assert {r.paper_key for r in every.select("paper_key").distinct().collect()} == {"p1", "p2", "p5"}
    indexes = sorted(r.chunk_index for r in every.filter("paper_key = 'p1'").collect())
    assert indexes == list(range(1, len(indexes) + 1))
    kept = every.filter(F.size(F.split("chunk_text", " ")) >= 20)
    assert sorted(map(tuple, long_enough.collect())) == sorted(map(tuple, kept.collect()))
    texts = {r.paper_key: r.chunk_text for r in every.filter("chunk_index = 1").collect()}
    assert texts["p1"].startswith("Title: A title. Summary: Sentence")
    assert texts["p2"] == "Summary: Short one."


def test_validation_raises_and_names_the_rule(spark):
    good = ins.alpaca_records(chunking.chunk_records(papers(spark)))
    ins.validate_alpaca(good)
    ins.validate_chat(ins.chat_records(good))
    with pytest.raises(ValueError, match="duplicate_id"):
        ins.validate_alpaca(good.unionByName(good.limit(1)))
    with pytest.raises(ValueError, match="no_records"):
        ins.validate_alpaca(good.filter("false"))
    with pytest.raises(ValueError, match="empty_output"):
        ins.validate_alpaca(good.withColumn("output", F.lit(" ")))
    with pytest.raises(ValueError, match="input_too_short"):
        ins.validate_alpaca(good, min_input_words=10_000)
    ins.validate_both(good)
    with pytest.raises(ValueError, match="empty_output=.*empty_assistant_content="):
        ins.validate_both(good.withColumn("output", F.lit(" ")))
    chat = ins.chat_records(good)
    with pytest.raises(ValueError, match="message_count"):
        ins.validate_chat(chat.withColumn("messages", F.slice("messages", 1, 1)))
    swapped = ins.chat_records(good).withColumn("messages", F.reverse("messages"))
    with pytest.raises(ValueError, match="first_role=.*second_role="):
        ins.validate_chat(swapped)
    assert ins.faulty_alpaca_records(good).isEmpty() and not ins.faulty_chat_records(swapped).isEmpty()


@pytest.mark.parametrize("count,ratio", [(10, 0.9), (100, 0.29), (1000, 0.5), (2, 0.5), (3, 0.34)])
def test_split_size_is_exact(spark, count, ratio):
    ids = spark.range(count).select(F.concat(F.lit("id"), "id").alias("id"))
    parts = {r["split"]: r["count"] for r in assign_split(ids, train_ratio=ratio).groupBy("split").count().collect()}
    assert parts == {"train": int(count * ratio), "val": count - int(count * ratio)}
    again = assign_split(ids.repartition(7), train_ratio=ratio)
    assert again.exceptAll(assign_split(ids, train_ratio=ratio)).isEmpty()


def test_split_refuses_an_empty_side(spark):
    one = spark.createDataFrame([("a",)], "id string")
    with pytest.raises(ValueError, match="side of the split empty"):
        assign_split(one)
    assert train_cut(one.filter("false"), "id").first().train_count == 0


def test_split_by_paper_keeps_papers_together(spark):
    records = spark.range(300).select(
        F.col("id").cast("string").alias("id"), (F.col("id") % 20).cast("string").alias("paper_key")
    )
    split = assign_split(records, "paper_key", 0.5, units=records.select("paper_key").distinct())
    per_paper = split.groupBy("paper_key").agg(F.count_distinct("split").alias("n"), F.first("split").alias("s"))
    rows = per_paper.collect()
    assert all(r.n == 1 for r in rows) and sum(r.s == "train" for r in rows) == 10

"""Sentence-first chunking with word overlap.

All steps are column expressions on one row per document: no shuffle, and the text never leaves the
JVM. Only the order-dependent packing is a fold, over numbers of words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions.text import collapse_whitespace, flat_sentences, flat_word_count, is_blank

MAX_WORDS = 350
OVERLAP_WORDS = 50
MIN_INPUT_WORDS = 30

_PIECE = "struct<text:string,words:int>"
_BOUND = "struct<start:int,words:int>"
_STATE = f"struct<closed:array<{_BOUND}>,start:int,words:int,at:int>"


def source_text(title: Column, summary: Column) -> Column:
    """``Title: <t>. Summary: <s>``, without the title part when the title is empty."""
    with_title = F.concat(F.lit("Title: "), title, F.lit(". Summary: "), summary)
    return F.when(title != "", with_title).otherwise(F.concat(F.lit("Summary: "), summary))


def sentence_pieces(sentence: Column, max_words: int, overlap_words: int) -> Column:
    """``sentence`` (collapsed) as text/words pieces.

    One piece when it fits; else windows of ``max_words`` words, a step of ``max_words - overlap_words``
    (at least 1) apart, up to the window that reaches the end.
    """
    step = max(1, max_words - overlap_words)
    words = F.split(sentence, " ")
    last_window = F.ceil((F.size(words) - max_words) / F.lit(step)).cast("int")
    windows = F.transform(
        F.sequence(F.lit(0), last_window),
        lambda i: F.array_join(F.slice(words, i * step + 1, max_words), " "),
    )
    whole = F.array(F.struct(sentence.alias("text"), flat_word_count(sentence).alias("words")))
    cut = F.transform(windows, lambda w: F.struct(w.alias("text"), flat_word_count(w).alias("words")))
    return F.when(flat_word_count(sentence) <= max_words, whole.cast(f"array<{_PIECE}>")).otherwise(
        cut.cast(f"array<{_PIECE}>")
    )


def pieces(flat: Column, max_words: int, overlap_words: int) -> Column:
    """The pieces of a collapsed text in order."""
    return F.flatten(F.transform(flat_sentences(flat), lambda s: sentence_pieces(s, max_words, overlap_words)))


def chunk_bounds(sizes: Column, max_words: int, overlap_words: int) -> Column:
    """Where each chunk begins and ends among the words of all pieces, from the pieces' numbers of words.

    A chunk holds pieces as long as they fit into ``max_words``. The next one begins with the last ``overlap_words`` words of
    the one before and takes a piece in any case, so it may pass ``max_words`` by the overlap.
    """
    none = F.struct(
        F.array().cast(f"array<{_BOUND}>").alias("closed"), *[F.lit(0).alias(name) for name in ("start", "words", "at")]
    ).cast(_STATE)

    def step(state: Column, size: Column) -> Column:
        full = (state["words"] > 0) & (state["words"] + size > max_words)
        kept = F.least(state["words"], F.lit(max(overlap_words, 0)))
        return F.struct(
            F.when(full, F.array_append(state["closed"], _bound(state))).otherwise(state["closed"]).alias("closed"),
            F.when(full, state["at"] - kept).otherwise(state["start"]).alias("start"),
            (F.when(full, kept).otherwise(state["words"]) + size).alias("words"),
            (state["at"] + size).alias("at"),
        )

    def finish(state: Column) -> Column:
        return F.when(state["words"] == 0, state["closed"]).otherwise(F.array_append(state["closed"], _bound(state)))

    return F.aggregate(sizes, none, step, finish)


def _bound(state: Column) -> Column:
    return F.struct(state["start"].alias("start"), state["words"].alias("words"))


def pack_pieces(pieces_col: Column, max_words: int, overlap_words: int) -> Column:
    """Pack pieces into chunks of up to ``max_words`` words.

    A chunk is a run of the words of all pieces, its overlap included, so a fold over numbers finds the runs and each chunk
    is one slice of the words; no text is copied while packing.
    """

    def packed(found: Column) -> Column:
        words = F.flatten(F.transform(found, lambda p: F.split(p["text"], " ")))
        bounds = chunk_bounds(F.transform(found, lambda p: p["words"]), max_words, overlap_words)
        return F.transform(
            F.array(words), lambda w: F.transform(bounds, lambda b: F.array_join(F.slice(w, b["start"] + 1, b["words"]), " "))
        )[0]

    # Bound to a name of its own, so that the pieces are made once.
    return F.transform(F.array(F.filter(pieces_col, lambda p: p["words"] > 0)), packed)[0]


def chunk_text(c: Column, max_words: int = MAX_WORDS, overlap_words: int = OVERLAP_WORDS) -> Column:
    """Chunks of a text as an array of strings."""
    return pack_pieces(pieces(collapse_whitespace(c), max_words, overlap_words), max_words, overlap_words)


def nonblank_sources(papers: DataFrame) -> DataFrame:
    """Papers with a non-blank key, summary and category."""
    return papers.filter(~is_blank(F.col("paper_key")) & ~is_blank(F.col("summary")) & ~is_blank(F.col("primary_category")))


def chunk_records(
    papers: DataFrame,
    max_words: int = MAX_WORDS,
    overlap_words: int = OVERLAP_WORDS,
    min_input_words: int = MIN_INPUT_WORDS,
) -> DataFrame:
    """One row per chunk of ``min_input_words`` words or more.

    ``chunk_index`` counts all chunks of the paper from 1, so dropped chunks leave gaps. ``chunk_id``
    is the first 16 hex digits of SHA-256 over ``key|index|text``.
    """
    flat = nonblank_sources(papers).select(
        *[collapse_whitespace(F.col(c)).alias(c) for c in ("paper_key", "title", "primary_category", "summary")]
    )
    chunked = flat.select(
        "paper_key",
        "primary_category",
        "title",
        # The outer form keeps the optimizer from adding a filter that packs a second time.
        F.posexplode_outer(
            pack_pieces(
                pieces(source_text(F.col("title"), F.col("summary")), max_words, overlap_words),
                max_words,
                overlap_words,
            )
        ).alias("_position", "chunk_text"),
    )
    kept = chunked.filter(F.col("_position").isNotNull() & (flat_word_count(F.col("chunk_text")) >= min_input_words))
    index = F.col("_position") + 1
    digest = F.sha2(F.concat_ws("|", "paper_key", index.cast("string"), "chunk_text"), 256)
    return kept.select(
        F.substring(digest, 1, 16).alias("chunk_id"),
        "paper_key",
        "primary_category",
        "title",
        index.cast("int").alias("chunk_index"),
        "chunk_text",
    )

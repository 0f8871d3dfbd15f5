"""Catalog: column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.catalog import fixtures as fx
from paperloom.catalog.registry import query
from paperloom.functions import feed as ff
from paperloom.functions import text, values
from paperloom.functions.hashing import row_hash
from paperloom.operators.quality import typed_reviews

_PADDED = "chr(9) || chr(28) || ' ' || text || chr(160) || chr(10)"


@query("fn_strip", f"SELECT doc_id, {fx.sql_strip('(' + _PADDED + ')')} AS stripped FROM documents")
def fn_strip(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_PADDED} AS padded")
    return docs.select("doc_id", text.strip(F.col("padded")).alias("stripped"))


@query("fn_collapse_ws", f"SELECT doc_id, {fx.sql_collapse('text')} AS flat FROM documents")
def fn_collapse_ws(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.collapse_whitespace(F.col("text")).alias("flat"))


_BLANKABLE = ("title", "division_name", "department_name", "class_name")


@query(
    "fn_blank_to_null",
    "SELECT row_number, " + ", ".join(f"{fx.sql_blank_to_null(c)} AS {c}" for c in _BLANKABLE) + " FROM reviews",
    ("reviews",),
)
def fn_blank_to_null(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir)
    return raw.select("row_number", *[text.blank_to_null(F.col(c)).alias(c) for c in _BLANKABLE])


_NUMERIC = ("unnamed_0", "clothing_id", "age", "rating", "recommended_ind", "positive_feedback_count")


@query(
    "fn_to_numeric",
    "SELECT row_number, " + ", ".join(f"{fx.sql_number(c)} AS {c}" for c in _NUMERIC) + " FROM reviews",
    ("reviews",),
)
def fn_to_numeric(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir)
    return raw.select("row_number", *[values.to_number(F.col(c)).alias(c) for c in _NUMERIC])


_SIGNED = "CASE WHEN event_id % 2 = 0 THEN value ELSE -value END"


@query("fn_trunc_int", f"SELECT event_id, TRY_CAST(trunc({_SIGNED}) AS INT) AS whole FROM events")
def fn_trunc_int(spark, sf_dir):
    numbers = fx.table(spark, sf_dir, "events").selectExpr("event_id", f"{_SIGNED} AS number")
    return numbers.select("event_id", values.truncate_to_int(F.col("number")).alias("whole"))


_DATE = (
    "'2024-' || lpad(CAST(event_id % 12 + 1 AS STRING), 2, '0') || '-' || lpad(CAST(event_id % 28 + 1 AS STRING), 2, '0')"
)
_CLOCK = "lpad(CAST(event_id % 24 AS STRING), 2, '0') || ':' || lpad(CAST(event_id % 60 AS STRING), 2, '0') || ':05'"
_ISO = f"""CASE event_id % 7 WHEN 0 THEN {_DATE} || 'T' || {_CLOCK} || 'Z' WHEN 1 THEN {_DATE} || 'T' || {_CLOCK} || '+05:30'
 WHEN 2 THEN {_DATE} || ' ' || {_CLOCK} WHEN 3 THEN {_DATE} WHEN 4 THEN substr({_DATE}, 1, 7) WHEN 5 THEN '' END"""


@query(
    "fn_parse_ts",
    f"""SELECT event_id, CASE event_id % 7 WHEN 0 THEN full_ts WHEN 1 THEN full_ts - INTERVAL 330 MINUTE
        WHEN 2 THEN full_ts WHEN 3 THEN CAST(day AS TIMESTAMP) END AS parsed
        FROM (SELECT event_id, CAST({_DATE} || ' ' || {_CLOCK} AS TIMESTAMP) AS full_ts, CAST({_DATE} AS DATE) AS day
              FROM events)""",
)
def fn_parse_ts(spark, sf_dir):
    texts = fx.table(spark, sf_dir, "events").selectExpr("event_id", f"{_ISO} AS iso")
    parsed = values.parse_iso_timestamp(F.col("iso"))
    return texts.select("event_id", values.as_utc_wall_clock(parsed).alias("parsed"))


_FULL_ID = (
    "CASE doc_id % 5 WHEN 0 THEN 'http://arxiv.org/abs/2401.' || CAST(doc_id AS STRING) || 'v2' "
    "WHEN 1 THEN 'http://arxiv.org/abs/hep-th/99' || CAST(doc_id AS STRING) || 'v1' "
    "WHEN 2 THEN ' 2401.' || CAST(doc_id AS STRING) || ' ' WHEN 3 THEN '' END"
)


@query(
    "fn_split_id",
    f"""SELECT doc_id, versioned AS versioned_id, nullif(regexp_replace(versioned, 'v[0-9]+$', ''), '') AS paper_key
        FROM (SELECT doc_id, nullif(regexp_extract(trim({_FULL_ID}), '([^/]*)$', 1), '') AS versioned FROM documents)""",
)
def fn_split_id(spark, sf_dir):
    ids = fx.table(spark, sf_dir, "documents").selectExpr("doc_id", f"{_FULL_ID} AS full_id")
    versioned = ids.select("doc_id", ff.versioned_id(F.col("full_id")).alias("versioned_id"))
    return versioned.withColumn("paper_key", ff.base_id(F.col("versioned_id")))


@query("fn_first_link", "SELECT versioned_id, pdf_url FROM feed", ("feed",))
def fn_first_link(spark, sf_dir):
    return fx.feed_records(spark, sf_dir).select("versioned_id", "pdf_url")


@query("fn_link_fallback", "SELECT versioned_id, arxiv_url FROM feed", ("feed",))
def fn_link_fallback(spark, sf_dir):
    return fx.feed_records(spark, sf_dir).select("versioned_id", "arxiv_url")


@query(
    "fn_array_with_position",
    """SELECT versioned_id, 1 AS author_order, author_1 AS author_name,
              CASE WHEN author_1 <> '' THEN 'Lab' END AS affiliation FROM feed
       UNION ALL SELECT versioned_id, 2, author_2, NULL FROM feed WHERE author_2 IS NOT NULL""",
    ("feed",),
)
def fn_array_with_position(spark, sf_dir):
    return fx.feed_records(spark, sf_dir).select("versioned_id", F.inline("authors"))


@query("fn_array_nonblank", "SELECT versioned_id, categories FROM feed", ("feed",))
def fn_array_nonblank(spark, sf_dir):
    records = fx.feed_records(spark, sf_dir)
    return records.select("versioned_id", F.array_join("categories", "|").alias("categories"))


@query("fn_author_rollup", "SELECT versioned_id, author_count, first_author, authors_preview FROM feed", ("feed",))
def fn_author_rollup(spark, sf_dir):
    return fx.feed_records(spark, sf_dir).select("versioned_id", "author_count", "first_author", "authors_preview")


_PAYLOAD = tuple(c for c in fx.REVIEW_EXPRS if c != "row_number")


@query("fn_raw_payload_json", f"SELECT row_number, {', '.join(_PAYLOAD)} FROM reviews", ("reviews",))
def fn_raw_payload_json(spark, sf_dir):
    scored = typed_reviews(fx.reviews_raw(spark, sf_dir)).select("row_number", "raw_payload")
    back = F.from_json("raw_payload", ", ".join(f"{c} string" for c in _PAYLOAD)).alias("payload")
    return scored.select("row_number", back).select("row_number", "payload.*")


@query("fn_row_hash", f"SELECT row_number, {fx.SQL_REVIEW_HASH} AS row_hash FROM reviews", ("reviews",))
def fn_row_hash(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir)
    return raw.select("row_number", row_hash(list(_PAYLOAD), "row_number").alias("row_hash"))


@query("fn_key_fallback", "SELECT row_number, review_key FROM typed", ("typed",))
def fn_key_fallback(spark, sf_dir):
    return typed_reviews(fx.reviews_raw(spark, sf_dir)).select("row_number", "review_key")


@query("fn_month_trunc", "SELECT paper_key, CAST(date_trunc('month', published_at) AS TIMESTAMP) AS month FROM papers", ("papers",))
def fn_month_trunc(spark, sf_dir):
    return fx.papers(spark, sf_dir).select("paper_key", values.month_of(F.col("published_at")).alias("month"))


@query(
    "fn_word_count",
    f"SELECT paper_key, CAST({fx.sql_words('summary')} AS INT) AS words, "
    f"CAST({fx.sql_words('title')} AS INT) AS title_words FROM flat",
    ("flat",),
)
def fn_word_count(spark, sf_dir):
    counts = [text.word_count(F.col(c)).alias(n) for c, n in (("summary", "words"), ("title", "title_words"))]
    return fx.papers(spark, sf_dir).select("paper_key", *counts)


@query(
    "fn_tail_words",
    """SELECT paper_key, array_to_string(list_slice(w, greatest(len(w) - 49, 1), len(w)), ' ') AS tail, '' AS none
       FROM (SELECT paper_key, string_split(summary, ' ') AS w FROM flat)""",
    ("flat",),
)
def fn_tail_words(spark, sf_dir):
    summary = F.col("summary")
    return fx.papers(spark, sf_dir).select(
        "paper_key", text.tail_words(summary, 50).alias("tail"), text.tail_words(summary, 0).alias("none")
    )


@query(
    "fn_split_sentences",
    f"""SELECT paper_key, unnest(s) AS sentence, CAST(generate_subscripts(s, 1) AS INT) AS position
        FROM (SELECT paper_key, {fx.sql_sentences('summary')} AS s FROM flat)""",
    ("flat",),
)
def fn_split_sentences(spark, sf_dir):
    exploded = fx.papers(spark, sf_dir).select(
        "paper_key", F.posexplode(text.split_sentences(F.col("summary"))).alias("p", "sentence")
    )
    return exploded.select("paper_key", "sentence", (F.col("p") + 1).alias("position"))


@query(
    "fn_extractive_summary",
    f"SELECT paper_key, array_to_string({fx.sql_sentences('summary')}[1:4], ' ') AS short FROM flat",
    ("flat",),
)
def fn_extractive_summary(spark, sf_dir):
    return fx.papers(spark, sf_dir).select("paper_key", text.extractive_summary(F.col("summary"), 4).alias("short"))


@query(
    "fn_keypoints",
    f"""SELECT paper_key, CASE WHEN len(s) = 0 THEN '- Key point unavailable due to empty chunk.'
               ELSE array_to_string(list_transform(s[1:5], lambda x: '- ' || x), chr(10)) END AS points
        FROM (SELECT paper_key, {fx.sql_sentences("CASE WHEN title = '' THEN '' ELSE summary END")} AS s FROM flat)""",
    ("flat",),
)
def fn_keypoints(spark, sf_dir):
    # Some texts are taken as blank, by the rule that leaves titles blank.
    source = F.when(F.trim("title") == "", F.lit("")).otherwise(F.col("summary")).alias("source")
    return fx.papers(spark, sf_dir).select("paper_key", source).select("paper_key", text.keypoints(F.col("source"), 5).alias("points"))

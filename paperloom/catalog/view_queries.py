"""Catalog: row rules, filters, joins, aggregations and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from paperloom.catalog import fixtures as fx
from paperloom.catalog.registry import query
from paperloom.operators import quality, reports
from paperloom.operators.chunking import chunk_records, nonblank_sources
from paperloom.plans import views
from paperloom.sources import tables
from paperloom.streaming.feed_ingest import cap_at_clean_rows

# --- rules -------------------------------------------------------------------------------------


@query("dq_review_rules", "SELECT row_number, reject_reason FROM typed", ("typed",))
def dq_review_rules(spark, sf_dir):
    return quality.typed_reviews(fx.reviews_raw(spark, sf_dir)).select("row_number", "reject_reason")


@query("dq_paper_rules", "SELECT versioned_id, reject_reason FROM feed", ("feed",))
def dq_paper_rules(spark, sf_dir):
    records = fx.feed_records(spark, sf_dir)
    return records.select("versioned_id", quality.paper_reasons().alias("reject_reason"))


@query(
    "dq_split",
    "SELECT row_number, CASE WHEN reject_reason = '' THEN 'clean' ELSE 'rejected' END AS outcome FROM typed",
    ("typed",),
)
def dq_split(spark, sf_dir):
    clean, rejected = quality.split_by_reason(fx.scored_reviews(spark, sf_dir))
    return clean.select("row_number", F.lit("clean").alias("outcome")).unionByName(
        rejected.select("row_number", F.lit("rejected").alias("outcome"))
    )


# --- filters and projections -------------------------------------------------------------------

_AS_OF = "TIMESTAMP '1997-06-01 00:00:00'"
_RECENT = ", ".join(views.RECENT_PAPER_COLUMNS)


@query(
    "f_recent", f"SELECT {_RECENT} FROM papers WHERE published_at >= {_AS_OF} - INTERVAL 180 DAY", ("papers",)
)
def f_recent(spark, sf_dir):
    as_of = F.lit("1997-06-01 00:00:00").cast("timestamp_ntz")
    return views.recent_papers(fx.papers(spark, sf_dir), as_of)


@query(
    "f_category",
    "SELECT paper_key FROM papers WHERE list_has_any(categories_json, ['de', 'g3'])",
    ("papers",),
)
def f_category(spark, sf_dir):
    return views.in_categories(fx.papers(spark, sf_dir), ["de", "g3"], "categories_json").select("paper_key")


@query(
    "f_submitted_range",
    """SELECT event_id FROM events
       WHERE date_trunc('minute', ts) BETWEEN TIMESTAMP '2024-01-02 03:04:00' AND TIMESTAMP '2024-01-05 06:07:00'""",
)
def f_submitted_range(spark, sf_dir):
    entries = fx.table(spark, sf_dir, "events").withColumnRenamed("ts", "published_at")
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-02 03:04:59", "2024-01-05 06:07:08"))
    return views.submitted_between(entries, start, end).select("event_id")


@query(
    "f_nonblank_source",
    f"""SELECT paper_key FROM (SELECT * REPLACE (CASE WHEN trim(title) = '' THEN ' ' ELSE summary END AS summary) FROM papers)
        WHERE {fx.sql_strip('paper_key')} <> '' AND {fx.sql_strip('summary')} <> ''
          AND {fx.sql_strip('primary_category')} <> ''""",
    ("papers",),
)
def f_nonblank_source(spark, sf_dir):
    # Some texts are taken as blank, by the rule that leaves titles blank.
    summary = F.when(F.trim("title") == "", F.lit(" ")).otherwise(F.col("summary"))
    return nonblank_sources(fx.papers(spark, sf_dir).withColumn("summary", summary)).select("paper_key")


@query("f_min_words", "SELECT paper_key, chunk_index FROM chunk_records", ("chunk_records",))
def f_min_words(spark, sf_dir):
    return chunk_records(fx.papers(spark, sf_dir)).select("paper_key", "chunk_index")


@query(
    "p_metadata_score",
    "SELECT paper_key, primary_category, published_at, CAST("
    + " + ".join(
        f"CASE WHEN {c} IS NOT NULL AND trim({c}) <> '' THEN 1 ELSE 0 END"
        for c in ("summary", "doi", "journal_ref", "comment")
    )
    + " AS INT) AS metadata_score FROM papers",
    ("papers",),
)
def p_metadata_score(spark, sf_dir):
    return views.metadata_quality(fx.papers(spark, sf_dir))


_AGENT = ", ".join(c if c != "categories_json" else "array_to_string(categories_json, '|') AS categories_json"
                   for c in views.AGENT_PAPER_COLUMNS)


@query("p_agent_papers", f"SELECT {_AGENT} FROM papers", ("papers",))
def p_agent_papers(spark, sf_dir):
    rows = views.agent_papers(fx.papers(spark, sf_dir))
    return rows.withColumn("categories_json", F.array_join("categories_json", "|"))


# --- joins -------------------------------------------------------------------------------------


@query(
    "j_author_paper",
    "SELECT a.author_name, a.paper_key, a.author_order, p.primary_category, p.published_at "
    "FROM authors a JOIN papers p ON p.paper_key = a.paper_key",
    ("authors", "papers"),
)
def j_author_paper(spark, sf_dir):
    authors, papers = fx.authors(spark, sf_dir), fx.papers(spark, sf_dir)
    joined = views.author_papers(authors, papers, ["primary_category", "published_at"])
    return joined.select("author_name", "paper_key", "author_order", "primary_category", "published_at")


@query(
    "j_category_self",
    """SELECT a.paper_key, a.category AS category_a, b.category AS category_b
       FROM (SELECT paper_key, unnest(categories_json) AS category FROM papers) a
       JOIN (SELECT paper_key, unnest(categories_json) AS category FROM papers) b
         ON a.paper_key = b.paper_key AND a.category < b.category""",
    ("papers",),
)
def j_category_self(spark, sf_dir):
    return views.paper_category_pairs(fx.papers(spark, sf_dir), "categories_json")


@query(
    "j_scalar_cross",
    """SELECT o_orderstatus, sum(o_totalprice) AS status_price,
              (SELECT count(*) FROM lineitem) AS line_rows, (SELECT max(l_shipdate) FROM lineitem) AS last_ship
       FROM orders GROUP BY o_orderstatus""",
)
def j_scalar_cross(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    status = fx.table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.sum("o_totalprice").alias("status_price"))
    return status.withColumns(
        {
            "line_rows": lines.agg(F.count(F.lit(1)).alias("n")).scalar(),
            "last_ship": lines.agg(F.max("l_shipdate").alias("t")).scalar(),
        }
    )


_WORDS = """SELECT paper_key, unnest(string_split(
    lower(regexp_replace(coalesce(title, '') || ' ' || coalesce(summary, ''), '[^a-zA-Z0-9]+', ' ', 'g')), ' ')) AS word
FROM papers"""


@query(
    "j_lateral_explode",
    f"SELECT paper_key, word, count(*) AS copies FROM ({_WORDS}) WHERE word <> '' GROUP BY paper_key, word",
    ("papers",),
)
def j_lateral_explode(spark, sf_dir):
    words = views.paper_words(fx.papers(spark, sf_dir))
    return words.groupBy("paper_key", "word").agg(F.count(F.lit(1)).alias("copies"))


# --- aggregations ------------------------------------------------------------------------------


@query(
    "agg_category_counts",
    "SELECT primary_category, count(*) AS paper_count FROM papers GROUP BY primary_category",
    ("papers",),
)
def agg_category_counts(spark, sf_dir):
    return views.category_counts(fx.papers(spark, sf_dir))


@query(
    "agg_monthly_category",
    "SELECT CAST(date_trunc('month', published_at) AS TIMESTAMP) AS month, primary_category, count(*) AS paper_count "
    "FROM papers GROUP BY 1, 2",
    ("papers",),
)
def agg_monthly_category(spark, sf_dir):
    return views.monthly_category_counts(fx.papers(spark, sf_dir))


@query(
    "agg_author_frequency",
    """SELECT a.author_name, count(DISTINCT a.paper_key) AS paper_count,
              min(p.published_at) AS first_published_at, max(p.published_at) AS last_published_at
       FROM authors a JOIN papers p ON p.paper_key = a.paper_key GROUP BY a.author_name""",
    ("authors", "papers"),
)
def agg_author_frequency(spark, sf_dir):
    return views.author_frequency(fx.authors(spark, sf_dir), fx.papers(spark, sf_dir))


@query(
    "agg_author_category",
    """SELECT a.author_name, p.primary_category, count(DISTINCT a.paper_key) AS paper_count
       FROM authors a JOIN papers p ON p.paper_key = a.paper_key GROUP BY 1, 2""",
    ("authors", "papers"),
)
def agg_author_category(spark, sf_dir):
    return views.author_category_frequency(fx.authors(spark, sf_dir), fx.papers(spark, sf_dir))


_STATE = """SELECT primary_category AS source_name, max(published_at) AS watermark_published_at,
       max_by(paper_key, (published_at, paper_key)) AS watermark_paper_key, max(batch_id) AS last_batch_id,
       max(loaded_at) AS updated_at FROM papers GROUP BY primary_category"""


def state_rows(spark, sf_dir):
    """A state row per language: its newest paper."""
    newest = F.max(F.struct("published_at", "paper_key"))
    return fx.papers(spark, sf_dir).groupBy(F.col("primary_category").alias("source_name")).agg(
        newest["published_at"].alias("watermark_published_at"),
        newest["paper_key"].alias("watermark_paper_key"),
        F.max("batch_id").alias("last_batch_id"),
        F.max("loaded_at").alias("updated_at"),
    )


_HEALTH = f"""SELECT source_name, watermark_published_at, watermark_paper_key, last_batch_id,
               updated_at AS pipeline_updated_at, (SELECT count(*) FROM papers) AS clean_paper_rows,
               (SELECT count(*) FROM authors) AS author_rows, (SELECT count(*) FROM reviews) AS raw_rows,
               (SELECT count(*) FROM typed WHERE reject_reason <> '') AS rejected_rows,
               (SELECT max(loaded_at) FROM papers) AS latest_clean_loaded_at FROM ({_STATE})"""


@query("agg_ingest_health", _HEALTH, ("papers", "authors", "reviews", "typed"))
@query("agg_pipeline_health", _HEALTH, ("papers", "authors", "reviews", "typed"))
def agg_pipeline_health(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir)
    rejected = quality.split_by_reason(fx.scored_reviews(spark, sf_dir, raw))[1]
    return views.ingest_health(
        state_rows(spark, sf_dir), fx.papers(spark, sf_dir), fx.authors(spark, sf_dir), raw, rejected
    )


_STOP = ", ".join(f"'{w}'" for w in views.STOP_WORDS)
SQL_KEYWORDS = (
    f"SELECT word, count(*) AS frequency FROM ({_WORDS}) WHERE length(word) >= 3 AND word NOT IN ({_STOP}) GROUP BY word"
)


@query("agg_keyword_frequency", SQL_KEYWORDS, ("papers",))
def agg_keyword_frequency(spark, sf_dir):
    return views.keyword_frequency(fx.papers(spark, sf_dir))


@query(
    "agg_category_cooccurrence",
    """SELECT a.category AS category_a, b.category AS category_b, count(*) AS co_paper_count
       FROM (SELECT paper_id, unnest(categories) AS category
             FROM (SELECT row_number() OVER () AS paper_id, categories FROM category_lists)) a
       JOIN (SELECT paper_id, unnest(categories) AS category
             FROM (SELECT row_number() OVER () AS paper_id, categories FROM category_lists)) b
         ON a.paper_id = b.paper_id AND a.category < b.category
       GROUP BY 1, 2""",
    ("category_lists",),
)
def agg_category_cooccurrence(spark, sf_dir):
    return views.category_cooccurrence(fx.category_lists(spark, sf_dir))


@query(
    "agg_rating_distribution",
    "SELECT rating, count(*) AS rating_count FROM typed WHERE reject_reason = '' GROUP BY rating ORDER BY rating LIMIT 5",
    ("typed",),
)
def agg_rating_distribution(spark, sf_dir):
    clean = quality.split_by_reason(fx.scored_reviews(spark, sf_dir))[0]
    return quality.rating_distribution(clean)


@query(
    "agg_table_snapshot",
    """SELECT 'clean_papers' AS name, count(*) AS row_count FROM papers
       UNION ALL SELECT 'paper_authors', count(*) FROM authors
       UNION ALL SELECT 'pipeline_state', count(DISTINCT primary_category) FROM papers
       UNION ALL SELECT 'v_agent_papers', count(*) FROM papers
       UNION ALL SELECT 'mv_agent_keyword_frequency', count(*) FROM (""" + SQL_KEYWORDS + ")",
    ("papers", "authors"),
)
def agg_table_snapshot(spark, sf_dir):
    papers = fx.papers(spark, sf_dir)
    return quality.count_rows(
        {
            "clean_papers": papers,
            "paper_authors": fx.authors(spark, sf_dir),
            "pipeline_state": state_rows(spark, sf_dir),
            "v_agent_papers": views.agent_papers(papers),
            "mv_agent_keyword_frequency": views.keyword_frequency(papers),
        }
    )


_TIMINGS = """SELECT event_type AS reader, CASE WHEN user_id % 2 = 0 THEN 'csv' ELSE 'parquet' END AS format,
                     value AS duration_ms, event_id AS run FROM events"""
_TIMING_STATS = f"""SELECT reader, format, count(*) AS run_count, round(avg(duration_ms), 3) AS average_ms,
    round(median(duration_ms), 3) AS median_ms, round(min(duration_ms), 3) AS min_ms, round(max(duration_ms), 3) AS max_ms
    FROM ({_TIMINGS}) GROUP BY reader, format"""


def timings(spark, sf_dir):
    """Event values as read times of four readers in two formats."""
    return fx.table(spark, sf_dir, "events").selectExpr(
        "event_type AS reader", "IF(user_id % 2 = 0, 'csv', 'parquet') AS format", "value AS duration_ms", "event_id AS run"
    )


@query("agg_timing_stats", _TIMING_STATS)
def agg_timing_stats(spark, sf_dir):
    return reports.timing_stats(timings(spark, sf_dir))


@query(
    "agg_format_comparison",
    f"""SELECT c.reader, c.average_ms AS csv_avg_ms, p.average_ms AS parquet_avg_ms,
          round(c.average_ms - p.average_ms, 3) AS ms_delta, round(c.average_ms / p.average_ms, 3) AS speedup_factor,
          round(csv_b / 1048576.0, 3) AS csv_size_mb, round(parquet_b / 1048576.0, 3) AS parquet_size_mb,
          round((csv_b - parquet_b) / 1048576.0, 3) AS mb_delta,
          round((csv_b - parquet_b) * 100.0 / csv_b, 3) AS size_reduction_pct
        FROM (SELECT * FROM ({_TIMING_STATS}) WHERE format = 'csv') c
        JOIN (SELECT * FROM ({_TIMING_STATS}) WHERE format = 'parquet') p ON p.reader = c.reader,
        (SELECT CAST(sum(length(text)) AS DOUBLE) AS csv_b, CAST(sum(n_chars) AS DOUBLE) / 3 AS parquet_b FROM documents)""",
)
def agg_format_comparison(spark, sf_dir):
    docs = fx.table(spark, sf_dir, "documents")
    csv_bytes = docs.agg(F.sum(F.length("text")).cast("double").alias("b")).scalar()
    parquet_bytes = docs.agg((F.sum("n_chars").cast("double") / 3).alias("b")).scalar()
    return reports.format_comparison(reports.timing_stats(timings(spark, sf_dir)), csv_bytes, parquet_bytes)


# --- sorts and limits --------------------------------------------------------------------------

_TEXT = ", ".join(tables.TEXT_COLUMNS)


@query("sort_key_order", f"SELECT {_TEXT} FROM papers ORDER BY paper_key", ("papers",))
def sort_key_order(spark, sf_dir):
    return tables.text_projection(fx.papers(spark, sf_dir))


@query(
    "sort_limit_topk",
    "SELECT row_number, row_hash, reject_reason FROM typed WHERE reject_reason <> '' ORDER BY row_number LIMIT 100",
    ("typed",),
)
def sort_limit_topk(spark, sf_dir):
    rejected = quality.split_by_reason(fx.scored_reviews(spark, sf_dir))[1]
    return rejected.orderBy("row_number").limit(100).select("row_number", "row_hash", "reject_reason")


@query(
    "sort_feed_cap",
    """SELECT versioned_id, reject_reason FROM feed WHERE (start_index, entry_position) <= (
         SELECT max((start_index, entry_position)) FROM (SELECT start_index, entry_position FROM feed
           WHERE reject_reason = '' ORDER BY start_index, entry_position LIMIT 100))""",
    ("feed",),
)
def sort_feed_cap(spark, sf_dir):
    # The cap is the feature: the first entries that hold 100 clean ones.
    scored = fx.scored_records(spark, sf_dir)
    capped = cap_at_clean_rows(scored.withColumn("landed_at", F.lit(0).cast("timestamp")), 100)
    return capped.select("versioned_id", quality.REASON)

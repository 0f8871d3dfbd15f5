"""Catalog: scans, sinks and whole jobs. Files go to the shared folder of the session."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from paperloom.catalog import fixtures as fx
from paperloom.catalog.registry import query
from paperloom.catalog.view_queries import SQL_KEYWORDS
from paperloom.folders import data_size
from paperloom.operators import quality
from paperloom.operators.positions import number_rows
from paperloom.plans.export import export_papers
from paperloom.plans.full_run import run_all
from paperloom.plans.payload import build_payload
from paperloom.plans.reviews import ingest_reviews
from paperloom.plans.stored_views import KEYWORD_VIEW, PAIR_VIEW, StoredViews
from paperloom.plans.tables import CLEAN_PAPERS, INGEST_STATE, PAPER_AUTHORS, RAW_ENTRIES, REJECTED_ENTRIES
from paperloom.session import fresh_path
from paperloom.sinks import files
from paperloom.sources import feed, reviews_csv, tables
from paperloom.sources.feed import land_pages
from paperloom.streaming.feed_ingest import stream_feed

# --- scans ------------------------------------------------------------------------------------

_HEADER = ("", "Clothing ID", "Age", "Title", "Review Text", "Rating", "Recommended IND",
           "Positive Feedback Count", "Division Name", "Department Name", "Class Name")
LINES_A_FILE = 50_000
_TEXT_FIELDS = [c for c in fx.REVIEW_EXPRS if c != "row_number"]


def _review_lines(raw: DataFrame) -> DataFrame:
    """Raw CSV lines, one per event: some with a field too many or two, some cut short."""

    def quoted(c: str):
        return F.concat(F.lit('"'), F.replace(F.col(c), F.lit('"'), F.lit('""')), F.lit('"'))

    full = F.concat_ws(",", *[F.coalesce(quoted(c), F.lit("")) for c in _TEXT_FIELDS])
    short = F.concat_ws(",", *[F.coalesce(quoted(c), F.lit("")) for c in _TEXT_FIELDS[:3]])
    n = F.col("row_number")
    line = (
        F.when(n % 97 == 0, F.concat(full, F.lit(",x")))
        .when(n % 101 == 0, F.concat(full, F.lit(",,y")))
        .when(n % 89 == 0, short)
        .otherwise(full)
    )
    return raw.select(line.alias(",".join(_HEADER)))


def land_review_files(spark, sf_dir) -> str:
    """Write the raw lines as header-first text files; the separator never occurs, so nothing is quoted."""
    path = fresh_path(spark, "review-files")
    _review_lines(fx.reviews_raw(spark, sf_dir)).write.option("header", "true").option("sep", "\x01").option("quote", "").csv(path)
    return path


def _scanned_sql(c: str) -> str:
    kept = f"CASE WHEN {c} IN ('', 'None', 'NaN') THEN NULL ELSE {c} END"
    if c in _TEXT_FIELDS[:3]:
        return f"{kept} AS {c}"
    return f"CASE WHEN row_number % 89 = 0 AND row_number % 97 <> 0 AND row_number % 101 <> 0 THEN NULL ELSE {kept} END AS {c}"


SQL_SCANNED = (
    f"SELECT {', '.join(_scanned_sql(c) for c in _TEXT_FIELDS)}, row_number FROM reviews "
    "WHERE row_number % 97 <> 0 AND row_number % 101 <> 0"
)


@query("src_csv_defensive", f"SELECT * EXCLUDE (row_number) FROM ({SQL_SCANNED})", ("reviews",))
def src_csv_defensive(spark, sf_dir):
    scan = reviews_csv.read_csv_defensively(spark, land_review_files(spark, sf_dir), multi_line=False)
    return reviews_csv.normalize_header(scan)


@query(
    "src_csv_line_breaks",
    f"SELECT * EXCLUDE (row_number) REPLACE (CASE WHEN title IS NULL THEN NULL ELSE title || chr(10) || 'second line' END AS title) "
    f"FROM ({SQL_SCANNED})",
    ("reviews",),
)
def src_csv_line_breaks(spark, sf_dir):
    """The same lines with line breaks inside quoted titles."""
    path = fresh_path(spark, "review-files")
    raw = fx.reviews_raw(spark, sf_dir)
    kept = ~F.col("title").isin("", "None", "NaN")
    broken = raw.withColumn("title", F.when(kept, F.concat("title", F.lit("\nsecond line"))).otherwise(F.col("title")))
    lines = _review_lines(broken)
    # Text files of several lines a record, each headed by the header: one file per part, as each is read by one task.
    parts, header = max(8, -(-raw.count() // LINES_A_FILE)), ",".join(_HEADER)
    heads = spark.range(parts).select(F.col("id").cast("int").alias("part"), F.lit(0).alias("after"), F.lit(header).alias("line"))
    body = lines.select(F.pmod(F.xxhash64(F.col(f"`{header}`")), F.lit(parts)).cast("int").alias("part"), F.lit(1).alias("after"), F.col(f"`{header}`").alias("line"))
    together = heads.unionByName(body).repartition("part").sortWithinPartitions("part", "after")
    together.drop("after").write.partitionBy("part").text(path)
    return reviews_csv.normalize_header(reviews_csv.read_csv_defensively(spark, f"{path}/part=*"))


@query("src_normalize_header", f"SELECT {', '.join(_TEXT_FIELDS)} FROM reviews", ("reviews",))
def src_normalize_header(spark, sf_dir):
    raw = fx.reviews_raw(spark, sf_dir).select(*_TEXT_FIELDS)
    return reviews_csv.normalize_header(raw.toDF("_c0", *[f" {h.replace(' ', ' - ')}! " for h in _HEADER[1:]]))


@query(
    "src_schema_conformance",
    "SELECT 'reviews' AS source, '' AS missing, count(*) AS row_count FROM reviews "
    "UNION ALL SELECT 'events', 'unnamed_0,clothing_id,age,title,review_text,rating,recommended_ind,"
    "positive_feedback_count,division_name,department_name,class_name', count(*) FROM events",
    ("reviews",),
)
def src_schema_conformance(spark, sf_dir):
    sources = {"reviews": fx.reviews_raw(spark, sf_dir), "events": fx.table(spark, sf_dir, "events")}
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("source"), F.lit(",".join(reviews_csv.missing_columns(df))).alias("missing"), "row_count"
        )
        for name, df in sources.items()
    ]
    return parts[0].unionByName(parts[1])


@query("src_row_number", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS row_number FROM events")
def src_row_number(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events").select("ts", "event_id")
    return number_rows(events, ["ts", "event_id"]).select("event_id", "row_number")


@query(
    "src_feed_entries",
    """SELECT versioned_id, paper_key, title, summary, published_at, updated_at, primary_category, author_count,
              arxiv_url, pdf_url, journal_ref FROM feed""",
    ("feed",),
)
def src_feed_entries(spark, sf_dir):
    records = fx.feed_records(spark, sf_dir)
    zone_free = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("published_at", "updated_at")]
    return records.select(
        "versioned_id", "paper_key", "title", "summary", *zone_free, "primary_category", "author_count", "arxiv_url",
        "pdf_url", "journal_ref",
    )


@query("src_feed_page_meta", """SELECT start_index, CASE WHEN start_index // 2 % 9 = 0 THEN 0 ELSE CAST(start_index // 2 % 50 AS BIGINT) END AS total_results,
        CAST((SELECT count(*) FROM feed f WHERE f.start_index = p.start_index) AS INT) AS entry_count FROM feed_fields p""", ("feed_fields", "feed"))
def src_feed_page_meta(spark, sf_dir):
    pages = feed.parse_pages(fx.feed_pages(spark, sf_dir), "xml")
    return feed.page_facts(pages).select("start_index", "total_results", "entry_count")


@query("src_table_projection", f"{fx.SQL_EXPORTED} ORDER BY paper_key", ("papers",))
def src_table_projection(spark, sf_dir):
    return tables.export_projection(fx.papers(spark, sf_dir))


@query(
    "src_table_limit",
    f"SELECT {', '.join(tables.TEXT_COLUMNS)} FROM papers ORDER BY paper_key LIMIT 100",
    ("papers",),
)
def src_table_limit(spark, sf_dir):
    # The limit is the feature.
    return tables.text_projection(fx.papers(spark, sf_dir), max_papers=100)


@query("src_require_nonempty", "SELECT count(*) AS row_count FROM papers", ("papers",))
def src_require_nonempty(spark, sf_dir):
    return tables.require_nonempty(fx.papers(spark, sf_dir)).agg(F.count(F.lit(1)).alias("row_count"))


# --- sinks ------------------------------------------------------------------------------------


_TEXTS = [c for c in tables.EXPORT_COLUMNS if c not in ("published_at", "updated_at", "loaded_at", "author_count")]


@query(
    "sink_csv",
    # CSV has one spelling for NULL and empty text; both come back as NULL.
    f"SELECT * REPLACE ({', '.join(f"nullif({c}, '') AS {c}" for c in _TEXTS)}) FROM ({fx.SQL_EXPORTED})",
    ("papers",),
)
def sink_csv(spark, sf_dir):
    rows, path = fx.exported(spark, sf_dir), fresh_path(spark, "csv")
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema)


@query("sink_parquet", fx.SQL_EXPORTED, ("papers",))
def sink_parquet(spark, sf_dir):
    rows, path = fx.exported(spark, sf_dir), fresh_path(spark, "parquet")
    files.write_parquet(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


@query(
    "sink_jsonl",
    f"SELECT *, journal_ref IS NULL AS null_written FROM ({fx.SQL_EXPORTED})",
    ("papers",),
)
def sink_jsonl(spark, sf_dir):
    """JSON lines read back as text: the NULL field must be in the line."""
    rows, path = fx.exported(spark, sf_dir), fresh_path(spark, "jsonl")
    files.write_jsonl(rows, path)
    lines = spark.read.text(path)
    parsed = lines.select(F.from_json("value", rows.schema).alias("r"), F.col("value").contains('"journal_ref":null').alias("n"))
    return parsed.select("r.*", F.col("n").alias("null_written"))


@query(
    "sink_reject_sample",
    "SELECT row_number, row_hash, reject_reason FROM typed WHERE reject_reason <> '' ORDER BY row_number LIMIT 100",
    ("typed",),
)
def sink_reject_sample(spark, sf_dir):
    # A sample of the first 100 rejects is the feature.
    rejected = quality.split_by_reason(fx.scored_reviews(spark, sf_dir))[1]
    path = fresh_path(spark, "reject-sample")
    columns = ["row_hash", "row_number", quality.REASON, "raw_payload"]
    files.write_reject_sample(rejected, path, ["row_number"], columns)
    back = files.read_csv(spark, path, "row_hash string, row_number bigint, reject_reason string, raw_payload string")
    return back.select("row_number", "row_hash", "reject_reason")


# --- jobs -------------------------------------------------------------------------------------

_JOB_TYPED = fx.sql_typed(f"({SQL_SCANNED})")


@query(
    "job_reviews",
    f"""SELECT unnest(['raw_count', 'clean_count', 'reject_count', 'clean_nulls', 'clean_duplicate_keys']) AS name,
               unnest([count(*), count(*) FILTER (WHERE reject_reason = ''), count(*) FILTER (WHERE reject_reason <> ''),
                       count(*) FILTER (WHERE reject_reason = '' AND (review_key IS NULL OR clothing_id IS NULL OR
                         review_text IS NULL OR rating IS NULL OR recommended_ind IS NULL)),
                       count(*) FILTER (WHERE reject_reason = '')
                         - count(DISTINCT review_key) FILTER (WHERE reject_reason = '')]) AS row_count FROM ({_JOB_TYPED})
        UNION ALL SELECT 'rating_' || CAST(rating AS STRING), count(*) FROM ({_JOB_TYPED}) WHERE reject_reason = '' GROUP BY rating""",
    ("reviews",),
)
def job_reviews(spark, sf_dir):
    root = fresh_path(spark, "review-tables")
    return ingest_reviews(
        spark, land_review_files(spark, sf_dir), root, "b1", sample_path=f"{root}/sample", multi_line=False
    )


def land_feed_pages(spark, sf_dir) -> str:
    """Pages as rows of a landing table; one small file per page would not scale."""
    path = fresh_path(spark, "feed-pages")
    land_pages(fx.feed_pages(spark, sf_dir), path)
    return path


AS_OF = datetime(2024, 3, 1, tzinfo=timezone.utc)
# Pages whose document number is even come first; then the odd ones, and every fourth again. The watermark is the
# last entry of the last page of the first increment, or of the second one if that is not older.
_SQL_FEED_COUNTS = """
SELECT unnest(['raw', 'clean', 'authors', 'rejected', 'clean_of_second_load', 'rejected_of_second_load', 'watermark_day']) AS name,
       unnest([count(*), count(*) FILTER (WHERE reject_reason = ''),
               count(*) FILTER (WHERE reject_reason = '')
                 + count(*) FILTER (WHERE reject_reason = '' AND author_2 <> ''),
               count(*) FILTER (WHERE reject_reason <> ''),
               count(*) FILTER (WHERE reject_reason = '' AND (start_index % 4 = 2 OR start_index % 8 = 0)),
               count(*) FILTER (WHERE reject_reason <> '' AND (start_index % 4 = 2 OR start_index % 8 = 0)),
               day(greatest(max_by(published_at, start_index) FILTER (WHERE reject_reason = '' AND start_index % 4 = 0),
                   max_by(published_at, start_index) FILTER (WHERE reject_reason = '' AND (start_index % 4 = 2 OR start_index % 8 = 0))
               ))]) AS row_count FROM feed
"""


@query("job_feed_incremental", _SQL_FEED_COUNTS, ("feed",))
def job_feed_incremental(spark, sf_dir):
    """Two increments of landed pages: the second one has late pages and some of the first again."""
    root, landing = fresh_path(spark, "feed-tables"), fresh_path(spark, "feed-pages")
    pages = fx.feed_pages(spark, sf_dir, "start_index")
    load = lambda: stream_feed(spark, landing, root, "feed", f"{root}/checkpoint", page_format="parquet", as_of=AS_OF)
    land_pages(pages.filter("start_index % 4 = 0"), landing)
    load()
    first = INGEST_STATE.open(spark, root).current().first().last_batch_id
    land_pages(pages.filter("start_index % 4 = 2 OR start_index % 8 = 0"), landing)
    load()
    raw, clean, authors, rejected, state = (
        spec.open(spark, root).current() for spec in (RAW_ENTRIES, CLEAN_PAPERS, PAPER_AUTHORS, REJECTED_ENTRIES, INGEST_STATE)
    )
    later = F.col("batch_id") != first
    counts = quality.count_rows({
        "raw": raw, "clean": clean, "authors": authors, "rejected": rejected,
        "clean_of_second_load": clean.filter(later), "rejected_of_second_load": rejected.filter(later),
    })
    day = state.select(F.lit("watermark_day").alias("name"), F.dayofmonth("watermark_published_at").cast("bigint").alias("row_count"))
    return counts.unionByName(day)


_SQL_PAIRS = """SELECT a.c AS category_a, b.c AS category_b, count(*) AS n
FROM (SELECT paper_key, unnest(categories_json) AS c FROM papers) a
JOIN (SELECT paper_key, unnest(categories_json) AS c FROM papers) b ON a.paper_key = b.paper_key AND a.c < b.c
GROUP BY 1, 2"""


@query(
    "job_refresh_views",
    f"""SELECT '{KEYWORD_VIEW}' AS view_name, word AS item, frequency AS n FROM ({SQL_KEYWORDS})
        UNION ALL SELECT '{PAIR_VIEW}', category_a || '|' || category_b, n FROM ({_SQL_PAIRS})""",
    ("papers",),
)
def job_refresh_views(spark, sf_dir):
    """Views kept up over two loads: the second adds half of the papers and replaces a quarter of them."""
    root = fresh_path(spark, "views")
    papers, views, number = CLEAN_PAPERS.open(spark, root), StoredViews(spark, root), F.pmod(F.xxhash64("paper_key"), F.lit(4))
    final = fx.papers(spark, sf_dir)
    former = {
        "title": F.concat(F.lit("former title "), F.coalesce("title", F.lit(""))),
        "categories_json": F.concat(F.array(F.lit("former.category")), F.coalesce("categories_json", F.array().cast("array<string>"))),
    }
    first = final.filter(number == 0).withColumns(former).unionByName(final.filter(number == 1))
    for load_id, batch in (("load-1", first), ("load-2", final.filter(number != 1))):
        views.prepare(papers, batch, load_id)
        papers.upsert(batch, ["paper_key"], load_id)
        views.apply(papers, load_id)
    built = views.current()
    words = built[KEYWORD_VIEW].select(F.lit(KEYWORD_VIEW).alias("view_name"), F.col("word").alias("item"), F.col("frequency").alias("n"))
    pair = F.concat_ws("|", "category_a", "category_b").alias("item")
    return words.unionByName(
        built[PAIR_VIEW].select(F.lit(PAIR_VIEW).alias("view_name"), pair, F.col("co_paper_count").alias("n"))
    )


_EXPORTED_TEXTS = ("title", "summary", "primary_category", "doi")
_EXPORTED_HASH = " || '|' || ".join(f"coalesce(nullif({c}, ''), '')" for c in _EXPORTED_TEXTS)


@query(
    "job_export",
    f"""SELECT f.format, paper_key, md5({_EXPORTED_HASH}) AS content, (SELECT count(*) FROM papers) AS row_count, true AS is_file_size,
              true AS csv_holds_the_texts FROM papers, (VALUES ('csv'), ('parquet')) f(format)""",
    ("papers",),
)
def job_export(spark, sf_dir):
    """Both copies read back row by row; the reported sizes are those of the files, and the CSV is no smaller than its texts."""
    root = fresh_path(spark, "export")
    report = export_papers(spark, fx.papers(spark, sf_dir), f"{root}/csv", f"{root}/parquet")
    stored = spark.read.parquet(f"{root}/parquet")
    copies = {"csv": files.read_csv(spark, f"{root}/csv", stored.schema), "parquet": stored}
    text = F.concat_ws("|", *[F.coalesce(F.nullif(c, F.lit("")), F.lit("")) for c in _EXPORTED_TEXTS])
    rows = reduce(DataFrame.unionByName, [c.select(F.lit(n).alias("format"), "paper_key", F.md5(text).alias("content")) for n, c in copies.items()])
    measured = {name: F.lit(data_size(spark, f"{root}/{name}", ".parquet" if name == "parquet" else ".csv")) for name in copies}
    texts = stored.agg(F.sum(sum(F.coalesce(F.octet_length(c), F.lit(0)) for c in _EXPORTED_TEXTS))).scalar()
    facts = report.select(
        "format", "row_count", (F.col("size_bytes") == F.when(F.col("format") == "csv", measured["csv"]).otherwise(measured["parquet"])).alias("is_file_size"),
        ((F.col("format") != "csv") | (F.col("size_bytes") >= texts)).alias("csv_holds_the_texts"),
    )
    return rows.join(F.broadcast(facts), "format")


_RECORD_TEXT = "instruction || chr(10) || input || chr(10) || output"
_CHAT_TEXT = "'user: Instruction: ' || instruction || chr(10) || chr(10) || 'Input:' || chr(10) || input || chr(10) || 'assistant: ' || output"


@query(
    "job_payload",
    f"""SELECT 'alpaca' AS format, split, id, task_type, {_RECORD_TEXT} AS content FROM alpaca JOIN split USING (id)
        UNION ALL SELECT 'chat', split, id, task_type, {_CHAT_TEXT} FROM alpaca JOIN split USING (id)
        UNION ALL SELECT 'manifest', '', name, '', CAST(n AS VARCHAR) FROM (SELECT
          unnest(['rows', 'chunk_count', 'total_records', 'summarize', 'classify', 'keypoints', 'train_records', 'val_records']) AS name,
          unnest([(SELECT count(*) FROM papers), (SELECT count(*) FROM chunk_records), count(*), count(*) FILTER (WHERE task_type = 'summarize'),
            count(*) FILTER (WHERE task_type = 'classify'), count(*) FILTER (WHERE task_type = 'keypoints'),
            count(*) FILTER (WHERE split = 'train'), count(*) FILTER (WHERE split = 'val')]) AS n FROM alpaca JOIN split USING (id))""",
    ("papers", "chunk_records", "alpaca", "split"),
)
def job_payload(spark, sf_dir):
    """The records of both formats as they were written, and the counts of the manifest."""
    root = fresh_path(spark, "payload")
    row = build_payload(spark, fx.papers(spark, sf_dir), root)
    common, message = "id string, task_type string, split string", "array<struct<role: string, content: string>>"
    alpaca = spark.read.schema(f"{common}, instruction string, input string, output string").json(f"{root}/alpaca")
    chat = spark.read.schema(f"{common}, messages {message}").json(f"{root}/chat")
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(": "), m["content"])), "\n")
    parts = {"alpaca": (alpaca, F.concat_ws("\n", "instruction", "input", "output")), "chat": (chat, said)}
    records = [rows.select(F.lit(name).alias("format"), "split", "id", "task_type", text.alias("content")) for name, (rows, text) in parts.items()]
    counts = row.select("source.rows", "chunking.chunk_count", "payload.total_records", "payload.task_counts.*", "payload.train_records", "payload.val_records")
    counts = counts.unpivot([], counts.columns, "id", "n")
    blank = F.lit("")
    told = counts.select(F.lit("manifest").alias("format"), blank.alias("split"), "id", blank.alias("task_type"), F.col("n").cast("string").alias("content"))
    return reduce(DataFrame.unionByName, [*records, told])


_FEED_PAPERS = "(SELECT *, string_split(categories, '|') AS categories_json FROM feed WHERE reject_reason = '')"


@query(
    "job_full_run",
    f"""SELECT 'table' AS part, unnest(['clean_papers', 'paper_authors', 'pipeline_state', 'v_agent_papers', '{KEYWORD_VIEW}']) AS item,
               unnest([n, a, 1, n, (SELECT count(*) FROM ({SQL_KEYWORDS.replace("FROM papers", f"FROM {_FEED_PAPERS} papers")}))]) AS n
        FROM (SELECT count(*) AS n, count(*) + count(*) FILTER (WHERE author_2 <> '') AS a FROM feed WHERE reject_reason = '')
        UNION ALL SELECT '{KEYWORD_VIEW}', word, frequency FROM ({SQL_KEYWORDS.replace("FROM papers", f"FROM {_FEED_PAPERS} papers")})
        UNION ALL SELECT '{PAIR_VIEW}', category_a || '|' || category_b, n FROM ({_SQL_PAIRS.replace("FROM papers", f"FROM {_FEED_PAPERS} papers")})
        UNION ALL SELECT f.format, paper_key || '|' || title, length(summary) FROM {_FEED_PAPERS} papers, (VALUES ('csv'), ('parquet')) f(format)""",
    ("feed",),
)
def job_full_run(spark, sf_dir):
    """The flow run twice over the same pages: the second run changes nothing. Tables, views and both exports after it."""
    landing, root = land_feed_pages(spark, sf_dir), fresh_path(spark, "full-run")
    run_all(spark, landing, root, "feed", page_format="parquet", as_of=AS_OF)
    told = run_all(spark, landing, root, "feed", page_format="parquet", as_of=AS_OF)
    views = StoredViews(spark, root).current()
    stored = spark.read.parquet(f"{root}/export/papers_parquet")
    copies = {"csv": files.read_csv(spark, f"{root}/export/papers_csv", stored.schema), "parquet": stored}
    parts = [
        told.select(F.lit("table").alias("part"), F.col("name").alias("item"), F.col("row_count").alias("n")),
        views[KEYWORD_VIEW].select(F.lit(KEYWORD_VIEW).alias("part"), F.col("word").alias("item"), F.col("frequency").alias("n")),
        views[PAIR_VIEW].select(F.lit(PAIR_VIEW).alias("part"), F.concat_ws("|", "category_a", "category_b").alias("item"), F.col("co_paper_count").alias("n")),
    ]
    for name, copy in copies.items():
        parts.append(copy.select(F.lit(name).alias("part"), F.concat_ws("|", "paper_key", "title").alias("item"), F.length("summary").cast("bigint").alias("n")))
    return reduce(DataFrame.unionByName, parts)

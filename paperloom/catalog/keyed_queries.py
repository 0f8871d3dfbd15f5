"""Catalog: keyed upserts, ingest state and constraint checks.

The batch of each upsert query is the whole table again with about half of its keys moved, so it holds
inserts and replacements, and the target also holds rows the batch leaves alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.catalog import fixtures as fx
from paperloom.catalog.registry import query
from paperloom.catalog.view_queries import _STATE, state_rows
from paperloom.operators import keyed, quality
from paperloom.operators.keyed import KeyedTable
from paperloom.plans.reviews import raw_review_rows
from paperloom.session import fresh_path, land
from paperloom.streaming.feed_ingest import author_rows, last_in_feed, watermark_of, window_bounds

_STAMP = "2024-06-01 00:00:00"


def _stamp() -> Column:
    return F.lit(_STAMP).cast("timestamp_ntz")


def _merged(target: str, batch: str, keys: str) -> str:
    """Oracle text: target rows without a batch row of the key, and the batch rows."""
    return f"SELECT t.* FROM ({target}) t ANTI JOIN ({batch}) b USING ({keys}) UNION ALL SELECT * FROM ({batch})"


# --- generic ----------------------------------------------------------------------------------

_LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
_LAST = ", ".join(f"last.{c} AS {c}" for c in _LINE_COLUMNS[2:])
SQL_LAST_LINES = f"""SELECT l_orderkey, l_linenumber, {_LAST} FROM (
  SELECT l_orderkey, l_linenumber, max(struct_pack({', '.join(f'{c} := {c}' for c in _LINE_COLUMNS[2:])})) AS last
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""


def _lines(spark, sf_dir) -> DataFrame:
    return fx.table(spark, sf_dir, "lineitem").select(*_LINE_COLUMNS)


@query("up_dedupe_last", SQL_LAST_LINES)
def up_dedupe_last(spark, sf_dir):
    return keyed.dedupe_last(_lines(spark, sf_dir), ["l_orderkey", "l_linenumber"], list(_LINE_COLUMNS[2:]))


_MOVED_KEY = "CAST(CAST(paper_key AS BIGINT) * 2 AS STRING)"
_PAPER_BATCH = (
    f"SELECT * REPLACE ({_MOVED_KEY} AS paper_key, 'b2' AS batch_id, title || ' (2)' AS title, "
    f"TIMESTAMP '{_STAMP}' AS loaded_at) FROM ({fx.SQL_EXPORTED})"
)


def _paper_batch(papers: DataFrame) -> DataFrame:
    return papers.withColumns(
        {
            "paper_key": F.expr(_MOVED_KEY),
            "batch_id": F.lit("b2"),
            "title": F.concat("title", F.lit(" (2)")),
        }
    )


_SQL_PAPER_UPSERT = _merged(fx.SQL_EXPORTED, _PAPER_BATCH, "paper_key")


@query("up_merge", _SQL_PAPER_UPSERT, ("papers",))
def up_merge(spark, sf_dir):
    papers = fx.exported(spark, sf_dir)
    return keyed.upsert(papers, _paper_batch(papers), ["paper_key"], ["published_at"], {"loaded_at": _stamp()})


@query("sink_upsert", _SQL_PAPER_UPSERT, ("papers",))
def sink_upsert(spark, sf_dir):
    """The same upsert through a stored table: two loads, one of them sent twice, then a fold."""
    papers = fx.exported(spark, sf_dir)
    stored = KeyedTable(spark, fresh_path(spark, "papers-table"), papers.schema, ("paper_key",))
    stored.upsert(papers, ["published_at"], "load-1")
    for _ in range(2):
        stored.upsert(_paper_batch(papers), ["published_at"], "load-2", {"loaded_at": _stamp()})
    stored.fold()
    return stored.current()


# --- the stored tables ------------------------------------------------------------------------

_MOVED_ROW = "CASE WHEN event_id % 2 = 0 THEN event_id ELSE event_id + 1000000000 END"
_REVIEW_BATCH_EXPRS = {
    **fx.REVIEW_EXPRS,
    "unnamed_0": f"CASE WHEN event_id % 50 = 0 THEN NULL ELSE CAST({_MOVED_ROW} AS STRING) END",
    "row_number": _MOVED_ROW,
}


def _review_batch(spark, sf_dir) -> DataFrame:
    events = fx.table(spark, sf_dir, "events")
    return fx.derive(events, _REVIEW_BATCH_EXPRS)


def _review_batch_sql() -> str:
    return "(" + fx._select(_REVIEW_BATCH_EXPRS, "events") + ")"


_PAYLOAD = [c for c in fx.REVIEW_EXPRS if c != "row_number"]


def _raw_sql(source: str, batch: str) -> str:
    return (
        f"SELECT {fx.SQL_REVIEW_HASH} AS row_hash, '{batch}' AS batch_id, row_number, 'file' AS source_url, "
        f"{', '.join(_PAYLOAD)} FROM {source}"
    )


@query("up_raw_reviews", _merged(_raw_sql("reviews", "b1"), _raw_sql(_review_batch_sql(), "b2"), "row_hash"), ("reviews",))
def up_raw_reviews(spark, sf_dir):
    target = raw_review_rows(fx.reviews_raw(spark, sf_dir), "b1", "file")
    batch = raw_review_rows(_review_batch(spark, sf_dir), "b2", "file")
    merged = keyed.upsert(target, batch, ["row_hash"], ["row_number"])
    payload = F.from_json("row_data", ", ".join(f"{c} string" for c in _PAYLOAD))
    return merged.withColumn("p", payload).select("row_hash", "batch_id", "row_number", "source_url", "p.*")


_CLEAN = (
    "review_key, row_hash, row_number, review_id, clothing_id, age, title, review_text, rating, recommended_ind, "
    "positive_feedback_count, division_name, department_name, class_name"
)


_REJECTED = ("row_hash", "row_number", quality.REASON)


def _scored_batch(raw: DataFrame, batch: str, columns: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """The clean and the rejected rows, landed with their reasons and as many ``columns`` as the table takes."""
    wanted = dict.fromkeys((*columns, quality.REASON))
    scored = land(quality.typed_reviews(raw).select(*wanted), "scored-reviews").withColumn("batch_id", F.lit(batch))
    return quality.split_by_reason(scored)


def _clean_sql(source: str, batch: str) -> str:
    return f"SELECT {_CLEAN}, '{batch}' AS batch_id FROM ({fx.sql_typed(source)}) WHERE reject_reason = ''"


@query("up_clean_reviews", _merged(_clean_sql("reviews", "b1"), _clean_sql(_review_batch_sql(), "b2"), "review_key"), ("reviews",))
def up_clean_reviews(spark, sf_dir):
    columns = tuple(_CLEAN.split(", "))
    target = _scored_batch(fx.reviews_raw(spark, sf_dir), "b1", columns)[0]
    batch = _scored_batch(_review_batch(spark, sf_dir), "b2", columns)[0]
    return keyed.upsert(target, batch, ["review_key"], ["row_number"])


def _rejected_sql(source: str, batch: str) -> str:
    return (
        f"SELECT row_hash, row_number, reject_reason, '{batch}' AS batch_id "
        f"FROM ({fx.sql_typed(source)}) WHERE reject_reason <> ''"
    )


@query(
    "up_rejected_reviews",
    _merged(_rejected_sql("reviews", "b1"), _rejected_sql(_review_batch_sql(), "b2"), "row_hash"),
    ("reviews",),
)
def up_rejected_reviews(spark, sf_dir):
    target = _scored_batch(fx.reviews_raw(spark, sf_dir), "b1", _REJECTED)[1]
    batch = _scored_batch(_review_batch(spark, sf_dir), "b2", _REJECTED)[1]
    return keyed.upsert(target, batch, ["row_hash"], ["row_number"])


_ENTRY_BATCH = "CASE WHEN start_index % 4 = 0 THEN paper_key ELSE paper_key || '9' END"


def _entries_sql(columns: str, where: str = "true") -> str:
    first = f"SELECT paper_key, {columns}, 'b1' AS batch_id, 1 AS page_number FROM feed WHERE {where}"
    second = f"SELECT {_ENTRY_BATCH} AS paper_key, {columns}, 'b2' AS batch_id, 2 AS page_number FROM feed WHERE {where}"
    return _merged(first, second, "paper_key")


def _entry_loads(spark, sf_dir, columns: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Two loads of the feed records with their reasons; the second one with half of the keys moved."""
    scored = fx.scored_records(spark, sf_dir, ("paper_key", *columns, "start_index", quality.REASON))
    second = scored.withColumn("paper_key", F.expr(_ENTRY_BATCH))
    return (
        scored.withColumns({"batch_id": F.lit("b1"), "page_number": F.lit(1)}),
        second.withColumns({"batch_id": F.lit("b2"), "page_number": F.lit(2)}),
    )


def _upsert_entries(spark, sf_dir, columns: list[str], where: str = "true") -> DataFrame:
    first, second = _entry_loads(spark, sf_dir, tuple(columns))
    wanted = ["paper_key", *columns, "batch_id", "page_number"]
    order = "start_index"
    target = first.filter(where).select(*wanted)
    return keyed.upsert(target, second.filter(where).select(*wanted, order), ["paper_key"], [order])


_CLEAN_ENTRY = (
    "versioned_id, title, summary, primary_category, author_count, first_author, authors_preview, arxiv_url, pdf_url, "
    "journal_ref"
)


@query("up_raw_entries", _entries_sql(_CLEAN_ENTRY), ("feed",))
def up_raw_entries(spark, sf_dir):
    return _upsert_entries(spark, sf_dir, _CLEAN_ENTRY.split(", "))


@query("up_clean_papers", _entries_sql(_CLEAN_ENTRY, "reject_reason = ''"), ("feed",))
def up_clean_papers(spark, sf_dir):
    return _upsert_entries(spark, sf_dir, _CLEAN_ENTRY.split(", "), f"{quality.REASON} = ''")


@query(
    "up_rejected_entries",
    # A NULL key never conflicts: the rows of both loads stay.
    _merged(
        "SELECT nullif(paper_key, '990') AS paper_key, reject_reason, 'b1' AS batch_id FROM feed WHERE reject_reason <> ''",
        f"SELECT nullif({_ENTRY_BATCH}, '990') AS paper_key, reject_reason, 'b2' AS batch_id FROM feed WHERE reject_reason <> ''",
        "paper_key",
    ),
    ("feed",),
)
def up_rejected_entries(spark, sf_dir):
    loads = [
        load.filter(f"{quality.REASON} <> ''").select(
            F.nullif("paper_key", F.lit("990")).alias("paper_key"), quality.REASON, "batch_id", "start_index"
        )
        for load in _entry_loads(spark, sf_dir)
    ]
    return keyed.upsert(loads[0].drop("start_index"), loads[1], ["paper_key"], ["start_index"])


@query(
    "up_authors",
    """SELECT paper_key, 1 AS author_order, author_1 || CASE WHEN start_index % 6 = 0 THEN ' II' ELSE '' END AS author_name
       FROM feed WHERE reject_reason = ''
       UNION ALL SELECT paper_key, 2, author_2 FROM feed WHERE reject_reason = '' AND author_2 <> '' AND start_index % 6 <> 0""",
    ("feed",),
)
def up_authors(spark, sf_dir):
    """Stored author rows; a third of the papers comes again with a changed first and without its second author."""
    scored = fx.scored_records(spark, sf_dir)
    clean = quality.split_by_reason(scored.withColumn("landed_at", F.lit(0).cast("timestamp")))[0]
    rows = author_rows(clean).select("paper_key", "author_order", "author_name", "start_index")
    stored = KeyedTable(spark, fresh_path(spark, "authors-table"), rows.drop("start_index").schema, ("paper_key", "author_order"))
    stored.upsert(rows, ["start_index"])
    again = rows.filter("start_index % 6 = 0")
    changed = again.filter("author_order = 1").withColumn("author_name", F.concat("author_name", F.lit(" II")))
    stored.upsert(changed, ["start_index"], gone=again)
    return stored.current()


@query(
    "up_state",
    f"""SELECT * FROM ({_STATE}) WHERE source_name <> 'fr' UNION ALL
        SELECT source_name, watermark_published_at + INTERVAL 1 DAY, watermark_paper_key, 'b9', updated_at
        FROM ({_STATE}) WHERE source_name = 'fr'""",
    ("papers",),
)
def up_state(spark, sf_dir):
    state = state_rows(spark, sf_dir)
    moved = state.filter("source_name = 'fr'").withColumns(
        {
            "watermark_published_at": F.col("watermark_published_at") + F.make_dt_interval(F.lit(1)),
            "last_batch_id": F.lit("b9"),
        }
    )
    return keyed.upsert(state, moved, ["source_name"], ["watermark_published_at"])


# --- state ------------------------------------------------------------------------------------


@query(
    "st_get_watermark",
    f"""SELECT source_name, watermark_published_at, watermark_paper_key, last_batch_id FROM ({_STATE})
        WHERE source_name = 'en'""",
    ("papers",),
)
def st_get_watermark(spark, sf_dir):
    return watermark_of(state_rows(spark, sf_dir), "en")


@query(
    "st_window_bounds",
    f"""SELECT 'en' AS source_name, watermark_published_at - INTERVAL 10 MINUTE AS window_start,
               TIMESTAMP '{_STAMP}' AS window_end FROM ({_STATE}) WHERE source_name = 'en'
        UNION ALL SELECT 'unseen', TIMESTAMP '{_STAMP}' - INTERVAL 180 DAY, TIMESTAMP '{_STAMP}'""",
    ("papers",),
)
def st_window_bounds(spark, sf_dir):
    state = state_rows(spark, sf_dir)
    bounds = [
        window_bounds(state, name, _stamp()).select(F.lit(name).alias("source_name"), "*") for name in ("en", "unseen")
    ]
    return bounds[0].unionByName(bounds[1])


@query(
    "st_new_watermark",
    """SELECT CAST(ts AS TIMESTAMP) AS published_at, CAST(event_id AS STRING) AS paper_key FROM events
       ORDER BY date_trunc('day', ts) DESC, user_id DESC, event_id DESC LIMIT 1""",
)
def st_new_watermark(spark, sf_dir):
    """Events as feed entries: a day's pages land together, the user is the page, the event number the place in it."""
    entries = fx.table(spark, sf_dir, "events").select(
        F.col("ts").alias("published_at"), F.col("event_id").cast("string").alias("paper_key"),
        F.date_trunc("day", "ts").alias("landed_at"), F.col("user_id").alias("start_index"),
        F.col("event_id").alias("entry_position"), F.lit("page").alias("page_file"),
    )
    return last_in_feed(entries)


# --- checks -----------------------------------------------------------------------------------


@query(
    "q_batch_counts",
    """SELECT 'papers' AS name, count(*) AS row_count FROM papers WHERE batch_id = 'b1'
       UNION ALL SELECT 'authors', count(*) FROM authors WHERE batch_id = 'b1'""",
    ("papers", "authors"),
)
def q_batch_counts(spark, sf_dir):
    return quality.count_rows({"papers": fx.papers(spark, sf_dir), "authors": fx.authors(spark, sf_dir)}, "b1")


@query(
    "q_null_violations",
    "SELECT count(*) AS null_rows FROM papers WHERE comment IS NULL OR journal_ref IS NULL OR title IS NULL",
    ("papers",),
)
def q_null_violations(spark, sf_dir):
    return quality.null_violations(fx.papers(spark, sf_dir), ["comment", "journal_ref", "title"])


@query(
    "q_duplicate_keys",
    """SELECT 'single' AS key, CAST(coalesce(sum(n) - count(*), 0) AS BIGINT) AS duplicate_rows
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)
       UNION ALL SELECT 'composite', CAST(coalesce(sum(n) - count(*), 0) AS BIGINT)
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def q_duplicate_keys(spark, sf_dir):
    lines = fx.table(spark, sf_dir, "lineitem")
    found = [
        quality.duplicate_key_rows(lines, keys).select(F.lit(name).alias("key"), "duplicate_rows")
        for name, keys in (("single", ["l_orderkey"]), ("composite", ["l_orderkey", "l_linenumber"]))
    ]
    return found[0].unionByName(found[1])


_NOT_NULL = ("title", "comment", "journal_ref", "doi", "pdf_url")


@query(
    "q_not_null",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM papers" for c in _NOT_NULL
    ),
    ("papers",),
)
def q_not_null(spark, sf_dir):
    return quality.not_null_violations(fx.papers(spark, sf_dir), list(_NOT_NULL))


@query(
    "q_unique",
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def q_unique(spark, sf_dir):
    return quality.unique_violations(fx.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "q_foreign_key",
    "SELECT a.paper_key, a.author_order, a.author_name FROM authors a ANTI JOIN papers p USING (paper_key)",
    ("authors", "papers"),
)
def q_foreign_key(spark, sf_dir):
    orphans = quality.foreign_key_violations(fx.authors(spark, sf_dir), fx.papers(spark, sf_dir), "paper_key")
    return orphans.select("paper_key", "author_order", "author_name")


@query(
    "q_cascade_delete",
    """SELECT a.paper_key, a.author_order, a.author_name FROM authors a
       SEMI JOIN (SELECT paper_key FROM papers WHERE primary_category <> 'en') p USING (paper_key)""",
    ("authors", "papers"),
)
def q_cascade_delete(spark, sf_dir):
    kept = fx.papers(spark, sf_dir).filter("primary_category <> 'en'")
    rows = quality.cascade_delete(fx.authors(spark, sf_dir), kept, "paper_key")
    return rows.select("paper_key", "author_order", "author_name")

"""Incremental feed ingest with a stored high-water mark, in batch or as a stream of landed pages."""

from __future__ import annotations

import json
from datetime import datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.folders import read_text
from paperloom.operators.keyed import last_landed, last_per_key
from paperloom.operators.quality import REASON, paper_checks, paper_reasons, split_by_reason
from paperloom.operators.selection import nth_key, up_to
from paperloom.plans.stored_views import StoredViews
from paperloom.plans.tables import CLEAN_PAPERS, INGEST_STATE, PAPER_AUTHORS, RAW_ENTRIES, REJECTED_ENTRIES
from paperloom.plans.views import in_categories, submitted_between
from paperloom.session import land, scratch
from paperloom.sinks.files import write_reject_sample
from paperloom.sources.feed import entry_records, page_entries, read_pages, stream_pages

LOOKBACK_DAYS = 180
OVERLAP_MINUTES = 10

# Feed order: when the page landed, its first index, the place in it; the file name only tells equals apart.
FEED_ORDER = ("landed_at", "start_index", "entry_position", "page_file")
# Number of a landed record, given as it is landed.
_ROW = "_record"


# --- watermark ---------------------------------------------------------------------------------


def watermark_of(state: DataFrame, source_name: str) -> DataFrame:
    """The state row of a source, or no row."""
    return state.filter(F.col("source_name") == source_name).select(
        "source_name", "watermark_published_at", "watermark_paper_key", "last_batch_id"
    )


def window_bounds(
    state: DataFrame,
    source_name: str,
    now: Column,
    lookback_days: int = LOOKBACK_DAYS,
    overlap_minutes: int = OVERLAP_MINUTES,
) -> DataFrame:
    """One row ``window_start``/``window_end``: from the watermark less the overlap, or from the
    look-back on a first run, until now. Re-read rows replace stored ones by key."""
    overlap = F.make_dt_interval(mins=F.lit(overlap_minutes))
    lookback = F.make_dt_interval(days=F.lit(lookback_days))
    seen = watermark_of(state, source_name).agg(F.max("watermark_published_at").alias("w"))
    return seen.select(
        F.coalesce(F.col("w") - overlap, now - lookback).alias("window_start"), now.alias("window_end")
    )


def last_in_feed(records: DataFrame, order: tuple[str, ...] = FEED_ORDER) -> DataFrame:
    """``published_at`` and ``paper_key`` of the last record in feed order, rejected ones included.

    No row when there is no record or that record has no date: the watermark then stays.
    """
    last = records.agg(
        F.max_by(F.struct("published_at", "paper_key"), F.struct(*order)).alias("_last")
    )
    return last.select("_last.*").filter("published_at IS NOT NULL")


# --- one load ----------------------------------------------------------------------------------


def cap_at_clean_rows(scored: DataFrame, max_papers: int, order: tuple[str, ...] = FEED_ORDER) -> DataFrame:
    """Records in feed order up to and including the ``max_papers``-th clean one; rejects do not count.

    The place of that record is found by counting clean records per range of the order, so nothing is sorted; the places
    are landed for it, as they are counted more than once.
    """
    places = land(scored.filter(F.col(REASON) == "").select(*order), "feed-places")
    last = nth_key(places, list(order), max_papers)
    return scored if last is None else scored.filter(up_to(last, scored, list(order)))


def author_rows(clean: DataFrame) -> DataFrame:
    """One row per named author of each paper; positions of unnamed authors stay open."""
    exploded = clean.select("paper_key", *FEED_ORDER, F.explode("authors").alias("author"))
    return exploded.filter(F.col("author.author_name") != "").select(
        "paper_key",
        "author.author_order",
        "author.author_name",
        "author.affiliation",
        F.to_json("author", {"ignoreNullFields": "false"}).alias("raw_payload"),
        *FEED_ORDER,
    )


def with_page_number(records: DataFrame) -> DataFrame:
    """Pages counted from 1 by their first index, in steps of the longest page of the load."""
    longest = records.agg(F.coalesce(F.max("entry_position") + 1, F.lit(1)).alias("n")).first().n
    return records.withColumn("page_number", (F.floor(F.col("start_index") / longest) + 1).cast("int"))


class FeedLoader:
    """Writes feed entries into the paper tables below ``root`` and moves the watermark last.

    Every write carries a commit id made of the load id and the table, so a repeated load skips what
    is already in and completes the rest; a load id that comes back with other records raises.

    All landed records are loaded: what the feed returned for a window is what belongs to it, and late
    rows replace stored ones by key. ``views`` are kept up with the papers, by the counts of what each load adds and
    replaces. The window is recorded with the raw rows. ``window_only`` is for bounded
    reloads of a landing folder that holds more than the window; the checks then tell how many records it left out.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        source_name: str,
        query_text: str = "",
        categories: list[str] | None = None,
        as_of: datetime | None = None,
        lookback_days: int = LOOKBACK_DAYS,
        overlap_minutes: int = OVERLAP_MINUTES,
        replace_children: bool = False,
        window_only: bool = False,
        views: StoredViews | None = None,
    ) -> None:
        self.spark, self.root, self.source_name = spark, root, source_name
        self.query_text, self.categories, self.replace_children = query_text, categories, replace_children
        self.window_only, self.left_out, self.views = window_only, 0, views
        self.raw, self.clean, self.authors, self.rejected, self.state = (
            spec.open(spark, root)
            for spec in (RAW_ENTRIES, CLEAN_PAPERS, PAPER_AUTHORS, REJECTED_ENTRIES, INGEST_STATE)
        )
        self.now = F.lit(as_of or datetime.now(timezone.utc))
        bounds = window_bounds(self.state.current(), source_name, self.now, lookback_days, overlap_minutes).first()
        self.start, self.end = F.lit(bounds.window_start), F.lit(bounds.window_end)

    def _selected(self, landed: DataFrame) -> DataFrame:
        """Records to load; with ``window_only`` those of the window, and undated ones, to be rejected with a reason."""
        if not self.window_only:
            return landed
        inside = submitted_between(landed, self.start, self.end, keep_undated=True)
        self.left_out = landed.count() - inside.count()
        return inside

    def _not_loaded(self, records: DataFrame) -> DataFrame:
        """Records that are not in the raw or reject table as they are, so that capped loads go on where they ended."""
        loaded = self.raw.current().select("row_hash").unionByName(self.rejected.current().select("row_hash"))
        return records.join(loaded, "row_hash", "left_anti")

    @staticmethod
    def _fingerprint(records: DataFrame) -> str:
        """What a load is made of: the number of records and the sum of the hashes of their contents."""
        parts = records.agg(F.count(F.lit(1)), F.sum(F.xxhash64("row_hash").cast("decimal(38,0)"))).first()
        return f"{parts[0]}:{parts[1] or 0}"

    def load(self, pages: DataFrame, load_id: str, max_papers: int = 0) -> DataFrame:
        """Load pages; returns the landed, scored records."""
        records = entry_records(page_entries(pages))
        records = in_categories(records, self.categories) if self.categories else records
        records = records.withColumn(REASON, paper_reasons()).withColumn(_ROW, F.monotonically_increasing_id())
        landed = with_page_number(land(records, "feed-records", "zstd"))
        content = self._fingerprint(landed)
        scored = self._selected(landed)
        if max_papers > 0:
            scored = land(cap_at_clean_rows(self._not_loaded(scored), max_papers), "feed-records", "zstd")
        scored = scored.withColumn("batch_id", F.lit(load_id)).withColumnRenamed("categories", "categories_json")
        clean, rejected = split_by_reason(scored)
        order, stamp = list(FEED_ORDER), F.current_timestamp()
        # Records hold whole texts and most keys have one, so that only what tells the last record of a key is shuffled.
        last = lambda rows: last_landed(rows, ["paper_key"], order, _ROW)
        self.raw.upsert(
            last(scored.filter("paper_key IS NOT NULL")).withColumns(
                {"source_query": F.lit(self.query_text), "source_start_at": self.start}
            ),
            order, f"{load_id}-raw", {"ingested_at": stamp}, content=content, single=True,
        )
        commit_id = f"{load_id}-clean"
        latest = last(clean)
        if self.views is not None:
            self.views.prepare(self.clean, latest, commit_id)
        self.clean.upsert(latest, order, commit_id, {"loaded_at": stamp}, content=content, single=True)
        if self.views is not None:
            self.views.apply(self.clean, commit_id)
        self._load_authors(clean, load_id, content)
        self.rejected.upsert(
            last(rejected).withColumnRenamed(REASON, "reason"), order, f"{load_id}-rejected", {"rejected_at": stamp}, content=content,
            single=True,
        )
        # A late page never takes the watermark back.
        seen = watermark_of(self.state.current(), self.source_name).agg(F.max("watermark_published_at").alias("w")).first().w
        newer = last_in_feed(scored)
        newest = (newer if seen is None else newer.filter(F.col("published_at") >= F.lit(seen))).select(
            F.lit(self.source_name).alias("source_name"),
            F.col("published_at").alias("watermark_published_at"),
            F.col("paper_key").alias("watermark_paper_key"),
            F.lit(load_id).alias("last_batch_id"),
        )
        self.state.upsert(newest, ["watermark_published_at"], f"{load_id}-state", {"updated_at": stamp}, content=content)
        return scored

    def _load_authors(self, clean: DataFrame, load_id: str, content: str) -> None:
        order, stamp = list(FEED_ORDER), {"loaded_at": F.current_timestamp()}
        commit_id = f"{load_id}-authors"
        if not self.replace_children:
            rows = author_rows(clean).withColumn("batch_id", F.lit(load_id))
            self.authors.upsert(rows, order, commit_id, stamp, content=content)
            return
        # Optional: a reloaded paper keeps only the authors of its last record; the others are marked as deleted.
        last = last_per_key(clean.select("paper_key", "authors", *order), ["paper_key"], order)
        rows = author_rows(last).withColumn("batch_id", F.lit(load_id))
        former = self.authors.current().join(last.select("paper_key"), "paper_key", "left_semi")
        self.authors.upsert(rows, order, commit_id, stamp, content=content, gone=former)

    def checks(self, load_id: str) -> DataFrame:
        """The load checks; for a bounded reload also the records outside of the window."""
        checks = paper_checks(
            self.raw.current(), self.clean.current(), self.authors.current(), self.rejected.current(), load_id
        )
        if not self.window_only:
            return checks
        outside = self.spark.range(1).select(F.lit("outside_window").alias("name"), F.lit(self.left_out).cast("bigint").alias("row_count"))
        return checks.unionByName(outside)


def ingest_feed(
    spark: SparkSession,
    landing: str,
    root: str,
    source_name: str,
    load_id: str | None = None,
    max_papers: int = 0,
    sample_path: str | None = None,
    page_format: str = "xml",
    landed_after: str | None = None,
    **settings,
) -> DataFrame:
    """Load of the landed pages; returns the load checks.

    With ``max_papers`` each run takes the next so many clean records that are not loaded yet. ``landed_after``
    (``YYYY-MM-DDTHH:mm:ss``) skips files that landed earlier without opening them; ``stream_feed`` remembers by
    itself which files it has loaded.
    """
    load_id = load_id or str(uuid4())
    loader = FeedLoader(spark, root, source_name, **settings)
    with scratch(spark):
        scored = loader.load(read_pages(spark, landing, page_format, landed_after), load_id, max_papers)
        if sample_path:
            rejects = scored.filter(F.col(REASON) != "").withColumnRenamed(REASON, "reason")
            columns = ["paper_key", "row_hash", "reason", "raw_payload"]
            write_reject_sample(rejects, sample_path, list(FEED_ORDER), columns, skip_empty=True)
    return loader.checks(load_id)


def stream_feed(
    spark: SparkSession,
    landing: str,
    root: str,
    source_name: str,
    checkpoint: str,
    files_per_batch: int | None = None,
    page_format: str = "xml",
    **settings,
) -> int:
    """Load every page file that landed since the last run, then stop; returns the batches loaded.

    The checkpoint remembers files, the tables remember commits: a micro-batch that is repeated
    after a failure changes nothing. Commit ids hold the id of the checkpoint, so another checkpoint folder never
    meets the commits of this one. Late rows replace stored ones.
    """
    loader = FeedLoader(spark, root, source_name, **settings)
    loaded = []

    def write_batch(pages: DataFrame, epoch: int) -> None:
        run = json.loads(read_text(spark, f"{checkpoint}/metadata"))["id"]
        with scratch(spark):
            loader.load(pages, f"{source_name}-{run}-{epoch}")
        loaded.append(epoch)

    query = (
        stream_pages(spark, landing, page_format, files_per_batch)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(loaded)

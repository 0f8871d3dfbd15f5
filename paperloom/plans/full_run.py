"""The whole flow in order, safe to run again, with a snapshot of row counts at the end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paperloom.operators.quality import count_rows
from paperloom.plans.export import keep_exported
from paperloom.plans.stored_views import KEYWORD_VIEW, StoredViews
from paperloom.plans.tables import CLEAN_PAPERS, INGEST_STATE, PAPER_AUTHORS
from paperloom.plans.views import agent_papers
from paperloom.streaming.feed_ingest import stream_feed


def refresh_views(spark: SparkSession, papers: DataFrame, root: str) -> dict[str, DataFrame]:
    """Rebuild the two stored views below ``root`` and register them by name; loads that are given the views keep them up."""
    views = StoredViews(spark, root)
    views.rebuild(papers)
    return views.current()


def snapshot(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of the named tables and views."""
    return count_rows(tables)


def run_all(
    spark: SparkSession, landing: str, root: str, source_name: str, csv_compression: str = "gzip", **settings
) -> DataFrame:
    """Feed load, stored views, export, then the snapshot. Running it twice leaves the same tables.

    The load opens only pages that landed since the last run; its checkpoint lies below ``root``. The views take what the load
    adds and replaces; they are not counted anew. Papers are exported again only if a load has changed them.
    A file of the CSV copy is read by one task in any case, so that it loses nothing by ``csv_compression``.
    """
    kept_up = StoredViews(spark, root)
    stream_feed(spark, landing, root, source_name, f"{root}/checkpoint-{source_name}", views=kept_up, **settings)
    stored = CLEAN_PAPERS.open(spark, root)
    papers, views = stored.current(), kept_up.current()
    export = f"{root}/export"
    keep_exported(spark, stored, f"{export}/papers_csv", f"{export}/papers_parquet", f"{export}/made_of.json", csv_compression)
    return snapshot(
        {
            "clean_papers": papers,
            "paper_authors": PAPER_AUTHORS.open(spark, root).current(),
            "pipeline_state": INGEST_STATE.open(spark, root).current(),
            "v_agent_papers": agent_papers(papers),
            KEYWORD_VIEW: views[KEYWORD_VIEW],
        }
    )

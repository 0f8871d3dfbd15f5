"""Stored views that follow the papers by signed counts, without being rebuilt.

Both stored views are sums over papers, so a load changes them by the counts of the rows it adds less the counts of the rows it
replaces. ``prepare`` writes these differences before the papers are committed; ``apply`` adds them to the views
afterwards. The differences are written ahead, as the replaced rows cannot be told once the commit is in: a load that failed
in between finds them when it is repeated, and commit ids keep them from being added twice.

A load reads its own rows and the stored rows of their keys (the buckets these fall into); ``apply`` reads the view rows of
the words and pairs that change.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.folders import delete, read_text, replace_text
from paperloom.operators.keyed import KeyedTable
from paperloom.plans.views import category_cooccurrence, keyword_frequency
from paperloom.session import land, scratch

KEYWORD_VIEW = "mv_agent_keyword_frequency"
PAIR_VIEW = "mv_agent_category_cooccurrence"


@dataclass(frozen=True)
class StoredView:
    """A view of counts per key over papers."""

    name: str
    build: Callable[[DataFrame], DataFrame]
    keys: tuple[str, ...]
    count: str

    def difference(self, added: DataFrame, replaced: DataFrame) -> DataFrame:
        """By how much the count of each key changes; keys that stay as they are have no row."""
        plus = self.build(added)
        minus = self.build(replaced).withColumn(self.count, -F.col(self.count))
        changed = plus.unionByName(minus).groupBy(*self.keys).agg(F.sum(self.count).alias(self.count))
        return changed.filter(F.col(self.count) != 0)


VIEWS = (
    StoredView(KEYWORD_VIEW, keyword_frequency, ("word",), "frequency"),
    StoredView(PAIR_VIEW, lambda papers: category_cooccurrence(papers, "categories_json"), ("category_a", "category_b"), "co_paper_count"),
)


class StoredViews:
    """The stored views below ``root``, as tables named like the views. Single writer, as the papers have."""

    #: Columns of the papers that the views are made of.
    READS = ("title", "summary", "categories_json")

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root

    def _table(self, view: StoredView, papers: DataFrame | None = None) -> KeyedTable:
        shape = "paper_key string, title string, summary string, categories_json array<string>"
        schema = view.build(papers if papers is not None else self.spark.createDataFrame([], shape)).schema
        return KeyedTable(self.spark, f"{self.root}/{view.name}", schema, view.keys)

    def _ahead(self, commit_id: str) -> str:
        return f"{self.root}/view-differences/{commit_id}"

    def rebuild(self, papers: DataFrame, commit_id: str | None = None) -> None:
        """Count all papers anew. Readers of the previous content are not disturbed: a rebuild is a folder and a commit."""
        for view in VIEWS:
            self._table(view).replace(view.build(papers), commit_id)

    def prepare(self, papers: KeyedTable, added: DataFrame, commit_id: str) -> None:
        """Write what the commit will change; ``added`` has one row per key. To be called before the papers are committed.

        Nothing is done where the commit is in already, or the views have yet to be built. Differences that a failed
        run left are used again only if the papers are as they were then.
        """
        if papers.has(commit_id) or any(self._table(view).commits() == 0 for view in VIEWS):
            return
        path, seen = self._ahead(commit_id), papers.commits()
        left = read_text(self.spark, f"{path}/written.json")
        if left is not None and json.loads(left)["commits"] == seen:
            return
        delete(self.spark, path)
        with scratch(self.spark):
            rows = land(added.select(*papers.keys, *self.READS), "view-rows")
            keys = rows.select(*papers.keys).filter(F.col(papers.keys[0]).isNotNull())
            replaced = land(papers.matching(keys).select(*papers.keys, *self.READS), "view-rows")
            for view in VIEWS:
                view.difference(rows, replaced).write.parquet(f"{path}/{view.name}")
        replace_text(self.spark, f"{path}/written.json", json.dumps({"commits": seen}))

    def apply(self, papers: KeyedTable, commit_id: str) -> None:
        """Add the differences of a commit that is in. Where there are none to be found, the views are counted anew."""
        path = self._ahead(commit_id)
        written = read_text(self.spark, f"{path}/written.json") is not None
        for view in VIEWS:
            table = self._table(view)
            if table.has(commit_id):
                continue
            if not written:
                table.replace(view.build(papers.current()), commit_id)
                continue
            with scratch(self.spark):
                self._add(table, view, self.spark.read.schema(table.schema).parquet(f"{path}/{view.name}"), commit_id)
        delete(self.spark, path)

    def _add(self, table: KeyedTable, view: StoredView, difference: DataFrame, commit_id: str) -> None:
        stored = table.matching(difference.select(*view.keys)).withColumnRenamed(view.count, "_stored")
        total = F.coalesce("_stored", F.lit(0)) + F.col(view.count)
        sums = difference.join(stored, list(view.keys), "left").select(*view.keys, total.alias(view.count))
        wrong = F.raise_error(F.lit(f"{view.name} counts less than the rows that were replaced; rebuild it"))
        sums = land(sums.withColumn(view.count, F.when(F.col(view.count) >= 0, F.col(view.count)).otherwise(wrong)), "view-sums")
        gone = sums.filter(F.col(view.count) == 0).select(*view.keys)
        table.upsert(sums.filter(F.col(view.count) > 0), [view.count], commit_id, gone=gone)

    def current(self) -> dict[str, DataFrame]:
        """The views by name, registered under it."""
        found = {view.name: self._table(view).current() for view in VIEWS}
        for name, rows in found.items():
            rows.createOrReplaceTempView(name)
        return found

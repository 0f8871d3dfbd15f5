"""Keyed upserts on plain Parquet.

A ``KeyedTable`` is a base folder per bucket of keys plus a few change folders, named in one small pointer file.
An upsert writes only its batch; reading takes buckets without changes as they are and, in the others, keeps the
base rows that no change replaces. After some commits the change folders are combined into one; buckets
are rewritten only once their changes have grown to a fair share of them. Folders that nothing names any
more are removed after a while.
"""

from __future__ import annotations

import json
import time
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from paperloom.folders import delete, names, read_text, replace_text, size
from paperloom.session import land


def dedupe_last(batch: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """The last row of each key by ``sequence``; ties fall to the larger remaining values.

    Spark keeps the first row of each key in every task before the shuffle, so a key with very many rows costs
    one row per task, and whole rows are never held in aggregation buffers. Map columns cannot be
    ordered and do not break ties.
    """
    rest = [
        f.name for f in batch.schema.fields
        if f.name not in (*keys, *sequence) and "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"
    ]
    newest_first = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in (*sequence, *rest)])
    return batch.withColumn("_place", F.row_number().over(newest_first)).filter("_place = 1").drop("_place")


def merge(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with the rows of ``batch`` inserted or replaced; ``batch`` has one row per key.

    A NULL in a key never matches, so such rows of both sides stay. They are given a spread number as
    an extra join column, or the shuffle would send them all to one task.
    """
    spread = "_spread"
    has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    spread_nulls = F.when(has_null, F.monotonically_increasing_id()).otherwise(F.lit(0))
    # Always 0, but not a constant to the optimizer, which would take it out of the join columns.
    zero = F.pmod(F.hash(*keys), F.lit(1)).cast("bigint")
    left = target.withColumn(spread, spread_nulls)
    right = batch.select(*keys, zero.alias(spread))
    kept = left.join(right, [*keys, spread], "left_anti").drop(spread)
    return kept.unionByName(batch.select(*target.columns))


def last_per_key(batch: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """``dedupe_last`` in which rows with a NULL in the key never meet each other and all stay."""
    if not any(batch.schema[k].nullable for k in keys):
        return dedupe_last(batch, keys, sequence)
    lone = "_lone_row"
    has_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    marked = batch.withColumn(lone, F.when(has_null, F.monotonically_increasing_id()))
    return dedupe_last(marked, [*keys, lone], sequence).drop(lone)


def last_landed(batch: DataFrame, keys: list[str], sequence: list[str], row: str) -> DataFrame:
    """``last_per_key`` of landed rows that have a unique number in ``row``, which breaks ties; whole rows stay where they lie.

    Only keys, sequence and numbers are shuffled, combined in each task first. Of keys with several rows, few as a rule, the
    last row is landed, so its size is known: Spark sends it to all tasks below its threshold and joins by key above.
    """
    last, times, key = "_last", "_times", [f"_key_{k}" for k in keys]
    known = ~reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    newest = F.max(F.struct(*sequence, row))[row].alias(last)
    repeated = batch.filter(known).groupBy(*[F.col(k).alias(c) for k, c in zip(keys, key, strict=True)])
    repeated = repeated.agg(newest, F.count(F.lit(1)).alias(times)).filter(F.col(times) > 1).drop(times)
    found = land(repeated, "repeated-keys")
    same = reduce(Column.__and__, [F.col(k) == F.col(c) for k, c in zip(keys, key, strict=True)])
    return batch.join(found, same, "left").filter(F.col(last).isNull() | (F.col(last) == F.col(row))).select(*batch.columns)


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], sequence: list[str], stamp: dict[str, Column] | None = None
) -> DataFrame:
    """Last row per key of ``batch`` into ``target``; ``stamp`` sets columns such as the load time.

    The reduced batch is landed: the merge reads it twice, as keys and as rows. Rows of the batch with
    a NULL key are all appended.
    """
    changes = land(last_per_key(batch, keys, sequence).withColumns(stamp or {}), "upsert-batch")
    return merge(target, changes, keys)


_BUCKET = "_bucket"
_GONE = "_gone"
# So many commit ids are remembered; a repeated load comes soon after the first or carries other rows.
_REMEMBERED = 1000


@dataclass(frozen=True)
class KeyedTable:
    """One stored table with a unique key. Single writer; any number of readers.

    Rows lie in ``buckets`` folders by the hash of the first key column. ``live.json`` names the base folder of
    each bucket, the change folders on top, and what is dead; it is replaced in one step. Dead folders are removed
    once they have been dead for ``keep_hours``, so a reader that has begun can finish.
    """

    spark: SparkSession
    root: str
    schema: T.StructType
    keys: tuple[str, ...]
    buckets: int = 16
    keep_hours: float = 24.0

    # --- the pointer ---

    def _live(self) -> dict:
        text = read_text(self.spark, f"{self.root}/live.json")
        if text is None:
            return {"seq": 0, "buckets": self.buckets, "base": {}, "changes": [], "recent": {}, "dead": []}
        return json.loads(text)

    def _publish(self, live: dict, dead: list[str]) -> None:
        """Make ``live`` the state of the table and remove what has been dead for long."""
        now = time.time()
        gone = [path for path, since in live["dead"] if now - since >= self.keep_hours * 3600]
        live["dead"] = [[p, s] for p, s in live["dead"] if p not in gone] + [[p, now] for p in dead]
        live["recent"] = dict(list(live["recent"].items())[-_REMEMBERED:])
        live["seq"] += 1
        replace_text(self.spark, f"{self.root}/live.json", json.dumps(live))
        for path in gone:
            delete(self.spark, f"{self.root}/{path}")

    @staticmethod
    def _known(live: dict, commit_id: str, content: str) -> bool:
        """Whether the commit is in already; raises if it was made of something else."""
        if commit_id not in live["recent"]:
            return False
        if live["recent"][commit_id] != content:
            raise ValueError(f"Commit {commit_id} has been made already, from other rows")
        return True

    # --- reading ---

    def _read(self, folders: list[str], marks: bool = False) -> DataFrame:
        schema = T.StructType([*self.schema.fields, T.StructField(_GONE, T.BooleanType())]) if marks else self.schema
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    @staticmethod
    def _base_folders(live: dict, which=lambda bucket: True) -> list[str]:
        return [f"{path}/{_BUCKET}={bucket}" for bucket, path in live["base"].items() if which(int(bucket))]

    @staticmethod
    def _touched(live: dict) -> set[int]:
        return {bucket for change in live["changes"] for bucket in change["buckets"]}

    def _latest_changes(self, live: dict) -> DataFrame:
        order = "_change"
        stacked = reduce(
            DataFrame.unionByName,
            [
                self._read([f"{c['path']}/{_BUCKET}={b}" for b in c["buckets"]], True).withColumn(order, F.lit(c["seq"]))
                for c in live["changes"]
            ],
        )
        latest = last_per_key(stacked, list(self.keys), [order]) if len(live["changes"]) > 1 else stacked
        return latest.drop(order)

    def _merged(self, live: dict, only: DataFrame | None = None) -> DataFrame:
        """The rows of the buckets that have changes; with ``only`` those of its keys."""
        touched = self._touched(live)
        base = self._read(self._base_folders(live, touched.__contains__)).withColumn(_GONE, F.lit(False))
        changes = self._latest_changes(live)
        if only is not None:
            base, changes = (side.join(only, list(self.keys), "left_semi") for side in (base, changes))
        return merge(base, changes, list(self.keys)).filter(~F.col(_GONE)).drop(_GONE)

    def current(self) -> DataFrame:
        """The rows as they are after the last commit; only buckets with changes are joined."""
        live = self._live()
        if not live["changes"]:
            return self._read(self._base_folders(live))
        touched = self._touched(live)
        still = self._base_folders(live, lambda bucket: bucket not in touched)
        merged = self._merged(live)
        return self._read(still).unionByName(merged) if still else merged

    def matching(self, wanted: DataFrame) -> DataFrame:
        """The current rows of the keys in ``wanted`` (distinct, landed); opens only the buckets these keys fall into."""
        live = self._live()
        places = wanted.select(self._place(live["buckets"])).distinct().collect()
        buckets = {row[0] for row in places}
        changes = [change | {"buckets": [b for b in change["buckets"] if b in buckets]} for change in live["changes"]]
        near = live | {
            "base": {b: path for b, path in live["base"].items() if int(b) in buckets},
            "changes": [change for change in changes if change["buckets"]],
        }
        touched = self._touched(near)
        still = self._read(self._base_folders(near, lambda bucket: bucket not in touched))
        found = still.join(wanted, list(self.keys), "left_semi")
        return found.unionByName(self._merged(near, wanted)) if touched else found

    def content(self) -> str:
        """Names the rows as they are after the last commit: folders are never written again under a name."""
        live = self._live()
        return json.dumps([sorted(live["base"].items()), [[c["path"], sorted(c["buckets"])] for c in live["changes"]]])

    def commits(self) -> int:
        """How many commits the table has had."""
        return self._live()["seq"]

    def has(self, commit_id: str) -> bool:
        """Whether a commit is in, as far back as ids are remembered."""
        return commit_id in self._live()["recent"]

    # --- writing ---

    def upsert(
        self,
        batch: DataFrame,
        sequence: list[str],
        commit_id: str | None = None,
        stamp: dict[str, Column] | None = None,
        combine_after: int = 16,
        content: str = "",
        gone: DataFrame | None = None,
        single: bool = False,
    ) -> bool:
        """Commit the last row per key of ``batch``. Returns False when ``commit_id`` is already in.

        A batch known to have a ``single`` row per key is written where it lies, without a shuffle.

        ``content`` tells what the commit is made of; an id that returns with another content raises. Keys in
        ``gone`` that the batch does not hold are deleted. The change folder is written in full before the pointer
        names it, so a failed or repeated run leaves the table as it was or as it should be.
        """
        commit_id = commit_id or uuid4().hex
        live = self._live()
        if self._known(live, commit_id, content):
            return False
        changes = (batch if single else last_per_key(batch, list(self.keys), sequence)).withColumns(stamp or {})
        changes = self._typed(changes).withColumn(_GONE, F.lit(False))
        if gone is not None:
            removed = gone.select(*self.keys).distinct().join(changes.select(*self.keys), list(self.keys), "left_anti")
            changes = changes.unionByName(removed.withColumn(_GONE, F.lit(True)), allowMissingColumns=True)
        live["recent"][commit_id] = content
        if not live["base"] and not live["changes"]:
            rows = changes.filter(~F.col(_GONE)).drop(_GONE)
            path, filled = self._store(rows, "base", live["buckets"], dealt=True)
            live["base"] = {str(b): path for b in filled}
            self._publish(live, [])
            return True
        path, filled = self._store(changes, "change", live["buckets"], dealt=True)
        live["changes"].append({"path": path, "seq": live["seq"], "buckets": filled})
        self._publish(live, [])
        if len(live["changes"]) >= combine_after:
            self.combine()
        return True

    def _typed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(f.name).cast(f.dataType) for f in self.schema.fields])

    def _place(self, buckets: int) -> Column:
        return F.pmod(F.xxhash64(F.col(self.keys[0])), F.lit(buckets)).cast("int")

    def _store(self, rows: DataFrame, kind: str, buckets: int, dealt: bool = False) -> tuple[str, list[int]]:
        """Write rows by bucket, sorted by key in each; the folder and the buckets in it. Texts and payloads are packed with zstd.

        Rows without a first key match nothing; they are spread by all they hold. Rows that a shuffle has ``dealt`` out by key are
        written where they are, at most a file per task and bucket; shuffling them whole once more would save files only.
        """
        path = f"{kind}/{uuid4().hex}"
        others = [F.col(f.name) for f in self.schema.fields if "map<" not in f.dataType.simpleString()]
        place = F.when(F.col(self.keys[0]).isNull(), F.pmod(F.xxhash64(*others), F.lit(buckets)).cast("int")).otherwise(self._place(buckets))
        placed = rows.withColumn(_BUCKET, place)
        spread = placed if dealt else placed.hint("rebalance", _BUCKET)
        # The writer sorts by bucket anyway; with the key behind it, bounds of row groups tell where a key may be.
        spread.sortWithinPartitions(_BUCKET, *self.keys).write.partitionBy(_BUCKET).parquet(f"{self.root}/{path}", compression="zstd")
        found = [n for n in names(self.spark, f"{self.root}/{path}") if n.startswith(f"{_BUCKET}=")]
        return path, sorted(int(n.split("=")[1]) for n in found)

    def combine(self, base_share: float = 0.25) -> None:
        """Write all changes as one; fold them into the base once they reach ``base_share`` of the buckets they touch."""
        live = self._live()
        if not live["changes"]:
            return
        old = [change["path"] for change in live["changes"]]
        path, filled = self._store(self._latest_changes(live), "change", live["buckets"])
        live["changes"] = [{"path": path, "seq": live["seq"], "buckets": filled}]
        self._publish(live, old)
        base = sum(self._bytes(f) for f in self._base_folders(live, set(filled).__contains__))
        if self._bytes(path) >= base_share * base:
            self.fold()

    def _bytes(self, path: str) -> int:
        return size(self.spark, f"{self.root}/{path}")

    def replace(self, rows: DataFrame, commit_id: str | None = None, content: str = "") -> bool:
        """Make ``rows`` (one per key) the whole content, for rebuilt snapshots.

        Returns False when ``commit_id`` is already in.
        """
        commit_id = commit_id or uuid4().hex
        live = self._live()
        if self._known(live, commit_id, content):
            return False
        path, filled = self._store(self._typed(rows), "base", live["buckets"])
        old = self._base_folders(live) + [change["path"] for change in live["changes"]]
        live |= {"base": {str(b): path for b in filled}, "changes": []}
        live["recent"][commit_id] = content
        self._publish(live, old)
        return True

    def fold(self) -> None:
        """Write the buckets that have changes as new base folders; the others stay as they are."""
        live = self._live()
        if not live["changes"]:
            return
        touched = self._touched(live)
        path, filled = self._store(self._merged(live), "base", live["buckets"], dealt=True)
        old = self._base_folders(live, touched.__contains__) + [change["path"] for change in live["changes"]]
        live["base"] = {b: p for b, p in live["base"].items() if int(b) not in touched} | {str(b): path for b in filled}
        live["changes"] = []
        self._publish(live, old)

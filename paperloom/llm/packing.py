"""Best-fit packing of documents into fixed windows, without conflicts inside a window.

A bin holds at most ``capacity`` tokens, at most one piece of a duplicate cluster and, if asked for, at
most one document of a source. Bins stand in order of what is left in them and carry bitmaps of their sources
and clusters. The longest document goes first, into the tightest bin that takes it: the search starts at the
smallest sufficient residual and goes on to the next until a bin is compatible, else a new bin is opened.

A text longer than the capacity is cut into full pieces, each a bin of its own, and one rest. Rows
are dealt by hash into shards of about ``shard_rows``, packed independently; so no task holds an
unbounded group, and a hot source or cluster is spread evenly. A shard leaves a few bins part-filled.

Defined cases: no tokens (null or empty text): one piece of length 0 without a bin; a null source or cluster
conflicts with nothing; equal lengths go by id; repeated rows are packed as rows; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import WORD_PATTERN, shipped

PACKED = "piece int, start_token bigint, n_tokens bigint, bin_id bigint, bin_offset bigint"


def word_tokens(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_PATTERN)).cast("long")


class Bins:
    """Open bins by residual. ``left`` has a bit for each residual that some bin has."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.at: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.left = 0
        self.maps: list[int] = []
        self.used: list[int] = []

    def open(self, size: int, bits: int) -> int:
        self.maps.append(bits)
        self.used.append(size)
        self._file(len(self.maps) - 1)
        return len(self.maps) - 1

    def _file(self, number: int) -> None:
        residual = self.capacity - self.used[number]
        if residual:
            self.at[residual].append(number)
            self.left |= 1 << residual

    def place(self, size: int, bits: int) -> tuple[int, int]:
        """The bin and the offset of an item: the tightest compatible bin, the oldest among equals."""
        rest = self.left >> size
        residual = size
        while rest:
            step = (rest & -rest).bit_length() - 1
            residual += step
            row = self.at[residual]
            for index, number in enumerate(row):
                if not self.maps[number] & bits:
                    del row[index]
                    if not row:
                        self.left &= ~(1 << residual)
                    offset = self.used[number]
                    self.used[number] += size
                    self.maps[number] |= bits
                    self._file(number)
                    return number, offset
            rest >>= step + 1
            residual += 1
        return self.open(size, bits), 0


def pack_rows(sizes: list[int], sources: list, clusters: list, keys: list, capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(row, piece, start, size, bin, offset) for each piece; bin -1 for rows without tokens."""
    bits: dict = {}
    many = Counter(("c", c) for c in clusters if c is not None) + Counter(("s", s) for s in sources if s is not None)
    for value, times in many.items():
        if times > 1:  # whatever occurs once in the shard conflicts with nothing
            bits[value] = 1 << len(bits)
    bins, out = Bins(capacity), []
    rest: list[tuple[int, int, int]] = []
    masks = [bits.get(("c", c), 0) | bits.get(("s", s), 0) for c, s in zip(clusters, sources, strict=True)]
    for row, size in enumerate(sizes):
        full, tail = divmod(size, capacity)
        out += [(row, piece, piece * capacity, capacity, bins.open(capacity, masks[row]), 0) for piece in range(full)]
        if tail:
            rest.append((tail, row, full))
        elif not size:
            out.append((row, 0, 0, 0, -1, 0))
    for size, row, piece in sorted(rest, key=lambda x: (-x[0], keys[x[1]] is not None, keys[x[1]] or 0, x[1])):
        number, offset = bins.place(size, masks[row])
        out.append((row, piece, piece * capacity, size, number, offset))
    return out


def pack(
    docs: DataFrame, size: Column, key: str = "doc_id", source: Column | None = None, cluster: Column | None = None,
    capacity: int = 2048, shard_rows: int = 4096,
) -> DataFrame:
    """``key``, ``source``, ``cluster`` and the columns of ``PACKED``, one row per piece.

    ``source`` and ``cluster`` are what must not meet in a bin; leave one out to allow it.
    """
    none = F.lit(None).cast("string")
    # rows of a key that would fill a shard are dealt by their place, all others by what they are
    counts = docs.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__rows"))
    often = counts.where(F.col("__rows") > shard_rows).select("__key", F.lit(True).alias("__often"))
    salt = F.when(F.col("__often"), F.monotonically_increasing_id())
    items = shipped(docs).join(F.broadcast(often), F.col(key).eqNullSafe(F.col("__key")), "left").select(
        salt.alias("_salt"), F.col(key).alias("_key"), (source if source is not None else none).cast("string").alias("_source"),
        (cluster if cluster is not None else none).cast("string").alias("_cluster"), size.cast("long").alias("_size"),
    )
    shards = max(1, -(-docs.count() // shard_rows))
    dealt = items.withColumn("_shard", F.pmod(F.xxhash64("_key", "_size", "_cluster", "_salt"), F.lit(shards))).drop("_salt")
    kind = items.schema["_key"].dataType.simpleString()

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_key", "ascending"), ("_size", "ascending"), ("_cluster", "ascending")])
        keys, sources, clusters, sizes, shard = (table.column(c).to_pylist() for c in table.column_names)
        packed = pack_rows(sizes, sources, clusters, keys, capacity)
        rows, pieces, starts, lengths, numbers, offsets = zip(*packed, strict=True)
        chosen = table.select(["_key", "_source", "_cluster"]).take(pa.array(rows, pa.int64()))
        ids = [None if n < 0 else (shard[0] << 32) | n for n in numbers]
        arrays = [
            *chosen.columns, pa.array(pieces, pa.int32()), pa.array(starts, pa.int64()),
            pa.array(lengths, pa.int64()), pa.array(ids, pa.int64()), pa.array(offsets, pa.int64()),
        ]
        return pa.table(arrays, names=[key, "source", "cluster", "piece", "start_token", "n_tokens", "bin_id", "bin_offset"])

    return dealt.groupBy("_shard").applyInArrow(run, f"`{key}` {kind}, source string, cluster string, {PACKED}")

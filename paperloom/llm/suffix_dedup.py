"""Removal of repeated byte strings with suffix arrays over shards.

A byte goes if it is covered by a string of ``length`` bytes that also starts anywhere else, in the same
document or another one. All texts together are far too long for one suffix array, so the windows of ``length``
bytes are first dealt to shards in such a way that equal windows always meet:

1. Each window is owned by its minimizer, the ``KMER``-byte string in it with the smallest hash (the
   leftmost among equals). Neighbouring windows mostly share it; what one occurrence of a minimizer owns
   is a segment of at most ``2 * length`` bytes. Equal windows have equal minimizers.
2. Segments are sorted by minimizer and by a hash of their bytes. A segment that occurs twice is repeated as a
   whole; a minimizer with a single segment repeats nothing. Only different segments of one minimizer
   are left to compare, one of each kind.
3. Shards of such segments get a suffix array by induced sorting. Among the suffixes that start owned windows,
   neighbours in order that share ``length`` bytes (permuted common prefixes) are repeated windows.
   A minimizer with more than ``HOT_BYTES`` of segments would fill a shard by itself; its windows are counted by a
   128-bit digest instead, with partial aggregation.
4. Spans come back to their documents, which are cut once.

Scale: per document only about one row per 80 bytes is shuffled; rows are sorted in the shuffle and streamed, so
neither a hot minimizer nor a passage in a third of the documents gathers in memory.

Defined cases: null text is empty; texts shorter than ``length`` keep all bytes; a row is identified by its id
and its text, rows repeated as a whole are copies of each other and lose everything; null ids are
an id of their own; an empty table gives an empty result; columns of the input are kept as they are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.common import shipped
from paperloom.llm.induced import common_prefixes, suffix_array
from paperloom.session import land

KMER = 32
CHUNK = 1 << 20
SHARD_BYTES = 1 << 20
HOT_BYTES = 1 << 22
_PLACE = 24
_LOW = np.uint64((1 << _PLACE) - 1)


# --- minimizers -------------------------------------------------------------------------------------

def _kmer_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the ``KMER`` bytes at each place, by doubling."""
    table = np.random.default_rng(7).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    h, factor, width = table[data], 0xD1342543DE82EF95, 1
    while width < KMER:
        h = h[:-width] * np.uint64(factor) + h[width:]
        factor, width = factor * factor & ((1 << 64) - 1), 2 * width
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def segments(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(text, first window, last window, minimizer, hash of the bytes) of each segment of these texts."""
    out: list[tuple[np.ndarray, ...]] = []
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def flush() -> None:
        nonlocal held, size
        if held:
            out.append(_segments(held, length))
        held, size = [], 0

    for number, text in enumerate(texts):
        if len(text) < length:
            continue
        # pieces of a very long text overlap such that each window lies in exactly one of them
        for start in range(0, len(text) - length + 1, 4 * CHUNK):
            piece = text[start : start + 4 * CHUNK + length - 1]
            held.append((number, start, piece))
            size += len(piece)
            if size >= CHUNK:
                flush()
    flush()
    if not out:
        return tuple(np.empty(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _segments(pieces: list[tuple[int, int, bytes]], length: int) -> tuple[np.ndarray, ...]:
    raw = b"".join(p for _, _, p in pieces)
    data = np.frombuffer(raw, np.uint8)
    sizes = np.array([len(p) for _, _, p in pieces])
    starts = np.cumsum(sizes) - sizes
    hashes = _kmer_hashes(data)
    least = (hashes & ~_LOW) | np.arange(len(hashes), dtype=np.uint64)
    span = length - KMER + 1
    width = 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if span > width:
        least = np.minimum(least[: len(least) - (span - width)], least[span - width :])
    # windows that lie inside one piece
    windows = sizes - length + 1
    inside = np.repeat(starts - (np.cumsum(windows) - windows), windows) + np.arange(windows.sum())
    owner = least[inside]
    new = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
    first = inside[new]
    last = inside[np.append(new[1:], len(inside)) - 1]
    at = (owner[new] & _LOW).astype(np.int64)
    piece = np.searchsorted(starts, first, "right") - 1
    view = memoryview(raw)
    digest = xxhash.xxh3_64_intdigest
    bodies = np.fromiter((digest(view[a : b + length]) for a, b in zip(first.tolist(), last.tolist(), strict=True)), np.uint64, len(first))
    numbers = np.array([n for n, _, _ in pieces])[piece]
    shift = np.array([s for _, s, _ in pieces])[piece] - starts[piece]
    return numbers, first + shift, last + shift, hashes[at].view(np.int64), bodies.view(np.int64)


SEGMENT = "k bigint, s bigint, id bigint, place bigint, first bigint, last bigint"


def segment_rows(texts: DataFrame, length: int) -> DataFrame:
    """One row per segment of ``texts`` (id, place, text)."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1000):
                some = batch.slice(start, 1000)
                values = [(t or "").encode() for t in some.column(2).to_pylist()]
                number, first, last, k, s = segments(values, length)
                rows = some.select([0, 1]).take(pa.array(number))
                arrays = [pa.array(k), pa.array(s), *rows.columns, pa.array(first), pa.array(last)]
                yield pa.RecordBatch.from_arrays(arrays, names=["k", "s", "id", "place", "first", "last"])

    return texts.mapInArrow(run, SEGMENT)


# --- what repeats as a whole, and what is left to compare ------------------------------------------------

def sift(rows: DataFrame) -> DataFrame:
    """Segments that matter: ``whole`` if its bytes occur again, ``compare`` for one of each kind that shares its minimizer.

    Streams over rows sorted by minimizer and bytes; what it holds between batches is two rows.
    """
    names = ["k", "s", "id", "place", "first", "last"]

    def run(batches):
        held = None  # the last row so far: its values, whether it equals the row before it
        lead, many = None, False  # first row of its minimizer (value, whole) until a second kind comes; whether one came

        def out(columns, whole, compare):
            keep = whole | compare
            picked = [pa.array(c[keep]) for c in (*columns[2:], columns[0])]
            return pa.RecordBatch.from_arrays(
                [*picked, pa.array(whole[keep]), pa.array(compare[keep])], names=["id", "place", "first", "last", "k", "whole", "compare"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [np.asarray(c) for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(([v], c)) for v, c in zip(held[0], columns, strict=True)]
            k, s = columns[0], columns[1]
            n = len(k)
            as_before = np.zeros(n, bool)
            as_before[1:] = (k[1:] == k[:-1]) & (s[1:] == s[:-1])
            new_k = np.ones(n, bool)
            new_k[1:] = k[1:] != k[:-1]
            starts = ~as_before
            if held is not None:
                as_before[0], new_k[0], starts[0] = held[1], True, held[2]
            group = np.cumsum(new_k) - 1
            kinds = np.bincount(group, weights=starts).astype(np.int64)
            if held is not None:
                kinds[0] += 0 if starts[0] else 1
                if many:
                    kinds[0] = max(kinds[0], 2)
            compare = starts & (kinds[group] > 1)
            as_next = np.zeros(n, bool)
            as_next[:-1] = (k[1:] == k[:-1]) & (s[1:] == s[:-1])
            whole = as_before | as_next
            extra = []
            if held is not None and lead is not None and kinds[0] > 1 and not many:
                extra = [lead]  # a row already passed by, now known to be one of several kinds
            if extra:
                one = [np.array([v]) for v in extra[0]]
                yield out(one, np.zeros(1, bool), np.ones(1, bool))
            # the state of the last minimizer
            tail = n - 1
            last_group = group == group[tail]
            carried = held is not None and group[tail] == 0
            many_now = bool(kinds[group[tail]] > 1)
            if many_now:
                lead_now = None
            elif carried and (lead is not None or not starts[0]):
                lead_now = lead
            else:
                begin = int(np.flatnonzero(last_group)[0])
                lead_now = None if begin == tail else tuple(c[begin] for c in columns)
            yield out([c[:-1] for c in columns], whole[:-1], compare[:-1])
            held = ([c[tail] for c in columns], bool(as_before[tail]), bool(starts[tail]))
            lead, many = lead_now, many_now
        if held is not None:
            one = [np.array([v]) for v in held[0]]
            yield out(one, np.array([held[1]]), np.array([held[2] and many]))

    ordered = rows.select(*names).repartition("k").sortWithinPartitions("k", "s", "id", "place", "first")
    return ordered.mapInArrow(run, "id bigint, place bigint, first bigint, last bigint, k bigint, whole boolean, compare boolean")


# --- shards -----------------------------------------------------------------------------------------------

def repeated_windows(bodies: list[bytes], length: int) -> list[np.ndarray]:
    """For each segment, which of its windows equal a window of another one, by a suffix array of them all."""
    owned = np.array([len(b) - length + 1 for b in bodies])
    sizes = np.array([len(b) + 1 for b in bodies])
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"\0".join(bodies) + bytes(length + 9), np.uint8)
    text = data[: int(sizes.sum())].astype(np.uint16) + np.uint16(1)
    text[starts + sizes - 1] = 0
    order = suffix_array(text, 257, length)
    is_owned = np.zeros(len(text) + 1, np.int32)
    np.add.at(is_owned, starts, 1)
    np.add.at(is_owned, starts + owned, -1)
    is_owned = np.cumsum(is_owned[:-1]) > 0
    order = order[is_owned[order]]
    repeated = common_prefixes(data, order, length) >= length
    found = np.zeros(len(text), bool)
    found[order[repeated]] = True
    found[order[:-1][repeated[1:]]] = True
    return [found[a : a + n] for a, n in zip(starts.tolist(), owned.tolist(), strict=True)]


def _runs(flags: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edges[::2].tolist(), (edges[1::2] - 1).tolist(), strict=True))


SPAN = "id bigint, place bigint, start bigint, stop bigint"


def _span_table(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
    return pa.table([pa.array(c, pa.int64()) for c in columns], names=["id", "place", "start", "stop"])


def shard_spans(pieces: DataFrame, length: int, shards: int) -> DataFrame:
    """Repeated spans of the segments that are not repeated as a whole."""

    def run(table: pa.Table) -> pa.Table:
        flags = repeated_windows(table.column("body").to_pylist(), length)
        ids, places, firsts, whole = (table.column(c).to_pylist() for c in ("id", "place", "first", "whole"))
        return _span_table([
            (ids[i], places[i], firsts[i] + a, firsts[i] + b + length)
            for i, flag in enumerate(flags) if not whole[i] for a, b in _runs(flag)
        ])

    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("k"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(run, SPAN)


def counted_spans(pieces: DataFrame, length: int) -> DataFrame:
    """The same for the windows of hot minimizers, by digests of windows."""

    def run(batches):
        for batch in batches:
            rows = []
            for id_, place, first, body in zip(*(batch.column(c).to_pylist() for c in ("id", "place", "first", "body")), strict=True):
                rows += [(xxhash.xxh3_128_digest(body[i : i + length]), id_, place, first + i) for i in range(len(body) - length + 1)]
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["digest", "id", "place", "start"])

    windows = pieces.mapInArrow(run, "digest binary, id bigint, place bigint, start bigint")
    many = windows.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    return windows.join(many, "digest", "left_semi").select("id", "place", "start", (F.col("start") + length).alias("stop"))


# --- whole operator ------------------------------------------------------------------------------------------

def keyed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """id, place and text: what identifies a row, and its text."""
    return docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-1)).alias("id"), F.xxhash64(text).alias("place"), F.col(text).alias("text"))


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """``id``, ``place``, ``start``, ``stop``: spans of bytes to remove; they may overlap."""
    texts = keyed(shipped(docs), key, text)
    sifted = land(sift(segment_rows(texts, length)), "segments")
    compare = sifted.where("compare")
    sizes = compare.groupBy("k").agg(F.sum(F.col("last") - F.col("first") + length).alias("bytes"))
    total = sizes.where(F.col("bytes") <= HOT_BYTES).agg(F.sum("bytes")).first()[0] or 0
    hot = land(sizes.where(F.col("bytes") > HOT_BYTES).select("k", F.lit(True).alias("hot")), "hot-segments")
    marked = compare.join(hot, "k", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    by_doc = marked.groupBy("id", "place").agg(F.collect_list(F.struct("k", "first", "last", "whole", "hot")).alias("wanted"))
    # rows repeated as a whole give their segments once
    found = texts.join(by_doc, ["id", "place"]).dropDuplicates(["id", "place"])

    def cut(batches):
        for batch in batches:
            ids, places, values, wanted = (batch.column(c).to_pylist() for c in ("id", "place", "text", "wanted"))
            rows = []
            for id_, place, value, parts in zip(ids, places, values, wanted, strict=True):
                raw = value.encode()
                rows += [(p["k"], id_, place, p["first"], p["whole"], p["hot"], raw[p["first"] : p["last"] + length]) for p in parts]
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["k", "id", "place", "first", "whole", "hot", "body"])

    pieces = found.select("id", "place", "text", "wanted").mapInArrow(
        cut, "k bigint, id bigint, place bigint, first bigint, whole boolean, hot boolean, body binary"
    )
    if not hot.isEmpty():
        pieces = land(pieces, "pieces")
    shards = max(1, -(-total // SHARD_BYTES))
    spans = sifted.where("whole").select("id", "place", F.col("first").alias("start"), (F.col("last") + length).alias("stop"))
    spans = spans.unionByName(shard_spans(pieces.where("not hot").drop("hot"), length, shards))
    if not hot.isEmpty():
        spans = spans.unionByName(counted_spans(pieces.where("hot").select("id", "place", "first", "body"), length))
    return spans


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs: spans that overlap or touch become one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            if stop > out[-1][1]:
                out[-1] = (out[-1][0], stop)
        else:
            out.append((start, stop))
    return out


def without(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, stop in runs:
        kept.append(raw[at:start])
        at = stop
    return b"".join([*kept, raw[at:]])


def _spans_by_document(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    spans = repeated_spans(docs, key, text, length)
    return spans.groupBy(F.col("id").alias("__id"), F.col("place").alias("__place")).agg(
        F.collect_set(F.struct("start", "stop")).alias("__spans")
    )


def _with_spans(docs: DataFrame, key: str, text: str, length: int) -> DataFrame:
    marked = docs.withColumns({"__id": F.coalesce(F.col(key).cast("long"), F.lit(-1)), "__place": F.xxhash64(text)})
    return marked.join(_spans_by_document(docs, key, text, length), ["__id", "__place"], "left").drop("__id", "__place")


def _runs_of(value) -> list[tuple[int, int]]:
    return merged([(s["start"], s["stop"]) for s in value or ()])


def digests(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200) -> DataFrame:
    """Per row: its id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept_sha256``."""
    rows = _with_spans(docs.select(key, text), key, text, length)

    def run(batches):
        for batch in batches:
            out = []
            for value, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                raw, runs = (value or "").encode(), _runs_of(spans)
                out.append((len(raw), sum(b - a for a, b in runs), len(runs), hashlib.sha256(without(raw, runs)).hexdigest()))
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            arrays = [pa.array(c, pa.int64()) for c in columns[:3]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays, pa.array(columns[3], pa.string())], names=[key, "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            )

    kind = docs.schema[key].dataType.simpleString()
    return rows.select(key, text, "__spans").mapInArrow(
        run, f"`{key}` {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    )


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = 200, size: str | None = None) -> DataFrame:
    """The rows of ``docs`` with repeated bytes taken out of their texts; half characters at the edges go too.

    ``size`` names a column that holds the number of characters and follows the text.
    """
    rows = _with_spans(docs, key, text, length)
    at = docs.columns.index(text)

    def run(batches):
        for batch in batches:
            texts = []
            for value, spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                runs = _runs_of(spans)
                if runs and value is not None:
                    raw, kept, begin = value.encode(), [], 0
                    for start, stop in [*runs, (len(raw), len(raw))]:
                        kept.append(raw[begin:start].decode(errors="ignore"))
                        begin = stop
                    value = "".join(kept)
                texts.append(value)
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    cleaned = rows.select(*[F.col(f"`{c}`") for c in docs.columns], "__spans").mapInArrow(run, docs.schema)
    return cleaned.withColumn(size, F.length(text).cast(docs.schema[size].dataType)) if size else cleaned

"""Periodic runs of words: stretches that repeat a group of words three times or more, found by internal pattern matching.

A text is cut into blocks of 8, 16, 32, ... words. A run with period q holds a whole block of about q words whose copy lies q
words on, so it is enough to ask for the occurrences of every block in the window behind it: of 8-word blocks at
distances below 16, of larger ones at distances from one to two block lengths. Such occurrences form one arithmetic
progression, so three questions per window tell all of it: how many there are, the first and the second. One or two
occurrences are candidate periods themselves; of three or more, the candidates are the step and the distances at which the
ends of the two stretches that repeat at that step coincide. Each candidate is extended to both sides as far as it
holds; stretches that are long enough are runs, and of candidates with equal ends the smallest period is the period.

Tables per slice of texts (about ``AT_ONCE`` words, several texts side by side with a separator of their own): names of
all stretches of 1, 2, 4, ... words (equal names, equal words), the suffix array that the largest of them give, and a wavelet
tree over that array. An occurrence query is a range successor query: a block's occurrences are a range of the suffix
array (those of equal name), and the tree counts the places below a limit in a range and gives the i-th smallest place.
Names also tell how far two places agree. Texts in which no 8 words occur twice have no runs and skip the tables.

Cost: n log n per text in numpy, no shuffle; a task holds one slice, or one text if that is longer.

Defined cases: null or empty text has no words, no runs and an empty collapsed text; null ids are kept; repeated rows are
rows; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import shipped

#: The smallest block, and by it the shortest run whose blocks are certain to be whole.
SMALLEST = 3
AT_ONCE = 200_000
WORDS_KNOWN = 1_000_000


class Names:
    """Names of the stretches of 2**k words at each place; the order of names is that of the stretches."""

    def __init__(self, text: np.ndarray, top: int) -> None:
        self.text = text
        order = np.argsort(text, kind="stable")
        self.levels = [self._named(order, text[order])]
        for k in range(top):
            now, n = self.levels[k], len(text)
            behind = np.full(n, -1, np.int64)
            behind[: max(n - (1 << k), 0)] = now[1 << k :]
            # places with a name of their own keep it; the others are told apart by what follows
            common = np.zeros(n, bool)
            common[:-1] = now[order[:-1]] == now[order[1:]]
            common[1:] |= common[:-1].copy()
            at = np.flatnonzero(common)
            if not len(at):
                self.levels.append(now)
                continue
            key = now[order[at]].astype(np.int64) * (n + 1) + behind[order[at]] + 1
            by_key = np.argsort(key, kind="stable")
            order[at] = order[at][by_key]
            names = now.copy()
            names[order[at]] = self._starts(key[by_key], at)
            self.levels.append(names)
        self.order = order

    @staticmethod
    def _starts(key: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each place in order, where in the order its equals begin."""
        first = np.concatenate(([True], key[1:] != key[:-1]))
        return at[np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))]

    def _named(self, order: np.ndarray, key: np.ndarray) -> np.ndarray:
        names = np.empty(len(order), np.int32)
        names[order] = self._starts(key, np.arange(len(order)))
        return names

    def agree_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words from the places ``a < b`` on are the same. The text ends in a separator, which stops it."""
        far = np.zeros(len(a), np.int64)
        top = len(self.levels) - 1
        alive = np.arange(len(a))
        while len(alive):
            alive = alive[self.levels[top][a[alive] + far[alive]] == self.levels[top][b[alive] + far[alive]]]
            far[alive] += 1 << top
        for k in range(top - 1, -1, -1):
            far += (self.levels[k][a + far] == self.levels[k][b + far]).astype(np.int64) << k
        return far

    def agree_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many words in front of the places ``a < b`` are the same. The text starts with a separator."""
        far = np.zeros(len(a), np.int64)
        top = len(self.levels) - 1

        def same(k: int, which) -> np.ndarray:
            x, y = a[which] - far[which] - (1 << k), b[which] - far[which] - (1 << k)
            return (x >= 0) & (self.levels[k][np.maximum(x, 0)] == self.levels[k][np.maximum(y, 0)])

        alive = np.arange(len(a))
        while len(alive):
            alive = alive[same(top, alive)]
            far[alive] += 1 << top
        for k in range(top - 1, -1, -1):
            far += same(k, slice(None)).astype(np.int64) << k
        return far


class WaveletTree:
    """Counts and order statistics of any range of an array of different places, for many questions at once."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, len(values).bit_length())
        self.zeros = []  # per bit from the highest: zeros in front of each position
        for bit in range(self.bits - 1, -1, -1):
            ones = (values >> bit) & 1 == 1
            before = np.zeros(len(values) + 1, np.int32)
            np.cumsum(~ones, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate((values[~ones], values[ones]))

    def below(self, left: np.ndarray, right: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """How many values in ``[left, right)`` are below the limit."""
        found = np.zeros(len(left), np.int64)
        for level, before in enumerate(self.zeros):
            one = (limit >> (self.bits - 1 - level)) & 1 == 1
            left_zeros, right_zeros = before[left], before[right]
            found += np.where(one, right_zeros - left_zeros, 0)
            left = np.where(one, before[-1] + left - left_zeros, left_zeros)
            right = np.where(one, before[-1] + right - right_zeros, right_zeros)
        return found

    def smallest(self, left: np.ndarray, right: np.ndarray, number: np.ndarray) -> np.ndarray:
        """The value with so many smaller ones in ``[left, right)``."""
        value = np.zeros(len(left), np.int64)
        for before in self.zeros:
            left_zeros, right_zeros = before[left], before[right]
            zeros = right_zeros - left_zeros
            one = number >= zeros
            value = 2 * value + one
            number = number - np.where(one, zeros, 0)
            left = np.where(one, before[-1] + left - left_zeros, left_zeros)
            right = np.where(one, before[-1] + right - right_zeros, right_zeros)
        return value


def _occurrences(tree: WaveletTree, left, right, low, high) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of occurrences in ``[low, high)``, the first and the second (meaningless beyond the number)."""
    n = len(tree.zeros[0]) - 1
    skipped = tree.below(left, right, np.minimum(low, n))
    times = tree.below(left, right, np.minimum(high, n)) - skipped
    first, second = np.full(len(left), -1, np.int64), np.full(len(left), -1, np.int64)
    some, more = np.flatnonzero(times > 0), np.flatnonzero(times > 1)
    first[some] = tree.smallest(left[some], right[some], skipped[some])
    second[more] = tree.smallest(left[more], right[more], skipped[more] + 1)
    return times, first, second


def _candidates(names: Names, tree: WaveletTree, starts: np.ndarray, lengths: np.ndarray, times: int):
    """Pairs of a place and a period that may hold around it."""
    sizes = lengths // times  # the longest period of each text
    n = len(names.text)
    for k in range(SMALLEST, len(names.levels)):
        size = 1 << k
        whole = np.where((sizes >= size) | (k == SMALLEST), lengths // size, 0)
        if not whole.any():
            continue
        block = np.arange(whole.sum()) - np.repeat(np.cumsum(whole) - whole, whole)
        places = np.repeat(starts, whole) + block * size
        level = names.levels[k]
        left = level[places].astype(np.int64)
        in_order = level[names.order]
        ends = np.append(np.flatnonzero(in_order[1:] != in_order[:-1]) + 1, n)
        right = ends[np.searchsorted(ends, left, "right")]
        often = right - left > 1
        places, left, right = places[often], left[often], right[often]
        for low, high in ((1, size + 1), (size, 2 * size)) if k == SMALLEST else ((size, 2 * size),):
            met, first, second = _occurrences(tree, left, right, places + low, places + high)
            some = met > 0
            yield places[some], first[some] - places[some]
            some = met > 1
            yield places[some], second[some] - places[some]
            some = np.flatnonzero(met > 2)
            at, other, step = places[some], first[some], second[some] - first[some]
            yield at, step
            before = names.agree_before(other, other + step) - names.agree_before(at, at + step)
            yield at, other - before - at
            after = names.agree_after(other, other + step) - names.agree_after(at, at + step)
            yield at, other + after - at


def runs_of(texts: list[np.ndarray], shortest: int = 24, times: int = 3) -> list[np.ndarray]:
    """Per text of word numbers (from 0) its runs as rows ``start, length, period``, by start, then period.

    A run is ``shortest`` words and ``times`` periods long at least; both may be raised, not lowered.
    """
    if shortest < 24 or times < 3:
        raise ValueError("runs shorter than 24 words or three periods hold no whole block")
    lengths = np.array([len(text) for text in texts], np.int64)
    starts = np.cumsum(lengths + 1) - lengths
    text = np.empty(int(lengths.sum()) + len(texts) + 1, np.int64)
    text[0] = -1
    for number, (start, words) in enumerate(zip(starts.tolist(), texts, strict=True)):
        text[start : start + len(words)] = words
        text[start + len(words)] = -2 - number
    longest = max(int(lengths.max(initial=0)) // times, 1 << SMALLEST)
    names = Names(text, longest.bit_length() - 1)
    tree = WaveletTree(names.order)
    found = [np.empty((0, 3), np.int64)]
    for at, period in _candidates(names, tree, starts, lengths, times):
        fits = (period > 0) & (at + period < len(text))
        key = np.unique(at[fits] * len(text) + period[fits])
        at, period = key // len(text), key % len(text)
        start = at - names.agree_before(at, at + period)
        length = at + period + names.agree_after(at, at + period) - start
        enough = (length >= shortest) & (length >= times * period)
        found.append(np.stack((start, length, period), 1)[enough])
    runs = np.concatenate(found)
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    again = np.zeros(len(runs), bool)
    again[1:] = (runs[1:, :2] == runs[:-1, :2]).all(1)
    runs = runs[~again]
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    owner = np.searchsorted(starts, runs[:, 0], "right") - 1
    runs[:, 0] -= starts[owner]
    return np.split(runs, np.searchsorted(owner, np.arange(1, len(texts))))


def with_repeats(texts: list[np.ndarray]) -> np.ndarray:
    """For each text whether some 8 words may occur twice in it (by 64-bit hashes: never missed, rarely said in vain)."""
    size = 1 << SMALLEST
    lengths = np.array([len(text) for text in texts], np.int64)
    flags = np.zeros(len(texts), bool)
    grams = np.maximum(lengths - size + 1, 0)
    if not grams.any():
        return flags
    mixed = (np.concatenate(texts).astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    value = np.zeros(len(mixed) - size + 1, np.uint64)
    for j in range(size):
        value = value * np.uint64(0xBF58476D1CE4E5B9) + mixed[j : j + len(value)]
    value ^= value >> np.uint64(31)
    owner = np.repeat(np.arange(len(texts)), lengths)[: len(value)]
    inside = np.arange(len(value)) + size <= np.cumsum(lengths)[owner]
    value, owner = value[inside], owner[inside]
    value = value * np.uint64(0x94D049BB133111EB) + owner.astype(np.uint64)
    order = np.argsort(value)
    equal = value[order[1:]] == value[order[:-1]]
    flags[owner[order[1:][equal]]] = True
    return flags


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words joined by a space, of each run only the first period."""
    if not len(runs):
        return b" ".join(words)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edges[:-1]) == 0)])


_known: defaultdict[bytes, int] = defaultdict(count().__next__)


def _numbered(words: list[list[bytes]]) -> list[np.ndarray]:
    global _known
    if len(_known) > WORDS_KNOWN:
        _known = defaultdict(count().__next__)
    return [np.fromiter(map(_known.__getitem__, some), np.int64, len(some)) for some in words]


def _slice_rows(keys: list, words: list[list[bytes]], shortest: int, times: int) -> pa.RecordBatch:
    texts = _numbered(words)
    runs = [np.empty((0, 3), np.int64)] * len(texts)
    repeating = np.flatnonzero(with_repeats(texts)).tolist()
    if repeating:
        for number, some in zip(repeating, runs_of([texts[i] for i in repeating], shortest, times), strict=True):
            runs[number] = some
    offsets = np.concatenate(([0], np.cumsum([len(r) for r in runs]))).astype(np.int32)
    rows = np.concatenate(runs)
    structs = pa.StructArray.from_arrays([pa.array(rows[:, i].copy()) for i in range(3)], ["start", "length", "period"])
    return pa.RecordBatch.from_pydict(
        {
            "doc_id": pa.array(keys, pa.int64()), "n_words": pa.array([len(w) for w in words], pa.int64()),
            "runs": pa.ListArray.from_arrays(offsets, structs),
            "collapsed": [collapsed(w, r).decode("utf-8", "replace") for w, r in zip(words, runs, strict=True)],
        }
    )


def periodic_runs(docs: DataFrame, shortest: int = 24, times: int = 3, key: Column | None = None, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (array of start, length, period; by start, then period) and ``collapsed`` text."""
    wanted = shipped(docs).select((F.col("doc_id") if key is None else key).cast("long"), F.col(text).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, words, held = [], [], 0
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                keys.append(key.as_py())
                words.append((value.as_py() or b"").split())  # cuts at exactly the six white-space characters
                held += len(words[-1]) + 1
                if held >= AT_ONCE:
                    yield _slice_rows(keys, words, shortest, times)
                    keys, words, held = [], [], 0
            if keys:
                yield _slice_rows(keys, words, shortest, times)

    schema = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
    return wanted.mapInArrow(run, schema)


# --- the report of the query ----------------------------------------------------------------------

def planted(docs: DataFrame, crc: Column) -> DataFrame:
    """``doc_id`` and ``text``; where ``crc % 10`` is 0, the words behind a place repeat with a period, both given by ``crc``."""
    some = (crc % 10 == 0) & F.col("text").isNotNull()
    split = docs.select(
        "doc_id", "text", F.floor(crc / 10).alias("__g"),
        F.when(some, F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))).alias("__words"),
    )
    sized = split.withColumn("__n", F.size("__words")).withColumn("__a", F.when(F.col("__n") > 0, F.col("__g") % F.col("__n")))
    sized = sized.withColumn("__p", 1 + F.floor((F.col("__n") - F.col("__a")) / (3 + F.col("__g") % 8)))
    a, p, words = F.col("__a"), F.col("__p"), F.col("__words")
    moved = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("__n") - F.lit(1).cast("long")),
        lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")),
    )
    return sized.select("doc_id", F.when(F.col("__n") > 0, F.array_join(moved, " ")).otherwise(F.col("text")).alias("text"))


def report(found: DataFrame) -> DataFrame:
    """The run with the greatest length per period and digests, per row of ``periodic_runs``."""
    def greater(x: Column, y: Column) -> Column:
        by_share = y["length"] * x["period"] - x["length"] * y["period"]
        return F.when(by_share != 0, F.signum(by_share)).when(
            x["start"] != y["start"], F.signum(x["start"] - y["start"])
        ).otherwise(F.signum(x["period"] - y["period"])).cast("int")

    line = lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))
    best = F.get(F.array_sort("runs", greater), F.lit(0))
    rows = found.withColumn("__best", best)
    lines = F.concat(F.array_join(F.transform("runs", line), "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("__best.start").alias("start"),
        F.col("__best.length").alias("length"), F.col("__best.period").alias("period"),
        F.floor(1000 * F.col("__best.length") / F.col("__best.period")).cast("long").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

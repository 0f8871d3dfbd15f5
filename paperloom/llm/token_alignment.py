"""Which tokens of one vocabulary end where tokens of another end: per document and per pair of ids over the corpus.

Every text is encoded twice, by a byte-level vocabulary (A) and by a sentencepiece vocabulary (B). Byte offsets at which a token
of each ends cut both rows of tokens into groups, and the two tokens that end there are linked. A pair of ids is counted over
all documents and its count goes back to each document that holds the pair.

The corpus is held as inverted bitmaps. Documents lie in blocks; a pair's posting in a block has one compressed bitmap per
bit of its multiplicity: plane j holds the documents in which bit j of the pair's number of links is set. A bitmap is a
sorted list of 16-bit places, or plain bits where these are shorter. Postings of parts of a block are OR-merged, plane by plane
(a document is in one part only). The population count of the OR of all planes is the number of documents, and the counts
of the planes, each times 2**j, give the number of links.

Spark's part: one pass writes rows of documents and postings; counts per pair are summed over salted partial sums, so a pair that
occurs in every block meets as many rows as there are salts; totals go back along the same two steps to the blocks; each
block reads its bitmaps once and adds the scores of its pairs to its documents. Only counts are shuffled by pair, bitmaps
only to their block. Encodings of common chunks of text are remembered per worker, up to ``Aligner.CHUNKS``; texts are cut
into chunks only where neither vocabulary has a token that reaches across.

Defined cases: texts that are null, empty, or that a vocabulary does not give back byte by byte have no tokens: zeros and an
empty ``groups_sha256``; null ids and repeated rows are kept as rows; an empty table gives no rows; other columns are not
looked at. Very long texts are a block of their own.
"""

from __future__ import annotations

import hashlib
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F
from tokenizers import Tokenizer

from paperloom.llm.common import shipped
from paperloom.llm.sentence_pieces import LATIN, SPACE, Pieces
from paperloom.session import land

#: A block ends with the document that reaches one of these; places in a block need 16 bits.
BLOCK_DOCS, BLOCK_LINKS = 32_768, 3_000_000
SALTS = 64
_PROBE = "Aa b  c\t\n d\ne it's 12,345 \xa0x ﬁ \U0001f600  z\n\ny </s><|endoftext|> "


def byte_of_character() -> dict[str, int]:
    """The visible characters that byte-level vocabularies write for bytes.

    Printable Latin-1 characters stand for themselves, all other bytes for the characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


# --- chunks ---------------------------------------------------------------------------------------

class Aligner:
    """Two vocabularies and what the chunks met so far give: numbers of tokens, groups as text, linked pairs."""

    CHUNKS = 700_000

    def __init__(self, bytewise: str, pieces: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.first = Tokenizer.from_str(bytewise)
        self.first.encode_special_tokens = True  # their strings in a text are plain text
        to_byte = byte_of_character()
        vocabulary = self.first.get_vocab(with_added_tokens=False)
        self.first_octets = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            if all(c in to_byte for c in token):
                self.first_octets[number] = bytes(to_byte[c] for c in token)
        self.second = Pieces(pieces)
        if "\n" in self.second.known or not self.second.cuts_at_spaces:
            raise ValueError("the second vocabulary has pieces that reach across spaces or line breaks")
        # in front of a space or line break behind a visible character, and between a word and a mark
        word = f"\\s*[{LATIN}]+(?=[ \\n{self.second.closing}]|\\Z)"
        self.chunks = re.compile(rf"{word}|\s*\S+(?:[^\S \n]\s*\S+)*(?:[^\S \n]\s*\Z)?|\s+").findall
        self.first_sizes = np.array([len(o) for o in self.first_octets], np.int64)
        self.second_sizes = np.array([len(o) for o in self.second.octets], np.int64)
        numbers = range(max(len(self.first_octets), self.second.size))
        self.between, self.middle, self.last = (np.array([f"{n}{mark}" for n in numbers], object) for mark in ",|;")
        whole = self._first_ids([" " + _PROBE])[0]
        if whole != list(chain.from_iterable(self._first_of(self.chunks(" " + _PROBE)))):
            raise ValueError("the first vocabulary does not cut words as byte-level vocabularies do")
        self._forget()

    def _first_ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.first.encode_batch_fast(texts, add_special_tokens=False)]

    def _first_of(self, chunks: list[str]) -> list[list[int]]:
        """Ids of each chunk. Those that start with white space are encoded side by side, many in one call."""
        found: list = [None] * len(chunks)
        side = [i for i, chunk in enumerate(chunks) if chunk[0].isspace() and not chunk[-1].isspace()]
        runs = [side[i : i + 400] for i in range(0, len(side), 400)]
        for run, ids in zip(runs, self._first_ids(["".join([chunks[i] for i in run]) for run in runs]), strict=True):
            ends = np.cumsum([len(chunks[i].encode()) for i in run])
            cuts = np.searchsorted(np.cumsum(self.first_sizes[ids]), ends) + 1
            for i, start, end in zip(run, [0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
                found[i] = ids[start:end]
        alone = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(alone, self._first_ids([chunks[i] for i in alone]), strict=True):
            found[i] = ids
        return found

    def _second_of(self, chunk: str) -> list[int]:
        parts = self.second._cut(chunk.replace(" ", SPACE))
        return self.second.part_ids(parts[0]) if len(parts) == 1 else [n for part in parts for n in self.second.part_ids(part)]

    def _forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[str] = []
        self.counts = np.empty((0, 4), np.int32)  # valid, tokens of each vocabulary, links
        self.pairs = np.empty(0, np.int64)
        self.pair_ends = np.zeros(1, np.int64)

    def add(self, texts: list[list[str]]) -> None:
        """Make sure all chunks are known; forgets all others first when there are too many."""
        if len(self.number) > self.CHUNKS:
            self._forget()
        new: set[str] = set()
        for chunks in texts:
            new.update(filterfalse(self.number.__contains__, chunks))
        if new:
            self._add(list(new))

    def _add(self, new: list[str]) -> None:
        first, second = self._first_of(new), [self._second_of(chunk) for chunk in new]
        given = [
            b"".join([self.first_octets[n] for n in a]) == octets and b"".join([self.second.octets[n] for n in b]) == octets
            for a, b, octets in zip(first, second, (chunk.encode() for chunk in new), strict=True)
        ]
        if not all(given):  # chunks that a vocabulary does not give back have no tokens
            first = [ids if good else [] for ids, good in zip(first, given, strict=True)]
            second = [ids if good else [] for ids, good in zip(second, given, strict=True)]
        a, b = (np.fromiter(chain.from_iterable(ids), np.int64) for ids in (first, second))
        a_end, b_end = np.cumsum(self.first_sizes[a]), np.cumsum(self.second_sizes[b])
        a_count, b_count = (np.array([len(i) for i in ids], np.int64) for ids in (first, second))
        common = np.intersect1d(a_end, b_end, assume_unique=True)
        # the group of each token, and the tokens of both side by side in the order they are written
        a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        a_last, b_last = np.searchsorted(a_end, common), np.searchsorted(b_end, common)
        a_text, b_text = self.between[a], self.between[b]
        a_text[a_last], b_text[b_last] = self.middle[a[a_last]], self.last[b[b_last]]
        written = np.empty(len(a) + len(b), object)
        written[np.arange(len(a)) + np.searchsorted(b_group, a_group)] = a_text
        written[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = b_text
        ends = np.cumsum(a_count + b_count).tolist()
        listed = written.tolist()
        self.groups += ["".join(listed[s:e])[:-1] for s, e in zip([0, *ends[:-1]], ends, strict=True)]
        owner = np.searchsorted(np.cumsum(a_count), a_last, "right")
        links = np.bincount(owner, minlength=len(new))
        counts = np.stack((np.array(given), a_count, b_count, links), 1).astype(np.int32)
        self.counts = np.concatenate((self.counts, counts))
        self.pairs = np.concatenate((self.pairs, a[a_last] << 32 | b[b_last]))
        self.pair_ends = np.concatenate((self.pair_ends, self.pair_ends[-1] + np.cumsum(links)))
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))

    def rows(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Per text: tokens of each vocabulary and links, digest of its groups; and pair, text and times of all links."""
        split = [self.chunks(" " + text) if text else [] for text in texts]
        self.add(split)
        sizes = np.array([len(chunks) for chunks in split], np.int64)
        number = self.number
        chunk = np.fromiter(map(number.__getitem__, chain.from_iterable(split)), np.int64, int(sizes.sum()))
        text = np.repeat(np.arange(len(texts)), sizes)
        valid = np.ones(len(texts), bool)
        valid[text[self.counts[chunk, 0] == 0]] = False
        chunk, text = chunk[valid[text]], text[valid[text]]
        totals = np.stack([np.bincount(text, self.counts[chunk, i], len(texts)) for i in (1, 2, 3)], 1).astype(np.int64)
        ends = np.cumsum(np.bincount(text, minlength=len(texts)))
        digests, groups, listed, start = [], self.groups, chunk.tolist(), 0
        for end in ends.tolist():
            joined = ";".join([groups[c] for c in listed[start:end]])
            digests.append(hashlib.sha256(joined.encode()).hexdigest() if end > start else "")
            start = end
        key, times = np.unique(text * len(self.groups) + chunk, return_counts=True)
        chunk, text = key % len(self.groups) if len(key) else key, key // max(len(self.groups), 1)
        held = self.pair_ends[chunk + 1] - self.pair_ends[chunk]
        at = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held - self.pair_ends[chunk], held)
        return totals, digests, self.pairs[at], np.repeat(text, held), np.repeat(times, held)


# --- bitmaps --------------------------------------------------------------------------------------

def bitmap(places: np.ndarray) -> bytes:
    """Sorted places below 65,536 as 16-bit numbers, or as bits where that is shorter; the first byte tells which."""
    width = int(places[-1]) // 8 + 1 if len(places) else 0
    if 2 * len(places) <= width or not width:
        return b"\0" + places.astype("<u2").tobytes()
    bits = np.zeros(8 * width, np.uint8)
    bits[places] = 1
    return b"\1" + np.packbits(bits, bitorder="little").tobytes()


def places(held: bytes) -> np.ndarray:
    """The places a bitmap holds, in order."""
    if held[:1] == b"\1":
        return np.flatnonzero(np.unpackbits(np.frombuffer(held, np.uint8, offset=1), bitorder="little"))
    return np.frombuffer(held, "<u2", offset=1).astype(np.int64) if held else np.empty(0, np.int64)


class Postings:
    """The pairs of a block: documents and times as parts, OR-merged into bitmaps at the end."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, pair: np.ndarray, place: np.ndarray, times: np.ndarray) -> None:
        """One part; a document lies in one part only, a pair may be in it more than once."""
        if not len(pair):
            return
        order = np.lexsort((place, pair))
        pair, place = pair[order], place[order]
        first = np.flatnonzero(np.concatenate(([True], (pair[1:] != pair[:-1]) | (place[1:] != place[:-1]))))
        self.parts.append((pair[first], place[first].astype(np.uint16), np.add.reduceat(times[order], first)))
        self.held += len(first)

    def rows(self) -> Iterator[tuple[int, int, int, list[bytes]]]:
        """Pair, number of documents, number of links and the bitmaps of its planes."""
        if not self.parts:
            return
        pair, place, times = (np.concatenate(columns) for columns in zip(*self.parts, strict=True))
        self.parts = []
        order = np.argsort(pair, kind="stable")  # parts hold their documents in order, one part behind the other
        pair, place, times = pair[order], place[order].astype(np.int64), times[order]
        starts = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        ends = np.append(starts[1:], len(pair))
        links = np.add.reduceat(times, starts)
        most = np.maximum.reduceat(times, starts)
        for start, end, linked, top in zip(starts.tolist(), ends.tolist(), links.tolist(), most.tolist(), strict=True):
            here, bits = place[start:end], times[start:end]
            if top == 1:
                planes = [bitmap(here)]
            else:
                planes = [bitmap(here[(bits >> j) & 1 == 1]) for j in range(top.bit_length())]
            yield int(pair[start]), end - start, linked, planes


# --- Spark ----------------------------------------------------------------------------------------

_aligners: dict[int, Aligner] = {}


def _aligner(bytewise: str, pieces: bytes) -> Aligner:
    """One per worker process, so what it remembers serves later tasks too."""
    key = zlib.crc32(pieces, zlib.crc32(bytewise.encode()))
    if key not in _aligners:
        _aligners[key] = Aligner(bytewise, pieces)
    return _aligners[key]


BLOCKS = (
    "block bigint, place int, doc_id bigint, n_a bigint, n_b bigint, n_links bigint, groups_sha256 string, "
    "a int, b int, n_docs bigint, planes array<binary>"
)
_ARROW = pa.schema(
    [
        ("block", pa.int64()), ("place", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()),
        ("n_docs", pa.int64()), ("planes", pa.list_(pa.binary())),
    ]
)


def _batch(size: int, **columns) -> pa.RecordBatch:
    arrays = [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(size, f.type) for f in _ARROW]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW)


def _posting_batches(block: int, postings: Postings) -> Iterator[pa.RecordBatch]:
    rows = []
    for row in chain(postings.rows(), [None]):
        if row is not None:
            rows.append(row)
        if rows and (row is None or len(rows) == 5000):
            pair, docs, links, planes = zip(*rows, strict=True)
            yield _batch(
                len(rows), block=[block] * len(rows), a=[p >> 32 for p in pair], b=[p & 0xFFFFFFFF for p in pair],
                n_docs=docs, n_links=links, planes=planes,
            )
            rows = []


def blocks(docs: DataFrame, bytewise_file: str, pieces_file: str, key: Column | None = None, text: str = "text") -> DataFrame:
    """The documents (rows with ``place``) and the postings (rows with ``planes``) of all blocks, written once."""
    with open(bytewise_file, encoding="utf-8") as file:
        bytewise = file.read()
    with open(pieces_file, "rb") as file:
        pieces = file.read()
    Aligner(bytewise, pieces)  # unsuitable vocabularies raise here
    spec = docs.sparkSession.sparkContext.broadcast((bytewise, pieces))
    wanted = shipped(docs).select((F.col("doc_id") if key is None else key).cast("long"), F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*spec.value)
        block = TaskContext.get().partitionId() << 32
        postings, size = Postings(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                totals, digests, pair, owner, times = aligner.rows(some.column(1).to_pylist())
                yield _batch(
                    some.num_rows, block=[block] * some.num_rows, place=np.arange(size, size + some.num_rows),
                    doc_id=some.column(0), n_a=totals[:, 0], n_b=totals[:, 1], n_links=totals[:, 2], groups_sha256=digests,
                )
                postings.add(pair, size + owner, times)
                size += some.num_rows
                if size > BLOCK_DOCS - 500 or postings.held > BLOCK_LINKS:
                    yield from _posting_batches(block, postings)
                    postings, size, block = Postings(), 0, block + 1
        yield from _posting_batches(block, postings)

    return land(wanted.mapInArrow(run, BLOCKS), "alignment")


def _salted(held: DataFrame) -> DataFrame:
    return held.where("planes IS NOT NULL").select("block", "a", "b", "n_docs", "n_links", F.pmod(F.xxhash64("block"), F.lit(SALTS)).alias("salt"))


def _partial(held: DataFrame) -> DataFrame:
    return _salted(held).groupBy("a", "b", "salt").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))


def pair_counts(held: DataFrame) -> DataFrame:
    """``a``, ``b``, ``n_docs``, ``n_links`` over the corpus, and ``best``: no id of A is linked with ``b`` more often."""
    totals = _partial(held).groupBy("a", "b").agg(F.sum("n_docs").alias("n_docs"), F.sum("n_links").alias("n_links"))
    totals = land(totals, "alignment-pairs")
    best = totals.groupBy("b").agg(F.max("n_links").alias("__most"))
    # one row per id of the second vocabulary
    return totals.join(F.broadcast(best), "b").select("a", "b", "n_docs", "n_links", (F.col("n_links") == F.col("__most")).alias("best"))


def document_scores(held: DataFrame) -> DataFrame:
    """Per document its tokens, groups and links, the links whose pair is the best of its ``b``, and the sum of their counts."""
    counts = pair_counts(held).select("a", "b", F.col("n_links").alias("count"), "best")
    by_salt = _partial(held).select("a", "b", "salt").join(counts, ["a", "b"])
    scores = _salted(held).select("block", "a", "b", "salt").join(by_salt, ["a", "b", "salt"]).select("block", "a", "b", "count", "best")
    scores = scores.toDF("scored", "a", "b", "count", "best")  # columns apart from those of the blocks
    schema = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
    )
    return held.groupBy("block").cogroup(scores.groupBy("scored")).applyInArrow(_scored, schema)


def _scored(held: pa.Table, scores: pa.Table) -> pa.Table:
    import pyarrow.compute as pc

    is_doc = pc.is_valid(held.column("place"))
    docs, postings = held.filter(is_doc), held.filter(pc.invert(is_doc))
    place = docs.column("place").to_numpy()
    size = int(place.max()) + 1 if len(place) else 0

    def pair(table: pa.Table) -> np.ndarray:
        return table.column("a").to_numpy().astype(np.int64) << 32 | table.column("b").to_numpy().astype(np.int64)

    sums = np.zeros((size, 2), np.int64)
    known = pair(scores)
    order = np.argsort(known)
    at = order[np.searchsorted(known[order], pair(postings))] if len(known) else order
    count = scores.column("count").to_numpy()[at]
    best = scores.column("best").to_numpy(zero_copy_only=False).astype(np.int64)[at]
    for number, planes in enumerate(chain.from_iterable(c.to_pylist() for c in postings.column("planes").chunks)):
        for j, plane in enumerate(planes):
            here = places(plane)  # a document is in a bitmap once, so plain addition is enough
            sums[here, 0] += best[number] << j
            sums[here, 1] += count[number] << j
    return pa.table(
        {
            "doc_id": docs.column("doc_id"), "n_a": docs.column("n_a"), "n_b": docs.column("n_b"),
            "n_groups": docs.column("n_links"), "n_links": docs.column("n_links"), "n_best": pa.array(sums[place, 0]),
            "count_sum": pa.array(sums[place, 1]), "groups_sha256": docs.column("groups_sha256"),
        }
    )

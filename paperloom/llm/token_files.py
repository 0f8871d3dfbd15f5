"""Token ids in bit-packed files: encode whole texts, write ids in id order, read any range back.

A file holds the ids of a run of documents, each id in the fewest bits that hold the vocabulary, in blocks of
``BLOCK`` ids (so each block starts on a byte). Layout, all numbers little-endian:

    magic (8 bytes), bits per id (uint32), ids per block (uint32)
    the packed blocks
    offset of each block (int64), id of each document (int64), 1 where that id is null (uint8),
    first token of each document and the end of the last one (int64)
    numbers of tokens, documents and blocks, offset of the block table (int64 each)

Unpacking is one numpy expression per block, and a range of tokens needs only its own blocks.

Scale: rows are range-partitioned by id and hash of the text, so a repeated id does not gather in one task; each
task streams its documents into one file below the shared folder and renames it when complete, so a
retried task replaces what a lost one left. The driver sees one manifest row per file.

Encoding remembers what pieces of text encode to. A text is cut only where the byte-level pre-tokenizer never
joins across, such as single spaces between visible characters; so the ids equal those of the whole text.

Defined cases: null text is encoded as empty text (just the end id); a null id sorts first and is kept as null;
equal ids are ordered by a hash of their text; an empty table gives no rows.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F
from tokenizers import Tokenizer

from paperloom.llm.common import shipped
from paperloom.session import fresh_path

MAGIC = b"PLTOKEN1"
BLOCK = 8192
_TRAILER = struct.Struct("<4q")
#: Cuts a text only where the byte-level pre-tokenizer cuts as well: a word with its space, a comma or full stop behind a
#: word, a single line break, or else all up to the next single space between visible characters.
_pieces = re.compile(
    r" ?[^\W\d_]+(?=[ ,.\n])|(?<=[^\W_])[,.](?=[ \n]\S)|(?<=\S)\n(?=\S)|.+?(?=(?<=\S) \S|\Z)", re.DOTALL
).findall


# --- bits -----------------------------------------------------------------------------------------

def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold the ids 0 to ``vocabulary - 1``."""
    return max(1, (max(vocabulary, 1) - 1).bit_length())


def pack_ids(ids: np.ndarray, bits: int) -> bytes:
    """Ids side by side, lowest bit first, padded to a whole byte."""
    octets = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if bits % 8 == 0:
        return octets[:, : bits // 8].tobytes()
    return np.packbits(np.unpackbits(octets, axis=1, bitorder="little")[:, :bits].reshape(-1), bitorder="little").tobytes()


def unpack_ids(data: bytes, bits: int, count: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        out[:, : bits // 8] = raw[: count * bits // 8].reshape(count, bits // 8)
    else:
        wide = np.zeros((count, 32), np.uint8)
        wide[:, :bits] = np.unpackbits(raw, bitorder="little")[: count * bits].reshape(count, bits)
        out = np.packbits(wide, axis=1, bitorder="little")
    return out.reshape(-1).view("<u4")


# --- one file ---------------------------------------------------------------------------------------

class TokenWriter:
    """Streams documents into a file; blocks leave memory as they fill."""

    def __init__(self, sink, bits: int) -> None:
        self.sink, self.bits = sink, bits
        self.sink.write(MAGIC + struct.pack("<2I", bits, BLOCK))
        self.at = 16
        self.held: list[bytes] = []
        self.held_ids = 0
        self.offsets, self.ids, self.nulls, self.starts = array("q"), array("q"), bytearray(), array("q", [0])

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """``ids`` as little-endian unsigned 32-bit integers."""
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.starts.append(self.starts[-1] + len(ids) // 4)
        self.held.append(ids)
        self.held_ids += len(ids) // 4
        if self.held_ids >= 16 * BLOCK:
            self._flush(self.held_ids // BLOCK * BLOCK)

    def _flush(self, count: int) -> None:
        held = b"".join(self.held)
        ids = np.frombuffer(held, "<u4")
        for first in range(0, count, BLOCK):
            data = pack_ids(ids[first : min(first + BLOCK, count)], self.bits)
            self.offsets.append(self.at)
            self.sink.write(data)
            self.at += len(data)
        self.held, self.held_ids = [held[4 * count :]], self.held_ids - count

    def close(self) -> None:
        if self.held_ids:
            self._flush(self.held_ids)
        for table in (self.offsets, self.ids, self.nulls, self.starts):
            self.sink.write(bytes(table) if isinstance(table, bytearray) else np.array(table, "<i8").tobytes())
        self.sink.write(_TRAILER.pack(self.starts[-1], len(self.ids), len(self.offsets), self.at))


class TokenFile:
    """Random access to a written file."""

    def __init__(self, source) -> None:
        self.source = source
        if self._read(0, 8) != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block = struct.unpack("<2I", self._read(8, 8))
        end = source.size() - _TRAILER.size
        self.n_tokens, self.n_docs, blocks, at = _TRAILER.unpack(self._read(end, _TRAILER.size))
        table = self._read(at, end - at)
        self.offsets = np.frombuffer(table, "<i8", blocks)
        self.doc_ids = np.frombuffer(table, "<i8", self.n_docs, 8 * blocks)
        self.nulls = np.frombuffer(table, np.uint8, self.n_docs, 8 * (blocks + self.n_docs))
        self.starts = np.frombuffer(table, "<i8", self.n_docs + 1, 8 * blocks + 9 * self.n_docs)
        self._end = at

    def _read(self, at: int, count: int) -> bytes:
        self.source.seek(at)
        return self.source.read(count)

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` to ``stop``; reads their blocks only."""
        if stop <= start:
            return np.empty(0, "<u4")
        first, last = start // self.block, (stop - 1) // self.block
        begin = int(self.offsets[first])
        end = int(self.offsets[last + 1]) if last + 1 < len(self.offsets) else self._end
        count = min((last + 1) * self.block, self.n_tokens) - first * self.block
        ids = unpack_ids(self._read(begin, end - begin), self.bits, count)
        return ids[start - first * self.block : stop - first * self.block]

    def document(self, number: int) -> np.ndarray:
        return self.tokens(int(self.starts[number]), int(self.starts[number + 1]))

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[int, np.ndarray]]:
        """(number, ids) of each document in order, reading about ``at_once`` tokens at a time."""
        number = 0
        while number < self.n_docs:
            stop = max(number + 1, int(np.searchsorted(self.starts, self.starts[number] + at_once, "right")) - 1)
            stop = min(stop, self.n_docs)
            base = int(self.starts[number])
            ids = self.tokens(base, int(self.starts[stop]))
            for k in range(number, stop):
                yield k, ids[int(self.starts[k]) - base : int(self.starts[k + 1]) - base]
            number = stop


# --- encoding -----------------------------------------------------------------------------------------

class Encoder:
    """Whole texts to ids as bytes, by a tokenizer of the byte-level kind, remembering pieces.

    Memory is kept in two generations: when the young one is full it becomes the old one, and pieces that are met
    again move back into the young one, so common pieces stay.
    """

    MEMORY = 700_000
    #: So many pieces go to the tokenizer as one text.
    TOGETHER = 400

    def __init__(self, tokenizer: Tokenizer) -> None:
        self.tokenizer = tokenizer
        # bytes of each id; a byte-level token is written with one character per byte, an added one as it is
        sizes = {number: len(token) for token, number in tokenizer.get_vocab(with_added_tokens=False).items()}
        sizes |= {number: len(token.content.encode()) for number, token in tokenizer.get_added_tokens_decoder().items()}
        self.sizes = np.array([sizes.get(number, 0) for number in range(max(sizes, default=0) + 1)], np.int64)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encoded(self, pieces: list[str]) -> Iterator[tuple[str, bytes]]:
        """Pieces with their ids. Those from a space to a visible character are encoded side by side, many in one call."""
        side = [piece for piece in pieces if piece[0] == " " and not piece[-1].isspace()]
        alone = [piece for piece in pieces if piece[0] != " " or piece[-1].isspace()]
        for first in range(0, len(side), self.TOGETHER):
            run = side[first : first + self.TOGETHER]
            ids = np.array(self._ids(["".join(run)])[0], "<u4")
            ends, reached = np.cumsum([len(piece.encode()) for piece in run]), np.cumsum(self.sizes[ids])
            cuts = np.searchsorted(reached, ends) + 1
            if cuts[-1] != len(ids) or (reached[cuts - 1] != ends).any():
                alone += run  # an added token of another size than its text
                continue
            held = ids.tobytes()
            for piece, start, end in zip(run, [0, *cuts[:-1].tolist()], cuts.tolist(), strict=True):
                yield piece, held[4 * start : 4 * end]
        for piece, ids in zip(alone, self._ids(alone), strict=True):
            yield piece, array("I", ids).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self.young) > self.MEMORY:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        rows, gaps = [], []
        for text in texts:
            pieces = _pieces(text or "")
            found = list(map(young.get, pieces))
            gaps += [(found, at, pieces[at]) for at, ids in enumerate(found) if ids is None]
            rows.append(found)
        new = []
        for piece in {piece for _, _, piece in gaps}:
            if piece in old:
                young[piece] = old[piece]
            else:
                new.append(piece)
        young.update(self._encoded(new))
        for found, at, piece in gaps:
            found[at] = young[piece]
        return [b"".join(found) for found in rows]


_encoders: dict[int, Encoder] = {}


def _encoder(spec: str) -> Encoder:
    """One encoder per worker process, so what it remembers serves later tasks too."""
    key = zlib.crc32(spec.encode())
    if key not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[key] = Encoder(Tokenizer.from_str(spec))
    return _encoders[key]


# --- Spark --------------------------------------------------------------------------------------------

MANIFEST = "shard int, file string, n_docs bigint, n_tokens bigint"


def write_tokens(docs: DataFrame, folder: str, tokenizer_file: str, end_id: int = 0, key: str = "doc_id", text: str = "text") -> list:
    """Write the files; the manifest has one row per file, in order of the ids."""
    with open(tokenizer_file, encoding="utf-8") as file:
        spec_text = file.read()
    bits = bits_for(Tokenizer.from_str(spec_text).get_vocab_size())
    spec = docs.sparkSession.sparkContext.broadcast(spec_text)
    store, root = pyarrow.fs.FileSystem.from_uri(folder)
    store.create_dir(root)
    end = struct.pack("<I", end_id)
    rows = shipped(docs).select(F.col(key).cast("long").alias("_id"), F.col(text).alias("_text"), F.xxhash64(text).alias("_hash"))
    ordered = rows.repartitionByRange("_id", "_hash").sortWithinPartitions("_id", "_hash", "_text")

    def run(batches):
        context = TaskContext.get()
        shard = context.partitionId()
        store, root = pyarrow.fs.FileSystem.from_uri(folder)
        part = f"{root}/part-{shard:06d}.{context.taskAttemptId()}.tmp"
        writer = None
        encoder = _encoder(spec.value)
        sink = None
        for batch in batches:
            if batch.num_rows and writer is None:
                sink = store.open_output_stream(part)
                writer = TokenWriter(sink, bits)
            for first in range(0, batch.num_rows, 1000):
                some = batch.slice(first, 1000)
                encoded = encoder.encode(some.column(1).to_pylist())
                for doc_id, ids in zip(some.column(0).to_pylist(), encoded, strict=True):
                    writer.add(doc_id, ids + end)
        if writer is not None:
            writer.close()
            sink.close()
            done = f"{root}/tokens-{shard:06d}.bin"
            store.move(part, done)
            yield pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([shard], pa.int32()), "file": [f"{folder}/tokens-{shard:06d}.bin"],
                    "n_docs": pa.array([len(writer.ids)], pa.int64()), "n_tokens": pa.array([writer.starts[-1]], pa.int64()),
                }
            )

    return sorted(ordered.mapInArrow(run, MANIFEST).collect())


def read_documents(spark: SparkSession, manifest: list) -> DataFrame:
    """``doc_id``, ``start`` (tokens of all documents before it), ``n_tokens`` and ``ids_crc32``, from the files."""
    files, start = [], 0
    for row in manifest:
        files.append((row["file"], start))
        start += row["n_tokens"]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    if not files:
        return spark.createDataFrame([], schema)
    listed = spark.createDataFrame(files, "file string, base bigint").repartition(len(files))
    shipped(listed)

    def run(batches):
        for batch in batches:
            for file, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                store, path = pyarrow.fs.FileSystem.from_uri(file)
                with store.open_input_file(path) as source:
                    tokens = TokenFile(source)
                    crcs = [zlib.crc32(ids.tobytes()) for _, ids in tokens.documents()]
                    yield pa.RecordBatch.from_pydict(
                        {
                            "doc_id": pa.array(tokens.doc_ids, pa.int64(), mask=tokens.nulls.astype(bool)),
                            "start": pa.array(tokens.starts[:-1] + base, pa.int64()),
                            "n_tokens": pa.array(np.diff(tokens.starts), pa.int64()),
                            "ids_crc32": pa.array(crcs, pa.int64()),
                        }
                    )

    return listed.mapInArrow(run, schema)


def token_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "tokens")

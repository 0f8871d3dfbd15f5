"""Ids and texts of a sentencepiece vocabulary of the merging kind: encode whole texts, decode the ids again.

Every prefix of a text has one encoding, so it has one last token, and the prefix in front of that token has its own.
A table of last tokens therefore holds the encodings of all prefixes. It is filled from left to right: an automaton over
the vocabulary names the tokens that end at a place, and of these exactly one is compatible with the last token in front
of it. The ids are read off the table from its end backwards.

Two tokens are compatible if merging their joined characters, best score first and leftmost among equals, gives these two
tokens back. A row of tokens is an encoding exactly when all its neighbours are compatible: up to the first merge across a
boundary the characters on both sides merge as they do alone. The test is made once per pair and remembered.

A text is cut where no piece reaches across: in front of each run of spaces, if no piece of the vocabulary has a space
behind another character, at line breaks and between a word and a mark, if no piece holds these. The parts then encode on
their own, and what common parts encode to is remembered (two generations, bounded).

Defined cases: null text is encoded as empty text (begin and end id only); a null id is kept; repeated rows are rows; an
empty table gives no rows; characters without a piece become the ids of their UTF-8 bytes; strings of control pieces inside
a text are plain text; very long parts are encoded in linear time and not remembered; other columns are not looked at.
The vocabulary must merge (not unigram), leave texts as they are apart from a space put in front, and hold all bytes and all
single characters of its pieces: anything else raises before a row is read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import filterfalse

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from sentencepiece import SentencePieceProcessor

from paperloom.llm.common import shipped

SPACE = "▁"
#: Latin letters and digits, as a character class; a text may be cut between one and a mark that follows it in no piece.
LATIN = "A-Za-z0-9À-ÖØ-öø-ɏ"
_MARKS = ".,!?;:$%#&*)]}>|/\"'-"
#: What a vocabulary must encode as the library does before it is used.
_PROBE = "Aa b  c\t\n ﬁ Ａ½ 　x\xa0y é </s><0x41>\0 words, 12,345 " + SPACE + " \U0001f600 "


class Pieces:
    """A vocabulary, the automaton over its pieces and the pairs tested so far."""

    PAIRS = 1_500_000

    def __init__(self, model: bytes) -> None:
        library = SentencePieceProcessor(model_proto=model)
        self.size = library.get_piece_size()
        self.begin, self.end = library.bos_id(), library.eos_id()
        self.score: dict[str, float] = {}
        self.piece: list[str] = []
        self.octets: list[bytes] = []
        self.byte_ids = [-1] * 256
        ids: dict[str, int] = {}
        for number in range(self.size):
            piece = library.id_to_piece(number)
            octets = b""
            if library.is_byte(number):
                octets = bytes([int(piece[3:-1], 16)])
                self.byte_ids[octets[0]] = number
            elif not (library.is_control(number) or library.is_unknown(number) or library.is_unused(number)):
                octets = piece.replace(SPACE, " ").encode()
                ids[piece] = number
                self.score[piece] = library.get_score(number)
            self.piece.append(piece)
            self.octets.append(octets)
        self.known = {c for piece in ids for c in piece}
        if min(self.byte_ids) < 0 or not self.known.issubset(ids):
            raise ValueError("the vocabulary must hold all bytes and the single characters of its pieces")
        self.cuts_at_spaces = not any(re.search(f"[^{SPACE}]{SPACE}", piece) for piece in ids)
        self.closing = "".join(re.escape(c) for c in _MARKS if not any(re.search(f"[{LATIN}]{re.escape(c)}", piece) for piece in ids))
        self._cut = self._pattern() if self.cuts_at_spaces else lambda text: [text]
        self.lengths = [len(piece) for piece in self.piece]
        self.automaton = ahocorasick.Automaton()
        for piece, number in ids.items():
            if self._merges_to_one(piece):
                self.automaton.add_word(piece, number)
        self.automaton.make_automaton()
        self._pairs: dict[int, bool] = {}
        if self.encode(_PROBE) != library.encode(_PROBE):
            raise ValueError("not a merging vocabulary that leaves texts as they are")

    def _pattern(self):
        """Cuts a marked text where no piece reaches across: at spaces, at line breaks without a piece, in front of marks."""
        edge = SPACE + ("\n" if "\n" not in self.known else "")  # a character without a piece stands alone
        word = f"{SPACE}*[{LATIN}]+(?=[{edge}{self.closing}]|\\Z)"
        return re.compile(f"{word}|{SPACE}*[^{edge}]+|{SPACE}+|\n").findall

    # --- compatibility ---------------------------------------------------------------------------

    def _next_merge(self, symbols: list[str]) -> int:
        """The place of the pair to merge next, -1 if none can."""
        best, at = None, -1
        for i in range(len(symbols) - 1):
            score = self.score.get(symbols[i] + symbols[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        return at

    def _merges_to_one(self, piece: str) -> bool:
        symbols = list(piece)
        while (at := self._next_merge(symbols)) >= 0:
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
        return len(symbols) == 1

    def compatible(self, left: int, right: int) -> bool:
        """Whether two tokens that stand side by side stay as they are; tests the joined characters."""
        symbols = [*self.piece[left], *self.piece[right]]
        boundary = self.lengths[left]  # symbols in front of it
        while (at := self._next_merge(symbols)) >= 0:
            if at == boundary - 1:
                return False
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]
            boundary -= at < boundary
        return True

    # --- encoding --------------------------------------------------------------------------------

    def _known_run(self, text: str) -> list[int]:
        """Ids of a text whose characters all have pieces, by the table of last tokens."""
        last = [-1] * (len(text) + 1)
        pairs, lengths, size = self._pairs, self.lengths, self.size
        for end, token in self.automaton.iter(text):
            if last[end + 1] < 0:
                start = end + 1 - lengths[token]
                if start:
                    pair = last[start] * size + token
                    fits = pairs.get(pair)
                    if fits is None:
                        if len(pairs) >= self.PAIRS:
                            pairs.clear()
                        fits = pairs[pair] = self.compatible(last[start], token)
                    if not fits:
                        continue
                last[end + 1] = token
        ids, at = [], len(text)
        while at:
            ids.append(last[at])
            at -= lengths[last[at]]
        ids.reverse()
        return ids

    def part_ids(self, part: str) -> list[int]:
        """Ids of a text in which spaces are marked."""
        if self.known.issuperset(part):
            return self._known_run(part)
        ids, run = [], []
        for character in part:
            if character in self.known:
                run.append(character)
            else:
                ids += self._known_run("".join(run))
                ids += [self.byte_ids[b] for b in character.encode()]
                run = []
        return ids + self._known_run("".join(run))

    def parts(self, text: str) -> list[str]:
        """A text with a space in front, spaces marked, cut where no piece reaches across."""
        return self._cut(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [number for part in self.parts(text) for number in self.part_ids(part)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids; control ids have none, and the space that was put in front goes."""
        return self.part_text(ids).removeprefix(" ")

    def part_text(self, ids: list[int]) -> str:
        return b"".join([self.octets[number] for number in ids]).decode("utf-8", "replace")


class Remembered:
    """Encodes and decodes texts by remembered parts, in two generations: what is met again moves to the young one."""

    PARTS = 350_000
    LONGEST = 64

    def __init__(self, model: bytes) -> None:
        self.pieces = Pieces(model)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _ids(self, part: str) -> bytes:
        return array("I", self.pieces.part_ids(part)).tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, with begin and end id."""
        split = [self.pieces.parts(text or "") for text in texts]
        if len(self.young) > self.PARTS:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        new: set[str] = set()
        for parts in split:
            new.update(filterfalse(young.__contains__, parts))
        long = {}
        for part in new:
            if len(part) > self.LONGEST:
                long[part] = self._ids(part)
            else:
                young[part] = old.get(part) or self._ids(part)
        begin, end = struct.pack("<I", self.pieces.begin), struct.pack("<I", self.pieces.end)
        if long:
            found = [b"".join([long.get(part) or young[part] for part in parts]) for parts in split]
        else:
            found = [b"".join(map(young.__getitem__, parts)) for parts in split]
        return [begin + ids + end for ids in found]


class Decoder:
    """Ids to text. A part starts at a piece with a space in front; texts of whole texts' ids are joined bytes."""

    def __init__(self, pieces: Pieces) -> None:
        self.octets = pieces.octets

    def decode(self, ids: bytes) -> str:
        joined = b"".join(map(self.octets.__getitem__, array("I", ids)))
        return joined.decode("utf-8", "replace").removeprefix(" ")


_coders: dict[int, Remembered] = {}


def coder(model: bytes) -> Remembered:
    """One per worker process, so what it remembers serves later tasks too."""
    key = zlib.crc32(model)
    if key not in _coders:
        _coders[key] = Remembered(model)
    return _coders[key]


def encoded(docs: DataFrame, model_file: str, key: Column | None = None, text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int, with begin and end id) and ``decoded`` of every row."""
    schema = "doc_id bigint, ids array<int>, decoded string"

    def rows(keys, texts, ids, decoder):
        numbers = [array("i", i) for i in ids]
        return {"doc_id": keys, "ids": pa.array(numbers, pa.list_(pa.int32())), "decoded": [decoder.decode(i) for i in ids]}

    return _mapped(docs, model_file, key, text, schema, rows)


def digests(docs: DataFrame, model_file: str, key: Column | None = None, text: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of every row."""
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"

    def rows(keys, texts, ids, decoder):
        return {
            "doc_id": keys,
            "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
            "ids_sha256": [hashlib.sha256(i).hexdigest() for i in ids],
            "decoded_sha256": [hashlib.sha256(decoder.decode(i).encode()).hexdigest() for i in ids],
        }

    return _mapped(docs, model_file, key, text, schema, rows)


def _mapped(docs: DataFrame, model_file: str, key: Column | None, text: str, schema: str, rows) -> DataFrame:
    with open(model_file, "rb") as file:
        content = file.read()
    Pieces(content)  # an unsuitable vocabulary raises here
    model = docs.sparkSession.sparkContext.broadcast(content)
    wanted = shipped(docs).select((F.col("doc_id") if key is None else key).cast("long"), F.col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered = coder(model.value)
        decoder = Decoder(remembered.pieces)
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                some = batch.slice(first, 1000)
                texts = some.column(1).to_pylist()
                yield pa.RecordBatch.from_pydict(rows(some.column(0), texts, remembered.encode(texts), decoder))

    return wanted.mapInArrow(run, schema)

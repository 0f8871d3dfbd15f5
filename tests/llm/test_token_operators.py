"""Token alignment, sentence pieces and periodic runs against plain versions and the libraries themselves."""

import hashlib
import random
from array import array
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from paperloom.llm import QUERIES, periodic_runs, sentence_pieces, token_alignment
from tests.llm.data import by_hand, no_documents, odd_documents, odd_rows

tokenizer_files = pytest.importorskip("public_tokenizers")
BYTEWISE, PIECES = tokenizer_files.path("byte_bpe_50k.json"), tokenizer_files.path("piece_bpe_32k.model")
DATA = Path("/root/testdata/sf0.001")
ALPHABET = "abcdefgh   eeetthhaaoonxX×÷²..,!)\n\n\t\r.,'-0123456789ÄÖéßñ中文字の\U0001f600ﬁ　\x1c\x85\xa0é▁"
SPECIAL = ["<|endoftext|>", "</s>", "<0x41>", "[INST]", "<s>"]


def odd_texts(seed, count):
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        text = "".join(rng.choice(ALPHABET[:-1] if rng.random() < 0.999 else ALPHABET) for _ in range(rng.randrange(70)))
        texts.append(text + rng.choice(SPECIAL) if rng.random() < 0.1 else text)
    return texts


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


@pytest.fixture(scope="module")
def pieces():
    return sentence_pieces.Pieces(Path(PIECES).read_bytes())


@pytest.fixture(scope="module")
def bytewise():
    tokenizer = Tokenizer.from_file(BYTEWISE)
    tokenizer.encode_special_tokens = True
    return tokenizer


# --- sentence pieces ------------------------------------------------------------------------------

def test_encoding_equals_the_library(library, pieces):
    for text in [*odd_texts(1, 3000), "x" * 5000, "ab" * 3000 + "中" * 2000, "  " * 700, "▁▁ ▁", "\0\0", "The end.\n\n  Next, (one) two."]:
        assert pieces.encode(text) == library.encode(text), text


def test_decoding_equals_the_library(library, pieces):
    for text in odd_texts(2, 1000):
        ids = library.encode(text, add_bos=True, add_eos=True)
        assert pieces.decode(ids) == library.decode(ids), text


def test_pairs_side_by_side_are_compatible_and_split_ones_are_not(library, pieces):
    ids = library.encode("compatible neighbours stay as they are")
    assert all(pieces.compatible(a, b) for a, b in zip(ids, ids[1:], strict=False))
    the, t, he = (library.piece_to_id(p) for p in ("▁the", "▁t", "he"))
    assert library.encode("the") == [the] and not pieces.compatible(t, he)


def test_remembered_parts_survive_their_generations(library, monkeypatch):
    monkeypatch.setattr(sentence_pieces.Remembered, "PARTS", 20)
    remembered = sentence_pieces.Remembered(Path(PIECES).read_bytes())
    for text in odd_texts(3, 300):
        expected = library.encode([text, text], add_bos=True, add_eos=True)
        assert [list(array("I", ids)) for ids in remembered.encode([text, text])] == expected


def plain_pieces(library, rows):
    out = []
    for key, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        sha = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        out.append((key, len(ids), sha, hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_piece_digests_of_odd_documents(spark, library):
    got = sentence_pieces.digests(odd_documents(spark), PIECES).collect()
    assert sorted(map(tuple, got), key=repr) == plain_pieces(library, [r[:2] for r in odd_rows()])
    assert sentence_pieces.digests(no_documents(spark), PIECES).collect() == []
    row = sentence_pieces.encoded(by_hand(spark, ["two words"]), PIECES).first()
    assert row["ids"] == library.encode("two words", add_bos=True, add_eos=True) and row["decoded"] == "two words"


@pytest.mark.skipif(not DATA.exists(), reason="test tables are absent")
def test_registered_piece_query(spark, library):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op12_sentence_pieces"](spark, str(DATA)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_pieces(library, docs)


# --- token alignment --------------------------------------------------------------------------------

def plain_alignment(library, bytewise, text):
    """Tokens of both vocabularies, groups as text, links."""
    if not text:
        return 0, 0, "", []
    to_byte = token_alignment.byte_of_character()
    names = {number: token for token, number in bytewise.get_vocab().items()}
    a = bytewise.encode(" " + text, add_special_tokens=False).ids
    b = library.encode(text)
    a_octets = [bytes(to_byte[c] for c in names[i]) for i in a]
    b_octets = [
        bytes([int(library.id_to_piece(i)[3:-1], 16)]) if library.is_byte(i) else library.id_to_piece(i).replace("▁", " ").encode() for i in b
    ]
    if not b"".join(a_octets) == b"".join(b_octets) == (" " + text).encode():
        return 0, 0, "", []
    a_ends, b_ends = ({int(end): k for k, end in enumerate(np.cumsum([len(o) for o in octets]))} for octets in (a_octets, b_octets))
    groups, links, a_from, b_from = [], [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        i, j = a_ends[end], b_ends[end]
        groups.append(",".join(map(str, a[a_from : i + 1])) + "|" + ",".join(map(str, b[b_from : j + 1])))
        links.append((a[i], b[j]))
        a_from, b_from = i + 1, j + 1
    return len(a), len(b), ";".join(groups), links


def plain_scores(library, bytewise, rows):
    aligned = [(key, *plain_alignment(library, bytewise, text)) for key, text in rows]
    counts = Counter(link for *_, links in aligned for link in links)
    most = Counter()
    for (_, b), times in counts.items():
        most[b] = max(most[b], times)
    out = []
    for key, n_a, n_b, groups, links in aligned:
        best = sum(counts[link] == most[link[1]] for link in links)
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        out.append((key, n_a, n_b, len(links), len(links), best, sum(counts[link] for link in links), digest))
    return sorted(out, key=repr)


def test_alignment_of_odd_texts(library, bytewise):
    aligner = token_alignment.Aligner(Path(BYTEWISE).read_text(encoding="utf-8"), Path(PIECES).read_bytes())
    for seed in range(4):
        texts = [*odd_texts(seed, 400), None, "", " ", "\n", "a\t", " \n x", "it's 12.5% (so) far.)"]
        totals, digests, pair, owner, times = aligner.rows(texts)
        met = [Counter() for _ in texts]
        for p, o, t in zip(pair.tolist(), owner.tolist(), times.tolist(), strict=True):
            met[o][p >> 32, p & 0xFFFFFFFF] += t
        for text, total, digest, links in zip(texts, totals.tolist(), digests, met, strict=True):
            n_a, n_b, groups, expected = plain_alignment(library, bytewise, text)
            assert (total, links) == ([n_a, n_b, len(expected)], Counter(expected)), text
            assert digest == (hashlib.sha256(groups.encode()).hexdigest() if groups else ""), text


def test_bitmaps_and_planes():
    rng = np.random.default_rng(4)
    for size in (0, 1, 7, 300, 5000):
        held = np.sort(rng.choice(30_000, size, replace=False))
        assert token_alignment.places(token_alignment.bitmap(held)).tolist() == held.tolist()
    dense = np.arange(9000)
    assert len(token_alignment.bitmap(dense)) < 1200 and token_alignment.places(token_alignment.bitmap(dense)).tolist() == dense.tolist()
    postings, expected = token_alignment.Postings(), {}
    for part in range(5):
        pair, place = rng.integers(0, 20, 400), rng.integers(part * 50, part * 50 + 50, 400)
        times = rng.integers(1, 9, 400)
        for p, d, t in zip(pair.tolist(), place.tolist(), times.tolist(), strict=True):
            expected.setdefault(p, Counter())[d] += t
        postings.add(pair, place, times)
    rows = list(postings.rows())
    assert [r[0] for r in rows] == sorted(expected)
    for pair, docs, links, planes in rows:
        assert docs == len(expected[pair]) and links == sum(expected[pair].values())
        assert docs == len(set().union(*[token_alignment.places(p).tolist() for p in planes]))
        back = Counter()
        for j, plane in enumerate(planes):
            back.update({d: 1 << j for d in token_alignment.places(plane).tolist()})
        assert back == expected[pair]


def test_scores_over_many_blocks(spark, library, bytewise, monkeypatch):
    docs = odd_documents(spark)
    held = token_alignment.blocks(docs.repartition(5), BYTEWISE, PIECES)
    got = sorted(map(tuple, token_alignment.document_scores(held).collect()), key=repr)
    assert got == plain_scores(library, bytewise, [r[:2] for r in odd_rows()])
    counts = Counter(link for r in odd_rows() for link in plain_alignment(library, bytewise, r[1])[3])
    documents = Counter(link for r in odd_rows() for link in set(plain_alignment(library, bytewise, r[1])[3]))
    for a, b, n_docs, n_links, _ in token_alignment.pair_counts(held).collect():
        assert (n_docs, n_links) == (documents.pop((a, b)), counts.pop((a, b)))
    assert not counts and not documents
    assert token_alignment.document_scores(token_alignment.blocks(no_documents(spark), BYTEWISE, PIECES)).collect() == []


@pytest.mark.skipif(not DATA.exists(), reason="test tables are absent")
def test_registered_alignment_query(spark, library, bytewise):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_token_alignment"](spark, str(DATA)).collect()
    assert sorted(map(tuple, got), key=repr) == plain_scores(library, bytewise, docs)


# --- periodic runs --------------------------------------------------------------------------------

def plain_runs(words, shortest=24, times=3):
    found, n = {}, len(words)
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(shortest, times * q):
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted(((s, length, q) for (s, length), q in found.items()), key=lambda r: (r[0], r[2]))


def repeating(rng):
    words = []
    for _ in range(rng.randrange(1, 6)):
        kind = rng.randrange(5)
        if kind == 0:
            words += [rng.randrange(50) for _ in range(rng.randrange(60))]
        elif kind == 1:
            unit = [rng.randrange(rng.choice([2, 3, 30])) for _ in range(rng.randrange(1, 40))]
            words += (unit * 8)[rng.randrange(len(unit)) :][: rng.randrange(1, len(unit) * 7 + 1)]
        elif kind == 2:
            words += [rng.randrange(2) for _ in range(rng.randrange(200))]
        elif kind == 3:
            words += ([1] * rng.randrange(1, 20) + [2] * rng.randrange(1, 20) + [1] * rng.randrange(20) + [3]) * rng.randrange(1, 6)
        else:
            inner = [rng.randrange(3) for _ in range(rng.randrange(1, 5))] * rng.randrange(1, 9)
            words += (inner + [rng.randrange(5) for _ in range(rng.randrange(3))]) * rng.randrange(1, 6)
            if words and rng.random() < 0.3:
                words[rng.randrange(len(words))] = 9
    return words


def test_runs_equal_brute_force():
    rng = random.Random(11)
    for _ in range(250):
        texts = [np.array(repeating(rng), np.int64) for _ in range(rng.randrange(1, 5))]
        for words, runs, flagged in zip(texts, periodic_runs.runs_of(texts), periodic_runs.with_repeats(texts), strict=True):
            expected = plain_runs(words.tolist())
            assert [tuple(r) for r in runs.tolist()] == expected
            assert flagged or not expected


def test_wavelet_tree():
    rng = np.random.default_rng(1)
    values = rng.permutation(300)
    tree = periodic_runs.WaveletTree(values)
    for _ in range(200):
        left, right = sorted(rng.integers(0, 301, 2).tolist())
        limit = int(rng.integers(0, 301))
        inside = np.sort(values[left:right])
        one = lambda *numbers: tuple(np.array([n]) for n in numbers)
        assert tree.below(*one(left, right, limit))[0] == (inside < limit).sum()
        if len(inside):
            k = int(rng.integers(0, len(inside)))
            assert tree.smallest(*one(left, right, k))[0] == inside[k]


def test_shorter_runs_are_refused():
    with pytest.raises(ValueError):
        periodic_runs.runs_of([np.arange(5)], shortest=10)


def test_runs_of_odd_documents(spark):
    got = periodic_runs.periodic_runs(odd_documents(spark)).collect()
    assert len(got) == len(odd_rows())
    expected = []
    for key, text, *_ in odd_rows():
        words = (text or "").encode().split()
        runs = plain_runs(words)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        expected.append((key, len(words), runs, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    seen = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got]
    assert sorted(seen, key=repr) == sorted(expected, key=repr)
    assert any(runs for _, _, runs, _ in expected)
    assert periodic_runs.periodic_runs(no_documents(spark)).collect() == []


def test_report_of_runs(spark):
    text = " ".join(["a", "b"] * 20 + list("uvwxyz") + ["c", "d", "e", "f"] * 20 + ["q"])
    row = periodic_runs.report(periodic_runs.periodic_runs(by_hand(spark, [text]))).first()
    assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (2, 0, 40, 2, 20000)
    assert row["runs_sha256"] == hashlib.sha256(b"0,40,2\n46,80,4\n").hexdigest()
    assert row["collapsed_sha256"] == hashlib.sha256(b"a b u v w x y z c d e f q").hexdigest()

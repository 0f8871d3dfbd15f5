import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from paperloom.llm import induced, suffix_dedup
from tests.llm.data import by_hand, no_documents, odd_documents, odd_rows, words


def plain(rows, length=200):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(raw[i : i + length] for raw in raws for i in range(len(raw) - length + 1))
    out = []
    for (key, _), raw in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if seen[raw[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((key, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize(("hot", "batch"), [(1 << 22, 10_000), (500, 3)])
def test_odd_rows(spark, monkeypatch, hot, batch):
    """Also with batches of three rows, and with the counted way for nearly every minimizer."""
    monkeypatch.setattr(suffix_dedup, "HOT_BYTES", hot)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = [r[:2] for r in odd_rows()]
        assert found(suffix_dedup.digests(odd_documents(spark))) == plain(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_periods_runs_and_edges(spark):
    rng = random.Random(8)
    passage = "".join(rng.choices("abcdef ", k=199))
    texts = ["ab" * 300, "ba" * 150, "z" * 199, "z" * 200, "z" * 201, "q" * 400, passage + "1", "2" + passage, passage + "3" + passage]
    long = "".join(rng.choices("abcdé", k=1200))
    texts += [long, long[300:700], "x" + long[:500], long[100:299], long[100:300] + "!"]
    assert found(suffix_dedup.digests(by_hand(spark, texts))) == plain(list(enumerate(texts)))


def test_very_long_text_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CHUNK", 700)
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefgh", k=9000))
    texts = [long, long[2500:3600], "n" * 5000, long[5500:5900] + long[2600:2900]]
    assert found(suffix_dedup.digests(by_hand(spark, texts))) == plain(list(enumerate(texts)))


def test_texts_are_cleaned(spark):
    docs = odd_documents(spark)
    out = suffix_dedup.remove_repeats(docs, size="n_chars")
    assert out.columns == docs.columns and out.count() == docs.count()
    removed = {r[0]: r[2] for r in plain([r[:2] for r in odd_rows()])}
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for row in out.collect():
        if row["doc_id"] is not None and row["doc_id"] != 9:
            if not removed[row["doc_id"]]:
                assert row["text"] == before[row["doc_id"]]
            else:
                assert len(row["text"].encode()) <= len(before[row["doc_id"]].encode()) - removed[row["doc_id"]]
            if row["text"] is not None:
                assert row["n_chars"] == len(row["text"])


def test_empty(spark):
    assert suffix_dedup.digests(no_documents(spark)).collect() == []
    assert suffix_dedup.remove_repeats(no_documents(spark)).collect() == []


@pytest.mark.parametrize("alphabet", [2, 2048])
def test_suffix_arrays(monkeypatch, alphabet):
    monkeypatch.setattr(induced, "ALPHABET", alphabet)
    rng = np.random.default_rng(3)
    for turn in range(300):
        k = int(rng.integers(1, 5))
        text = rng.integers(0, k, rng.integers(1, 60))
        text = np.tile(text, 1 + turn % 3)
        order = induced.suffix_array(text, k)
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())


def test_common_prefixes():
    text = np.frombuffer(b"banana bandana ananas" + bytes(40), np.uint8)
    order = induced.suffix_array(text[:21].astype(np.int64), 256)
    got = induced.common_prefixes(text, order, 16)
    for i in range(1, 21):
        a, b = order[i - 1], order[i]
        shared = next(n for n in range(17) if n == 16 or text[a + n] != text[b + n] or max(a, b) + n >= 21)
        assert got[i] == shared or max(a, b) + shared >= 21


def test_rows_repeated_as_a_whole_are_gathered_once(spark, monkeypatch):
    """One shard gets each segment once, and a document each of its spans once."""
    pieces, inner = [], suffix_dedup.shard_spans

    def seen(frame, *rest):
        pieces.extend((r["id"], r["place"], r["first"]) for r in frame.collect())
        return inner(frame, *rest)

    monkeypatch.setattr(suffix_dedup, "shard_spans", seen)
    rng = random.Random(8)
    shared = words(rng, 100)
    rows = [(1, words(rng, 80) + shared + words(rng, 70))] * 30 + [(2, words(rng, 60) + shared + words(rng, 50))]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    spans = {r["__id"]: r["__spans"] for r in suffix_dedup._spans_by_document(docs, "doc_id", "text", 200).collect()}
    assert pieces and len(pieces) == len(set(pieces))
    assert set(spans) == {1, 2} and all(len(x) == len({(y["start"], y["stop"]) for y in x}) for x in spans.values())

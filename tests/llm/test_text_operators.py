import math
import random
import uuid
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from paperloom.llm import gated, language_id, lm_scoring, quality, token_files
from paperloom.llm.common import folded_words, id_crc
from tests.llm.data import no_documents, odd_documents, odd_rows, words

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")


# --- quality -------------------------------------------------------------------------------------------

def test_counts_by_hand():
    assert quality.text_counts(None) == (0, 0, 0, 0, 0)
    assert quality.text_counts("a b c a b c") == (6, 6, 0, 0, 6)
    assert quality.text_counts("a b c x a b c") == (7, 7, 0, 0, 6)
    assert quality.text_counts("é#|\n\n \né#|\nb") == (3, 7, 4, 1, 0)
    assert quality.text_counts("a a a a") == (4, 4, 0, 0, 4)


def test_hosts_are_shrunk(spark):
    good, bad = words(random.Random(1), 80), "too short"
    rows = [(f"good{h}", good) for h in range(6) for _ in range(40)] + [("bad", bad)] * 35 + [("bad", good)] * 5
    rows += [("tiny", bad), (None, bad), (None, good)]
    docs = spark.createDataFrame([(i, t, h) for i, (h, t) in enumerate(rows)], "doc_id bigint, text string, source string")
    out = {r["doc_id"]: r for r in quality.judge(docs).collect()}
    assert all(out[i]["kept"] == (h is None and t == good or (h or "").startswith("good")) for i, (h, t) in enumerate(rows))
    tiny = next(out[i] for i, (h, _) in enumerate(rows) if h == "tiny")
    assert tiny["host_rate"] < 1 and out[240]["host_rate"] > 0.8
    kept = quality.keep_documents(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if r["kept"]}


def test_quality_odd_rows(spark):
    out = quality.judge(odd_documents(spark)).collect()
    assert len(out) == len(odd_rows())
    want = Counter((r[0], *quality.text_counts(r[1])) for r in odd_rows())
    assert Counter((r["doc_id"], *[r[c] for c in quality.COUNTS]) for r in out) == want
    assert quality.keep_documents(odd_documents(spark)).columns == odd_documents(spark).columns
    assert quality.judge(no_documents(spark)).collect() == [] and quality.keep_documents(no_documents(spark)).collect() == []


# --- language ------------------------------------------------------------------------------------------

def test_language_odd_rows(spark):
    held_out = id_crc() % 3 == 1
    out = language_id.identify(odd_documents(spark), ~held_out, columns=(F.col("doc_id"), F.col("text"))).collect()
    assert len(out) == len(odd_rows())
    for row in out:
        letters = any(c.isalpha() for c in row["text"] or "")
        assert (row["lang_pred"] == "und") == (not letters) and 0 <= row["score"] <= 1
    assert language_id.identify(no_documents(spark), F.lit(True)).collect() == []
    unlabelled = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language_id.identify(unlabelled, F.lit(True)).collect()} == {"und"}


def test_language_backs_off_to_shorter_grams():
    def table(*grams):
        return {g: i for i, g in enumerate(grams)}, np.array([[-1.0, -3.0]] * len(grams))

    model = {"langs": ["a", "b"], "tables": [table("known"), table("z"), table("xy"), table("^qu"), table(), table()]}
    scorer = language_id.Scorer(model)
    assert scorer.word("known").tolist() == [-1, -3]
    step = language_id.STEP_COST
    assert np.allclose(scorer.word("quit"), np.array([-1, -3]) - 3 * step)
    assert np.allclose(scorer.word("oxyo"), np.array([-1, -3]) - 4 * step)
    assert np.allclose(scorer.word("oz"), np.array([-1, -3]) - 5 * step)
    assert scorer.word("none").tolist() == [0, 0]
    assert scorer.predict(["known", None, "12"]) == (["a", "und", "und"], pytest.approx([1 / 1.01, 0, 0]))


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held_out = id_crc() % 3 == 1
    out = language_id.identify(docs, ~held_out, columns=(F.col("lang"), held_out.alias("h"))).where("h and lang is not null").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.97


# --- token files -----------------------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 24, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1000).astype("<u4")
    packed = token_files.pack_ids(ids, bits)
    assert len(packed) == 125 * bits and (token_files.unpack_ids(packed, bits, 1000) == ids).all()
    assert token_files.bits_for(2**bits) == bits and token_files.bits_for(1) == 1


def test_file_random_access(tmp_path):
    rng = np.random.default_rng(2)
    docs = [rng.integers(0, 1 << 13, n).astype("<u4") for n in (5, 0, 30_000, 8192, 1, 200_000)]
    with open(tmp_path / "f", "wb") as sink:
        writer = token_files.TokenWriter(sink, 13)
        for number, ids in enumerate(docs):
            writer.add(None if number == 1 else number, ids.tobytes())
        writer.close()
    import pyarrow.fs

    with pyarrow.fs.LocalFileSystem().open_input_file(str(tmp_path / "f")) as source:
        file = token_files.TokenFile(source)
        every = np.concatenate(docs)
        assert file.n_tokens == len(every) and file.nulls.tolist() == [0, 1, 0, 0, 0, 0]
        for start, stop in ((0, 0), (3, 9), (8190, 8195), (0, len(every)), (len(every) - 1, len(every))):
            assert (file.tokens(start, stop) == every[start:stop]).all()
        assert (file.document(4) == docs[4]).all()
        assert all((got == docs[n]).all() for n, got in file.documents(at_once=1000))


def test_pieces_encode_like_whole_texts():
    tokenizer = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(3)
    texts = ["".join(rng.choices(list("ab  ..,\n\t'1é²_-|ß中\x1c ́sS"), k=rng.randint(0, 30))) for _ in range(5000)]
    texts += [r[1] for r in odd_rows()] + ["it's  <|endoftext|>, a. b", "\n\n a,\n b", " lead", "trail ", "x ,y"]
    got = token_files.Encoder(tokenizer).encode(texts)
    for text, ids in zip(texts, got, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids, text


def test_token_files_odd_rows(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = tokenizers.Tokenizer.from_file(path)
    folder = token_files.token_folder(spark)
    manifest = token_files.write_tokens(odd_documents(spark), folder, path)
    out = token_files.read_documents(spark, manifest).collect()
    assert len(out) == len(odd_rows())
    out.sort(key=lambda r: r["start"])
    ids = [r["doc_id"] for r in out]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    start = 0
    for row in out:
        assert row["start"] == start
        start += row["n_tokens"]

    def crc(text):
        encoded = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        return len(encoded), zlib.crc32(np.array(encoded, "<u4").tobytes())

    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == Counter((r[0], *crc(r[1])) for r in odd_rows())
    empty = token_files.write_tokens(no_documents(spark), token_files.token_folder(spark), path)
    assert token_files.read_documents(spark, empty).collect() == []


def test_numerals_end_a_word():
    assert language_id.words_of("Maison² a½b CO₂, ²³ x1y été") == ["maison", "a", "b", "co", "x", "y", "été"]


# --- language model ---------------------------------------------------------------------------------------

def plain_base(rows, learned):
    folded = [(t or "").encode().lower().split() + [b""] for _, t in rows]
    counts = Counter(w for (key, _), ws in zip(rows, folded, strict=True) if learned(key) for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for ws in folded]


@pytest.mark.parametrize(("dictionary", "vocabulary"), [(300_000, 4096), (40, 10)])
def test_scores_odd_rows(spark, dictionary, vocabulary):
    """With the small dictionary most words take the way through the join."""
    rows = [r[:2] for r in odd_rows()]
    out = lm_scoring.scored(odd_documents(spark), id_crc() % 10 != 0, dictionary=dictionary, vocabulary=vocabulary).collect()
    learned = lambda key: zlib.crc32(("" if key is None else str(key)).encode()) % 10 != 0
    want = sorted(((key, not learned(key), *p) for (key, _), p in zip(rows, plain_base(rows, learned), strict=True)), key=repr)
    got = sorted(((r[0], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in out), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert [g[5] for g in got] == pytest.approx([w[5] for w in want])
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in out)


def test_scores_without_rows_or_training(spark):
    assert lm_scoring.scored(no_documents(spark), F.lit(True)).collect() == []
    out = lm_scoring.scored(odd_documents(spark), F.lit(False)).collect()
    assert all(r["held_out"] and r["train_tokens"] == 0 and r["base_score"] == pytest.approx(0) for r in out)


def test_no_task_scans_several_parts_of_the_documents(spark, tmp_path):
    def noted(batches):
        for batch in batches:
            if batch.num_rows:
                with open(f"{folder}/{TaskContext.get().taskAttemptId()}", "a") as file:
                    file.write(f"{batch.column(0)[0]}\n")
            yield batch

    folder = str(tmp_path)
    rows = spark.sparkContext.parallelize([(i, "a b c " * 5) for i in range(40)], 8).toDF("doc_id bigint, text string")
    lm_scoring.scored(rows.mapInArrow(noted, rows.schema), F.lit(True)).collect()
    assert all(len(file.read_text().split()) == 1 for file in tmp_path.iterdir())


def test_every_training_document_is_learned_from(spark, tmp_path, monkeypatch):
    """Two million tokens, more than any one task takes here."""
    folder, inner = str(tmp_path), gated.train

    def noted(model, documents, *rest):
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as file:
            file.write(f"{len(documents)} {sum(map(len, documents))}")
        return inner(model, documents, *rest)

    monkeypatch.setattr(lm_scoring, "train", noted)
    rows = spark.range(4_000, numPartitions=4).select(F.col("id").alias("doc_id"), F.expr("repeat('a b c d e ', 100)").alias("text"))
    out = lm_scoring.scored(rows, F.col("doc_id") >= 10, shard_tokens=100_000).agg(F.sum("score"), F.sum("base_score")).first()
    took = [tuple(map(int, file.read_text().split())) for file in tmp_path.iterdir()]
    assert (sum(t[0] for t in took), sum(t[1] for t in took)) == (3_990, 3_990 * 501)
    assert max(t[1] for t in took) <= 200_000 + 501 and out[0] > 0.5 * out[1]


def test_means_of_weights():
    models = [{"starts": np.array([0, 2]), "turn": np.full((2, 2), x, np.float32)} for x in (1.0, 5.0)]
    rows = [(t, lm_scoring._saved(m)) for t, m in zip((300, 100), models, strict=True)]
    total, mean = lm_scoring.averaged(iter(rows))
    assert total == 400 and mean["starts"].tolist() == [0, 2] and (mean["turn"] == 2).all()
    assert lm_scoring.averaged([]) == (0, None)


def tiny_model(size=7):
    model = gated.fresh_model(np.arange(size, 0, -1).astype(float), hidden=4, classes=3)
    rng = np.random.default_rng(1)
    return {k: v if k == "starts" else (v + rng.normal(0, 0.3, v.shape)).astype(np.float32) for k, v in model.items()}


def test_probabilities_add_up_and_state_carries_over(monkeypatch):
    model = tiny_model()
    pairs = [np.array([a, b], np.int32) for a in range(7) for b in range(7)]
    assert np.exp(gated.log_likelihoods(model, pairs)).sum() == pytest.approx(1, abs=1e-4)
    docs = [np.random.default_rng(n).integers(0, 7, n).astype(np.int32) for n in (1, 40, 3, 170, 64, 0)]
    whole = gated.log_likelihoods(model, docs)
    for lanes in (1, 2, 100):
        assert gated.log_likelihoods(model, docs, lanes) == pytest.approx(whole, rel=1e-4)
    monkeypatch.setattr(gated, "WINDOW", 5)
    assert gated.log_likelihoods(model, docs) == pytest.approx(whole, rel=1e-4)


def test_gates_of_far_numbers():
    """Also where a power has no finite value, and without a warning."""
    x = np.array([-200, -89, -20, -1, -1e-4, 0, 1e-4, 1, 20, 89, 200], np.float32)
    with np.errstate(all="raise", under="ignore"):
        found = gated._sigmoid(x.copy())
    assert found.dtype == np.float32 and found == pytest.approx(1 / (1 + np.exp(-x.astype(float))), rel=1e-5, abs=1e-30)


def test_gradients_by_differences():
    model = {k: v if k == "starts" else v.astype(np.float64) for k, v in tiny_model().items()}
    docs = [np.array([1, 3, 2, 6, 0], np.int32), np.array([5, 5, 4], np.int32)]

    def loss(m):
        return -gated.log_likelihoods(m, docs, 2).sum() / 8

    run = gated.Lanes(docs, 2, 7)
    steps = next(iter(run.windows()))
    kept, states, state = [], [], np.zeros((2, 4))
    for places in steps:
        now = state[: len(places)].copy()
        now[run.first[places]] = 0
        out = gated._step(model, now, run.source[places], kept)
        state[: len(places)] = out
        states.append(out)
    grad = gated._gradients(model, kept, steps, run, states)
    rng = np.random.default_rng(6)
    for name in grad:
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in model[name].shape)
            up, down = ({**model, name: model[name].copy()} for _ in range(2))
            up[name][at] += 1e-3
            down[name][at] -= 1e-3
            assert (loss(up) - loss(down)) / 2e-3 == pytest.approx(grad[name][at], abs=2e-3), name


def test_training_learns_what_counts_cannot():
    rng = np.random.default_rng(0)
    docs = []
    for _ in range(400):
        first = rng.integers(0, 2)
        docs.append(np.array([*(2 * rng.integers(0, 3, 20) + first), 6], np.int32))
    counts = np.bincount(np.concatenate(docs), minlength=7).astype(float)
    order = np.argsort(-counts, kind="stable")
    docs = [np.argsort(order)[d].astype(np.int32) for d in docs]
    fresh = gated.fresh_model(counts[order], hidden=8, classes=3)
    before = gated.log_likelihoods(fresh, docs[300:]).sum()
    after = gated.log_likelihoods(gated.train(dict(fresh), docs[:300] * 4, lanes=16), docs[300:]).sum()
    assert after > 0.8 * before


def test_a_long_document_does_not_stretch_training(monkeypatch):
    """Lanes are even, so updates follow the tokens; every token is learned from once, after the token before it."""
    rng = np.random.default_rng(3)
    docs = [rng.integers(0, 7, n).astype(np.int32) for n in [6_400, 0, *[100] * 64]]
    run = gated.Lanes(docs, 64, 7, cut=True)
    places = np.concatenate([np.concatenate(steps) for steps in run.windows()])
    assert sorted(places.tolist()) == list(range(12_800)) and run.size.max() == 200
    assert run.target.tolist() == np.concatenate(docs).tolist()
    assert run.source[run.first].tolist() == [7] * 65 and (run.source[1:] == run.target[:-1])[~run.first[1:]].all()
    inner, updates = gated._gradients, []
    monkeypatch.setattr(gated, "_gradients", lambda *args: updates.append(1) or inner(*args))
    gated.train(gated.fresh_model(np.arange(7, 0, -1).astype(float), hidden=4, classes=3), docs, 64)
    assert len(updates) == 7


def test_rows_are_added_where_they_repeat():
    rng = np.random.default_rng(0)
    for n, size in ((0, 5), (1, 5), (100, 3), (5_000, 20), (5_000, 4_097), (3_000, 70_000)):
        rows, values, out = (rng.zipf(1.3, n) % size).astype(np.int32), rng.normal(size=(n, 6)), np.zeros((size, 6))
        want = out.copy()
        np.add.at(want, rows, values)
        gated._add_rows(out, rows, values)
        assert out == pytest.approx(want)


def test_words_are_cut_in_columns_as_one_by_one():
    texts = ["", "  ", " a\x0bB\x0c\x1cÉ  x ", None, "\u0085y Z", "One\r\ntwo\tTHREE\n", *[r[1] for r in odd_rows()]]
    for kind in (pa.string(), pa.large_string()):
        found, lengths = lm_scoring.words_of(pa.array(texts, kind))
        want = [folded_words(text) for text in texts]
        assert lengths.tolist() == [len(w) for w in want] and found.to_pylist() == [x for w in want for x in w]

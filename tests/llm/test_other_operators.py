import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperloom.llm import chat, mixing, packing, topk
from paperloom.llm.cover_tree import top_products
from tests.llm.data import no_documents, odd_documents, odd_rows

# --- chat ---------------------------------------------------------------------------------------------

TURNS = [
    (1, 0, "user", "hi </s> \\ [INST]"), (1, 1, "assistant", "<s>\\</s>\\\\"), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "assistant", "<<SYS>> é\n<</SYS>>"),
    (2, 0, "user", "alone"), (3, 5, "assistant", "tie b"), (3, 5, "assistant", "tie a"), (3, None, None, "first"), (3, 5, "assistant", "tie a"),
    (None, 0, "assistant", "no id"), (4, 0, "[/INST]", "odd role"), (4, 1, "assistant", "x" * 50_000),
]


def conversations(spark, rows=TURNS):
    return spark.createDataFrame([(*r, "extra") for r in rows], "conv_id bigint, turn bigint, role string, text string, piece string")


def test_chat_round_trip(spark):
    path = chat.write_chat(chat.format_turns(conversations(spark)))
    out = {r["conv_id"]: r for r in chat.read_back(spark.read.parquet(path)).collect()}
    groups = defaultdict(list)
    for conv, turn, role, text in TURNS:
        groups[conv].append((turn if turn is not None else -1, role or "", text or ""))
    assert set(out) == set(groups)
    for conv, turns in groups.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        row = out[conv]
        assert (row["n_turns"], row["loss_chars"], row["n_examples"]) == (len(turns), len(loss), sum(r == "assistant" for _, r, _ in turns))
        assert row["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert row["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_each_reply_is_an_example_with_all_before_it(spark):
    turns = chat.format_turns(conversations(spark))
    examples = sorted(chat.expand(turns).where("conv_id = 1").collect(), key=lambda r: r["example"])
    assert [r["example"] for r in examples] == [1, 2, 3]
    assert [chat.unescape(r["text"][r["loss_start"] : r["loss_end"]]) for r in examples] == ["<s>\\</s>\\\\", "", "<<SYS>> é\n<</SYS>>"]
    assert examples[1]["text"].startswith(examples[0]["text"]) and examples[2]["text"].startswith(examples[1]["text"])
    for row in examples:
        assert row["text"].endswith("</s>") and row["loss_end"] == len(row["text"]) - len(chat.CLOSE)


def test_examples_are_written_with_their_contexts(spark):
    """The output has every example as a whole, and the turns behind the last one."""
    turns = chat.format_turns(conversations(spark))
    pieces = defaultdict(list)
    for row in sorted(turns.collect(), key=lambda r: r["position"]):
        pieces[row["conv_id"]].append(row)
    written = spark.read.parquet(chat.write_chat(turns)).collect()
    wanted = [(c, row["example"], "".join(r["piece"] for r in rows[: n + 1]), n + 1 == len(rows))
              for c, rows in pieces.items() for n, row in enumerate(rows) if row["is_target"] or n + 1 == len(rows)]
    assert Counter((r["conv_id"], r["example"], r["text"], r["is_last"]) for r in written) == Counter(wanted)


def test_escapes(spark):
    rng = random.Random(1)
    parts = [*chat.CONTROLS, "\\", "<", "[", "s>", "INST]", "a", "/"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 8))) for _ in range(2000)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for row in frame.collect():
        assert chat.unescape(row["e"]) == row["t"] and not any(c in row["e"] for c in chat.CONTROLS)


def test_chat_empty(spark):
    none = conversations(spark, []).limit(0)
    assert chat.read_back(chat.format_turns(none)).collect() == [] and chat.expand(chat.format_turns(none)).collect() == []


# --- top-k ----------------------------------------------------------------------------------------------

def plain_top(rows, is_query, k):
    usable = [(i, np.floor(256 * np.array(v, float)).astype(np.int64)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for i, v in usable:
        if is_query(i):
            scored = sorted((-int(v @ w), j) for j, w in usable if j != i and len(w) == len(v))[:k]
            out += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored, 1)]
    return sorted(out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id bigint, embedding array<float>, score int")


@pytest.mark.parametrize(("block", "group"), [(8192, 4096), (64, 3)])
def test_top_k_equals_brute_force(spark, block, group):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (5, 6))
    points = (centres[rng.integers(0, 5, 700)] + rng.normal(0, 0.05, (700, 6))).astype(np.float32)
    points[100:300] = points[0]
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    rows += [(700, None), (750, [None] * 6), (800, [float("nan")] + [0.0] * 5), (850, [float("inf")] * 6), (None, [1.0] * 6), (900, [1.0, 2.0]), (901, [3.0, 1.0]), (950, [])]
    got = topk.search(vectors(spark, rows), F.col("vec_id") % 50 == 0, block_rows=block, group_rows=group)
    assert sorted(map(tuple, got.collect())) == plain_top(rows, lambda i: i % 50 == 0, 5)


def test_top_k_of_few_and_of_none(spark):
    got = topk.search(vectors(spark, [(0, [1.0]), (7, [2.0])]), F.col("vec_id") % 50 == 0)
    assert [tuple(r) for r in got.collect()] == [(0, 1, 7, 256 * 512)]
    assert topk.search(vectors(spark, [(1, None)]), F.col("vec_id") % 50 == 0).collect() == []


def test_large_numbers_are_exact():
    data = np.array([[2**31, 1], [2**31, 2], [2**31, 3], [-(2**31), 5]])
    got = top_products(data, np.arange(4), data, np.arange(4), 2)
    for q in range(4):
        want = sorted(((-(int(data[q, 0]) * int(data[d, 0]) + int(data[q, 1]) * int(data[d, 1])), d) for d in range(4) if d != q))[:2]
        assert [(d, s) for a, d, s in got if a == q] == [(d, -s) for s, d in want]


# --- mixing -------------------------------------------------------------------------------------------------

def test_raking_meets_its_targets(spark):
    rng = random.Random(3)
    cells = spark.createDataFrame(
        [(f"s{a}", f"l{b}", f"t{c}", rng.randrange(1, 1000)) for a in range(4) for b in range(3) for c in range(2)],
        "_source string, _lang string, _topic string, tokens bigint",
    )
    goals = {
        "_source": spark.createDataFrame([("s0", 4.0), ("s1", 1.0), ("s2", 1.0), ("s3", 2.0), ("absent", 9.0)], "_source string, share double"),
        "_lang": spark.createDataFrame([("l0", 0.5), ("l1", 0.25), ("l2", 0.25)], "_lang string, share double"),
        "_topic": spark.createDataFrame([("t0", 0.3), ("t1", 0.7)], "_topic string, share double"),
    }
    fitted = mixing.rake(cells, goals, rounds=8).collect()
    total = sum(r["tokens"] for r in fitted)
    for dim, want in (("_source", {"s0": 0.5, "s1": 0.125, "s2": 0.125, "s3": 0.25}), ("_lang", {"l0": 0.5, "l1": 0.25, "l2": 0.25}), ("_topic", {"t0": 0.3, "t1": 0.7})):
        sums = Counter()
        for r in fitted:
            sums[r[dim]] += r["tokens"] * r["factor"]
        assert {k: v / total for k, v in sums.items()} == pytest.approx(want, rel=1e-3)
    frame = spark.createDataFrame(fitted)
    rate = mixing.rate_for(frame, 0.5)
    assert sum(r["tokens"] * min(1.0, rate * r["factor"]) for r in fitted) == pytest.approx(0.5 * total, rel=1e-6)


def test_mixing_odd_rows(spark):
    docs = odd_documents(spark)
    out = mixing.mix(docs.select("doc_id", "text", "source", "lang")).collect()
    assert len(out) == len(odd_rows()) and all(0 <= r["_chance"] <= 1 for r in out)
    kept = mixing.keep_sampled(docs)
    assert kept.columns == docs.columns
    whole = Counter(tuple(r) for r in odd_rows())
    assert not Counter(tuple(r) for r in kept.collect()) - whole
    assert mixing.keep_sampled(no_documents(spark)).collect() == []


# --- packing --------------------------------------------------------------------------------------------------

def plain_best_fit(sizes, masks, capacity):
    """The tightest compatible bin by looking at all of them."""
    bins, out = [], []
    for size, mask in zip(sizes, masks, strict=True):
        fitting = [(capacity - b[0], b[2]) for b in bins if capacity - b[0] >= size and not b[1] & mask]
        if fitting:
            tightest = min(f[0] for f in fitting)
            # the bin that has had this residual the longest
            number = min((b[3], b[2]) for b in bins if capacity - b[0] == tightest and not b[1] & mask)[1]
        else:
            number = len(bins)
            bins.append([0, 0, number, 0])
        chosen = bins[number]
        out.append((number, chosen[0]))
        chosen[0] += size
        chosen[1] |= mask
        chosen[3] = len(out)
    return out


def test_bins_take_the_tightest_compatible_place():
    rng = random.Random(6)
    for _ in range(200):
        sizes = sorted((rng.randint(1, 40) for _ in range(60)), reverse=True)
        masks = [rng.choice([0, 1, 2, 4, 3]) for _ in sizes]
        bins = packing.Bins(40)
        assert [bins.place(s, m) for s, m in zip(sizes, masks, strict=True)] == plain_best_fit(sizes, masks, 40)


def test_packing_odd_rows(spark):
    docs = odd_documents(spark)
    out = packing.pack(docs, packing.word_tokens(), source=F.col("source"), cluster=F.md5("text"), capacity=500, shard_rows=8).collect()
    sums, places, bins = Counter(), defaultdict(list), defaultdict(list)
    for r in out:
        sums[r["doc_id"]] += r["n_tokens"]
        if r["bin_id"] is None:
            assert r["n_tokens"] == 0
            continue
        bins[r["bin_id"]].append(r)
        places[(r["doc_id"], r["cluster"])].append((r["start_token"], r["n_tokens"]))
    want = Counter()
    for row in odd_rows():
        want[row[0]] += len((row[1] or "").encode().split())
    assert +sums == +want
    for rows in bins.values():
        rows.sort(key=lambda r: r["bin_offset"])
        at = 0
        for r in rows:
            assert r["bin_offset"] == at
            at += r["n_tokens"]
        assert at <= 500
        for name in ("source", "cluster"):
            values = [r[name] for r in rows if r[name] is not None]
            assert len(set(values)) == len(values)
    assert packing.pack(no_documents(spark), packing.word_tokens()).collect() == []


@pytest.mark.parametrize("key", [7, None])
def test_rows_of_one_key_are_dealt_to_many_shards(spark, key):
    rows = [(key, "same text", "s")] * 400 + [(i, "other text", "s") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    out = packing.pack(docs, packing.word_tokens(), cluster=F.md5("text"), shard_rows=20).collect()
    assert len(out) == 800 and max(Counter(r["bin_id"] >> 32 for r in out).values()) < 100

import random

import numpy as np
import pytest

from paperloom.llm import near_dedup
from paperloom.llm.components import components
from tests.llm.data import by_hand, no_documents, odd_documents, odd_rows, words


def plain_sets(text, size):
    found = (text or "").encode().lower().split()
    if not found:
        return set()
    return {tuple(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def plain_components(rows, size, percent):
    """(n_shingles, component) per row, all pairs compared."""
    sets = [plain_sets(text, size) for _, text in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= percent * len(a | sets[j]):
                parent[root(i)] = root(j)
    lowest = {}
    for i, (key, _) in enumerate(rows):
        known = lowest.get(root(i))
        lowest[root(i)] = key if known is None else known if key is None else min(known, key)
    return [(len(s), lowest[root(i)] if s else rows[i][0]) for i, s in enumerate(sets)]


def found(frame):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in frame.collect()), key=repr)


def expected(rows, size=4):
    plain = plain_components(rows, size, 80)
    return sorted(((key, n, c, key == c) for (key, _), (n, c) in zip(rows, plain, strict=True)), key=repr)


@pytest.mark.parametrize("size", [4, 5])
def test_odd_rows(spark, size):
    rows = [r[:2] for r in odd_rows()]
    assert found(near_dedup.near_duplicates(odd_documents(spark), shingle=size)) == expected(rows, size)


def test_empty(spark):
    assert near_dedup.near_duplicates(no_documents(spark)).collect() == []
    assert near_dedup.keep_one(no_documents(spark)).columns == no_documents(spark).columns


def test_chains_and_large_groups(spark, monkeypatch):
    """Drifting copies: links between neighbours only, in buckets larger than a block."""
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    monkeypatch.setattr(near_dedup, "PART", 4)
    rng = random.Random(2)
    texts = []
    for _ in range(3):
        drift = words(rng, 90, pool=5000).split(" ")
        for _ in range(40):
            at = rng.randrange(len(drift))
            drift[at] = f"n{rng.randrange(10**6)}"
            texts.append(" ".join(drift))
    shared = words(rng, 60, pool=5000)
    texts += [shared + " " + words(rng, 12, pool=5000) for _ in range(60)]
    texts += [texts[0]] * 50
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    assert found(near_dedup.near_duplicates(by_hand(spark, texts), shingle=4)) == expected(rows)


def test_nodes_outside_are_sent_to_a_large_component_that_stays(spark, monkeypatch):
    """600 linked nodes and 3 that share buckets with them: the rows sent grow with those outside."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    sent = []
    whole = near_dedup.pairs_across

    def counted(dealt, *args):
        sent.append(dealt.count())
        return whole(dealt, *args)

    monkeypatch.setattr(near_dedup, "pairs_across", counted)
    rng = random.Random(9)
    base = words(rng, 300, pool=5000).split(" ")
    texts = []
    for _ in range(600):
        near = list(base)
        near[rng.randrange(300)] = f"n{rng.randrange(10**6)}"
        texts.append(" ".join(near))
    for _ in range(3):
        far = list(base)
        for at in range(0, 300, 28):
            far[at] = f"f{rng.randrange(10**6)}"
        texts.append(" ".join(far))
    rows = list(enumerate(texts))
    assert found(near_dedup.near_duplicates(by_hand(spark, texts), shingle=4)) == expected(rows)
    # per pass: the large component once, each node outside once per block of it; and those outside by bucket
    assert sent and max(sent) <= 603 + 3 * 80


def test_one_of_each_group_stays(spark):
    kept = near_dedup.keep_one(odd_documents(spark), shingle=5)
    assert kept.columns == odd_documents(spark).columns
    rows = kept.select("doc_id", "text").collect()
    assert len({tuple(r) for r in rows}) == len(rows)
    left = [(r["doc_id"], r["text"]) for r in rows]
    assert all(key == c for (key, _), (n, c) in zip(left, plain_components(left, 5, 80), strict=True) if n)


def test_posterior_bounds():
    table = near_dedup.least_matches(80, 1e-8)
    assert list(table) == list(range(20, 161, 20)) and all(m < 0.8 * n for n, m in table.items())
    rng = np.random.default_rng(0)
    left = rng.integers(0, 2**32, (4000, near_dedup.HASHES), np.uint32)
    right = np.where(rng.random(left.shape) < 0.8, left, left ^ 1)
    assert near_dedup.plausible(left, right, table).all()
    right = np.where(rng.random(left.shape) < 0.3, left, left ^ 1)
    assert not near_dedup.plausible(left, right, table).any()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    shared, a, b = (rng.integers(0, 2**63, n, np.uint64) for n in (4000, 1000, 1000))
    one, two = (near_dedup.signature(np.unique(np.concatenate((shared, x)))) for x in (a, b))
    assert abs((one == two).mean() - 4000 / 6000) < 0.12


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(30)] + [(100, 100 + k) for k in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    parent = {}
    for a, b in edges:
        ra, rb = a, b
        while parent.get(ra, ra) != ra:
            ra = parent[ra]
        while parent.get(rb, rb) != rb:
            rb = parent[rb]
        parent[max(ra, rb)] = min(ra, rb)
    want = {}
    for x in {n for e in edges for n in e}:
        r = x
        while parent.get(r, r) != r:
            r = parent[r]
        if r != x:
            want[x] = r
    got = components(spark.createDataFrame(edges, "a bigint, b bigint"))
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


@pytest.mark.parametrize("key", [7, None])
def test_one_near_copy_stays_when_ids_do_not_tell_them_apart(spark, key):
    """Also a repeated row of the copy that stays goes, and rows without a word stay."""
    text = words(random.Random(3), 200)
    copies = [text, text + " more", text + " and more", text + " more"]
    rows = [(key, t) for t in copies] + [(None, text + " no id"), (8, "something else"), (9, "")]
    kept = near_dedup.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    assert sorted((r["doc_id"] for r in kept), key=repr) == sorted([key, 8, 9], key=repr)

"""MinHash near-duplicates with sequential Bayesian verification and an exact check.

1. Each text becomes its set of word shingles (64-bit hashes), a digest of the set, and a MinHash signature.
   Equal sets are one node from here on, whatever the number of copies.
2. Signatures are cut into bands; nodes that share a band are candidates. With ``ROWS`` rows and ``BANDS``
   bands a pair at similarity 0.8 is missed with probability (1 - 0.8 ** 5) ** 32 = 3e-6, a closer pair less.
3. Within a bucket every node is first compared with one hub only, so a bucket of n nodes gives n - 1 pairs. The
   hub is the node that meets most others over all its buckets: what many copies were made from. Connected components of
   the links found are contracted. Where a bucket still holds several, the largest stays in place, its members dealt once
   for all buckets, and the nodes outside are sent to it and to each other, by blocks of bounded size. They are compared inside
   the tasks. These steps give rows for links that join components, not for pairs.
4. A comparison reads the signatures batch by batch. With a uniform prior, the posterior probability that
   the similarity reaches the threshold after m of n equal hashes is a binomial tail; the pair is dropped as
   soon as that is below ``miss``. Sets whose sizes alone rule the threshold out are dropped first.
5. What survives is verified on the full sets, made again from whole texts.

Scale: signatures, buckets and links stay distributed and are landed where more than one step reads them.
A hub of many partners is split into parts of ``PART`` pairs; verification streams over sorted rows, one set
at a time. Hot digests and buckets meet partial aggregation or joins that the adaptive planner splits.

Defined cases: without words or text the set is empty and linked with nothing; fewer words than a shingle are
one shingle; component ids ignore null ids, and are null if all ids of a component are; repeated rows
are copies; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from paperloom.llm.common import folded_words, shipped
from paperloom.llm.components import components
from paperloom.session import land

ROWS, BANDS, BATCH = 5, 32, 20
HASHES = ROWS * BANDS
PART = 256
BLOCK, BLOCK_SHINGLES = 512, 500_000
_MASK = (1 << 64) - 1


@cache
def _multipliers(count: int, seed: int) -> np.ndarray:
    """Odd numbers for multiplicative hashing, the same in every process."""
    return np.random.default_rng(seed).integers(0, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of a whole text as sorted 64-bit hashes."""
    words = folded_words(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    factors = _multipliers(size, 4)
    if len(words) < size:
        total = int((hashes * factors[: len(words)]).sum(dtype=np.uint64)) + len(words) * 0x9E3779B97F4A7C15
        return _mixed(np.array([total & _MASK], np.uint64))
    count = len(words) - size + 1
    total = hashes[:count] * factors[0]
    for k in range(1, size):
        total += hashes[k : k + count] * factors[k]
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """``HASHES`` minima, as the upper halves of 64-bit products."""
    factors = _multipliers(HASHES, 11)
    low = np.full(HASHES, _MASK, np.uint64)
    for first in range(0, len(shingles), 2048):
        np.minimum(low, (shingles[first : first + 2048, None] * factors).min(axis=0), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def band_keys(signatures: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    rows = signatures.astype(np.uint64).reshape(len(signatures), BANDS, ROWS)
    total = (rows * _multipliers(ROWS, 23)).sum(axis=2, dtype=np.uint64)
    return _mixed(total + _multipliers(BANDS, 31)).view(np.int64)


def least_matches(percent: int, miss: float) -> dict[int, int]:
    """Per number of hashes read, the fewest equal ones at which a pair is kept.

    With a uniform prior, P(similarity >= t | m of n equal) = P(Binomial(n + 1, t) <= m).
    """
    t = percent / 100
    table = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, -1
        while m < n:
            m += 1
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= miss:
                break
        table[n] = m
    return table


def plausible(left: np.ndarray, right: np.ndarray, table: dict[int, int]) -> np.ndarray:
    """Which row pairs of two signature matrices pass every batch."""
    alive = np.arange(len(left))
    equal = np.zeros(len(left), np.int64)
    for n, least in table.items():
        part = slice(n - BATCH, n)
        equal[alive] += (left[alive, part] == right[alive, part]).sum(axis=1)
        alive = alive[equal[alive] >= least]
        if not len(alive):
            break
    out = np.zeros(len(left), bool)
    out[alive] = True
    return out


def _sizes_allow(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    return 100 * np.minimum(a, b) >= percent * np.maximum(a, b)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, HASHES)


# --- steps ------------------------------------------------------------------------------------------

SKETCH = "doc_id bigint, place bigint, n_shingles bigint, digest binary, sig binary"


def sketch(docs: DataFrame, key: str, text: str, shingle: int) -> DataFrame:
    """Per row: its id, a hash of its text, size and digest of its set, and its signature (null if empty)."""

    def run(batches):
        for batch in batches:
            counts, digests, signatures = [], [], []
            for value in batch.column(2).to_pylist():
                shingles = shingle_set(value, shingle)
                counts.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                signatures.append(signature(shingles).tobytes() if len(shingles) else None)
            arrays = [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "place", "n_shingles", "digest", "sig"])

    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("place"), F.col(text).alias("text"))
    return rows.mapInArrow(run, SKETCH)


def bands_of(nodes: DataFrame) -> DataFrame:
    """``key``, ``band`` and ``node``: the buckets of each node."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                keys = band_keys(_matrix(batch.column(1)))
                node = np.repeat(batch.column(0).to_numpy(), BANDS)
                band = np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)
                yield pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1)), pa.array(band), pa.array(node)], names=["key", "band", "node"])

    return nodes.select("node", "sig").mapInArrow(run, "key bigint, band int, node bigint")


def with_hubs(bands: DataFrame) -> DataFrame:
    """``key``, ``band``, ``node``, ``n``, ``hub``: the buckets of two nodes and more, their sizes and hubs."""
    sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    rows = land(bands.join(sizes, "key").select("key", "band", "node", "n"), "buckets")
    met = rows.groupBy("node").agg(F.sum("n").alias("met"))
    hubs = rows.join(met, "node").groupBy("key").agg(F.max(F.struct("met", (-F.col("node")).alias("node"))).alias("first"))
    return rows.join(hubs, "key").select("key", "band", "node", "n", (-F.col("first.node")).alias("hub"))


def drop_unlikely(pairs: DataFrame, nodes: DataFrame, percent: int, miss: float) -> DataFrame:
    """The pairs (a, b) that the sequential test on signatures keeps."""
    table = least_matches(percent, miss)
    short = nodes.select("node", "n_shingles", "sig")
    left = short.select(F.col("node").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa"))
    right = short.select(F.col("node").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb"))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b, na, sa, nb, sb = batch.columns
            keep = _sizes_allow(na.to_numpy(), nb.to_numpy(), percent)
            keep &= plausible(_matrix(sa), _matrix(sb), table)
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(keep))

    joined = pairs.join(right, "b").join(left, "a").select("a", "b", "na", "sa", "nb", "sb")
    return joined.mapInArrow(run, "a bigint, b bigint")


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets reach the threshold."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    shared = int((b[np.minimum(at, len(b) - 1)] == a).sum()) if len(b) else 0
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def texts_of(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str) -> DataFrame:
    """``node`` and ``text`` of the wanted nodes, landed: a document of each node is looked up by id and hash."""
    chosen = nodes.join(wanted.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "place")
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), F.xxhash64(text).alias("place"), F.col(text).alias("text"))
    same = F.coalesce(F.col("doc_id"), F.lit(-1))
    found = texts.withColumn("id", same).drop("doc_id").join(chosen.withColumn("id", same).drop("doc_id"), ["id", "place"])
    # rows repeated as a whole are one text; the join has dealt them by these columns already
    return land(found.dropDuplicates(["id", "place"]).select("node", "text"), "suspects")


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, shingle: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold.

    Each partner b travels to its a, and the partners of one a are dealt in parts of about ``PART``, each of
    which gets a's text first and streams over the others.
    """
    found = texts_of(pairs.select(F.explode(F.array("a", "b")).alias("node")), nodes, docs, key, text)
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts"))
    sent = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int").alias("part"))
    partners = sent.join(found.withColumnRenamed("node", "b"), "b").select("a", "part", F.lit(1).alias("kind"), "b", "text")
    heads = parts.select("a", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    heads = heads.join(found.withColumnRenamed("node", "a"), "a").select("a", "part", F.lit(0).alias("kind"), F.col("a").alias("b"), "text")

    def run(batches):
        head, own = None, None
        for batch in batches:
            links = []
            a, kinds, b = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for at, value in enumerate(batch.column(4).to_pylist()):
                other = shingle_set(value, shingle)
                if kinds[at] == 0:
                    head, own = a[at], other
                    continue
                assert head == a[at]
                if similar(own, other, percent):
                    links.append((a[at], b[at]))
            columns = list(zip(*links, strict=True)) or [(), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    together = heads.unionByName(partners).repartition("a", "part").sortWithinPartitions("a", "part", "kind")
    return together.mapInArrow(run, "a bigint, b bigint").distinct()


class Groups:
    """Which labels have been joined."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def root(self, label: int) -> int:
        while (up := self.parent.get(label, label)) != label:
            self.parent[label] = label = self.parent.get(up, up)
        return label

    def join(self, a: int, b: int) -> None:
        self.parent[self.root(a)] = self.root(b)


def open_buckets(members: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component, with ``component`` and ``main``, the one with most rows there."""
    labelled = members.where("n > 2").join(labels, "node", "left").select(
        "key", "band", "node", "hub", F.coalesce("component", "node").alias("component")
    )
    sizes = labelled.groupBy("key", "component").agg(F.count(F.lit(1)).alias("rows"))
    largest = F.max(F.struct("rows", (-F.col("component")).alias("main"))).alias("top")
    mixed = sizes.groupBy("key").agg(largest, F.count(F.lit(1)).alias("held")).where("held > 1")
    rows = labelled.join(mixed.select("key", (-F.col("top.main")).alias("main")), "key")
    return land(rows.join(nodes.select("node", "n_shingles"), "node"), "open-buckets")


def _parts(rows: DataFrame, by: str, name: str) -> DataFrame:
    """Into how many blocks the rows go, such that one holds about ``BLOCK`` rows and ``BLOCK_SHINGLES`` shingles at most."""
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES))
    return rows.groupBy(by).agg(blocks.cast("int").alias(name))


def outside_against_main(rows: DataFrame) -> DataFrame:
    """Nodes outside of the main component of a bucket (``left``) and the members of that component that they meet.

    Both are dealt once per component, whatever the number of buckets: in blocks, of which each of one side meets each of the other.
    """
    sides = rows.groupBy("main", "node").agg(
        F.first("component").alias("component"), F.first("n_shingles").alias("n_shingles"), F.collect_set("hub").alias("hubs")
    )
    outside, inside = sides.where("component <> main"), sides.where("component = main")
    parts = _parts(outside, "main", "n_left").join(_parts(inside, "main", "n_right"), "main")

    def dealt(side: DataFrame, own: str, other: str, left: bool) -> DataFrame:
        place = F.pmod(F.xxhash64("node"), F.col(f"n_{own}")).cast("int").alias(own)
        meets = F.explode(F.sequence(F.lit(0), F.col(f"n_{other}") - 1)).alias(other)
        placed = side.join(parts, "main").select("main", "node", "component", "n_shingles", "hubs", place, f"n_{other}")
        return placed.select("*", meets).select(
            F.col("main").alias("group"), F.col("left").alias("low"), F.col("right").alias("high"), F.lit(-1).alias("band"),
            "node", "component", "n_shingles", "hubs", F.lit(left).alias("is_left"), F.lit(not left).alias("is_right"),
        )

    return dealt(outside, "left", "right", True).unionByName(dealt(inside, "right", "left", False))


def outside_among_themselves(rows: DataFrame) -> DataFrame:
    """Nodes outside of the main component of their bucket, with the others there; blocks meet in pairs."""
    outside = rows.where("component <> main")
    placed = outside.join(_parts(outside, "key", "blocks"), "key").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    return dealt.select(
        F.col("key").alias("group"), low.alias("low"), high.alias("high"), "band", "node", "component", "n_shingles",
        F.array("hub").alias("hubs"),
        (F.col("own") == low).alias("is_left"), (F.col("own") == high).alias("is_right"),
    )


def pairs_across(dealt: DataFrame, nodes: DataFrame, texts: DataFrame, shingle: int, percent: int, miss: float) -> DataFrame:
    """Links between nodes of different components that share a band, as the components ``ca``, ``cb`` that they join.

    Pairs with a hub are done already. Of a bucket's pairs (``band``) those count that have no earlier band in common. Pairs
    that signatures leave likely are compared by full sets, the most alike first, unless links found in the task join their
    components already.
    """
    table = least_matches(percent, miss)
    signed = dealt.join(nodes.select("node", "sig"), "node").join(texts, "node")

    def run(rows: pa.Table) -> pa.Table:
        node, component, counts, bands = (rows.column(c).to_numpy() for c in ("node", "component", "n_shingles", "band"))
        is_left, is_right = (rows.column(c).to_numpy().astype(bool) for c in ("is_left", "is_right"))
        signatures, hubs = _matrix(rows.column("sig")), rows.column("hubs").to_pylist()
        written = rows.column("text")
        shared = signatures.reshape(len(signatures), BANDS, ROWS)
        right = np.flatnonzero(is_right)
        led: dict[int, list[int]] = {}
        for row in right.tolist():
            for hub in hubs[row]:
                led.setdefault(hub, []).append(row)
        sets: dict[int, np.ndarray] = {}
        joined, links = Groups(), []

        def set_of(row: int) -> np.ndarray:
            if row not in sets:
                sets[row] = shingle_set(written[row].as_py(), shingle)
            return sets[row]

        for at in np.flatnonzero(is_left).tolist():
            mine = component[right] != component[at]
            others = right[mine & ((node[right] > node[at]) | ~is_left[right] | ~is_right[at])]
            others = others[_sizes_allow(counts[others], counts[at], percent)]
            others = others[~np.isin(node[others], hubs[at]) & ~np.isin(others, led.get(int(node[at]), ()))]
            same = (shared[others] == shared[at]).all(axis=2)
            band = int(bands[at])
            others = others[same.any(axis=1) if band < 0 else ~same[:, :band].any(axis=1)]
            others = others[plausible(np.broadcast_to(signatures[at], (len(others), HASHES)), signatures[others], table)]
            equal = (signatures[others] == signatures[at]).sum(axis=1)
            for score, other in sorted(zip(equal.tolist(), others.tolist(), strict=True), reverse=True):
                ca, cb = int(component[at]), int(component[other])
                if joined.root(ca) != joined.root(cb) and similar(set_of(at), set_of(other), percent):
                    joined.join(ca, cb)
                    links.append((ca, cb))
        columns = list(zip(*links, strict=True)) or [(), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["ca", "cb"])

    return signed.groupBy("group", "low", "high").applyInArrow(run, "ca bigint, cb bigint")


def joined_across(
    links: DataFrame, members: DataFrame, nodes: DataFrame, docs: DataFrame, key: str, text: str, shingle: int, percent: int, miss: float,
) -> DataFrame:
    """Components after comparing also the nodes that share a bucket but no component yet; these links join components."""
    labels = components(links)
    rows = open_buckets(members, labels, nodes)
    how = (nodes, texts_of(rows, nodes, docs, key, text), shingle, percent, miss)
    found = pairs_across(outside_against_main(rows), *how).unionByName(pairs_across(outside_among_themselves(rows), *how))
    more = land(found.select(F.col("ca").alias("a"), F.col("cb").alias("b")), "links")
    if more.isEmpty():
        return labels
    merged = components(more)
    names = merged.select(F.col("node").alias("component"), F.col("component").alias("into"))
    moved = labels.join(names, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    return moved.unionByName(merged)


def grouped(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 5, percent: int = 80, miss: float = 1e-8,
) -> DataFrame:
    """``doc_id``, ``place`` (hash of the text), ``n_shingles``, ``component_id`` and ``survives``, one row per document.

    The rows that survive have one id and one text per component: the lowest known id and, under it, the lowest place.
    """
    rows = land(sketch(shipped(docs), key, text, shingle), "sketch")
    classes = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min(F.struct("doc_id", "place")).alias("first"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"),
        F.min("doc_id").alias("low"), F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "place")).alias("best"),
    )
    nodes = land(
        classes.select(
            F.monotonically_increasing_id().alias("node"), "digest", "low", "best", "n_shingles", "sig",
            F.col("first.doc_id").alias("doc_id"), F.col("first.place").alias("place"),
        ),
        "nodes",
    )
    bands = bands_of(nodes)
    members = land(with_hubs(bands), "buckets")
    stars = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    likely = land(drop_unlikely(stars, nodes, percent, miss), "likely")
    links = land(verify(likely, nodes, docs, key, text, shingle, percent), "links")
    labels = joined_across(links, members, nodes, docs, key, text, shingle, percent, miss)
    named = nodes.select("node", "digest", "low", "best").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"), F.min("best").alias("survivor"))
    by_digest = named.join(lowest, "component").select("digest", "component_id", "survivor")
    out = rows.select("doc_id", "place", "n_shingles", "digest").join(by_digest, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    best = F.col("doc_id").eqNullSafe(F.col("survivor.doc_id")) & (F.col("place") == F.col("survivor.place"))
    return out.select(
        "doc_id", "place", "n_shingles", component.alias("component_id"), (F.col("digest").isNull() | best).alias("survives")
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """``doc_id``, ``place`` (hash of the text), ``n_shingles``, ``component_id`` and ``kept``, one row per document."""
    return grouped(docs, key, text, **how).drop("survives").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, rows repeated under its id once."""
    verdict = grouped(docs, key, text, **how).where("survives").select(
        F.coalesce("doc_id", F.lit(-1)).alias("__id"), F.col("place").alias("__place")
    ).distinct()
    marked = docs.withColumns({"__id": F.coalesce(F.col(key).cast("long"), F.lit(-1)), "__place": F.xxhash64(text)})
    return marked.join(verdict, ["__id", "__place"], "left_semi").dropDuplicates(["__id", "__place"]).drop("__id", "__place")

"""Scores of whole documents by a gated recurrent language model and by word frequencies.

1. Every word of the training documents is counted (partial counts per task, then one shuffle).
2. The most frequent words, at most ``dictionary``, go to all tasks with their counts; the ``vocabulary`` most frequent of
   them are the model's tokens, all other words are its rare token. The model starts from the counts over
   all training documents and then learns from every one of them, in rounds: the documents of a round lie in shards of
   about ``shard_tokens`` tokens, each task trains on its own shards, and the weights are averaged for the next round.
3. All documents are scored whole: the state runs on from window to window. A rare word's probability is that of
   the rare token times its own share among the rare words.
4. Words outside of the dictionary are joined with the counts by a shuffle and added, so that no count is left out.

So what is broadcast is bounded by parameters, while counts, training and joins cover all data. Averages are taken in
two steps, so that neither a task nor the driver meets the weights of all shards. The scores depend a little on how documents
lie in parts when there is more than one shard; the base scores do not.

Defined cases: null text is empty and has the end token only; a null id counts as empty text in the hash; without training
documents every probability of the base is 1; repeated rows are rows; an empty table gives an empty result.
"""

from __future__ import annotations

import io
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import shipped
from paperloom.llm.gated import fresh_model, log_likelihoods, train
from paperloom.session import fresh_path, land

#: The end token. No word is empty.
END = b""
ADDED = 0.1


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts, as ``folded_words`` gives them, and how many each text has."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    words = parts.flatten()
    # spaces at either end leave an empty part
    whole = pc.greater(pc.binary_length(words), 0)
    of = pc.list_parent_indices(parts).filter(whole).to_numpy(zero_copy_only=False)
    return words.filter(whole).cast(pa.binary()), np.bincount(of, minlength=len(texts))


def word_counts(texts: DataFrame) -> DataFrame:
    """``word``, ``n``: all tokens of a one-column frame of texts; each text has one end token."""

    def rows(seen):
        found = pa.concat_tables(seen)
        if len(seen) > 1:
            found = found.group_by("word", use_threads=False).aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])
        return found.to_batches()

    def run(batches):
        seen, held, ends = [], 0, 0
        for batch in batches:
            words, _ = words_of(batch.column(0))
            counted = pc.value_counts(words)
            seen.append(pa.table({"word": counted.field(0), "n": counted.field(1)}))
            held, ends = held + len(counted), ends + batch.num_rows
            if held > 400_000:
                yield from rows(seen)
                seen, held = [], 0
        if seen:
            yield from rows(seen)
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([END], pa.binary()), pa.array([ends], pa.int64())], names=["word", "n"])

    return texts.mapInArrow(run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int) -> list:
    """At most ``most`` words with their counts, all above some count; most frequent first."""
    step = F.floor(F.log2("n") * 16).cast("int")
    levels = sorted(counts.groupBy(step.alias("level")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True)
    total, least = 0, None
    for row in levels:
        total += row["words"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return []
    rows = counts.where(step >= least).toPandas()
    return sorted(zip(rows["word"].map(bytes), rows["n"].tolist(), strict=True), key=lambda x: (-x[1], x[0]))


def _saved(model: dict) -> bytes:
    out = io.BytesIO()
    np.savez(out, **model)
    return out.getvalue()


def _loaded(weights: bytes) -> dict:
    with np.load(io.BytesIO(weights)) as file:
        return {name: file[name] for name in file.files}


WEIGHTS = "tokens bigint, model binary"


def _weights(tokens: int, model: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([tokens], pa.int64()), pa.array([_saved(model)], pa.binary())], names=["tokens", "model"])


def averaged(rows) -> tuple[int, dict | None]:
    """The mean of models, each weighted by its tokens; one of them at a time is unpacked."""
    total, sums = 0, None
    for tokens, weights in rows:
        model = _loaded(weights)
        total += tokens
        parts = {name: value if name == "starts" else value.astype(np.float64) * tokens for name, value in model.items()}
        sums = parts if sums is None else {name: value if name == "starts" else value + parts[name] for name, value in sums.items()}
    if sums is None:
        return 0, None
    return total, {name: value if name == "starts" else (value / total).astype(np.float32) for name, value in sums.items()}


def _with_ends(tokens: np.ndarray, lengths: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of documents with the end token behind each, and where each then ends."""
    ends = np.cumsum(lengths + 1)
    out = np.full(len(tokens) + len(lengths), end, np.int32)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = tokens
    return out, ends


def encoded(texts: DataFrame, tokens: dict[bytes, int], rare: int, rounds: int) -> DataFrame:
    """``document``, ``round``: each text of a one-column frame as tokens of four bytes; every part has a share in each round."""
    listed, end = pa.array(tokens.keys(), pa.binary()), tokens[END]
    # the last one is found for words that are not listed
    numbers = np.array([*tokens.values(), rare], np.int32)

    def run(batches):
        at = TaskContext.get().partitionId()
        for batch in batches:
            words, lengths = words_of(batch.column(0))
            found = pc.index_in(words, value_set=listed).fill_null(-1).to_numpy(zero_copy_only=False)
            joined, ends = _with_ends(numbers[found], lengths, end)
            edges = pa.py_buffer((4 * np.append(0, ends)).astype(np.int64))
            documents = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, edges, pa.py_buffer(joined)])
            dealt = (np.arange(at, at + len(ends)) % rounds).astype(np.int32)
            at += len(ends)
            yield pa.RecordBatch.from_arrays([documents.cast(pa.binary()), pa.array(dealt)], names=["document", "round"])

    return texts.mapInArrow(run, "document binary, round int")


def _pass(shards: DataFrame, weights: bytes, lanes: int, most: int, rate: float, last: float, groups: int) -> bytes:
    """The mean of the weights that the tasks reach, each on its own shards of at most ``most`` tokens and one document."""
    sent = shards.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        model, total, held, documents = None, 0, 0, []
        for batch in batches:
            for document in batch.column(0).to_pylist():
                documents.append(np.frombuffer(document, np.int32))
                held += len(documents[-1])
                if held >= most:
                    model = train(model or _loaded(sent.value), sorted(documents, key=lambda d: d.tobytes()), lanes, rate, last)
                    total, held, documents = total + held, 0, []
        if documents:
            model = train(model or _loaded(sent.value), sorted(documents, key=lambda d: d.tobytes()), lanes, rate, last)
            total += held
        if model is not None:
            yield _weights(total, model)

    def mean(batches):
        total, model = averaged(
            row for batch in batches for row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        )
        if model is not None:
            yield _weights(total, model)

    reached = shards.mapInArrow(run, WEIGHTS)
    if groups > 1:
        reached = reached.repartition(groups).mapInArrow(mean, WEIGHTS)
    model = averaged((row["tokens"], bytes(row["model"])) for row in reached.collect())[1]
    sent.destroy()
    return _saved(model) if model is not None else weights


def fit(
    texts: DataFrame, tokens: dict[bytes, int], rare: int, token_counts: np.ndarray, hidden: int, classes: int,
    shard_tokens: int = 1_000_000, most_rounds: int = 8,
) -> bytes:
    """The weights after one pass over all texts (one column), which ``token_counts`` counts.

    A few shards are worked through one after the other, one a round; more of them share ``most_rounds`` rounds.
    """
    weights, n = _saved(fresh_model(token_counts, hidden, classes)), int(token_counts.sum())
    rounds = max(1, min(most_rounds, n // shard_tokens))
    parts = -(-n // (rounds * shard_tokens))
    path = fresh_path(texts.sparkSession, "lm-shards")
    encoded(texts, tokens, rare, rounds).write.partitionBy("round").parquet(path)
    landed = texts.sparkSession.read.schema("document binary, round int").parquet(path)
    pace = [0.01 * (1 - 0.9 * number / rounds) for number in range(rounds + 1)]
    # wider lanes save CPU time, narrower ones take more steps
    lanes = min(256, max(64, n // 50_000))
    for number in range(rounds):
        shards = landed.where(F.col("round") == number).select("document").coalesce(max(1, parts))
        weights = _pass(shards, weights, lanes, 2 * shard_tokens, pace[number], pace[number + 1], math.isqrt(parts))
    return weights


SCORED = "row bigint, n_tokens bigint, n_known bigint, base double, score double, rest array<struct<word: binary, n: int>>"


def scored(
    docs: DataFrame, train_on: Column, key: str = "doc_id", text: str = "text", dictionary: int = 300_000, vocabulary: int = 4096,
    hidden: int = 24, classes: int = 64, shard_tokens: int = 1_000_000,
) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, one row per document."""
    spark = shipped(docs).sparkSession
    learned = F.coalesce(train_on, F.lit(False))
    counts = land(word_counts(docs.where(learned).select(text)), "word-counts")
    sums = counts.agg(F.sum("n"), F.count(F.lit(1)), F.sum(F.when(F.col("word") == F.lit(b""), F.col("n")))).first()
    n, v, ends = sums[0] or 0, sums[1], sums[2] or 0
    known = frequent(counts, dictionary)
    chosen = [(word, count) for word, count in known if word != END][: vocabulary - 2]
    rare_n = n - ends - sum(count for _, count in chosen)
    rare_v = v - len(chosen) - (1 if ends else 0)
    ranked = sorted([*chosen, (END, ends), (None, rare_n)], key=lambda x: -x[1])
    tokens = {word: at for at, (word, _) in enumerate(ranked) if word is not None}
    rare = next(at for at, (word, _) in enumerate(ranked) if word is None)
    token_counts = np.array([count for _, count in ranked], np.float64)

    weights = fit(docs.where(learned).select(text), tokens, rare, token_counts, hidden, classes, shard_tokens)

    base_of = lambda c: math.log10((c + ADDED) / (n + ADDED * (v + 1)))
    rare_of = lambda c: math.log10((c + ADDED) / (rare_n + ADDED * (rare_v + 1)))
    # a word's row in these arrays is its place in the dictionary; words that are not in it find the last row
    listed = [*tokens, *(word for word, _ in known if word not in tokens)]
    count_of = dict(known)
    base = np.array([*(base_of(count_of.get(word, 0)) for word in listed), 0.0])
    inner = np.array([*(0.0 if word in tokens else rare_of(count_of[word]) for word in listed), 0.0])
    token = np.array([*(tokens.get(word, rare) for word in listed), rare], np.int32)
    sent = spark.sparkContext.broadcast(
        (pa.array(listed, pa.binary()), base, inner, token, weights, tokens[END], base_of(ends), bool(ends))
    )
    fields = f"`{key}` {docs.schema[key].dataType.simpleString()}, held_out boolean, {SCORED}"
    names = [part.split(" ")[0].strip("`") for part in fields.split(", ")][: 2 + 5] + ["rest"]

    def looked_up(texts, parts):
        """What the dictionary has on texts: tokens and where each text ends, sums and counts, and the words it does not hold."""
        listed, base, inner, token, _, end, end_base, end_known = parts
        words, lengths = words_of(texts)
        found = pc.index_in(words, value_set=listed).fill_null(-1).to_numpy(zero_copy_only=False)
        of, unknown, size = np.repeat(np.arange(len(texts)), lengths), found < 0, len(texts)
        sums = np.bincount(of, weights=base[found], minlength=size) + end_base
        inners = np.bincount(of, weights=inner[found], minlength=size)
        known = np.bincount(of[~unknown], minlength=size) + end_known
        rest = pa.table({"of": of[unknown], "word": words.filter(pa.array(unknown))})
        rest = rest.group_by(["of", "word"], use_threads=False).aggregate([([], "count_all")]).combine_chunks()
        rest = rest.sort_by("of")
        words = pa.StructArray.from_arrays(
            [rest["word"].combine_chunks(), rest["count_all"].combine_chunks().cast(pa.int32())], names=["word", "n"]
        )
        edges = np.searchsorted(rest["of"].to_numpy(), np.arange(size + 1)).astype(np.int32)
        rests = pa.ListArray.from_arrays(pa.array(edges), words)
        return *_with_ends(token[found], lengths, end), lengths + 1, known, sums, inners, rests

    def run(batches):
        parts = sent.value
        model = _loaded(parts[4])
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            documents, columns, rests = [], [], []
            for begin in range(0, batch.num_rows, 4096):
                tokens, ends, *numbers, rest = looked_up(batch.column(2).slice(begin, 4096), parts)
                documents += np.split(tokens, ends[:-1])
                columns.append(numbers)
                rests.append(rest)
            lengths, known, sums, inners = (np.concatenate(c) for c in zip(*columns, strict=True)) if columns else (np.zeros(0),) * 4
            likely = log_likelihoods(model, documents) / math.log(10) if documents else np.zeros(0)
            arrays = [
                batch.column(0), batch.column(1), pa.array(range(row, row + batch.num_rows), pa.int64()), pa.array(lengths, pa.int64()),
                pa.array(known, pa.int64()), pa.array(sums, pa.float64()), pa.array(likely + inners, pa.float64()),
                pa.concat_arrays(rests) if rests else pa.array([], pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int32())]))),
            ]
            row += batch.num_rows
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = land(docs.select(F.col(key), (~learned).alias("held_out"), F.col(text).alias("text")).mapInArrow(run, fields), "lm-scores")
    rest = rows.where(F.size("rest") > 0).select("row", F.explode("rest").alias("w")).select("row", F.col("w.word").alias("word"), F.col("w.n").alias("times"))
    joined = rest.join(counts, "word", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    times = F.col("times")
    added = joined.groupBy("row").agg(
        F.sum(times.cast("long")).alias("r_times"), F.sum(F.when(F.col("n") > 0, times).otherwise(0).cast("long")).alias("r_known"),
        F.sum(times * F.log10(F.col("n") + ADDED)).alias("r_sum"),
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0))
    below, rare_below = math.log10(n + ADDED * (v + 1)), math.log10(rare_n + ADDED * (rare_v + 1))
    return rows.drop("rest").join(added, "row", "left").select(
        key, "held_out", "n_tokens", (F.col("n_known") + zero("r_known")).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base") + zero("r_sum") - zero("r_times") * below).alias("base_score"),
        (F.col("score") + zero("r_sum") - zero("r_times") * rare_below).alias("score"),
    )

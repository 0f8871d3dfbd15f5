"""Quality rules with host verdicts: rule failures by host, shrunk by an empirical beta prior.

Every document gets counts over its whole text and a verdict of its own (too few words, too much
repetition). Failures are then counted per host; the hosts' rates give a beta prior by the method of
moments, and a host whose posterior mean rate reaches ``max_host_rate`` takes all of its documents along.
A host of few documents stays close to the prior, so one bad page does not condemn it.

Defined cases: null or empty text has no words and fails; a null host is no host, its documents keep
their own verdict; repeated rows count as rows; an empty table gives an empty result; columns of the input
whose names clash with the added ones are replaced by them.
"""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import find_words, shipped
from paperloom.session import land

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_SYMBOLS = dict.fromkeys(map(ord, "#*$%&|<>"))


def text_counts(text: str | None) -> tuple[int, int, int, int, int]:
    """Words, code points in words, symbols, repeated lines, and words inside repeated 3-word windows."""
    text = text or ""
    words = find_words(text)
    symbols = len(text) - len(text.translate(_SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered = bytearray(len(words))
        for at, window in enumerate(windows):
            if times[window] > 1:
                covered[at : at + 3] = b"\1\1\1"
        repeated = sum(covered)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), repeated


def base_failed(min_words: int = 50, max_repeat_percent: int = 50) -> Column:
    few = F.col("n_words") < min_words
    return few | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))


def with_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """The input rows with the five count columns."""
    docs = shipped(docs).drop(*COUNTS)
    names = docs.columns
    at = names.index(text)

    def run(batches):
        for batch in batches:
            counted = [text_counts(value) for value in batch.column(at).to_pylist()]
            columns = zip(*counted, strict=True) if counted else ([] for _ in COUNTS)
            arrays = [pa.array(column, pa.int64()) for column in columns]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], names=[*batch.schema.names, *COUNTS])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, fields + "".join(f", {name} bigint" for name in COUNTS))


def host_rates(docs: DataFrame, host: str = "source") -> DataFrame:
    """Per host: n_docs, n_failed, and ``host_rate``, its failure rate shrunk to the prior.

    With the hosts' rates at mean m and variance v beyond binomial noise, the prior is
    beta(m * s, (1 - m) * s) with s = m * (1 - m) / v - 1. Hosts that do not differ have no v; the prior then
    weighs as much as all rows, so each host gets the mean.
    """
    hosts = docs.where(F.col(host).isNotNull()).groupBy(host).agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    moments = hosts.agg(
        F.sum("n_docs").alias("n"), (F.sum("n_failed") / F.sum("n_docs")).alias("mean"),
        (F.sum(F.col("n_docs") * rate * rate) / F.sum("n_docs")).alias("square"),
        F.count(F.lit(1)).alias("hosts"),
    ).first()
    if not moments["n"]:
        return hosts.withColumn("host_rate", F.lit(0.0))
    mean, rows = moments["mean"], moments["n"]
    noise = mean * (1 - mean) * moments["hosts"] / rows
    spread = max(moments["square"] - mean * mean - noise, 0.0)
    weight = min(max(mean * (1 - mean) / spread - 1, 1.0), float(rows)) if spread > 0 else float(rows)
    return hosts.withColumn("host_rate", (F.col("n_failed") + mean * weight) / (F.col("n_docs") + weight))


def judge(
    docs: DataFrame, text: str = "text", host: str = "source", min_words: int = 50,
    max_repeat_percent: int = 50, max_host_rate: float = 0.5, columns: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``columns``, the host, the counts, ``base_failed``, ``host_rate`` and ``kept``, one row per document.

    The counts are landed once (a few numbers per document), since both the host totals and the result
    need them. Hosts join back by key; a hot host is split by the adaptive join or meets a small table.
    """
    wanted = list(dict.fromkeys([*columns, text]))
    chosen = docs.select(*[F.col(c) for c in wanted], F.col(host).alias("_host"))
    counted = with_counts(chosen, text).drop(*([] if text in columns else [text]))
    counted = land(counted.withColumn("base_failed", base_failed(min_words, max_repeat_percent)), "quality")
    # landed, so that its size is known before the join: documents are not shuffled by host unless hosts are many
    rates = land(host_rates(counted, "_host").select(F.col("_host").alias("_rated"), "host_rate"), "hosts")
    joined = counted.join(rates, F.col("_host") == F.col("_rated"), "left").drop("_rated")
    bad_host = F.coalesce(F.col("host_rate") >= max_host_rate, F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~bad_host).withColumnRenamed("_host", "host")


def keep_documents(
    docs: DataFrame, text: str = "text", host: str = "source", min_words: int = 50, max_repeat_percent: int = 50,
    max_host_rate: float = 0.5,
) -> DataFrame:
    """The rows of ``docs``, all columns, that neither their own counts nor their host rejects."""

    def run(batches):
        for batch in batches:
            keep = []
            for value in batch.column(at).to_pylist():
                n_words, _, _, _, repeated = text_counts(value)
                keep.append(n_words >= min_words and 100 * repeated <= max_repeat_percent * n_words)
            yield batch.filter(pa.array(keep, pa.bool_()))

    at = docs.columns.index(text)
    counted = with_counts(docs.select(F.col(text), F.col(host).alias("_host")), text).drop(text)
    rates = host_rates(land(counted.withColumn("base_failed", base_failed(min_words, max_repeat_percent)), "quality"), "_host")
    bad = land(rates.where(F.col("host_rate") >= max_host_rate).select(F.col("_host").alias("__host")), "hosts")
    passed = docs.mapInArrow(run, docs.schema)
    return passed.join(bad, passed[host] == F.col("__host"), "left_anti")

"""Language identification: word frequencies first, shorter and shorter character n-grams for unseen words.

The model holds, per language, log10 frequencies of words and of the character n-grams (5 down to 1) of its
words. A word of the model scores by its word frequencies. Any other word is scored by the longest n-gram
length of which the model knows at least one, with a fixed cost for each step down.

Fitting uses a bounded sample of the labelled rows: whole documents, chosen by a hash of the id, so that each
language has about ``sample_chars`` characters. The model holds what the sample holds, so it may be broadcast.
Every document is predicted over its whole text.

Defined cases: null text or text without a letter gives ``und`` and score 0; without labelled rows every
text does; a language seen in few rows is learned from what is there; ties go to the first language
by name; repeated rows are rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import shipped

UNDETERMINED = "und"
LONGEST = 5
STEP_COST = 0.3
_letters = re.compile(r"[^\W\d_]+").findall


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters."""
    words = []
    for run in _letters((text or "").lower()):
        if run.isalpha():
            words.append(run)
        else:  # the pattern takes numerals such as superscripts for letters
            words += ["".join(part) for letters, part in groupby(run, str.isalpha) if letters]
    return words


def grams_of(word: str, size: int) -> list[str]:
    """The character n-grams of a word with its two ends marked."""
    marked = f"^{word}$"
    return [marked[i : i + size] for i in range(len(marked) - size + 1)]


def sample_for_fit(docs: DataFrame, text: str, lang: str, key: Column, sample_chars: int) -> DataFrame:
    """About ``sample_chars`` characters of each language in whole documents, chosen by a hash of the key."""
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    totals = known.groupBy(F.col(lang).alias("l")).agg(F.sum(F.length(text)).alias("n")).collect()
    place = F.pmod(F.xxhash64(key, F.lit(17)), F.lit(1_000_000))
    share = F.create_map(*[F.lit(v) for r in totals for v in (r["l"], min(1.0, sample_chars / max(r["n"], 1)))])
    if not totals:
        return known.select(lang, text)
    return known.where(place < share[F.col(lang)] * 1_000_000).select(lang, text)


def fit(sample: DataFrame, text: str, lang: str) -> dict:
    """Counts of words and n-grams by language, made on the executors, as log10 frequencies."""

    def count(batches):
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            words: dict[str, Counter] = {}
            for name, value in zip(langs, texts, strict=True):
                words.setdefault(name, Counter()).update(words_of(value))
            rows = [(name, 0, word, n) for name, seen in words.items() for word, n in seen.items()]
            for name, seen in words.items():
                for size in range(1, LONGEST + 1):
                    grams: Counter = Counter()
                    for word, n in seen.items():
                        for gram in grams_of(word, size):
                            grams[gram] += n
                    rows += [(name, size, gram, n) for gram, n in grams.items()]
            if rows:
                a, b, c, d = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.string()), pa.array(b, pa.int32()), pa.array(c, pa.string()), pa.array(d, pa.int64())],
                    names=["lang", "size", "gram", "n"],
                )

    counted = sample.select(lang, text).mapInArrow(count, "lang string, size int, gram string, n bigint")
    rows = counted.groupBy("size", "gram", "lang").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(rows["lang"].unique().tolist())
    model: dict = {"langs": langs, "tables": []}
    for size in range(LONGEST + 1):
        part = rows[rows["size"] == size]
        grams = {g: i for i, g in enumerate(sorted(part["gram"].unique().tolist()))}
        counts = np.zeros((len(grams), len(langs)))
        at = part["gram"].map(grams).to_numpy(dtype=np.int64)
        counts[at, part["lang"].map({x: i for i, x in enumerate(langs)}).to_numpy(dtype=np.int64)] = part["n"]
        total = counts.sum(axis=0)
        model["tables"].append((grams, np.log10((counts + 0.1) / (total + 0.1 * (len(grams) + 1)))))
    return model


class Scorer:
    """Scores texts with a fitted model; what words score is remembered, up to a fixed number of words."""

    MEMORY = 300_000

    def __init__(self, model: dict) -> None:
        self.langs: list[str] = model["langs"]
        self.tables = model["tables"]
        self.rows: list[np.ndarray] = []
        self.seen: dict[str, int] = {}

    def word(self, word: str) -> np.ndarray:
        known, scores = self.tables[0]
        if word in known:
            return scores[known[word]]
        for size in range(LONGEST, 0, -1):
            grams, scores = self.tables[size]
            found = [grams[g] for g in grams_of(word, size) if g in grams]
            if found:
                return scores[found].mean(axis=0) - STEP_COST * (LONGEST + 1 - size)
        return np.zeros(len(self.langs))

    def row(self, word: str) -> int:
        at = self.seen.get(word)
        if at is None:
            at = self.seen[word] = len(self.rows)
            self.rows.append(self.word(word))
        return at

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, chances = [], []
        for text in texts:
            words = words_of(text) if self.langs else []
            if not words:
                names.append(UNDETERMINED)
                chances.append(0.0)
                continue
            if len(self.rows) > self.MEMORY:
                self.rows, self.seen = [], {}
            times = Counter(words)
            at = [self.row(word) for word in times]
            weights = np.fromiter(times.values(), np.float64, len(times))
            total = weights @ np.array([self.rows[i] for i in at])
            best = int(total.argmax())
            names.append(self.langs[best])
            chances.append(float(1 / np.power(10.0, np.minimum(total - total[best], 0)).sum()))
        return names, chances


def identify(
    docs: DataFrame, train: Column, text: str = "text", lang: str = "lang", key: str = "doc_id",
    sample_chars: int = 3_000_000, columns: tuple[Column, ...] = (),
) -> DataFrame:
    """``columns``, then ``lang_pred`` and ``score``, for every row; ``train`` marks the rows to learn from."""
    sample = sample_for_fit(shipped(docs).where(train), text, lang, F.coalesce(F.col(key).cast("string"), F.lit("")), sample_chars)
    model = docs.sparkSession.sparkContext.broadcast(fit(sample, text, lang))
    chosen = docs.select(*columns, F.col(text).alias("_text"))
    kept = chosen.columns[:-1]

    def run(batches):
        scorer = Scorer(model.value)
        for batch in batches:
            names, chances = scorer.predict(batch.column(len(kept)).to_pylist())
            arrays = [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(chances, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "lang_pred", "score"])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in chosen.schema.fields[:-1])
    return chosen.mapInArrow(run, fields + "lang_pred string, score double")

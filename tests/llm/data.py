"""Small frames of documents with every odd case, for all operators."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that the operators use themselves
    T.StructField("kept", T.StringType()), T.StructField("n_words", T.StringType()), T.StructField("score", T.StringType()),
    T.StructField("component_id", T.StringType()), T.StructField("factor", T.StringType()), T.StructField("_tokens", T.StringType()),
])


def words(rng, count, pool=400, stem="w"):
    return " ".join(f"{stem}{rng.randrange(pool)}" for _ in range(count))


def odd_rows():
    rng = random.Random(5)
    base = [words(rng, 120) for _ in range(12)]
    near = base[0].split(" ")
    near[60] = "changed"
    passage = words(rng, 70, stem="shared")
    texts = [
        None, "", " \t\n ", "one", "two words", "Dup Line\nDup Line\n" * 40, "é中\U0001f600 " * 90, "a" * 3000, *base, base[1], base[1], base[2].upper(),
        " ".join(near), words(rng, 60) + " " + passage + " " + words(rng, 60), words(rng, 50) + " " + passage + " " + words(rng, 70),
        words(rng, 30_000, pool=100_000), "x y z " * 700, "\0 nul \x1c separators here " + base[3],
    ]
    rows = [(i, t, None if i % 7 == 3 else "en", None if i % 5 == 4 else f"s{i % 3}") for i, t in enumerate(texts)]
    rows += [(None, base[4], "fr", "s1"), (None, None, None, None), (9, base[1], "en", "s0"), (9, base[1], "en", "s0"), (9, base[5], "en", "s0")]
    return [(*r, len(r[1] or ""), "k", "n", "s", "c", "f", "t") for r in rows]


def odd_documents(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def by_hand(spark, texts):
    """A frame of (doc_id, text), over several partitions."""
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)

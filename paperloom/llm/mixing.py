"""Mixing sources to target weights by iterative proportional fitting, in DataFrame operations only.

Documents fall into cells of source, language and topic. Raking scales the token weight of each cell until
the totals by source, by language and by topic agree with their target shares; a document is then
sampled with a probability in proportion to the factor of its cell, at the rate that meets a token budget.
Probabilities stop at 1; what such cells cannot give is spread over the others.

The tables name no topic, so a lexical one stands in: a bucket of the word that sorts highest in the text. Any
column can be the topic. Targets default to the tempered shares of the data, ``share ** alpha``.

Scale: the texts are read in map tasks only; the raking runs on cells, which are counted with partial
aggregation, so a hot source is a handful of rows; cells are landed after each round to cut the lineage.

Defined cases: a null source, language or topic is the value ``''``; null or empty text has no tokens, no
influence on the weights and is sampled like its cell (factor 1 if the cell has no tokens at all); an empty table
gives an empty result; repeated rows share their id's fate; targets without data are left out and the
others scaled up; values without a target count as share 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import WORD_PATTERN
from paperloom.session import land

DIMS = ("_source", "_lang", "_topic")
ROUNDS = 8
TOPICS = 8
ALPHA = 0.7
BUDGET = 0.7
SEED = "mix"


def words(text: str = "text") -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(WORD_PATTERN), F.lit(0))


def lexical_topic(found: Column, topics: int = TOPICS) -> Column:
    """``t0``, ``t1``, ...: a bucket of the highest word; text without words is ``''``."""
    place = F.conv(F.substring(F.md5(F.array_max(found)), 1, 4), 16, 10).cast("long") % topics
    return F.coalesce(F.concat(F.lit("t"), place.cast("string")), F.lit(""))


def place_of(key: Column, seed: str = SEED) -> Column:
    """A fixed place in [0, 1) for each key."""
    text = F.concat(F.lit(seed), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(16**12)


def marked(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang", topics: int = TOPICS) -> DataFrame:
    """The rows with their cell and ``_tokens``."""
    found = docs.withColumn("_words", words(text))
    named = found.withColumns(
        {
            "_tokens": F.size("_words").cast("long"), "_topic": lexical_topic(F.col("_words"), topics),
            "_source": F.coalesce(F.col(source), F.lit("")), "_lang": F.coalesce(F.col(lang), F.lit("")),
        }
    )
    return named.drop("_words")


def tempered(cells: DataFrame, dim: str, alpha: float = ALPHA) -> DataFrame:
    """The target shares ``share ** alpha`` of a dimension, not yet normalised."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("n")).where("n > 0")
    return sums.select(dim, F.pow(F.col("n").cast("double"), F.lit(alpha)).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """Cells (dimensions, tokens) with ``factor``: by how much each cell's tokens weigh more or less.

    Each round fits the dimensions one after the other: the factor times target over current total.
    """
    total = cells.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    fitted = cells.withColumn("factor", F.lit(1.0))
    goals = {}
    for dim, target in targets.items():
        there = target.join(cells.where("tokens > 0").select(dim).distinct(), dim, "left_semi")
        goals[dim] = land(there, "mix-target")
    scale = {dim: goal.agg(F.sum("share").alias("s")).first()["s"] or 1.0 for dim, goal in goals.items()}
    for _ in range(rounds):
        for dim, goal in goals.items():
            sums = fitted.groupBy(dim).agg(F.sum(F.col("tokens") * F.col("factor")).alias("_now"))
            wanted = F.coalesce(F.col("share"), F.lit(0.0)) / scale[dim] * float(total)
            step = sums.join(goal, dim, "left").select(
                dim, F.when(F.col("_now") > 0, wanted / F.col("_now")).otherwise(F.lit(1.0)).alias("_step")
            )
            fitted = fitted.join(step, dim).withColumn("factor", F.col("factor") * F.col("_step")).drop("_step")
        fitted = land(fitted, "mix-cells")
    return fitted


def rate_for(cells: DataFrame, budget: float, rounds: int = ROUNDS) -> float:
    """The rate at which ``sum(tokens * least(1, rate * factor))`` meets ``budget`` of all tokens.

    Each round sets the cells that reach 1 aside and spreads what is left over the others.
    """
    rate = 0.0
    for _ in range(rounds):
        full = F.col("factor") * rate >= 1
        sums = cells.agg(
            F.sum("tokens").alias("n"), F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(~full, F.col("tokens") * F.col("factor")).otherwise(0.0)).alias("open"),
        ).first()
        if not sums["n"] or not sums["open"]:
            return rate or 1.0
        rate = (budget * sums["n"] - sums["full"]) / sums["open"]
    return rate


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
    budget: float = BUDGET, alpha: float = ALPHA, targets: dict[str, DataFrame] | None = None,
    rounds: int = ROUNDS, carry_text: bool = True,
) -> DataFrame:
    """Every row with ``_source``, ``_lang``, ``_topic``, ``_tokens``, ``_factor``, ``_chance`` and ``_kept``.

    ``targets`` gives, by dimension, a frame of its values and ``share``; a missing one is tempered. With
    ``carry_text=False`` the marked rows are landed without their text, so texts are read once.
    """
    rows = marked(docs, text, source, lang)
    if not carry_text:
        rows = land(rows.drop(text), "mix-rows")
    cells = land(rows.groupBy(*DIMS).agg(F.sum("_tokens").alias("tokens")), "mix-cells")
    goals = {dim: (targets or {}).get(dim) or tempered(cells, dim, alpha) for dim in DIMS}
    fitted = rake(cells, goals, rounds)
    rate = rate_for(fitted, budget, rounds)
    chance = F.least(F.lit(1.0), F.col("_factor") * rate)
    joined = rows.join(fitted.select(*DIMS, F.col("factor").alias("_factor")), list(DIMS))
    return joined.withColumns({"_chance": chance, "_kept": place_of(F.col(key)) < chance})


def keep_sampled(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang", **how) -> DataFrame:
    """The rows of ``docs``, all columns, that are sampled."""
    wrapped = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), *dict.fromkeys([key, text, source, lang]))
    return mix(wrapped, key, text, source, lang, **how).where("_kept").select("__row.*")


def oracle(budget: float = BUDGET, alpha: float = ALPHA, rounds: int = ROUNDS, topics: int = TOPICS) -> str:
    """The same in SQL, round by round."""
    pattern = WORD_PATTERN
    found = f"regexp_extract_all(coalesce(text, ''), '{pattern}')"
    parts = [
        f"""marked AS MATERIALIZED (SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
        len({found}) AS n_tokens, coalesce('t' || CAST(CAST('0x' || substr(md5(list_max({found})), 1, 4) AS BIGINT) % {topics}
        AS VARCHAR), '') AS topic FROM documents)""",
        "cells AS MATERIALIZED (SELECT source, lang, topic, sum(n_tokens) AS tokens, 1.0::DOUBLE AS factor FROM marked GROUP BY ALL)",
    ]
    for dim in ("source", "lang", "topic"):
        parts.append(
            f"""goal_{dim} AS MATERIALIZED (SELECT {dim}, share / sum(share) OVER () AS share FROM (SELECT {dim},
            pow(sum(tokens)::DOUBLE, {alpha}) AS share FROM cells GROUP BY 1 HAVING sum(tokens) > 0))"""
        )
    last = "cells"
    for turn in range(rounds):
        for dim in ("source", "lang", "topic"):
            name = f"fit_{turn}_{dim}"
            parts.append(
                f"""{name} AS MATERIALIZED (SELECT c.source, c.lang, c.topic, c.tokens, c.factor * CASE WHEN now > 0
                THEN coalesce(share, 0) * (SELECT sum(tokens) FROM cells) / now ELSE 1 END AS factor FROM {last} c JOIN
                (SELECT {dim}, sum(tokens * factor) AS now FROM {last} GROUP BY 1) s ON c.{dim} = s.{dim}
                LEFT JOIN goal_{dim} g ON g.{dim} = c.{dim})"""
            )
            last = name
    parts.append("rate_0 AS MATERIALIZED (SELECT 0.0::DOUBLE AS rate)")
    for turn in range(rounds):
        parts.append(
            f"""rate_{turn + 1} AS MATERIALIZED (SELECT CASE WHEN opened > 0 THEN ({budget} * n - filled) / opened ELSE rate END AS rate
            FROM (SELECT sum(tokens) AS n, coalesce(sum(tokens) FILTER (WHERE factor * rate >= 1), 0) AS filled,
            coalesce(sum(tokens * factor) FILTER (WHERE factor * rate < 1), 0) AS opened, any_value(rate) AS rate
            FROM {last}, rate_{turn}))"""
        )
    return f"""WITH {", ".join(parts)} SELECT doc_id, m.source, m.lang, m.topic, CAST(n_tokens AS BIGINT) AS n_tokens,
        round(factor, 6) AS weight, round(least(1.0, factor * rate), 6) AS probability,
        CAST('0x' || substr(md5('{SEED}' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) / {16**12}.0::DOUBLE
        < least(1.0, factor * rate) AS kept
        FROM marked m JOIN {last} c ON m.source = c.source AND m.lang = c.lang AND m.topic = c.topic, rate_{rounds}"""

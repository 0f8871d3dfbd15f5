"""The n-th row of an order, found by counting ranges instead of sorting.

A few sampled keys split the range of candidates; one pass counts the rows in each part (counts combine in every task before
the shuffle), and only the part that holds the wanted place is looked at again. Each pass narrows the range by about the number
of splitters, so a handful of passes over the key columns reach one key, however many rows there are. The driver
sees splitters, counts and at most ``FEW`` keys of the last range; no task holds more than the rows of its own scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, functions as F

#: Sampled keys per pass, and how many rows are few enough to be put in order at the end.
SPLITTERS, FEW = 31, 1000


def _key(order: list[str]) -> Column:
    """What rows are compared by: the column itself, so that a range reaches the Parquet scan, or all columns at once."""
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _literal(row: Row, order: list[str], types: dict) -> Column:
    values = [F.lit(row[c]).cast(types[c]).alias(c) for c in order]
    return values[0] if len(order) == 1 else F.struct(*values)


def up_to(key: Row, df: DataFrame, order: list[str]) -> Column:
    """A filter: rows whose key is ``key`` or lies before it."""
    return _key(order) <= _literal(key, order, dict(df.dtypes))


def _splitters(rows: DataFrame, order: list[str], seed: int) -> list[Row]:
    """A few keys in order, chosen by a hash, so that each row of the range has the same chance."""
    chance = F.xxhash64(F.lit(seed), *order)
    some = rows.select(*order).orderBy(chance, *order).limit(SPLITTERS)
    return some.distinct().orderBy(*order).collect()


def _part(key: Column, splitters: list[Column], first: int) -> Column:
    """How many splitters lie before a row's key, by a decision tree over them."""
    if not splitters:
        return F.lit(first)
    middle = len(splitters) // 2
    after = _part(key, splitters[middle + 1 :], first + middle + 1)
    return F.when(key > splitters[middle], after).otherwise(_part(key, splitters[:middle], first))


def nth_key(df: DataFrame, order: list[str], n: int) -> Row | None:
    """The key of the ``n``-th row (from 1) of ``df`` by ``order``, or None if there are fewer rows.

    Of a single column, rows without a value are no candidates; of several columns, a NULL comes first. Keys may repeat: the
    n-th place is counted by rows. ``df`` should be a table or landed rows, as it is read twice per pass.
    """
    if n < 1:
        raise ValueError("places are counted from 1")
    key, types = _key(order), dict(df.dtypes)
    rows = df.select(*order)
    if len(order) == 1:
        rows = rows.filter(key.isNotNull())
    place, seed = n, 0
    while True:
        seed += 1
        keys = _splitters(rows, order, seed)
        if not keys:
            return None
        values = [_literal(k, order, types) for k in keys]
        parted = rows.select(key.alias("_key")).withColumn("_part", _part(F.col("_key"), values, 0))
        is_last = F.col("_key").eqNullSafe(F.get(F.array(*values), F.col("_part")))
        counts = parted.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.count_if(is_last).alias("last")).collect()
        found = None
        for row in sorted(counts, key=lambda r: r["_part"]):
            if place <= row["n"]:
                found = row
                break
            place -= row["n"]
        if found is None:
            return None
        at = found["_part"]
        if at < len(keys) and place > found["n"] - found["last"]:
            return keys[at]
        if at > 0:
            rows = rows.filter(key > values[at - 1])
        if at < len(keys):
            rows = rows.filter(key < values[at])
        if found["n"] - found["last"] <= FEW:
            return rows.orderBy(*order).limit(place).collect()[-1]

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.operators import keyed
from paperloom.operators.keyed import KeyedTable
from paperloom.operators.positions import number_rows
from paperloom.operators.quality import cascade_delete, duplicate_key_rows, foreign_key_violations
from paperloom.operators.reports import timing_stats
from paperloom.operators.skew import salted_join

SCHEMA = "k string, seq int, v string"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_dedupe_last_and_null_keys(spark):
    batch = spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, None), (None, 1, "n1"), (None, 2, "n2")], SCHEMA
    )
    assert rows(keyed.last_per_key(batch, ["k"], ["seq"])) == sorted(
        [("a", 3, "z"), ("b", 1, None), (None, 1, "n1"), (None, 2, "n2")], key=repr
    )


def test_last_of_landed_rows_by_two_keys(spark):
    """As the window has it; rows with a NULL in the key stay, as does one of two that are told apart by their number only."""
    rng, schema = random.Random(5), "k string, part int, seq int, page string, v string, _row bigint"
    data = [
        (rng.choice(["a", "b", "c", None]), rng.choice([1, 2, None]), rng.choice([1, 2, None]), rng.choice("pq"), f"v{n}", n) for n in range(60)
    ]
    batch = spark.createDataFrame([*data, ("lone", 1, 1, "p", "v", 60), ("twin", 1, 1, "p", "v", 61), ("twin", 1, 1, "p", "v", 62)], schema)
    found = rows(keyed.last_landed(batch, ["k", "part"], ["seq", "page"], "_row"))
    assert found == rows(keyed.last_per_key(batch, ["k", "part"], ["seq", "page", "_row"]))
    assert ("twin", 1, 1, "p", "v", 62) in found and ("twin", 1, 1, "p", "v", 61) not in found and len(found) < 60


def test_stored_table_equals_a_dict(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(SCHEMA), ("k",))
    assert table.current().isEmpty()
    rng, truth = random.Random(3), {}
    for load in range(7):
        batch = [(f"k{rng.randrange(12)}", i, f"{load}-{i}") for i in range(15)]
        assert table.upsert(spark.createDataFrame(batch, SCHEMA), ["seq"], f"load-{load}", combine_after=3)
        truth.update({k: (k, s, v) for k, s, v in batch})
        assert rows(table.current()) == sorted(truth.values(), key=repr)
    assert not table.upsert(spark.createDataFrame([("k1", 99, "late")], SCHEMA), ["seq"], "load-6")
    assert rows(table.current()) == sorted(truth.values(), key=repr)
    table.fold()
    assert not table._live()["changes"]
    assert rows(table.current()) == sorted(truth.values(), key=repr)


def test_an_id_with_other_rows_raises(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(SCHEMA), ("k",))
    batch = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    assert table.upsert(batch, ["seq"], "one", content="x") and not table.upsert(batch, ["seq"], "one", content="x")
    with pytest.raises(ValueError, match="other rows"):
        table.upsert(batch, ["seq"], "one", content="y")


def test_many_small_upserts_leave_few_files(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(SCHEMA), ("k",), buckets=4, keep_hours=0)
    for load in range(40):
        table.upsert(spark.createDataFrame([(f"k{load % 7}", load, "v")], SCHEMA), ["seq"], combine_after=4)
    assert table.current().count() == 7
    assert sum(1 for _ in (tmp_path / "t").rglob("*.parquet")) < 60
    assert len(list((tmp_path / "t" / "change").iterdir())) < 12 and len(table._live()["dead"]) < 10


def test_deleted_keys_and_unchanged_buckets(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(SCHEMA), ("k",), buckets=64)
    table.upsert(spark.createDataFrame([(f"k{i}", i, "v") for i in range(200)], SCHEMA), ["seq"])
    gone = spark.createDataFrame([("k3",), ("k4",), ("none",)], "k string")
    table.upsert(spark.createDataFrame([("k4", 9, "new")], SCHEMA), ["seq"], gone=gone)
    want = [(f"k{i}", i, "v") for i in range(200) if i not in (3, 4)] + [("k4", 9, "new")]
    assert rows(table.current()) == sorted(want, key=repr)
    live = table._live()
    assert len(live["changes"][0]["buckets"]) <= 3
    before = dict(live["base"])
    table.fold()
    after = table._live()["base"]
    assert sum(before[b] != after.get(b) for b in before) <= 3
    assert rows(table.current()) == sorted(want, key=repr)


def test_a_failed_load_leaves_the_table_as_it_was(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), T.StructType.fromDDL(SCHEMA), ("k",))
    good = spark.createDataFrame([("a", 1, "x")], SCHEMA)
    table.upsert(good, ["seq"], "one")
    broken = good.withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        table.upsert(broken, ["seq"], "two")
    assert rows(table.current()) == [("a", 1, "x")]
    assert table.upsert(good.withColumn("v", F.lit("y")), ["seq"], "two")
    assert rows(table.current()) == [("a", 1, "y")]


def test_batches_over_the_same_keys_are_idempotent(spark):
    target = spark.createDataFrame([("a", 0, "old"), ("c", 0, "keep")], SCHEMA)
    batch = spark.createDataFrame([("a", 1, "new"), ("b", 1, "ins")], SCHEMA)
    once = keyed.upsert(target, batch, ["k"], ["seq"])
    twice = keyed.upsert(once, batch, ["k"], ["seq"])
    assert rows(once) == rows(twice) == [("a", 1, "new"), ("b", 1, "ins"), ("c", 0, "keep")]


def test_merge_spreads_rows_without_a_key(spark):
    target = spark.range(4000).select(
        F.when(F.col("id") % 4 == 0, F.col("id").cast("string")).alias("k"), F.col("id").cast("int").alias("seq"), F.lit("t").alias("v")
    )
    batch = spark.createDataFrame([("0", 1, "b"), ("x", 2, "b"), (None, 3, "b")], SCHEMA)
    merged = keyed.merge(target, batch, ["k"])
    assert merged.count() == 4002 and merged.filter("v = 'b'").count() == 3
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        placed = keyed.merge(target, batch, ["k"]).filter("k IS NULL AND v = 't'").groupBy(F.spark_partition_id()).count()
        sizes = [r["count"] for r in placed.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 3000 and max(sizes) < 1500


def skewed(spark):
    """A third of the rows has one key; some keys have no partner; some keys are NULL."""
    return spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 1500)).alias("k"),
        F.col("id"),
    )


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    large = skewed(spark)
    unique = spark.range(0, 1500, 2).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") * 2).alias("w"))
    unique = unique.unionByName(spark.createDataFrame([("hot", -1)], "k string, w bigint"))
    spread = salted_join(large, unique, "k", how, ["id"], ["hot"])
    assert rows(spread) == rows(large.join(unique, "k", how))


def test_salted_join_splits_the_hot_key(spark):
    large, unique = skewed(spark), spark.createDataFrame([("hot", 1)], "k string, w int")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(large, unique, "k", "inner", ["id"], ["hot"]).withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 2000 and max(sizes) < 1700


def test_constraint_checks(spark):
    children = skewed(spark).filter("k IS NOT NULL").withColumnRenamed("id", "n")
    parents = spark.createDataFrame([("hot",), ("k1",)], "k string")
    orphans = foreign_key_violations(children, parents, "k")
    assert orphans.count() == children.filter("k NOT IN ('hot', 'k1')").count()
    assert cascade_delete(children, parents, "k").count() == children.count() - orphans.count()
    assert duplicate_key_rows(children.filter("false"), ["k"]).first()[0] == 0


def test_number_rows_is_contiguous_in_order(spark):
    frame = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x")).repartition(9)
    numbered = number_rows(frame, ["x"]).collect()
    assert sorted((r.x, r.row_number) for r in numbered) == [(i, i + 1) for i in range(1000)]


def test_timing_stats_median_even_and_odd(spark):
    data = [("pandas", "csv", d, i) for i, d in enumerate([5.0, 1.0, 9.0, 3.0])]
    data += [("pandas", "parquet", d, i) for i, d in enumerate([2.0, 2.0, 8.0])]
    stats = timing_stats(spark.createDataFrame(data, "reader string, format string, duration_ms double, run int"))
    got = {r.format: (r.run_count, r.average_ms, r.median_ms, r.min_ms, r.max_ms) for r in stats.collect()}
    assert got == {"csv": (4, 4.5, 4.0, 1.0, 9.0), "parquet": (3, 4.0, 2.0, 2.0, 8.0)}


def test_rows_dealt_out_by_key_are_not_shuffled_again(spark, tmp_path, monkeypatch):
    """Upserts and folds write rows where the shuffle for the last row per key, or for the merge, has put them."""
    hints, hint = [], type(spark.range(1)).hint
    monkeypatch.setattr(type(spark.range(1)), "hint", lambda df, *a: hints.append(a) or hint(df, *a))
    rows = spark.range(200).selectExpr("CAST(id % 100 AS STRING) AS k", "id AS n")
    table = KeyedTable(spark, str(tmp_path / "t"), rows.schema, ("k",))
    table.upsert(rows, ["n"])
    table.upsert(rows.filter("n >= 150").withColumn("n", F.col("n") + 1000), ["n"])
    table.fold()
    assert hints == []
    assert sorted(r.n for r in table.current().collect()) == [*range(100, 150), *range(1150, 1200)]

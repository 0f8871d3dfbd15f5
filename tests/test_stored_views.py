"""Views kept up by signed counts, and the n-th key by range counts."""

import random
import statistics

import pytest
from pyspark.sql import Row

from paperloom.operators import medians, selection
from paperloom.operators.medians import group_medians
from paperloom.operators.selection import nth_key, up_to
from paperloom.plans.stored_views import VIEWS, StoredViews
from paperloom.plans.tables import CLEAN_PAPERS
from paperloom.session import fresh_path


def batch(spark, papers):
    """Paper rows of (key, title, categories); the other columns are empty."""
    names = {f.name for f in CLEAN_PAPERS.open(spark, "none").schema}
    rows = spark.createDataFrame(
        [(k, t, "summary words of " + t if t else None, c) for k, t, c in papers],
        "paper_key string, title string, summary string, categories_json array<string>",
    )
    return rows.selectExpr("*", *[f"NULL AS {n}" for n in names - set(rows.columns)])


FIRST = [("a", "Graph nets and graph walks", ["x", "y"]), ("b", "Sparse sets", ["y", "z"]), ("c", None, None), ("d", "Lone", ["x"])]
SECOND = [("b", "Dense sets", ["y", "z", "z"]), ("d", "Lone", ["w", "x"]), ("e", "Graph cuts", []), ("c", "Now named", ["x", "y"])]
THIRD = [("a", None, []), ("e", "Graph cuts again", ["q", "z"])]


def load(views, papers, rows, load_id):
    views.prepare(papers, rows, load_id)
    papers.upsert(rows, ["paper_key"], load_id)
    views.apply(papers, load_id)


def stored(views):
    return {name: sorted(map(tuple, rows.collect())) for name, rows in views.current().items()}


def counted(papers):
    return {view.name: sorted(map(tuple, view.build(papers.current()).collect())) for view in VIEWS}


def opened(spark):
    root = fresh_path(spark, "stored-views")
    return CLEAN_PAPERS.open(spark, root), StoredViews(spark, root)


def test_views_follow_loads_as_a_rebuild_would(spark):
    papers, views = opened(spark)
    for number, rows in enumerate((FIRST, SECOND, THIRD, FIRST)):
        load(views, papers, batch(spark, rows), f"load-{number}")
        assert stored(views) == counted(papers)
    assert not any(word == "dense" and n == 0 for word, n in stored(views)["mv_agent_keyword_frequency"])


def test_a_repeated_load_is_added_once(spark):
    papers, views = opened(spark)
    load(views, papers, batch(spark, FIRST), "load-1")
    for _ in range(3):
        load(views, papers, batch(spark, SECOND), "load-2")
    assert stored(views) == counted(papers)


def test_a_load_that_failed_between_papers_and_views_is_completed(spark):
    papers, views = opened(spark)
    load(views, papers, batch(spark, FIRST), "load-1")
    rows = batch(spark, SECOND)
    views.prepare(papers, rows, "load-2")
    papers.upsert(rows, ["paper_key"], "load-2")  # and the run ends here
    load(views, papers, batch(spark, THIRD), "load-3")
    load(views, papers, rows, "load-2")
    assert stored(views) == counted(papers)


def test_differences_left_by_a_run_that_never_committed_are_not_used(spark):
    papers, views = opened(spark)
    load(views, papers, batch(spark, FIRST), "load-1")
    views.prepare(papers, batch(spark, SECOND), "load-2")
    load(views, papers, batch(spark, THIRD), "load-3")
    load(views, papers, batch(spark, SECOND), "load-2")
    assert stored(views) == counted(papers)


def test_views_of_papers_that_were_there_before_are_counted(spark):
    papers, views = opened(spark)
    papers.upsert(batch(spark, FIRST), ["paper_key"], "load-1")
    load(views, papers, batch(spark, SECOND), "load-2")
    assert stored(views) == counted(papers)


def test_a_load_opens_only_the_buckets_of_its_keys(spark):
    papers, _ = opened(spark)
    papers.upsert(batch(spark, [(f"k{i}", "Title", ["x"]) for i in range(200)]), ["paper_key"], "load-1")
    wanted = spark.createDataFrame([("k7",), ("absent",)], "paper_key string")
    found = papers.matching(wanted)
    assert [r["paper_key"] for r in found.collect()] == ["k7"]
    assert len(found.inputFiles()) <= 2 < len(papers.current().inputFiles())
    papers.upsert(batch(spark, [("k7", "Changed", ["x"]), ("k8", "Changed", ["x"])]), ["paper_key"], "load-2")
    assert [(r["paper_key"], r["title"]) for r in papers.matching(wanted).collect()] == [("k7", "Changed")]


@pytest.fixture(params=[5, 1000])
def few(request, monkeypatch):
    """From how many rows on ranges are counted instead of put in order."""
    monkeypatch.setattr(selection, "FEW", request.param)
    monkeypatch.setattr(medians, "FEW", request.param)


def test_nth_key_of_one_column(spark, few):
    rng = random.Random(2)
    keys = [f"k{rng.randrange(10**6)}" for _ in range(2000)] + ["dup"] * 1500 + [None] * 20
    rows = spark.createDataFrame([(k,) for k in keys], "k string").repartition(4).cache()
    in_order = sorted(k for k in keys if k)
    for n in (1, 700, 1501, 2600, 3500):
        assert nth_key(rows, ["k"], n) == Row(k=in_order[n - 1])
    assert nth_key(rows, ["k"], 3501) is None and nth_key(rows.limit(0), ["k"], 1) is None
    with pytest.raises(ValueError):
        nth_key(rows, ["k"], 0)


def test_nth_key_of_several_columns(spark, few):
    rng = random.Random(4)
    rows = spark.createDataFrame(
        [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), rng.randrange(40)) for _ in range(1500)], "a int, b string, c int"
    ).cache()
    in_order = [tuple(r) for r in rows.orderBy("a", "b", "c").collect()]
    for n in (1, 400, 1499, 1500):
        key = nth_key(rows, ["a", "b", "c"], n)
        assert tuple(key) == in_order[n - 1]
        assert rows.filter(up_to(key, rows, ["a", "b", "c"])).count() == max(i for i, r in enumerate(in_order) if r == in_order[n - 1]) + 1


def test_medians_of_groups(spark, few):
    rng = random.Random(6)
    groups = {
        "odd": [rng.random() for _ in range(701)], "even": [rng.gauss(0, 1e9) for _ in range(500)], "one": [3.5], "two": [1.0, 2.0],
        "same": [7.0] * 400, "few": [rng.choice([1.0, 2.0, -1e-300, 1e300]) for _ in range(333)], "none": [None, None],
    }
    rows = [(name, value) for name, values in groups.items() for value in [*values, None]]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "name string, value double").repartition(3).cache()
    expected = {name: statistics.median(values) for name, values in groups.items() if values[0] is not None}
    assert {r["name"]: r["median"] for r in group_medians(frame, ["name"], "value").collect()} == expected

"""The registered queries against their SQL twins, and the pipeline against plain versions of its stages."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from paperloom.llm import ORACLES, QUERIES, packing, quality
from tests.llm.test_near_dedup import plain_components
from tests.llm.test_suffix_dedup import plain

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are absent")


def rounded(rows):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in row) for row in rows), key=repr)


def test_registered():
    names = entry_module.queries()
    for number in range(1, 14):
        assert sum(n.startswith(f"op{number}_") for n in names) == 1
    assert names["pipeline"] is corpus_pipeline.run
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "suffix_dedup", "mix_sources", "best_fit_packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    frame = QUERIES[name](spark, str(DATA))
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(frame.columns)
    assert rounded(frame.select(*names).collect()) == rounded(result.fetchall())


def test_pipeline_stages_on_their_own_inputs(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    seen = docs.collect()
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, spark.createDataFrame(seen, docs.schema), str(DATA)).collect()
        if name == "quality_rules":
            bad = [r for r in seen if (c := quality.text_counts(r["text"]))[0] < 50 or 100 * c[4] > 50 * c[0]]
            assert {r["doc_id"] for r in out} == {r["doc_id"] for r in seen} - {r["doc_id"] for r in bad}
        elif name == "near_dedup":
            rows = [(r["doc_id"], r["text"]) for r in seen]
            kept = {key for (key, _), (_, c) in zip(rows, plain_components(rows, 5, 80), strict=True) if key == c}
            assert {r["doc_id"] for r in out} == kept and len(out) == len(kept)
        elif name == "suffix_dedup":
            removed = {r[0]: r[2] for r in plain([(r["doc_id"], r["text"]) for r in seen])}
            before = {r["doc_id"]: r["text"] for r in seen}
            assert len(out) == len(seen)
            for r in out:
                lost = len(before[r["doc_id"]].encode()) - len(r["text"].encode())
                assert removed[r["doc_id"]] <= lost <= removed[r["doc_id"]] + 3 * 2 * (removed[r["doc_id"]] // 200)
        elif name == "mix_sources":
            assert {r["doc_id"] for r in out} <= {r["doc_id"] for r in seen} and 0.3 < len(out) / len(seen) < 1
        else:
            total = sum(r["n_tokens"] for r in out)
            assert total == sum(len(r["text"].encode().split()) for r in seen)
            assert all(r["n_tokens"] <= 2048 for r in out)
            break
        seen = out
    assert packing.PACKED.startswith("piece")

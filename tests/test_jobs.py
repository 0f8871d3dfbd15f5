import hashlib
import json
import os
from datetime import datetime, timezone
from unittest.mock import MagicMock

import pytest
from pyspark.sql import functions as F

from paperloom.catalog import file_queries
from paperloom.operators.keyed import KeyedTable
from paperloom.plans.export import compare_formats, export_papers
from paperloom.plans.full_run import run_all
from paperloom.plans.payload import build_payload
from paperloom.plans.reviews import ingest_reviews
from paperloom.plans.tables import (
    CLEAN_PAPERS, CLEAN_REVIEWS, INGEST_STATE, PAPER_AUTHORS, RAW_ENTRIES, RAW_REVIEWS, REJECTED_ENTRIES,
    REJECTED_REVIEWS,
)
from paperloom.sinks.files import read_csv, write_csv
from paperloom.sources.feed import entry_records, land_pages, page_entries, page_facts, read_pages
from paperloom.sources.reviews_csv import missing_columns, normalize_header, read_csv_defensively, snake_case
from paperloom.streaming.feed_ingest import ingest_feed, stream_feed

HEADER = ",Clothing ID,Age,Title,Review Text,Rating,Recommended IND,Positive Feedback Count,Division Name,Department Name,Class Name"
AS_OF = datetime(2024, 3, 1, tzinfo=timezone.utc)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_csv_triage(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text('a,b\n1,2\n1,2,3\n4\nNULL,\n"x\ny",5\n1,2,,x\n7,"say ""hi, you"""\n8,9,\n\n N/A ,NA\n')
    got = [tuple(r) for r in read_csv_defensively(spark, str(path)).collect()]
    assert got == [("1", "2"), ("4", None), (None, None), ("x\ny", "5"), ("7", 'say "hi, you"'), (" N/A ", None)]
    # Fewer columns asked for must not change which lines count as malformed.
    assert read_csv_defensively(spark, str(path)).select("a").count() == 6


def test_files_with_another_header_raise(spark, tmp_path):
    folder = tmp_path / "two"
    folder.mkdir()
    (folder / "1.csv").write_text("a,b\n1,2\n")
    (folder / "2.csv").write_text("b,a\n2,1\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_defensively(spark, str(folder), multi_line=False).collect()


def test_header_normalisation(spark, tmp_path):
    assert snake_case("  Review -- Text (EN)! ") == "review_text_en"
    (tmp_path / "h.csv").write_text(HEADER + "\n0,1,2,t,r,5,1,0,d,e,c\n")
    frame = normalize_header(read_csv_defensively(spark, str(tmp_path / "h.csv")))
    assert missing_columns(frame) == [] and frame.columns[0] == "unnamed_0"


def review_file(path, lines):
    path.write_text(HEADER + "\n" + "\n".join(lines) + "\n")
    return str(path)


REVIEWS = [
    '0,767,33,,"Silky, and\ncomfy",4,1,0,Inmates,Intimate,None',
    "1,1080,34,nan,Nice,5.7,1,4,General,Dresses,Dresses",
    ",1077,60,T,Good,3,0,0,General,Dresses,Dresses",
    "3,abc,12,T, NONE ,0.9,7,-2,General,Dresses,Dresses",
    "4,1,101.5,T,fine,inf,x,1d,General,Dresses,Dresses",
    "5,1,30,T,fine,5,1,1,General,Dresses,Dresses,extra",
    "6,1,30,T,short",
    "1,1080,34,nan,Nicer,5,1,4,General,Dresses,Dresses",
]


def test_review_ingest(spark, tmp_path):
    source, root = review_file(tmp_path / "r.csv", REVIEWS), str(tmp_path / "root")
    checks = dict(map(tuple, ingest_reviews(spark, source, root, "b1", sample_path=f"{root}/sample").collect()))
    ratings = {name: checks.pop(name) for name in list(checks) if name.startswith("rating_")}
    assert checks == {"raw_count": 7, "clean_count": 3, "reject_count": 3, "clean_nulls": 0, "clean_duplicate_keys": 0}
    assert sum(ratings.values()) == 3 and ratings["rating_4"] >= 1
    clean = {r.review_key: r for r in CLEAN_REVIEWS.open(spark, root).current().collect()}
    assert clean["0"].title is None and clean["0"].class_name is None and clean["0"].review_text == "Silky, and\ncomfy"
    assert clean["1"].review_text == "Nicer" and clean["1"].rating == 5
    keyless = next(r for r in clean.values() if r.review_id is None)
    assert keyless.review_key == keyless.row_hash and keyless.clothing_id == 1077
    reasons = {r.row_number: r.reason for r in REJECTED_REVIEWS.open(spark, root).current().collect()}
    assert reasons == {
        4: "missing_or_invalid_clothing_id;rating_out_of_range_1_to_5;recommended_ind_not_binary;"
           "negative_positive_feedback_count;missing_review_text;age_out_of_expected_range",
        5: "missing_or_invalid_rating;missing_or_invalid_recommended_ind;missing_or_invalid_positive_feedback_count;"
           "age_out_of_expected_range",
        6: "missing_or_invalid_rating;missing_or_invalid_recommended_ind;missing_or_invalid_positive_feedback_count",
    }
    raw = {r.row_number: r for r in RAW_REVIEWS.open(spark, root).current().collect()}
    first = json.loads(raw[1].row_data)
    assert sorted(raw) == list(range(1, 8)) and first["row_number"] == "1" and first["title"] is None
    fields = {"unnamed_0": "0", "clothing_id": "767", "age": "33", "title": "", "review_text": "Silky, and\ncomfy",
              "rating": "4", "recommended_ind": "1", "positive_feedback_count": "0", "division_name": "Inmates",
              "department_name": "Intimate", "class_name": "", "row_number": "1"}
    text = json.dumps(fields, sort_keys=True, ensure_ascii=True)
    assert raw[1].row_hash == hashlib.sha256(text.encode()).hexdigest() == first["row_hash"]
    before = [rows(t.open(spark, root).current().drop("batch_id", "ingested_at", "cleaned_at", "rejected_at"))
              for t in (RAW_REVIEWS, CLEAN_REVIEWS, REJECTED_REVIEWS)]
    ingest_reviews(spark, source, root, "b2")
    after = [rows(t.open(spark, root).current().drop("batch_id", "ingested_at", "cleaned_at", "rejected_at"))
             for t in (RAW_REVIEWS, CLEAN_REVIEWS, REJECTED_REVIEWS)]
    assert before == after
    sample = read_csv(spark, f"{root}/sample", "row_hash string, row_number int, reject_reason string, raw_payload string")
    assert [r.row_number for r in sample.collect()] == [4, 5, 6]


def test_review_ingest_numbers_many_files_in_order(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for part in range(5):
        lines = [f"{part * 10 + i},1,30,T,text,5,1,1,G,D,C" for i in range(10 - part)]
        review_file(folder / f"part-{part}.csv", lines)
    ingest_reviews(spark, str(folder), str(tmp_path / "root"), "b1")
    got = RAW_REVIEWS.open(spark, str(tmp_path / "root")).current()
    pairs = got.select("row_number", F.get_json_object("row_data", "$.unnamed_0").cast("int")).orderBy("row_number").collect()
    expected = [part * 10 + i for part in range(5) for i in range(10 - part)]
    assert [tuple(p) for p in pairs] == [(n + 1, v) for n, v in enumerate(expected)]


def test_review_ingest_refuses_a_wrong_header_after_landing_raw(spark, tmp_path):
    (tmp_path / "w.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError, match="lacks required columns: unnamed_0, clothing_id"):
        ingest_reviews(spark, str(tmp_path / "w.csv"), str(tmp_path / "root"), "b1")
    assert RAW_REVIEWS.open(spark, str(tmp_path / "root")).current().count() == 1


def entry(n, day, title="T", authors=("Ann", "Bob"), version=1, category="cs.LG"):
    people = "".join(f"<author><name>{a}</name><arxiv:affiliation>L</arxiv:affiliation></author>" for a in authors)
    return (
        f"<entry><id>http://arxiv.org/abs/24.{n}v{version}</id><title>{title}</title><summary>Some\n  text &amp; é {n}</summary>"
        f"<published>2024-01-{day:02d}T00:00:00Z</published><updated>2024-01-{day:02d}T01:00:00Z</updated>{people}"
        f'<link href="http://x/{n}" rel="alternate" type="text/html"/>'
        f'<category term="{category}"/><category term="stat.ML"/><arxiv:primary_category term="{category}"/>'
        f"<arxiv:doi>10.1/{n}</arxiv:doi></entry>"
    )


def page_file(folder, number, entries, total="7"):
    folder.mkdir(exist_ok=True)
    body = "".join(entries)
    count = f"<opensearch:totalResults>{total}</opensearch:totalResults>" if total else ""
    (folder / f"page-{number:04d}.xml").write_text(
        '<?xml version="1.0" encoding="UTF-8"?>\n<feed xmlns="http://www.w3.org/2005/Atom" '
        'xmlns:arxiv="http://arxiv.org/schemas/atom" xmlns:opensearch="http://a9.com/-/spec/opensearch/1.1/">'
        f"{count}{body}</feed>", encoding="utf-8")


def stored(spark, root):
    specs = (RAW_ENTRIES, CLEAN_PAPERS, PAPER_AUTHORS, REJECTED_ENTRIES, INGEST_STATE)
    stamps = ("ingested_at", "loaded_at", "rejected_at", "updated_at", "batch_id", "last_batch_id", "source_start_at")
    return {s.name: rows(s.open(spark, str(root)).current().drop(*stamps)) for s in specs}


def test_feed_records(spark, tmp_path):
    page_file(tmp_path / "in", 3, [entry(1, 2), entry(2, 3, authors=("", "Zoe"))])
    page_file(tmp_path / "in", 4, [], total="")
    pages = read_pages(spark, str(tmp_path / "in"))
    facts = sorted((r.total_results, r.entry_count) for r in page_facts(pages).collect())
    assert facts == [(0, 0), (7, 2)]
    records = {r.paper_key: r for r in entry_records(page_entries(pages)).collect()}
    first = records["24.1"]
    assert first.summary == "Some text & é 1" and first.authors_preview == "Ann, Bob" and first.pdf_url is None
    payload = {
        "paper_key": "24.1", "versioned_id": "24.1v1", "full_id": "http://arxiv.org/abs/24.1v1", "title": "T",
        "summary": "Some text & é 1", "published_at": "2024-01-02T00:00:00+00:00",
        "updated_at": "2024-01-02T01:00:00+00:00", "primary_category": "cs.LG", "categories": ["cs.LG", "stat.ML"],
        "authors": [{"author_order": i, "author_name": n, "affiliation": "L"} for i, n in ((1, "Ann"), (2, "Bob"))],
        "links": [{"href": "http://x/1", "rel": "alternate", "type": "text/html"}],
        "comment": None, "journal_ref": None, "doi": "10.1/1",
    }
    text = json.dumps(payload, sort_keys=True, ensure_ascii=True)
    assert first.raw_payload == text and first.row_hash == hashlib.sha256(text.encode()).hexdigest()
    assert records["24.2"].first_author == ""


def test_two_stream_runs_equal_one(spark, tmp_path):
    first = [entry(1, 2), entry(2, 3, title=" ")]
    second = [entry(1, 4, title="T2", authors=("Ann",), version=2), entry(3, 5), entry(4, 6, authors=(" ",))]
    step, whole = tmp_path / "step", tmp_path / "whole"
    page_file(step, 1, first)
    settings = {"as_of": AS_OF, "overlap_minutes": 60 * 24 * 60}
    run = lambda folder, root: stream_feed(
        spark, str(folder), str(tmp_path / root), "s", str(tmp_path / f"{root}-cp"), **settings)
    assert run(step, "a") == 1
    page_file(step, 2, second)
    assert run(step, "a") == 1 and run(step, "a") == 0
    page_file(whole, 1, first)
    page_file(whole, 2, second)
    run(whole, "b")
    a, b = stored(spark, tmp_path / "a"), stored(spark, tmp_path / "b")
    assert a == b
    assert [r[0] for r in a["clean_papers"]] == ["24.1", "24.3"]
    # A stale second author stays by default, and the watermark is the last entry, a rejected one.
    assert ("24.1", 2, "Bob", "L") in [r[:4] for r in a["paper_authors"]]
    assert a["pipeline_state"][0][2] == "24.4"


def test_batch_window_cap_and_replaced_children(spark, tmp_path):
    folder = tmp_path / "in"
    page_file(folder, 1, [entry(n, n, title="" if n == 2 else "T") for n in range(1, 8)])
    load = lambda load_id, **kw: dict(map(tuple, ingest_feed(
        spark, str(folder), str(tmp_path / "root"), "s", load_id, as_of=AS_OF, **kw).collect()))
    checks = load("l1", max_papers=3)
    assert (checks["raw_count"], checks["clean_count"], checks["reject_count"], checks["author_count"]) == (4, 3, 1, 6)
    # The next capped run goes on behind the third clean entry; a window takes entry 4 again, then the rest.
    checks = load("l2", max_papers=2)
    assert (checks["raw_count"], checks["clean_count"]) == (2, 2)
    assert load("l2", max_papers=2) == checks
    checks = load("l3", window_only=True)
    assert (checks["raw_count"], checks["clean_count"], checks["outside_window"]) == (2, 2, 5)
    assert load("l4", max_papers=5)["raw_count"] == 0
    page_file(folder, 2, [entry(7, 7, authors=("Ann",))])
    load("l5", replace_children=True)
    authors = PAPER_AUTHORS.open(spark, str(tmp_path / "root")).current()
    assert authors.filter("paper_key = '24.7'").count() == 1 and authors.count() == 11
    checks = load("l6", categories=["none.such"])
    assert checks["raw_count"] == 0
    with pytest.raises(ValueError, match="other rows"):
        load("l5", categories=["none.such"])


def test_late_pages_new_checkpoints_and_page_names(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "root")
    run = lambda checkpoint: stream_feed(spark, str(folder), root, "s", str(tmp_path / checkpoint), as_of=AS_OF)
    keys = lambda: [r[0] for r in rows(CLEAN_PAPERS.open(spark, root).current().select("paper_key"))]
    mark = lambda: INGEST_STATE.open(spark, root).current().first().watermark_paper_key

    def page(name, when, entries):
        page_file(folder, 1, entries)
        (folder / "page-0001.xml").rename(folder / name)
        os.utime(folder / name, (when, when))

    page("page-2.xml", 1_000, [entry(2, 2)])
    page("page-10.xml", 2_000, [entry(10, 10)])
    assert run("cp") == 1 and keys() == ["24.10", "24.2"] and mark() == "24.10"
    # A page with an older entry lands late: it is loaded, and the watermark stays.
    page("page-20240301120000.xml", 3_000, [entry(3, 3)])
    assert run("cp") == 1 and keys() == ["24.10", "24.2", "24.3"] and mark() == "24.10"
    # A new checkpoint reads all pages again, also those that landed meanwhile.
    page("page-11.xml", 4_000, [entry(11, 11)])
    assert run("other") == 1 and keys() == ["24.10", "24.11", "24.2", "24.3"] and mark() == "24.11"
    numbers = {r.page_number for r in RAW_ENTRIES.open(spark, root).current().collect()}
    assert numbers == {1}


def test_capped_runs_take_everything_in_turn(spark, tmp_path):
    folder = tmp_path / "in"
    for number, days in ((2, (1, 2, 3)), (10, (4, 5, 6))):
        page_file(folder, number, [entry(n, n, title="" if n == 5 else "T") for n in days])
        os.utime(folder / f"page-{number:04d}.xml", (number, number))
    seen = []
    for turn in range(5):
        ingest_feed(spark, str(folder), str(tmp_path / "root"), "s", f"t{turn}", max_papers=2, as_of=AS_OF)
        seen.append(CLEAN_PAPERS.open(spark, str(tmp_path / "root")).current().count())
    assert seen == [2, 4, 5, 5, 5]
    assert REJECTED_ENTRIES.open(spark, str(tmp_path / "root")).current().count() == 1


def test_full_run_twice_changes_nothing(spark, tmp_path):
    folder, root = tmp_path / "in", tmp_path / "root"
    page_file(folder, 1, [entry(n, n, title="Deep graph learning") for n in range(1, 6)])
    first = run_all(spark, str(folder), str(root), "s", as_of=AS_OF)
    counts, tables = rows(first), stored(spark, root)
    assert ("clean_papers", 5) in counts and ("paper_authors", 10) in counts and ("pipeline_state", 1) in counts
    assert rows(run_all(spark, str(folder), str(root), "s", as_of=AS_OF)) == counts
    assert stored(spark, root) == tables
    assert spark.table("mv_agent_category_cooccurrence").collect() == [("cs.LG", "stat.ML", 5)]
    papers = CLEAN_PAPERS.open(spark, str(root)).current()
    report = export_papers(spark, papers, str(root / "c"), str(root / "p"))
    timings = spark.createDataFrame(
        [("spark", "csv", 4.0, 1), ("spark", "parquet", 2.0, 1)], "reader string, format string, duration_ms double, run int"
    )
    compared = compare_formats(timings, report).first()
    assert compared.speedup_factor == 2.0 and compared.csv_size_mb >= 0
    row = build_payload(spark, papers, str(root / "out"), min_input_words=3, max_papers=4).first()
    assert row.payload.total_records == 12 and (row.payload.train_records, row.payload.val_records) == (10, 2)
    manifest = json.loads(spark.read.text(str(root / "out" / "manifest")).first()[0])
    assert manifest["source"]["rows"] == 4 and manifest["payload"]["task_counts"] == {"summarize": 4, "classify": 4, "keypoints": 4}
    assert spark.read.json(row.files.chat_train).count() == 10 and spark.read.json(row.files.alpaca_all).count() == 12
    assert list(json.loads(spark.read.text(row.files.alpaca_val).first()[0])) == [
        "id", "task_type", "paper_key", "chunk_id", "instruction", "input", "output", "metadata"]


def test_full_run_exports_unchanged_papers_once(spark, tmp_path):
    """Made again when a load changes the papers or a file is gone; the CSV copy is smaller than the texts, and whole."""
    folder, root = tmp_path / "in", tmp_path / "root"
    run = lambda: run_all(spark, str(folder), str(root), "s", as_of=AS_OF)
    made = lambda: {f.name for n in ("csv", "parquet") for f in (root / "export" / f"papers_{n}").iterdir() if f.name.startswith("part-")}
    page_file(folder, 1, [entry(n, n, title="Deep graph learning " * 200) for n in range(1, 6)])
    run()
    first = made()
    run()
    assert made() == first
    page_file(folder, 2, [entry(9, 9)])
    run()
    second = made()
    assert not second & first
    stored = spark.read.parquet(str(root / "export" / "papers_parquet"))
    copy = read_csv(spark, str(root / "export" / "papers_csv"), stored.schema)
    assert rows(copy.select("paper_key", "title", "summary")) == rows(stored.select("paper_key", "title", "summary")) and copy.count() == 6
    assert sum(f.stat().st_size for f in (root / "export" / "papers_csv").glob("part-*")) < 5 * len("Deep graph learning " * 200)
    next((root / "export" / "papers_csv").glob("part-*")).unlink()
    run()
    assert not made() & second
    assert read_csv(spark, str(root / "export" / "papers_csv"), stored.schema).count() == 6


def test_feed_load_shuffles_no_whole_records(spark, tmp_path, monkeypatch):
    """Texts and payloads of new records are written where they lie, also where a key comes twice."""
    plans, store = {}, KeyedTable._store

    def watched(self, rows, *how, **more):
        plans[os.path.basename(self.root)] = rows._jdf.queryExecution().executedPlan().toString()
        return store(self, rows, *how, **more)

    monkeypatch.setattr(KeyedTable, "_store", watched)
    page_file(tmp_path / "in", 1, [entry(1, 2), entry(2, 3, title=" "), entry(3, 3)])
    page_file(tmp_path / "in", 2, [entry(1, 4, title="T2", version=2)])
    os.utime(tmp_path / "in" / "page-0001.xml", (1_000, 1_000))
    ingest_feed(spark, str(tmp_path / "in"), str(tmp_path / "root"), "s", "l1", as_of=AS_OF)
    for name in ("raw_arxiv_entries", "clean_papers", "rejected_arxiv_entries"):
        assert "hashpartitioning" not in plans[name] and "rangepartitioning" not in plans[name], name
    kept = stored(spark, tmp_path / "root")
    assert [r[0] for r in kept["raw_arxiv_entries"]] == ["24.1", "24.2", "24.3"]
    assert [(r[0], r[1], r[3]) for r in kept["clean_papers"]] == [("24.1", "24.1v2", "T2"), ("24.3", "24.3v1", "T")]
    assert len(kept["rejected_arxiv_entries"]) == 1


def test_payload_files_hold_the_copies_of_a_text_once(spark, tmp_path):
    """Six records have the text of a chunk as their input; the files together are smaller than the texts."""
    words = [hashlib.sha256(str(n).encode()).hexdigest()[:8] for n in range(3000)]
    papers = spark.createDataFrame(
        [(str(n), "t", ". ".join(" ".join(words[k : k + 10]) for k in range(n * 300, n * 300 + 300, 10)) + ".", "cs") for n in range(10)],
        "paper_key string, title string, summary string, primary_category string",
    ).withColumn("published_at", F.lit(AS_OF))
    out = str(tmp_path / "payload")
    row = build_payload(spark, papers, out).first()
    assert row.payload.total_records == spark.read.json(f"{out}/alpaca").count() == spark.read.json(f"{out}/chat").count() > 0
    files = [os.path.join(d, f) for name in ("alpaca", "chat") for d, _, names in os.walk(f"{out}/{name}") for f in names if f.startswith("part-")]
    assert sum(map(os.path.getsize, files)) < 2 * papers.selectExpr("sum(octet_length(summary))").first()[0]


def test_csv_round_trip(spark, tmp_path):
    data = [("a", ' "quoted" ', "line\nbreak, comma"), ("b", None, "back\\slash"), ("c", "'", "é\t")]
    frame = spark.createDataFrame(data, "k string, x string, y string")
    write_csv(frame, str(tmp_path / "c"))
    assert rows(read_csv(spark, str(tmp_path / "c"), frame.schema)) == sorted(data, key=repr)


def test_feed_pages_are_landed_by_all_tasks(spark, monkeypatch):
    """Both increments of the catalog job: a file for each part that has rows."""
    landed = []

    def counted(spark, landing, *rest, **how):
        landed.append(len([f for f in os.listdir(landing.removeprefix("file://")) if f.endswith(".parquet")]))
        if len(landed) == 2:
            raise KeyboardInterrupt

    documents = spark.range(400, numPartitions=4).selectExpr("id AS doc_id", "'some text' AS text", "'en' AS lang", "'s' AS source")
    monkeypatch.setattr(file_queries.fx, "table", lambda *_: documents)
    monkeypatch.setattr(file_queries, "INGEST_STATE", MagicMock())
    monkeypatch.setattr(file_queries, "stream_feed", counted)
    with pytest.raises(KeyboardInterrupt):
        file_queries.job_feed_incremental(spark, "")
    assert landed == [4, 8]


def test_pages_that_land_together_have_one_time(spark, tmp_path):
    """The file of the first page is written last; the last page of the landing still is the one with the largest index."""
    page = '<feed><startIndex>{}</startIndex><entry><id>{}</id></entry></feed>'
    frame = spark.createDataFrame([("p", page.format(n, n)) for n in (0, 2)], "page_file string, xml string").repartition(2, "xml")
    path = str(tmp_path / "landing")
    land_pages(frame, path)
    for name in os.listdir(path):
        if name.endswith(".parquet"):
            first = spark.read.parquet(f"{path}/{name}").filter("xml LIKE '%<id>0<%'").count()
            os.utime(f"{path}/{name}", (2_000_000_000 + first * 60,) * 2)
    pages = read_pages(spark, path, "parquet")
    assert pages.select("landed_at").distinct().count() == 1
    assert pages.agg(F.max_by("start_index", F.struct("landed_at", "start_index"))).first()[0] == 2
    land_pages(frame.filter("xml LIKE '%<id>0<%'"), path)
    assert read_pages(spark, path, "parquet").agg(F.max_by("start_index", F.struct("landed_at", "start_index"))).first()[0] == 0


def test_csv_parts_grow_with_the_rows(spark, monkeypatch):
    """With line breaks inside quotes each file is read by one task."""
    seen = []
    monkeypatch.setattr(file_queries, "LINES_A_FILE", 100)
    monkeypatch.setattr(file_queries.reviews_csv, "read_csv_defensively", lambda spark, path: seen.append(path) or spark.range(0))
    monkeypatch.setattr(file_queries.reviews_csv, "normalize_header", lambda df: df)
    texts = {c: F.lit("x") for c in file_queries._TEXT_FIELDS}
    raw = spark.range(2_000).withColumn("row_number", F.col("id")).withColumns(texts).withColumn("title", F.col("id").cast("string"))
    monkeypatch.setattr(file_queries.fx, "reviews_raw", lambda *_: raw)
    file_queries.src_csv_line_breaks(spark, "")
    assert len([d for d in os.listdir(seen[0].removeprefix("file://").removesuffix("/part=*")) if d.startswith("part=")]) == 20

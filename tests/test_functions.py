import hashlib
import json
import re

import pytest
from pyspark.sql import functions as F

from paperloom.functions import feed as ff
from paperloom.functions import hashing, text, values

SPACES = ["\t a \n", " x y　", "\x1c a\x1f\x1eb", "", None, "a  b\n\nc", " ", "\u0085z", "a b"]


def column(spark, items, build, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.out for r in rows.select("i", build(F.col("v")).alias("out")).orderBy("i").collect()]


def test_whitespace_functions_follow_python(spark):
    assert set(text.WHITESPACE) == {chr(i) for i in range(0x110000) if chr(i).isspace()}
    plain = [s or "" for s in SPACES]
    assert column(spark, SPACES, text.strip) == [s.strip() for s in plain]
    assert column(spark, SPACES, text.collapse_whitespace) == [" ".join(s.split()) for s in plain]
    assert column(spark, SPACES, text.word_count) == [len(s.split()) for s in plain]
    assert column(spark, SPACES, text.is_blank) == [not s.strip() for s in plain]
    for count in (0, 1, 2, 3):
        assert column(spark, SPACES, lambda c: text.has_words(c, count)) == [len(s.split()) >= count for s in plain]


def test_has_words_on_long_text(spark):
    long = "word " * 200_000
    assert column(spark, [long, long + "x"], lambda c: text.has_words(c, 350)) == [True, True]
    assert column(spark, [long], text.word_count) == [200_000]


def test_blank_to_null(spark):
    items = [" NaN ", "none", "None", "", None, " x ", "nano"]
    assert column(spark, items, text.blank_to_null) == [None, None, None, None, None, "x", "nano"]


@pytest.mark.parametrize("count", [0, 1, 3, 5, 9])
def test_tail_words(spark, count):
    items = ["a b c d e", "a", "", "  a  b "]
    expected = [" ".join(s.split()[-count:]) if count > 0 else "" for s in items]
    assert column(spark, items, lambda c: text.tail_words(c, count)) == expected


def test_sentences(spark):
    items = ["No end", "One. Two! Three? Four", "What?. Yes.", "a.b c", "...  x", "", "Dr. Who\nis. here"]
    expected = [[s for s in re.split(r"(?<=[.!?])\s+", " ".join(i.split())) if s] for i in items]
    assert column(spark, items, text.split_sentences) == expected
    assert column(spark, items, lambda c: text.extractive_summary(c, 2)) == [
        " ".join(e[:2]) if e else i for e, i in zip(expected, items)
    ]
    assert column(spark, [""], text.keypoints) == [text.NO_KEYPOINT]
    assert column(spark, ["A. B."], text.keypoints) == ["- A.\n- B."]


def test_numbers(spark):
    items = ["5.7", "0.9", "-0.9", "1e3", " 5 ", "1d", "inf", "nan", "0x10", "", None, ".5", "5.", "+2", "1_0", "1e999"]
    numbers = column(spark, items, values.to_number)
    assert numbers[:5] == [5.7, 0.9, -0.9, 1000.0, 5.0]
    assert numbers[5:11] == [None] * 6
    assert numbers[11:15] == [0.5, 5.0, 2.0, None]
    whole = column(spark, items, lambda c: values.truncate_to_int(values.to_number(c)))
    assert whole[:5] == [5, 0, 0, 1000, 5] and whole[-1] is None


def test_timestamps(spark):
    items = ["2024-01-01T00:00:00Z", "2024-01-01T05:30:00+05:30", "2024-01", "bad", "", None, "2024-02-30T00:00:00Z",
             "2024-01-01T00:00:00.250000Z", "2024-01-01"]
    got = column(spark, items, lambda c: values.as_utc_wall_clock(values.parse_iso_timestamp(c)).cast("string"))
    day = "2024-01-01 00:00:00"
    assert got == [day, day, None, None, None, None, None, day + ".25", day]


def test_ids(spark):
    items = ["http://arxiv.org/abs/2401.00001v2", "http://arxiv.org/abs/hep-th/9901001v1", "2401.00001", "", None, "v2"]
    versioned = column(spark, items, ff.versioned_id)
    assert versioned == ["2401.00001v2", "9901001v1", "2401.00001", None, None, "v2"]
    assert column(spark, items, lambda c: ff.base_id(ff.versioned_id(c))) == [
        "2401.00001", "9901001", "2401.00001", None, None, None
    ]


def test_links(spark):
    kind = "array<struct<_href:string,_rel:string,_type:string,_title:string>>"
    items = [
        [],
        [("", "alternate", "text/html", None), (" u2 ", "alternate", "text/html", None), ("u3", "alternate", "text/html", None)],
        [("u", "related", "application/pdf", "pdf")],
        [("u", None, "text/html", None)],
    ]
    page = lambda c: ff.first_link(c, rel="alternate", type="text/html")
    assert column(spark, items, page, kind) == [None, "u2", None, None]
    assert column(spark, items, lambda c: ff.paper_link(c, F.lit("k")), kind)[0] == "https://arxiv.org/abs/k"


def test_authors(spark):
    kind = "array<struct<name:string,affiliation:array<string>>>"
    items = [None, [(" ", [" "])], [("", None), ("B", ["L", "M"]), ("C", []), ("D", None)]]
    got = column(spark, items, ff.positioned_authors, kind)
    assert [[tuple(a) for a in row] for row in got] == [
        [], [(1, "", None)], [(1, "", None), (2, "B", "L"), (3, "C", None), (4, "D", None)]
    ]
    assert column(spark, items, lambda c: ff.authors_preview(ff.positioned_authors(c)), kind) == ["", "", ", B, C"]
    assert column(spark, items, lambda c: ff.first_author(ff.positioned_authors(c)), kind) == [None, "", ""]


def test_row_hash_equals_a_python_json_dump(spark):
    rows = [
        {"b": "x", "a": None, "z y": "é😀\u0001\x7f"},
        {"b": ' "q" \\ \n\t\r\b\f/ ', "a": "", "z y": " ok"},
        {"b": "x", "a": None, "z y": "é😀\u0001\x7f"},
    ]
    frame = spark.createDataFrame(
        [(i + 1, r["b"], r["a"], r["z y"]) for i, r in enumerate(rows)], "row_number int, b string, a string, `z y` string"
    )

    def expected(row, number=None):
        fields = {k: (v or "").strip() for k, v in row.items()}
        if number is not None:
            fields["row_number"] = str(number)
        return hashlib.sha256(json.dumps(fields, sort_keys=True, ensure_ascii=True).encode()).hexdigest()

    by_content = hashing.row_hash(["b", "a", "z y"])
    by_place = hashing.row_hash(["b", "a", "z y"], "row_number")
    got = frame.select("row_number", by_content.alias("c"), by_place.alias("p")).orderBy("row_number").collect()
    assert [r.c for r in got] == [expected(r) for r in rows]
    assert [r.p for r in got] == [expected(r, i + 1) for i, r in enumerate(rows)]
    assert got[0].c == got[2].c and got[0].p != got[2].p


def test_plain_values_are_rendered_without_arrays(spark):
    """The object of short escapes, as a whole, and the plan of a value: arrays only for what is not plain."""
    rows = [('"q"\\', "x/y"), ("\x01", "b"), ("\x01\x01", None), (None, "z"), ("é", "\n"), ("", "\x7f"), ('}{, "', '\\"'), ("😀", "a")]
    frame = spark.createDataFrame(rows, "b string, a string")
    rendered = hashing.json_text_object({"b": frame["b"], "a": frame["a"]})
    assert [r[0] for r in frame.select(rendered).collect()] == [json.dumps({"a": a, "b": b}) for b, a in rows]
    assert "zip_with" not in frame.select(rendered)._jdf.queryExecution().optimizedPlan().toString()

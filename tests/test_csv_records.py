"""Records with line breaks inside quotes, over many blocks of a file, against Spark's own one-task scan."""

import csv
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.operators.positions import number_file_rows
from paperloom.sources.csv_records import csv_records
from paperloom.sources.reviews_csv import read_csv_defensively


@pytest.fixture
def small_blocks(spark):
    """Files are cut into many blocks."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = [spark.conf.get(name) for name in names]
    for name, value in zip(names, ("97", "1", "40"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def one_task(spark, path, columns):
    """Spark's scan of whole files."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "bad")])
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": True, "columnNameOfCorruptRecord": "bad", "columnPruning": "false"}
    rows = spark.read.options(**options).schema(schema).csv(path)
    return [tuple(r) for r in rows.cache().collect()]


def field(rng):
    kind = rng.randrange(9)
    text = "".join(rng.choice("ab ,\"\n\n'") for _ in range(rng.randrange(9)))
    if kind < 4:
        return '"' + text.replace('"', '""') + '"'
    if kind == 4:
        return rng.choice(["", '""', '""""', 'x"y', "5' 10\"", " "])
    return "".join(rng.choice("abc '") for _ in range(rng.randrange(6)))


def write(path, rng, records):
    lines = ["a,b,c"]
    for _ in range(records):
        lines.append(",".join(["k" + str(rng.randrange(100)), *[field(rng) for _ in range(2)]]))
        if rng.random() < 0.1:
            lines.append("")
    path.write_bytes(("\n".join(lines) + "\n" * rng.randrange(2)).encode())


def test_records_equal_a_scan_by_one_task(spark, tmp_path, small_blocks):
    rng = random.Random(8)
    for number in range(6):
        path = tmp_path / f"{number}.csv"
        write(path, rng, 60)
        expected = [r for r in one_task(spark, str(path), ("a", "b", "c")) if r[3] is None]
        scan = read_csv_defensively(spark, str(path))
        blanked = [tuple(None if v in ("", "nan") else v for v in r[:3]) for r in expected]
        assert sorted(map(tuple, scan.collect()), key=repr) == sorted(blanked, key=repr)
        assert csv_records(spark, str(path)).select("_block").distinct().count() > 3


def test_row_numbers_follow_the_file(spark, tmp_path, small_blocks):
    path = tmp_path / "n.csv"
    with open(path, "w", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(["n", "text"])
        for n in range(120):
            writer.writerow([n, "one" if n % 3 else f"line {n}\n\nwith, \"quotes\"\nand breaks"])
    numbered = number_file_rows(read_csv_defensively(spark, str(path), with_position=True))
    rows = numbered.select(F.col("n").cast("int"), "row_number", "text").collect()
    assert sorted((r[0] + 1, r[1]) for r in rows) == [(n, n) for n in range(1, 121)]
    assert {r[2] for r in rows if r[0] == 3} == {'line 3\n\nwith, "quotes"\nand breaks'}


def test_windows_line_ends_and_lines_of_other_lengths(spark, tmp_path, small_blocks):
    path = tmp_path / "w.csv"
    path.write_bytes(b'a,b\r\n1,"x\r\ny"\r\n2\r\n3,4,5\r\n6,"7"\r\n')
    got = sorted(map(tuple, read_csv_defensively(spark, str(path)).collect()))
    assert got == [("1", "x\ny"), ("2", None), ("6", "7")]


def test_files_keep_apart_and_must_agree_on_the_header(spark, tmp_path, small_blocks):
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "1.csv").write_text('a,b\n1,"left\nopen to the end')
    (folder / "2.csv").write_text('a,b\n2,"x\ny"\n')
    got = sorted(map(tuple, read_csv_defensively(spark, str(folder)).collect()))
    assert ("2", "x\ny") in got and len(got) == 2
    (folder / "3.csv").write_text("b,a\n2,1\n")
    with pytest.raises(ValueError, match="header"):
        read_csv_defensively(spark, str(folder))


def test_a_quote_left_open_is_told_instead_of_gathered(spark, tmp_path, small_blocks):
    path = tmp_path / "o.csv"
    path.write_text('a,b\n1,"open\n' + "2,x\n" * 300)
    with pytest.raises(ValueError, match="quote is open"):
        csv_records(spark, str(path), max_lines=200)
    assert csv_records(spark, str(path)).count() == 2


def test_files_without_quotes_or_rows(spark, tmp_path, small_blocks):
    path = tmp_path / "e.csv"
    path.write_text("a,b\n")
    assert read_csv_defensively(spark, str(path)).collect() == []
    path.write_text("a,b\n1,2\n\n3,4")
    assert sorted(map(tuple, read_csv_defensively(spark, str(path)).collect())) == [("1", "2"), ("3", "4")]

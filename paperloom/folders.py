"""Small files and folders in whatever store a path names, through Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def read_text(spark: SparkSession, path: str) -> str | None:
    """The whole text of a small file, or None where there is none."""
    place, store = _at(spark, path)
    if not store.exists(place):
        return None
    source = store.open(place)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file beside its place and move it there in one step."""
    place, store = _at(spark, path)
    fresh = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    sink = store.create(fresh, True)
    sink.write(bytearray(text.encode()))
    sink.close()
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark._sc._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    qualified = store.makeQualified(place)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(store.makeQualified(fresh), qualified, how)


def delete(spark: SparkSession, path: str) -> None:
    place, store = _at(spark, path)
    store.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies directly in a folder."""
    place, store = _at(spark, path)
    return [entry.getPath().getName() for entry in store.listStatus(place)] if store.exists(place) else []


def size(spark: SparkSession, path: str) -> int:
    """Total bytes of the files below a path."""
    place, store = _at(spark, path)
    return store.getContentSummary(place).getLength() if store.exists(place) else 0


def data_size(spark: SparkSession, path: str, ending: str) -> int:
    """Total bytes of the files directly in a folder whose names have the ending."""
    place, store = _at(spark, path)
    return sum(entry.getLen() for entry in store.listStatus(place) if entry.getPath().getName().endswith(ending))

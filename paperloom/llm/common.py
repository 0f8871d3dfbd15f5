"""Small helpers of the training-data operators: table scans, words, and the package on the executors."""

from __future__ import annotations

import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Fixed value: a word is a run of anything but these six white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
find_words = re.compile(WORD_PATTERN).findall


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_crc(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))


def folded_words(text: str | None) -> list[bytes]:
    """Words as UTF-8 bytes with A-Z lower-cased; ``bytes.split`` cuts at exactly the six characters."""
    return (text or "").encode().lower().split()


_shipped: set[str] = set()


def shipped(df: DataFrame) -> DataFrame:
    """``df``, after sending this package to the executors of its session, once per application.

    Tasks import their functions from it, and a cluster need not have it installed.
    """
    context = df.sparkSession.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="paperloom-package-")) / "paperloom_package.zip"
        with zipfile.ZipFile(archive, "w") as target:
            for file in sorted(package.rglob("*.py")):
                target.write(file, Path(package.name) / file.relative_to(package))
        context.addPyFile(str(archive))
        _shipped.add(context.applicationId)
    return df

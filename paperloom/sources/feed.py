"""Landed feed pages (Atom XML) to page facts and nested entry records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from paperloom.functions import feed as ff
from paperloom.functions.hashing import json_array, json_object, json_strings, json_text_object
from paperloom.functions.text import collapse_whitespace, strip
from paperloom.functions.values import as_utc_wall_clock, keep_nonblank, parse_iso_timestamp

# Namespaces are dropped by the XML source, attributes get a leading underscore.
_TERM = "struct<_term:string>"
ENTRY_TYPE = (
    "struct<id:string,title:string,summary:string,published:string,updated:string,"
    "author:array<struct<name:string,affiliation:array<string>>>,"
    "link:array<struct<_href:string,_rel:string,_type:string,_title:string>>,"
    f"category:array<{_TERM}>,primary_category:{_TERM},comment:string,journal_ref:string,doi:string>"
)
PAGE_SCHEMA = f"totalResults bigint, startIndex bigint, entry array<{ENTRY_TYPE}>"
XML_OPTIONS = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"}


# Layout of a landing table that holds one page text per row, for feeds of very many pages. Pages that land together have
# one time, whatever files they are spread over; without one, that of the file counts.
PAGE_TABLE_SCHEMA = "page_file string, landed_at timestamp, xml string"


def read_pages(
    spark: SparkSession, path: str, page_format: str = "xml", landed_after: str | None = None
) -> DataFrame:
    """One row per landed page: ``page_file``, ``landed_at``, ``start_index``, ``totalResults``, ``entry``.

    ``xml`` reads page files as they came, ``parquet`` a landing table of page texts.
    """
    reader = spark.read
    return _pages(reader.option("modifiedAfter", landed_after) if landed_after else reader, path, page_format)


def stream_pages(
    spark: SparkSession, path: str, page_format: str = "xml", files_per_batch: int | None = None
) -> DataFrame:
    """The same rows as a stream over the landing folder."""
    reader = spark.readStream
    return _pages(reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader, path, page_format)


def land_pages(pages: DataFrame, path: str) -> None:
    """Add rows of ``page_file`` and ``xml`` to a landing table, as pages that land together."""
    pages.select("page_file", F.current_timestamp().alias("landed_at"), "xml").write.mode("append").parquet(path, compression="zstd")


def _landed_at() -> Column:
    """When the file that holds a page landed."""
    return F.col("_metadata.file_modification_time").alias("landed_at")


def _pages(reader, path: str, page_format: str) -> DataFrame:
    if page_format == "parquet":
        rows = reader.schema(PAGE_TABLE_SCHEMA).parquet(path)
        return parse_pages(rows.select("page_file", F.coalesce("landed_at", _landed_at()).alias("landed_at"), "xml"), "xml")
    if page_format != "xml":
        raise ValueError(f"Unknown page format: {page_format}")
    pages = reader.format("xml").options(rowTag="feed", **XML_OPTIONS).schema(T.StructType.fromDDL(PAGE_SCHEMA)).load(path)
    return pages.select(
        F.col("_metadata.file_path").alias("page_file"),
        _landed_at(),
        F.coalesce("startIndex", F.lit(0)).alias("start_index"),
        "totalResults",
        "entry",
    )


def parse_pages(pages: DataFrame, xml: str) -> DataFrame:
    """Replace the XML text column ``xml`` by ``totalResults`` and ``entry``."""
    page = F.from_xml(F.col(xml), T.StructType.fromDDL(PAGE_SCHEMA).simpleString(), XML_OPTIONS)
    return pages.withColumn("_page", page).select(
        *[c for c in pages.columns if c != xml],
        F.coalesce("_page.startIndex", F.lit(0)).alias("start_index"),
        "_page.totalResults",
        "_page.entry",
    )


def page_facts(pages: DataFrame) -> DataFrame:
    """Reported total (0 when absent) and number of entries of each page."""
    rest = [c for c in pages.columns if c not in ("totalResults", "entry")]
    return pages.select(
        *rest,
        F.coalesce("totalResults", F.lit(0)).alias("total_results"),
        F.coalesce(F.size("entry"), F.lit(0)).alias("entry_count"),
    )


def page_entries(pages: DataFrame, position: str = "entry_position") -> DataFrame:
    """One row per entry, keeping the page columns and the position within the page."""
    rest = [c for c in pages.columns if c not in ("totalResults", "entry")]
    # The outer form keeps the optimizer from adding a filter that parses the page a second time.
    return pages.select(*rest, F.posexplode_outer("entry").alias(position, "entry")).filter(
        F.col(position).isNotNull()
    )


def _iso_text(ts: Column) -> Column:
    clock = as_utc_wall_clock(ts)
    micros = F.replace(F.date_format(clock, ".SSSSSS"), F.lit(".000000"), F.lit(""))
    return F.concat(F.date_format(clock, "yyyy-MM-dd'T'HH:mm:ss"), micros, F.lit("+00:00"))


def _link_json(link: Column) -> Column:
    return json_text_object({n: link[f"_{n}"] for n in ("href", "rel", "title", "type")}, skip_null=True)


def _author_json(author: Column) -> Column:
    names = json_strings(F.array(author["affiliation"], author["author_name"]))
    order = F.array(author["author_order"].cast("string"))
    return json_object(["affiliation", "author_name", "author_order"], F.concat(names, order))


# Keys of the audit record in sorted order; three of them are arrays.
_PAYLOAD_KEYS = (
    "authors", "categories", "comment", "doi", "full_id", "journal_ref", "links", "paper_key",
    "primary_category", "published_at", "summary", "title", "updated_at", "versioned_id",
)


def _entry_payload() -> tuple[Column, Column]:
    """The rendered text fields, to be stored as ``_texts``, and the key-sorted JSON built from them."""
    arrays = {
        "authors": json_array(F.transform("authors", _author_json)),
        "categories": json_array(json_strings(F.col("categories"))),
        "links": json_array(F.transform("links", _link_json)),
    }
    texts = {
        **{k: F.col(k) for k in _PAYLOAD_KEYS if k not in arrays},
        "published_at": _iso_text(F.col("published_at")),
        "updated_at": _iso_text(F.col("updated_at")),
        "primary_category": F.nullif(F.col("primary_category"), F.lit("")),
    }
    rendered = json_strings(F.array(*texts.values()))
    order = list(texts)
    runs: list[Column] = []
    for key in _PAYLOAD_KEYS:
        runs.append(F.array(arrays[key]) if key in arrays else F.slice(F.col("_texts"), order.index(key) + 1, 1))
    return rendered, json_object(list(_PAYLOAD_KEYS), F.concat(*runs))


def entry_records(entries: DataFrame) -> DataFrame:
    """Normalised records from rows with an ``entry`` struct; other columns are kept.

    Built in two projections so that the arrays and identifiers are computed once and reused.
    """
    rest = [c for c in entries.columns if c != "entry"]
    e = "entry."
    base = entries.select(
        *rest,
        strip(F.col(e + "id")).alias("full_id"),
        ff.versioned_id(F.col(e + "id")).alias("versioned_id"),
        collapse_whitespace(F.col(e + "title")).alias("title"),
        collapse_whitespace(F.col(e + "summary")).alias("summary"),
        parse_iso_timestamp(strip(F.col(e + "published"))).alias("published_at"),
        parse_iso_timestamp(strip(F.col(e + "updated"))).alias("updated_at"),
        strip(F.col(e + "primary_category._term")).alias("primary_category"),
        keep_nonblank(F.coalesce(F.col(e + "category._term"), F.array().cast("array<string>"))).alias("categories"),
        ff.positioned_authors(F.col(e + "author")).alias("authors"),
        F.coalesce(
            F.col(e + "link"), F.array().cast("array<struct<_href:string,_rel:string,_type:string,_title:string>>")
        ).alias("links"),
        ff.strip_or_null(F.col(e + "comment")).alias("comment"),
        ff.strip_or_null(F.col(e + "journal_ref")).alias("journal_ref"),
        ff.strip_or_null(F.col(e + "doi")).alias("doi"),
    ).withColumn("paper_key", ff.base_id(F.col("versioned_id")))
    texts, payload = _entry_payload()
    base = base.withColumn("_texts", texts)
    authors, links = F.col("authors"), F.col("links")
    return base.select(
        *rest,
        "paper_key",
        "versioned_id",
        "title",
        "summary",
        "published_at",
        "updated_at",
        "primary_category",
        "categories",
        "authors",
        ff.author_count(authors).alias("author_count"),
        ff.first_author(authors).alias("first_author"),
        ff.authors_preview(authors).alias("authors_preview"),
        ff.paper_link(links, F.col("paper_key")).alias("arxiv_url"),
        ff.first_link(links, rel="related", type="application/pdf", title="pdf").alias("pdf_url"),
        "comment",
        "journal_ref",
        "doi",
        payload.alias("raw_payload"),
    ).withColumn("row_hash", F.sha2("raw_payload", 256))

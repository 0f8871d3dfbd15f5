"""Column functions over feed entries: identifiers, links, authors and categories."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom.functions.text import strip

# Fixed value: address of a paper page when the feed gives no link.
PAPER_URL = "https://arxiv.org/abs/"


def versioned_id(full_id: Column) -> Column:
    """``.../abs/<id>`` without a further slash, else the last path segment; empty becomes NULL."""
    flat = strip(full_id)
    after_abs = F.nullif(F.regexp_extract(flat, r"/abs/([^/]+)$", 1), F.lit(""))
    return F.coalesce(after_abs, F.nullif(F.substring_index(flat, "/", -1), F.lit("")))


def base_id(versioned: Column) -> Column:
    """The identifier without its trailing ``v<digits>``; empty becomes NULL."""
    return F.nullif(F.regexp_replace(versioned, r"v[0-9]+$", ""), F.lit(""))


def first_link(links: Column, rel: str | None = None, type: str | None = None, title: str | None = None) -> Column:
    """Trimmed address of the first link that matches every given attribute and is not blank."""
    wanted = {"_rel": rel, "_type": type, "_title": title}

    def matches(link: Column) -> Column:
        found = strip(link["_href"]) != ""
        for field, value in wanted.items():
            if value is not None:
                found = found & link[field].eqNullSafe(value)
        return found

    return strip_or_null(F.try_element_at(F.filter(links, matches), F.lit(1))["_href"])


def strip_or_null(c: Column) -> Column:
    """Trimmed text, NULL when empty."""
    return F.nullif(strip(c), F.lit(""))


def paper_link(links: Column, key: Column) -> Column:
    """The HTML page link, else the fixed address of the key."""
    page = first_link(links, rel="alternate", type="text/html")
    return F.coalesce(page, F.concat(F.lit(PAPER_URL), key))


def positioned_authors(authors: Column) -> Column:
    """Authors with 1-based ``author_order``; a blank affiliation becomes NULL."""
    return F.transform(
        F.coalesce(authors, F.array().cast("array<struct<name:string,affiliation:array<string>>>")),
        lambda a, i: F.struct(
            (i + 1).cast("int").alias("author_order"),
            strip(a["name"]).alias("author_name"),
            strip_or_null(F.try_element_at(a["affiliation"], F.lit(1))).alias("affiliation"),
        ),
    )


def author_count(authors: Column) -> Column:
    """All authors, unnamed ones included."""
    return F.size(authors)


def first_author(authors: Column) -> Column:
    """Name of the first author (may be ``""``), NULL without authors."""
    return F.try_element_at(authors, F.lit(1))["author_name"]


def authors_preview(authors: Column, count: int = 3) -> Column:
    """The first names joined by ``, ``."""
    return F.array_join(F.transform(F.slice(authors, 1, count), lambda a: a["author_name"]), ", ")

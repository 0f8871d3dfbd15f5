"""The ten analytical views over papers and authors, as DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.functions.values import month_of

AGENT_PAPER_COLUMNS = (
    "paper_key", "versioned_id", "title", "summary", "primary_category", "categories_json", "author_count",
    "first_author", "arxiv_url", "pdf_url", "doi", "journal_ref", "comment", "published_at", "updated_at",
    "loaded_at",
)
RECENT_PAPER_COLUMNS = (
    "paper_key", "title", "summary", "primary_category", "first_author", "author_count", "published_at",
    "updated_at", "arxiv_url", "pdf_url",
)
# Words left out of the keyword counts, and the shortest word counted.
STOP_WORDS = (
    "the", "and", "for", "with", "that", "this", "from", "are", "was", "were", "have", "has", "had",
    "into", "over", "under", "than", "then", "our", "your", "their", "there", "here", "also", "using",
    "use", "used", "new", "via", "toward", "towards", "can", "may", "not",
)
MIN_WORD_LENGTH = 3
RECENT_DAYS = 180


def agent_papers(papers: DataFrame) -> DataFrame:
    return papers.select(*AGENT_PAPER_COLUMNS)


def category_counts(papers: DataFrame) -> DataFrame:
    return papers.groupBy("primary_category").agg(F.count(F.lit(1)).alias("paper_count"))


def monthly_category_counts(papers: DataFrame) -> DataFrame:
    month = month_of(F.col("published_at")).alias("month")
    return papers.groupBy(month, "primary_category").agg(F.count(F.lit(1)).alias("paper_count"))


def author_papers(authors: DataFrame, papers: DataFrame, paper_columns: list[str]) -> DataFrame:
    """Author rows with columns of their paper."""
    return authors.join(papers.select("paper_key", *paper_columns), "paper_key")


def author_frequency(authors: DataFrame, papers: DataFrame) -> DataFrame:
    """Distinct papers per author and the span of their dates.

    The distinct count first groups by author and paper, so a very productive author is combined in
    many tasks.
    """
    joined = author_papers(authors.select("author_name", "paper_key"), papers, ["published_at"])
    return joined.groupBy("author_name").agg(
        F.count_distinct("paper_key").alias("paper_count"),
        F.min("published_at").alias("first_published_at"),
        F.max("published_at").alias("last_published_at"),
    )


def author_category_frequency(authors: DataFrame, papers: DataFrame) -> DataFrame:
    joined = author_papers(authors.select("author_name", "paper_key"), papers, ["primary_category"])
    return joined.groupBy("author_name", "primary_category").agg(F.count_distinct("paper_key").alias("paper_count"))


def metadata_quality(papers: DataFrame) -> DataFrame:
    """0..4: a point for each of four fields that holds more than spaces."""

    def point(name: str) -> Column:
        return F.when(F.trim(name) != "", 1).otherwise(0)

    score = point("summary") + point("doi") + point("journal_ref") + point("comment")
    return papers.select("paper_key", "primary_category", "published_at", score.alias("metadata_score"))


def ingest_health(
    state: DataFrame, papers: DataFrame, authors: DataFrame, raw: DataFrame, rejected: DataFrame
) -> DataFrame:
    """Each state row with the table counts and the last load time, as scalar subqueries."""

    def rows(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1)).alias("n")).scalar()

    return state.select(
        "source_name",
        "watermark_published_at",
        "watermark_paper_key",
        "last_batch_id",
        F.col("updated_at").alias("pipeline_updated_at"),
        rows(papers).alias("clean_paper_rows"),
        rows(authors).alias("author_rows"),
        rows(raw).alias("raw_rows"),
        rows(rejected).alias("rejected_rows"),
        papers.agg(F.max("loaded_at").alias("t")).scalar().alias("latest_clean_loaded_at"),
    )


def recent_papers(papers: DataFrame, as_of: Column | None = None, days: int = RECENT_DAYS) -> DataFrame:
    """Papers published in the last ``days`` days before ``as_of`` (default: now)."""
    since = (F.current_timestamp() if as_of is None else as_of) - F.make_dt_interval(F.lit(days))
    return papers.filter(F.col("published_at") >= since).select(*RECENT_PAPER_COLUMNS)


def paper_words(papers: DataFrame, min_length: int = 1) -> DataFrame:
    """One row per lower-case word of title and summary; all but ASCII letters and digits separates.

    Matching the words is much cheaper than splitting at what lies between; words below
    ``min_length`` never become rows.
    """
    text = F.concat_ws(" ", F.coalesce("title", F.lit("")), F.coalesce("summary", F.lit("")))
    found = F.regexp_extract_all(text, F.lit(f"[a-zA-Z0-9]{{{min_length},}}"), F.lit(0))
    # The outer form keeps the optimizer from adding a filter that searches the text a second time.
    words = papers.select("paper_key", F.explode_outer(found).alias("word"))
    return words.select("paper_key", F.lower("word").alias("word")).filter("word IS NOT NULL")


def keyword_frequency(papers: DataFrame) -> DataFrame:
    """Occurrences of each word of three letters or more that is no stop word.

    Splits on whitespace, as the name says. The view this mirrors quotes its separator so that a whole
    text stays one "word"; the intended word counts are built here.
    """
    words = paper_words(papers, MIN_WORD_LENGTH).filter(~F.col("word").isin(*STOP_WORDS))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("frequency"))


def category_cooccurrence(papers: DataFrame, categories: str = "categories") -> DataFrame:
    """Papers per pair of categories ``a < b`` (bytewise); a repeated category counts once per copy.

    Papers are first counted per category list, in each task before the shuffle. Pairs are then made
    once per distinct list, weighted by copies and papers, so neither papers nor repeats multiply.
    """
    lists = (
        papers.select(F.sort_array(categories).alias("_all"))
        .groupBy("_all")
        .agg(F.count(F.lit(1)).alias("_papers"))
    )

    def with_copies(category: Column) -> Column:
        copies = F.size(F.filter("_all", lambda x: x == category))
        return F.struct(category.alias("c"), copies.alias("n"))

    def pairs_from(items: Column) -> Column:
        def pairs_of(a: Column, i: Column) -> Column:
            later = F.slice(items, i + 2, F.size(items))
            return F.transform(
                later, lambda b: F.struct(a["c"].alias("a"), b["c"].alias("b"), (a["n"] * b["n"]).alias("n"))
            )

        return F.flatten(F.transform(items, pairs_of))

    items = lists.select("_papers", F.transform(F.array_distinct("_all"), with_copies).alias("_items"))
    # The outer form keeps the optimizer from adding a filter that builds the pairs a second time.
    pairs = items.select("_papers", F.explode_outer(pairs_from(F.col("_items"))).alias("_pair"))
    return (
        pairs.filter(F.col("_pair").isNotNull())
        .groupBy(F.col("_pair.a").alias("category_a"), F.col("_pair.b").alias("category_b"))
        .agg(F.sum(F.col("_papers") * F.col("_pair.n")).alias("co_paper_count"))
    )


def paper_category_pairs(papers: DataFrame, categories: str = "categories") -> DataFrame:
    """Each paper's category pairs ``a < b``, repeats kept, without a join."""
    first = papers.select("paper_key", categories, F.explode(categories).alias("category_a"))
    larger = F.filter(categories, lambda b: b > F.col("category_a"))
    return first.select("paper_key", "category_a", F.explode(larger).alias("category_b"))


def in_categories(papers: DataFrame, wanted: list[str], categories: str = "categories") -> DataFrame:
    """Papers with at least one of the wanted categories."""
    return papers.filter(F.arrays_overlap(categories, F.array(*[F.lit(c) for c in wanted])))


def submitted_between(papers: DataFrame, start: Column, end: Column, keep_undated: bool = False) -> DataFrame:
    """Papers published from ``start`` to ``end``, all cut to the minute, both ends included.

    Written as a range on the bare column, so it reaches the Parquet scan. ``keep_undated`` keeps
    rows without a date, which a feed load rejects with a reason instead of losing them.
    """
    published = F.col("published_at")
    after_end = F.date_trunc("minute", end) + F.expr("INTERVAL '1' MINUTE")
    inside = (published >= F.date_trunc("minute", start)) & (published < after_end)
    return papers.filter(inside | published.isNull() if keep_undated else inside)

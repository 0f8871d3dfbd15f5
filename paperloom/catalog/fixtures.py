"""Inputs of the catalog: review, paper, author and feed frames derived from the given tables.

Each frame is a narrow projection of one whole table, so a query over it costs
what the query itself costs. The same expressions, in the oracle's dialect, are the common table
expressions its SQL starts with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.operators.quality import REASON, paper_reasons, typed_reviews
from paperloom.session import land
from paperloom.sources.tables import EXPORT_COLUMNS
from paperloom.sources.feed import entry_records, page_entries, parse_pages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(exprs: dict[str, str], table_name: str) -> str:
    return "SELECT " + ", ".join(f"{e} AS {n}" for n, e in exprs.items()) + f" FROM {table_name}"


def _spark(expr: str) -> str:
    """The few spots where the dialects differ: intervals and array literals."""
    return (
        expr.replace("to_days(", "make_dt_interval(").replace("to_hours(", "make_dt_interval(0, ")
        .replace("list_value(", "array(").replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    )


def derive(df: DataFrame, exprs: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{_spark(e)} AS {n}" for n, e in exprs.items()])


# --- papers: one per document ------------------------------------------------------------------

_PUBLISHED = "TIMESTAMP '1995-01-01 00:00:00' + to_days(CAST(doc_id % 2400 AS INT)) + to_hours(CAST(doc_id % 24 AS INT))"
PAPER_EXPRS = {
    "paper_key": "CAST(doc_id AS STRING)",
    "versioned_id": "CAST(doc_id AS STRING) || 'v1'",
    "batch_id": "'b' || CAST(doc_id % 4 AS STRING)",
    "row_hash": "sha256(text)",
    "title": "CASE WHEN doc_id % 11 = 0 THEN '  ' ELSE substr(text, 1, 40) END",
    "summary": "text",
    "published_at": _PUBLISHED,
    "updated_at": f"{_PUBLISHED} + to_days(1)",
    "primary_category": "lang",
    "categories_json": "list_value(lang, source, 'g' || CAST(doc_id % 5 AS STRING))",
    "author_count": "CAST(doc_id % 7 + 1 AS INT)",
    "first_author": "'Author ' || CAST(doc_id % 97 AS STRING)",
    "authors_preview": "'Author ' || CAST(doc_id % 97 AS STRING) || ', Author X'",
    "arxiv_url": "'https://arxiv.org/abs/' || CAST(doc_id AS STRING)",
    "pdf_url": "CASE WHEN doc_id % 6 = 0 THEN NULL ELSE 'https://arxiv.org/pdf/' || CAST(doc_id AS STRING) END",
    "comment": "CASE WHEN doc_id % 3 = 0 THEN NULL WHEN doc_id % 3 = 1 THEN '  ' ELSE 'note' END",
    "journal_ref": "CASE WHEN doc_id % 4 = 0 THEN 'J. Ref' ELSE NULL END",
    "doi": "CASE WHEN doc_id % 5 = 0 THEN '10.1/' || CAST(doc_id AS STRING) ELSE '' END",
    "raw_payload": "'{\"id\": ' || CAST(doc_id AS STRING) || '}'",
    "loaded_at": f"{_PUBLISHED} + to_days(2)",
}


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "documents"), {**PAPER_EXPRS, "row_hash": "sha2(text, 256)"})


SQL_EXPORTED = "SELECT " + ", ".join(
    "'[' || array_to_string(list_transform(categories_json, lambda c: '\"' || c || '\"'), ',') || ']' AS categories_json"
    if c == "categories_json" else c
    for c in EXPORT_COLUMNS
) + " FROM papers"


def exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The papers with all columns of an export, lists as JSON text."""
    rows = papers(spark, sf_dir)
    return rows.select(*[F.to_json(c).alias(c) if c == "categories_json" else F.col(c) for c in EXPORT_COLUMNS])


# --- authors: one per order line ---------------------------------------------------------------

AUTHOR_EXPRS = {
    "paper_key": "CAST(l_orderkey AS STRING)",
    "author_order": "CAST(l_linenumber AS INT)",
    "author_name": "'Supplier#' || CAST(l_suppkey AS STRING)",
    "affiliation": "CAST(NULL AS STRING)",
    "batch_id": "'b' || CAST(l_orderkey % 4 AS STRING)",
}


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "lineitem"), AUTHOR_EXPRS)


# --- category lists: one per order line, repeats on purpose ------------------------------------

CATEGORY_EXPRS = {
    "paper_key": "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)",
    "categories": (
        "list_value('c' || CAST(l_suppkey % 25 AS STRING), 'c' || CAST(l_partkey % 25 AS STRING), "
        "l_returnflag, l_linestatus, 'c' || CAST(l_orderkey % 25 AS STRING))"
    ),
}


def category_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "lineitem"), CATEGORY_EXPRS)


# --- raw reviews: one per event, dirty on purpose ----------------------------------------------

_E = "CAST(event_id AS STRING)"
REVIEW_EXPRS = {
    "unnamed_0": f"CASE WHEN event_id % 50 = 0 THEN NULL ELSE {_E} END",
    "clothing_id": "CASE WHEN event_id % 37 = 0 THEN 'abc' ELSE CAST(event_id % 1200 AS STRING) END",
    "age": "CASE WHEN event_id % 29 = 0 THEN '' WHEN event_id % 31 = 0 THEN '7' ELSE CAST(user_id AS STRING) END",
    "title": "CASE WHEN event_id % 7 = 0 THEN '  ' WHEN event_id % 11 = 0 THEN 'NaN' ELSE ' ' || event_type || ' ' END",
    "review_text": "CASE WHEN event_id % 41 = 0 THEN ' none ' WHEN event_id % 43 = 0 THEN NULL ELSE props END",
    "rating": (
        "CASE WHEN event_id % 19 = 0 THEN '5.7' WHEN event_id % 23 = 0 THEN '0.9' "
        "WHEN event_id % 61 = 0 THEN 'bad' ELSE CAST(event_id % 7 AS STRING) END"
    ),
    "recommended_ind": (
        "CASE WHEN event_id % 53 = 0 THEN '2' WHEN event_id % 59 = 0 THEN 'x' ELSE CAST(event_id % 2 AS STRING) END"
    ),
    "positive_feedback_count": (
        "CASE WHEN event_id % 47 = 0 THEN '-1' WHEN event_id % 67 = 0 THEN '?' ELSE CAST(event_id % 25 AS STRING) END"
    ),
    "division_name": "event_type",
    "department_name": "CASE WHEN event_id % 13 = 0 THEN 'None' ELSE 'dep' || CAST(event_id % 5 AS STRING) END",
    "class_name": "CASE WHEN event_id % 17 = 0 THEN '' ELSE 'cls' || CAST(event_id % 9 AS STRING) END",
    "row_number": "event_id",
}


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "events"), REVIEW_EXPRS)


def scored_reviews(spark: SparkSession, sf_dir: str, raw: DataFrame | None = None) -> DataFrame:
    """Typed reviews with their reasons, landed as in a load.

    Filtering the reasons on the fly would parse each text again for every rule that reads it.
    """
    return land(typed_reviews(reviews_raw(spark, sf_dir) if raw is None else raw), "scored-reviews")


# --- feed pages: one per document, a defective entry and a full one ----------------------------

FEED_FIELDS = {
    "n": "CAST(doc_id AS STRING)",
    "start_index": "doc_id * 2",
    "entry_title": "substr(text, 1, 40)",
    "entry_summary": "text",
    "day": "lpad(CAST(doc_id % 28 + 1 AS STRING), 2, '0')",
    "hour": "lpad(CAST(doc_id % 24 AS STRING), 2, '0')",
    "lang": "lang",
    "source": "source",
    "has_html": "doc_id % 5 <> 0",
    "version": "'v' || CAST(doc_id % 3 + 1 AS STRING)",
    "second_author": "CASE WHEN doc_id % 10 = 0 THEN ' ' ELSE 'Author B' || CAST(doc_id % 13 AS STRING) END",
    "journal": "CASE WHEN doc_id % 4 = 0 THEN ' J. Ref ' ELSE '' END",
}


def _xml_text(c: str):
    """Text without the characters XML forbids, the others escaped."""
    clean = F.regexp_replace(F.col(c), r"[^\x09\x0a\x0d\x20-\x{d7ff}\x{e000}-\x{fffd}\x{10000}-\x{10ffff}]", "")
    for char, escape in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        clean = F.replace(clean, F.lit(char), F.lit(escape))
    return clean


def feed_pages(spark: SparkSession, sf_dir: str, *also: str) -> DataFrame:
    """``page_file``, ``xml``, ``also``: each page holds two entries and reports some number of results, or none."""
    f = derive(table(spark, sf_dir, "documents"), FEED_FIELDS)

    def cat(*parts):
        return F.concat(*[F.lit(p[1:]) if p.startswith("=") else F.col(p) for p in parts])

    f = f.withColumns({"entry_title": _xml_text("entry_title"), "entry_summary": _xml_text("entry_summary")})
    html = F.when(
        F.col("has_html"), cat('=<link href="https://example.org/abs/', "n", '=" rel="alternate" type="text/html"/>')
    ).otherwise(F.lit('<link href=" " rel="alternate" type="text/html"/>'))
    good = F.concat(
        cat("=<entry><id>http://arxiv.org/abs/24.", "n", "version", "=</id><title>", "entry_title",
            "=</title><summary>", "entry_summary", "=</summary><published>2024-01-", "day", "=T", "hour",
            "=:00:00Z</published><updated>2024-02-", "day", "=T", "hour", "=:30:00+02:00</updated>"),
        F.lit("<author><name> Author A </name><arxiv:affiliation> Lab </arxiv:affiliation></author>"),
        cat("=<author><name>", "second_author", "=</name></author>"),
        html,
        cat('=<link href="https://example.org/pdf/', "n", '=" rel="related" type="application/pdf" title="pdf"/>'),
        cat('=<category term="', "lang", '="/><category term=" "/><category term=" ', "source", '=  "/>'),
        cat('=<arxiv:primary_category term="', "lang", '="/><arxiv:journal_ref>', "journal", "=</arxiv:journal_ref></entry>"),
    )
    bad = cat("=<entry><id>http://arxiv.org/abs/hep-th/99", "n", "=v1</id><title> </title><published>2024-01</published>"
              "<author><name> </name></author></entry>")
    head = F.lit(
        '<feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom" '
        'xmlns:opensearch="http://a9.com/-/spec/opensearch/1.1/">'
    )
    page = F.col("start_index") / 2
    total = F.when(page % 9 == 0, F.lit("")).otherwise(
        F.concat(F.lit("<opensearch:totalResults>"), (page % 50).cast("bigint").cast("string"), F.lit("</opensearch:totalResults>"))
    )
    head = F.concat(head, total, F.lit("<opensearch:startIndex>"))
    xml = F.concat(head, F.col("start_index").cast("string"), F.lit("</opensearch:startIndex>"), bad, good, F.lit("</feed>"))
    return f.select(F.lit("page-1.xml").alias("page_file"), xml.alias("xml"), *also)


def feed_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entry_records(page_entries(parse_pages(feed_pages(spark, sf_dir), "xml")))


def scored_records(spark: SparkSession, sf_dir: str, columns: tuple[str, ...] = ("*",)) -> DataFrame:
    """Feed records with their reasons, landed as in a load; of all columns or those a table takes."""
    return land(feed_records(spark, sf_dir).withColumn(REASON, paper_reasons()).select(*columns), "scored-records")


# --- the oracle's side -------------------------------------------------------------------------

# The whitespace class and characters, in the oracle's spelling.
WS_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WS_CHARS = "||".join(
    f"chr({c})"
    for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
)


def sql_strip(x: str) -> str:
    return f"trim(coalesce({x}, ''), {WS_CHARS})"


def sql_collapse(x: str) -> str:
    return f"trim(regexp_replace(coalesce({x}, ''), '{WS_CLASS}+', ' ', 'g'))"


def sql_blank_to_null(x: str) -> str:
    return f"CASE WHEN lower({sql_strip(x)}) IN ('', 'nan', 'none') THEN NULL ELSE {sql_strip(x)} END"


def sql_number(x: str) -> str:
    t = f"trim({x}, {WS_CHARS})"
    return (
        f"CASE WHEN regexp_matches({t}, '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
        f"THEN TRY_CAST({t} AS DOUBLE) END"
    )


def sql_sentences(flat: str) -> str:
    marked = f"regexp_replace({flat}, '([.!?]) ', '\\1' || chr(30), 'g')"
    return f"list_filter(string_split({marked}, chr(30)), lambda s: s <> '')"


def sql_words(flat: str) -> str:
    return f"CASE WHEN {flat} = '' THEN 0 ELSE len(string_split({flat}, ' ')) END"


def sql_json_string(x: str) -> str:
    return f"'\"' || replace(replace({sql_strip(x)}, '\\', '\\\\'), '\"', '\\\"') || '\"'"


_REVIEW_FIELDS = [c for c in REVIEW_EXPRS if c != "row_number"]
SQL_REVIEW_HASH = "sha256('{' || " + " || ', ' || ".join(
    f"'\"{c}\": ' || " + (f"'\"' || CAST({c} AS STRING) || '\"'" if c == "row_number" else sql_json_string(c))
    for c in sorted(REVIEW_EXPRS)
) + " || '}')"


def _int(x: str) -> str:
    return f"TRY_CAST(trunc({x}) AS INT)"


_TYPED = f"""
SELECT *, concat_ws(';',
    CASE WHEN clothing_id IS NULL THEN 'missing_or_invalid_clothing_id' END,
    CASE WHEN rating IS NULL THEN 'missing_or_invalid_rating'
         WHEN rating < 1 OR rating > 5 THEN 'rating_out_of_range_1_to_5' END,
    CASE WHEN recommended_ind IS NULL THEN 'missing_or_invalid_recommended_ind'
         WHEN recommended_ind NOT IN (0, 1) THEN 'recommended_ind_not_binary' END,
    CASE WHEN positive_feedback_count IS NULL THEN 'missing_or_invalid_positive_feedback_count'
         WHEN positive_feedback_count < 0 THEN 'negative_positive_feedback_count' END,
    CASE WHEN lower(review_text) IN ('', 'nan', 'none') THEN 'missing_review_text' END,
    CASE WHEN age < 13 OR age > 100 THEN 'age_out_of_expected_range' END) AS reject_reason
FROM (
  SELECT coalesce(CAST(CAST({sql_number('unnamed_0')} AS BIGINT) AS STRING), {SQL_REVIEW_HASH}) AS review_key,
    {SQL_REVIEW_HASH} AS row_hash, row_number, CAST({sql_number('unnamed_0')} AS BIGINT) AS review_id,
    {_int(sql_number('clothing_id'))} AS clothing_id, {_int(sql_number('age'))} AS age,
    {sql_blank_to_null('title')} AS title, {sql_strip('review_text')} AS review_text,
    {_int(sql_number('rating'))} AS rating, {_int(sql_number('recommended_ind'))} AS recommended_ind,
    {_int(sql_number('positive_feedback_count'))} AS positive_feedback_count,
    {sql_blank_to_null('division_name')} AS division_name, {sql_blank_to_null('department_name')} AS department_name,
    {sql_blank_to_null('class_name')} AS class_name
  FROM {{reviews}})
"""


def sql_typed(source: str) -> str:
    return _TYPED.replace("{reviews}", source)


_FEED_GOOD = f"""
SELECT start_index, 1 AS entry_position, '24.' || n AS paper_key, '24.' || n || version AS versioned_id,
    {sql_collapse('entry_title')} AS title, {sql_collapse('entry_summary')} AS summary,
    CAST('2024-01-' || day || ' ' || hour || ':00:00' AS TIMESTAMP) AS published_at,
    CAST('2024-02-' || day || ' ' || hour || ':30:00' AS TIMESTAMP) - INTERVAL 2 HOUR AS updated_at,
    lang AS primary_category, lang || '|' || source AS categories,
    'Author A' AS author_1, trim(second_author) AS author_2, 'Author A' AS first_author,
    'Author A, ' || trim(second_author) AS authors_preview, 2 AS author_count,
    CASE WHEN has_html THEN 'https://example.org/abs/' || n ELSE 'https://arxiv.org/abs/24.' || n END AS arxiv_url,
    'https://example.org/pdf/' || n AS pdf_url, nullif(trim(journal), '') AS journal_ref,
    '' AS reject_reason
FROM feed_fields
"""
_FEED_BAD = """
SELECT start_index, 0, '99' || n, '99' || n || 'v1', '', '', NULL, NULL, '', '', '', NULL, '', '', 1,
    'https://arxiv.org/abs/99' || n, NULL, NULL,
    'missing_title;missing_summary;missing_or_invalid_published_at;missing_or_invalid_updated_at;'
    || 'missing_primary_category;authors_without_names'
FROM feed_fields
"""

MAX_WORDS, OVERLAP = 350, 50
_FLAT = f"""
SELECT {sql_collapse('paper_key')} AS paper_key, {sql_collapse('title')} AS title,
    {sql_collapse('summary')} AS summary, {sql_collapse('primary_category')} AS primary_category FROM papers
"""
_SENTENCES = f"""
SELECT paper_key, unnest(s) AS sentence, generate_subscripts(s, 1) AS i FROM (
  SELECT paper_key, {sql_sentences('source_text')} AS s FROM (
    SELECT paper_key, CASE WHEN title <> '' THEN 'Title: ' || title || '. Summary: ' || summary
                           ELSE 'Summary: ' || summary END AS source_text
    FROM flat WHERE paper_key <> '' AND summary <> '' AND primary_category <> ''))
"""


def sql_pieces(source: str, max_words: int, overlap: int) -> str:
    """Windows of each sentence: the k-th starts k steps in, the last reaches the end."""
    step = max(1, max_words - overlap)
    return f"""
SELECT paper_key, i, k, array_to_string(w[k * {step} + 1 : k * {step} + {max_words}], ' ') AS piece
FROM (SELECT paper_key, i, string_split(sentence, ' ') AS w FROM {source}) t,
     unnest(generate_series(0, CASE WHEN len(w) <= {max_words} THEN 0
            ELSE CAST(ceil((len(w) - {max_words}) / {float(step)}) AS BIGINT) END)) AS u(k)
"""


_PIECES = f"""
SELECT paper_key, row_number() OVER (PARTITION BY paper_key ORDER BY i, k) AS p, piece,
       len(string_split(piece, ' ')) AS n FROM ({sql_pieces('sentences', MAX_WORDS, OVERLAP)})
"""
_PACKED = f"""
SELECT paper_key, p, piece AS cur, n, CAST(NULL AS STRING) AS closed FROM pieces WHERE p = 1
UNION ALL
SELECT r.paper_key, q.p,
  CASE WHEN r.n + q.n > {MAX_WORDS}
       THEN array_to_string(list_slice(string_split(r.cur, ' '), greatest(r.n - {OVERLAP} + 1, 1), r.n), ' ')
       ELSE r.cur END || ' ' || q.piece,
  CASE WHEN r.n + q.n > {MAX_WORDS} THEN least({OVERLAP}, r.n) ELSE r.n END + q.n,
  CASE WHEN r.n + q.n > {MAX_WORDS} THEN r.cur END
FROM packed r JOIN pieces q ON q.paper_key = r.paper_key AND q.p = r.p + 1
"""
_CHUNKS = """
SELECT c.paper_key, f.primary_category, f.title,
  CAST(row_number() OVER (PARTITION BY c.paper_key ORDER BY c.p) AS INT) AS chunk_index, c.chunk_text
FROM (
  SELECT paper_key, p, closed AS chunk_text FROM packed WHERE closed IS NOT NULL
  UNION ALL
  SELECT paper_key, p + 1, cur FROM packed WHERE (paper_key, p) IN (SELECT (paper_key, max(p)) FROM pieces GROUP BY paper_key)
) c JOIN flat f USING (paper_key)
"""
_CHUNK_RECORDS = """
SELECT substr(sha256(paper_key || '|' || CAST(chunk_index AS STRING) || '|' || chunk_text), 1, 16) AS chunk_id, *
FROM chunks WHERE len(string_split(chunk_text, ' ')) >= 30
"""
_ALPACA = f"""
SELECT chunk_id || '_' || task_type AS id, task_type, paper_key, chunk_id, instruction, chunk_text AS input,
  CASE task_type WHEN 'summarize' THEN array_to_string(sents[1:4], ' ')
       WHEN 'classify' THEN primary_category
       ELSE array_to_string(list_transform(sents[1:5], lambda s: '- ' || s), chr(10)) END AS output,
  chunk_index, primary_category, title
FROM (SELECT *, {sql_sentences('chunk_text')} AS sents FROM chunk_records)
CROSS JOIN (VALUES
  ('summarize', 'Summarize the research text below in 3-4 concise sentences. Keep factual details grounded in the source.'),
  ('classify', 'Classify the research text below into one ArXiv-style primary category. Return only the category code.'),
  ('keypoints', 'Extract 5 key points from the research text below. Return one bullet per point.')) t(task_type, instruction)
"""
_SPLIT = """
SELECT id, CASE WHEN row_number() OVER (ORDER BY sha256('42|' || id)) <= floor((SELECT count(*) FROM alpaca) * 0.9)
           THEN 'train' ELSE 'val' END AS split FROM alpaca
"""

_CTES = {
    "papers": (_select(PAPER_EXPRS, "documents"), ()),
    "authors": (_select(AUTHOR_EXPRS, "lineitem"), ()),
    "category_lists": (_select(CATEGORY_EXPRS, "lineitem"), ()),
    "reviews": (_select(REVIEW_EXPRS, "events"), ()),
    "typed": (sql_typed("reviews"), ("reviews",)),
    "feed_fields": (_select(FEED_FIELDS, "documents"), ()),
    "feed": (f"{_FEED_GOOD} UNION ALL {_FEED_BAD}", ("feed_fields",)),
    "flat": (_FLAT, ("papers",)),
    "sentences": (_SENTENCES, ("flat",)),
    "pieces": (_PIECES, ("sentences",)),
    "packed": (_PACKED, ("pieces",)),
    "chunks": (_CHUNKS, ("packed",)),
    "chunk_records": (_CHUNK_RECORDS, ("chunks",)),
    "alpaca": (_ALPACA, ("chunk_records",)),
    "split": (_SPLIT, ("alpaca",)),
}


def with_ctes(names: tuple[str, ...], body: str) -> str:
    """``body`` behind the named fixtures and everything they build on."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for needed in _CTES[name][1]:
                visit(needed)
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    ctes = ", ".join(f"{n} AS ({_CTES[n][0]})" for n in ordered)
    return f"WITH RECURSIVE {ctes} {body}"

"""Text column functions. All of them are built-in expressions and stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Every character Python treats as whitespace, as a character class and as plain text.
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# A whitespace run that is more than one plain space: single spaces, by far the most, need no work.
_UNEVEN_RUN = (
    f"(?:{WHITESPACE_CLASS.replace('x20', 'x1f', 1)}{WHITESPACE_CLASS}*| {WHITESPACE_CLASS}+)"
)
# A character that is no whitespace; plain ASCII is tested first.
_WORD_CHAR = f"[!-~{WHITESPACE_CLASS.replace('[', '[^', 1)}]"
# Trimmed text that counts as missing, in lower case.
BLANK_WORDS = ("", "nan", "none")
# Fixed value: the key point given to a text without sentences.
NO_KEYPOINT = "- Key point unavailable due to empty chunk."


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace; NULL becomes ``""``."""
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITESPACE))


def collapse_whitespace(c: Column) -> Column:
    """Turn each run of whitespace into one space and trim the ends; NULL becomes ``""``."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), _UNEVEN_RUN, " "))


def is_blank(c: Column) -> Column:
    """True for NULL and for text of whitespace only; stops at the first other character."""
    return ~F.coalesce(c, F.lit("")).rlike(_WORD_CHAR)


def counts_as_missing(c: Column) -> Column:
    """True where the trimmed text is empty, ``nan`` or ``none`` in any letter case."""
    return F.lower(strip(c)).isin(*BLANK_WORDS)


def blank_to_null(c: Column) -> Column:
    """Trimmed text, or NULL where it counts as missing."""
    return F.when(~counts_as_missing(c), strip(c))


def word_count(c: Column) -> Column:
    """Number of whitespace-separated words; 0 for empty and NULL text."""
    return F.regexp_count(F.coalesce(c, F.lit("")), F.lit(_WORD_CHAR + "+"))


def has_words(c: Column, count: int) -> Column:
    """True for text of at least ``count`` words; reads no further than the last word it needs."""
    if count <= 0:
        return F.lit(True)
    return F.coalesce(c, F.lit("")).rlike(
        f"^{WHITESPACE_CLASS}*+(?:{_WORD_CHAR}++{WHITESPACE_CLASS}++){{{count - 1}}}{_WORD_CHAR}"
    )


def flat_word_count(flat: Column) -> Column:
    """Word count of text that is already collapsed: one more than its spaces."""
    spaces = F.length(flat) - F.length(F.replace(flat, F.lit(" "), F.lit("")))
    return F.when(flat == "", F.lit(0)).otherwise(spaces + 1)


def tail_words(c: Column, count: int) -> Column:
    """The last ``count`` words joined by one space; all of them when there are fewer."""
    if count <= 0:
        return F.lit("")
    return F.substring_index(collapse_whitespace(c), " ", -count)


def flat_sentences(flat: Column) -> Column:
    """Sentences of text that is already collapsed."""
    return F.filter(F.split(flat, r"(?<=[.!?]) "), lambda s: s != "")


def split_sentences(c: Column) -> Column:
    """Collapse whitespace, split after ``.``, ``!`` or ``?`` before a space, drop blanks."""
    return flat_sentences(collapse_whitespace(c))


def leading_sentences(sentences: Column, text: Column, count: int) -> Column:
    """The first ``count`` sentences joined by a space; the text itself when there are none."""
    return F.when(F.size(sentences) > 0, F.array_join(F.slice(sentences, 1, count), " ")).otherwise(text)


def extractive_summary(c: Column, max_sentences: int = 3) -> Column:
    return leading_sentences(split_sentences(c), c, max_sentences)


def bullet_points(sentences: Column, count: int) -> Column:
    """The first ``count`` sentences as ``- `` lines, or the fixed line when there are none."""
    points = F.transform(F.slice(sentences, 1, count), lambda s: F.concat(F.lit("- "), s))
    return F.when(F.size(sentences) > 0, F.array_join(points, "\n")).otherwise(F.lit(NO_KEYPOINT))


def keypoints(c: Column, max_points: int = 5) -> Column:
    return bullet_points(split_sentences(c), max_points)

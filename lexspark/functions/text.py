"""Cleaning rules for lines of wiki-style text, as column expressions.

Two chains share the rules in a different order.  The BM25 chain squeezes spaces and opens
hyphens before the title test and replaces foreign characters in body lines only.  The
TF-IDF chain (``ascii_first=True``) replaces foreign characters first, so titles are
cleaned as well.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the markup looks like.
HEADING = "={2}.*={2}"  # greedy: from the first == of a line to its last
TITLE = r"^\[{2}.*\]{2}"  # greedy: up to the last ]] of the line
FOREIGN = r"[^\p{Alnum}\[\]]"  # \p{Alnum} is ASCII only, and one table lookup per character
CLOSER = "]]"
BLANKS = "".join(map(chr, range(0x21)))  # everything up to and including the space
NOT_BLANK = r"[^\x00-\x20]"
LINE_BREAK = "\r\n|\r|\n"
TITLE_BREAK = "[ \t\n\r\f]+"


def strip_blanks(line: Column) -> Column:
    """Cut blanks and control characters from both ends (``trim`` would cut spaces only)."""
    return F.btrim(line, F.lit(BLANKS))


def drop_headings(line: Column) -> Column:
    return F.when(line.contains("=="), F.regexp_replace(line, HEADING, "")).otherwise(line)


def squeeze_spaces(line: Column) -> Column:
    return F.regexp_replace(line, " +", " ")


def open_hyphens(line: Column) -> Column:
    return F.translate(line, "-", " ")


def blank_foreign(line: Column) -> Column:
    """Every character that is no ASCII letter, digit or square bracket becomes a space."""
    return F.regexp_replace(line, FOREIGN, " ")


def drop_closers(line: Column) -> Column:
    return F.replace(line, F.lit(CLOSER), F.lit(""))


def is_title(line: Column) -> Column:
    return line.rlike(TITLE)


def title_key(line: Column) -> Column:
    return F.regexp_extract(line, TITLE, 0)


def normalise_line(line: Column, ascii_first: bool = False) -> Column:
    """A stripped line as the title test sees it; '' if nothing is left of it."""
    line = drop_headings(line)
    if ascii_first:
        return blank_foreign(line)
    return open_hyphens(squeeze_spaces(line))


def has_line(line: Column) -> Column:
    """Whether anything is left of a raw line when it is stripped and normalised.  Only a
    line with a heading has to be stripped to know."""
    return line.rlike(NOT_BLANK) & ~(line.contains("==") & (drop_headings(strip_blanks(line)) == ""))


def clean_body(line: Column, ascii_first: bool = False) -> Column:
    """The words of a normalised body line, in lower case, separated by spaces."""
    line = squeeze_spaces(line) if ascii_first else blank_foreign(line)
    return F.rtrim(F.lower(drop_closers(line)))


def raw_words(text: Column) -> Column:
    """A text of many lines cut into words, in one go; ``clean_word`` finishes each.

    Gives the same words as cleaning line by line: headings never reach over a line break,
    and a line break is foreign to words like any other such character.
    """
    return F.split(drop_headings(text), FOREIGN + "+")


def clean_word(word: Column) -> Column:
    """A raw word without closing brackets, in lower case."""
    return F.lower(drop_closers(word))


def has_letters(word: Column) -> Column:
    """Whether something is left of a raw word when it is cleaned.  (Testing the cleaned
    word would clean every word twice, as filters move below projections.)"""
    return (word != "") & ~(word.endswith(CLOSER) & (drop_closers(word) == ""))


def chunk_words(chunk: Column) -> Column:
    """A cleaned line cut at its spaces; runs of spaces leave empty strings."""
    return F.split(chunk, " ")


def title_words(title: Column) -> Column:
    """The words of a title line, brackets and upper case kept."""
    return F.split(title, TITLE_BREAK)

"""Porter stemming as Spark column expressions.

The algorithm is Porter's suffix stripper (Program 14(3), 1980) with the two later
rules ``bli -> ble`` and ``logi -> log``.  A word is stemmed by a chain of projections of
built-in functions, so the work stays inside Catalyst: no Python UDF, no per-row driver
code.  Stemming costs some microseconds per word, which is why the index code applies it
to the distinct vocabulary (``operators.terms.stem_vocabulary``); only article bodies, which keep
the order of words, have every occurrence stemmed.

Letters: a word is lower case; ``y`` is a consonant at the start of a word and after a
vowel.  The leading ``y`` is therefore written ``Y`` while the rules run, and the classes
below take care of the others.  Digits and brackets count as consonants.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A consonant run and a vowel run, readable from the left end of a word.
_C = "[^aeiou][^aeiouy]*"
_V = "[aeiouy][aeiou]*"

MEASURE_GT0 = f"^(?:{_C})?{_V}{_C}"
MEASURE_EQ1 = f"^(?:{_C})?{_V}{_C}(?:{_V})?$"
MEASURE_GT1 = f"^(?:{_C})?{_V}{_C}{_V}{_C}"
HAS_VOWEL = f"^(?:{_C})?[aeiouy]"
# measure 1 and consonant-vowel-consonant at the end, the last one not w, x or y
SHORT_CVC = f"^{_C}[aeiouy][^aeiouwxy]$"
# Two equal consonants at the end, those kept double (l, s, z) left out.  A run of y
# alternates between vowel and consonant, so its parity decides.
DOUBLE_TO_CUT = r"([^aeiouylsz])\1$|[aeiou]y(?:yy)+$|[^aeiouy](?:yy)+$"

# The suffix rules of the published algorithm.
DOUBLE_SUFFIXES = {
    "ational": "ate",
    "tional": "tion",
    "enci": "ence",
    "anci": "ance",
    "izer": "ize",
    "bli": "ble",
    "alli": "al",
    "entli": "ent",
    "eli": "e",
    "ousli": "ous",
    "ization": "ize",
    "ation": "ate",
    "ator": "ate",
    "alism": "al",
    "iveness": "ive",
    "fulness": "ful",
    "ousness": "ous",
    "aliti": "al",
    "iviti": "ive",
    "biliti": "ble",
    "logi": "log",
}
DERIVED_SUFFIXES = {
    "icate": "ic",
    "ative": "",
    "alize": "al",
    "iciti": "ic",
    "ical": "ic",
    "ful": "",
    "ness": "",
}
# ``ion`` is the one suffix here that also needs an s or t before it.
RESIDUAL_SUFFIXES = (
    "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()
)


def _drop(word: Column, n: int) -> Column:
    return F.substring(word, F.lit(1), F.length(word) - n)


def _longest_suffix(word: Column, suffixes: Iterable[str]) -> Column:
    """The longest of the given suffixes the word ends in, or ''.

    The leftmost match of an alternation tied to the end is the longest one.  A suffix that
    is the whole word still counts, and stops shorter ones from being tried.  The test of
    the last two letters keeps most words away from the regular expression.
    """
    ends = sorted({suffix[-2:] for suffix in suffixes})
    return F.when(
        F.substring(word, -2, 2).isin(ends), F.regexp_extract(word, f"({'|'.join(suffixes)})$", 1)
    ).otherwise(F.lit(""))


def _swap(word: Column, suffix: Column, rules: dict[str, str]) -> Column:
    """Replace the found suffix if the part before it has a measure above 0."""
    base = F.substring(word, F.lit(1), F.length(word) - F.length(suffix))
    targets = F.create_map(*(F.lit(part) for rule in rules.items() for part in rule))
    return F.when(
        (suffix != "") & base.rlike(MEASURE_GT0), F.concat(base, F.element_at(targets, suffix))
    ).otherwise(word)


def with_stem(df: DataFrame, word: str = "term", out: str = "stem") -> DataFrame:
    """``df`` with the stem of column ``word`` added as column ``out``.

    One projection per rule, so no expression repeats the whole chain before it.  Store the
    result before filtering or joining by the new column: a filter moves down through the
    projections, and written in terms of the word it would be a huge expression.
    """
    w, cut, suffix = (f"__{out}_{part}" for part in ("w", "cut", "suffix"))
    c_w, c_cut, c_suffix = F.col(w), F.col(cut), F.col(suffix)
    raw = F.col(word)

    # leading y
    df = df.withColumn(w, F.when(raw.startswith("y"), F.concat(F.lit("Y"), F.substring(raw, 2, 2**31 - 1))).otherwise(raw))
    # plurals
    df = df.withColumn(
        w,
        F.when(c_w.endswith("sses") | c_w.endswith("ies"), _drop(c_w, 2))
        .when(c_w.endswith("s") & ~c_w.endswith("ss"), _drop(c_w, 1))
        .otherwise(c_w),
    )
    # -eed loses its d; -ed and -ing are cut if a vowel stays, and the rest is repaired
    df = df.withColumn(
        cut,
        F.when(
            (c_w.endswith("ed") & ~c_w.endswith("eed")) | c_w.endswith("ing"),
            F.regexp_extract(c_w, f"^((?:{_C})?[aeiouy].*)(?:ed|ing)$", 1),
        ).otherwise(F.lit("")),
    )
    df = df.withColumn(
        w,
        F.when(c_w.endswith("eed"), F.when(_drop(c_w, 3).rlike(MEASURE_GT0), _drop(c_w, 1)).otherwise(c_w))
        .when(c_cut == "", c_w)
        .when(c_cut.endswith("at") | c_cut.endswith("bl") | c_cut.endswith("iz"), F.concat(c_cut, F.lit("e")))
        .when(c_cut.rlike(DOUBLE_TO_CUT), _drop(c_cut, 1))
        .when(c_cut.rlike(SHORT_CVC), F.concat(c_cut, F.lit("e")))
        .otherwise(c_cut),
    )
    # final y after a vowel
    df = df.withColumn(
        w,
        F.when(
            c_w.endswith("y") & _drop(c_w, 1).rlike(HAS_VOWEL), F.concat(_drop(c_w, 1), F.lit("i"))
        ).otherwise(c_w),
    )
    # double suffixes, then derived ones
    for rules in (DOUBLE_SUFFIXES, DERIVED_SUFFIXES):
        df = df.withColumn(suffix, _longest_suffix(c_w, rules))
        df = df.withColumn(w, _swap(c_w, c_suffix, rules))
    # residual suffixes
    df = df.withColumn(suffix, _longest_suffix(c_w, RESIDUAL_SUFFIXES))
    base = F.substring(c_w, F.lit(1), F.length(c_w) - F.length(c_suffix))
    allowed = (c_suffix != "ion") | base.endswith("s") | base.endswith("t")
    df = df.withColumn(w, F.when((c_suffix != "") & allowed & base.rlike(MEASURE_GT1), base).otherwise(c_w))
    # final e, final ll (cutting the e never changes the measure)
    head = _drop(c_w, 1)
    df = df.withColumn(
        w,
        F.when(
            c_w.endswith("e")
            & (head.rlike(MEASURE_GT1) | (head.rlike(MEASURE_EQ1) & ~head.rlike(SHORT_CVC))),
            head,
        ).otherwise(c_w),
    )
    df = df.withColumn(w, F.when(c_w.endswith("ll") & c_w.rlike(MEASURE_GT1), _drop(c_w, 1)).otherwise(c_w))
    df = df.withColumn(
        out,
        F.when(F.length(raw) < 3, raw)
        .when(c_w.startswith("Y"), F.concat(F.lit("y"), F.substring(c_w, 2, 2**31 - 1)))
        .otherwise(c_w),
    )
    return df.drop(w, cut, suffix)

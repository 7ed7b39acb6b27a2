"""BM25 and TF-IDF weights as column arithmetic, in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# With these the length coefficient is 0.375 + 1.125 * dl / average.
K1 = 1.5
B = 0.75

_SUM_SCALE = 2.0**42  # room for the scores of some 50,000 terms, steps of 2e-13


def bm25_idf(n_docs: Column, df: Column) -> Column:
    """Signed: negative for a term that is in more than half of the documents."""
    return F.log10((n_docs - df + 0.5) / (df + 0.5))


def length_coefficient(dl: Column, avg_len: Column, k1: float = K1, b: float = B) -> Column:
    return F.lit(k1 * (1 - b)) + F.lit(k1 * b) * dl / avg_len


def bm25_term_score(tf: Column, idf: Column, k: Column, k1: float = K1) -> Column:
    return F.lit(k1 + 1) * tf * idf / (tf + k)


def log_tf(tf: Column) -> Column:
    return 1 + F.log10(tf)


def smoothed_idf(n_docs: Column, df: Column, exact: bool = False) -> Column:
    """``exact`` divides as real numbers; the default cuts N / df to a whole number."""
    ratio = n_docs / df
    return F.log10(1 + (ratio if exact else F.floor(ratio)))


def exact_sum(score: Column) -> Column:
    """The sum of scores, the same in whatever order tasks add them: each is rounded once to a fixed
    step, and whole numbers of steps are added."""
    return F.sum(F.rint(score * F.lit(_SUM_SCALE)).cast("long")) / F.lit(_SUM_SCALE)

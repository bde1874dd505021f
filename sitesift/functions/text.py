"""Text expressions: analyzer, query terms, ids, summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# The classic English stop list of the standard analyzer
# (optional; off unless asked for).
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it",
    "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there", "these",
    "they", "this", "to", "was", "will", "with",
)


def analyze_text(s, stop_words: Sequence[str] = ()) -> Column:
    """G1: lower-case tokens: maximal runs of letters and digits."""
    toks = F.regexp_extract_all(F.lower(F.coalesce(_c(s), F.lit(""))), F.lit(P.TOKEN), 0)
    if stop_words:
        stop = F.array(*[F.lit(w) for w in stop_words])
        toks = F.filter(toks, lambda t: ~F.array_contains(stop, t))
    return toks


def escape_term(s) -> Column:
    """Backslash before each query-syntax character, then lower case."""
    cls = "".join("\\" + ch for ch in P.QUERY_SYNTAX_CHARS)
    return F.lower(F.regexp_replace(_c(s), "([" + cls + "])", r"\\$1"))


def short_id(guid) -> Column:
    """E5: GUID text → 32 hex characters, no braces or dashes, upper case."""
    return F.upper(F.regexp_replace(_c(guid), "[{}-]", ""))


def intro_words(s, n: int, suffix: str = " ...") -> Column:
    """First n words (split on white space) plus suffix when longer."""
    words = F.filter(F.split(F.coalesce(_c(s), F.lit("")), P.WS_RUN), lambda w: w != "")
    return F.when(F.size(words) > n, F.concat(F.array_join(F.slice(words, 1, n), " "), F.lit(suffix))) \
        .otherwise(F.array_join(words, " "))

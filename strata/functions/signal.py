"""Comment signal: ``exclude`` / ``strong`` / ``neutral`` as one JVM expression.

Negative wins: a comment matching the negative lexicon is ``exclude`` even
when it also matches the positive one. NULL and empty comments match
nothing and are ``neutral``. Matching is a regex *find* (``rlike``), not a
full match.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.functions.lexicon import LEXICONS, alternation

SIGNALS = ("exclude", "strong", "neutral")


def _flags(lexicon: str, unicode_case: bool | None) -> str:
    if unicode_case is None:
        # parity defaults: the Spark job ran Java (?i) (ASCII folding), the
        # local script ran Python re, whose case folding and whose \s, \b
        # and \w are all Unicode
        unicode_case = lexicon == "short"
    return "(?iU)" if unicode_case else "(?i)"


# A word boundary as Python sees it: Java's Unicode \b counts combining marks
# as part of a word.
_WORD = r"[\p{L}\p{N}_]"
BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


def signal_patterns(lexicon: str = "full", unicode_case: bool | None = None) -> tuple[str, str]:
    """(negative, positive) Java regexes for ``lexicon`` ("full" | "short")."""
    if lexicon not in LEXICONS:
        raise ValueError(f"unknown lexicon {lexicon!r}; choose from {sorted(LEXICONS)}")
    neg, pos = LEXICONS[lexicon]
    flags = _flags(lexicon, unicode_case)
    texts = [alternation(neg), alternation(pos)]
    if "U" in flags:
        texts = [t.replace(r"\b", BOUNDARY) for t in texts]
    return flags + texts[0], flags + texts[1]


def comment_signal(comment: Column, lexicon: str = "full",
                   unicode_case: bool | None = None) -> Column:
    neg, pos = signal_patterns(lexicon, unicode_case)
    return (F.when(comment.rlike(neg), F.lit("exclude"))
             .when(comment.rlike(pos), F.lit("strong"))
             .otherwise(F.lit("neutral")))

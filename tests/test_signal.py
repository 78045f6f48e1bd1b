"""Golden comment phrases (FIXTURES.md §4) through the JVM regex."""

import pytest
from pyspark.sql import functions as F

from strata.functions.signal import comment_signal, signal_patterns

# (comment, full, full + unicode case, short)
GOLDEN = [
    (None, "neutral", "neutral", "neutral"),
    ("", "neutral", "neutral", "neutral"),
    ("update", "neutral", "neutral", "neutral"),
    ("building demolished", "strong", "strong", "strong"),
    ("Demolition of old school", "strong", "strong", "neutral"),
    ("reverted vandalism, building demolished", "exclude", "exclude", "exclude"),
    ("fix import error", "neutral", "neutral", "exclude"),
    ("imported shops", "neutral", "neutral", "exclude"),
    ("mass import of buildings", "exclude", "exclude", "exclude"),
    ("bot edit", "exclude", "exclude", "exclude"),
    ("bot", "neutral", "neutral", "exclude"),
    ("robot", "neutral", "neutral", "neutral"),
    ("contest", "neutral", "neutral", "neutral"),
    ("TESTING", "neutral", "neutral", "neutral"),
    ("tigers", "neutral", "neutral", "neutral"),
    ("test", "exclude", "exclude", "exclude"),
    ("TIGER cleanup", "exclude", "exclude", "exclude"),
    ("por error", "exclude", "exclude", "exclude"),
    ("deduplicated", "exclude", "exclude", "exclude"),
    ("wrong", "exclude", "exclude", "exclude"),
    ("incorrectly tagged", "exclude", "exclude", "neutral"),
    ("doppelt", "exclude", "exclude", "neutral"),
    ("annulé", "exclude", "exclude", "neutral"),
    ("deshacer", "neutral", "neutral", "exclude"),
    ("no existe", "neutral", "neutral", "strong"),
    ("ya no existe", "strong", "strong", "strong"),
    ("edificio derribado", "strong", "strong", "strong"),
    ("demolição", "strong", "strong", "strong"),
    ("removed", "strong", "strong", "strong"),
    ("unremoved", "neutral", "neutral", "strong"),
    ("gone", "strong", "strong", "neutral"),
    ("begone", "neutral", "neutral", "neutral"),
    ("rivet", "strong", "strong", "neutral"),
    ("privet", "neutral", "neutral", "neutral"),
    ("удалён дом", "strong", "strong", "neutral"),
    ("снесли", "strong", "strong", "neutral"),
    ("拆除", "strong", "strong", "neutral"),
    ("被拆", "strong", "strong", "neutral"),
    ("철거", "strong", "strong", "neutral"),
    ("取り壊し", "strong", "strong", "neutral"),
    ("ध्वस्त", "strong", "strong", "neutral"),
    ("הוסר", "strong", "strong", "neutral"),
    ("Удалён дом", "neutral", "strong", "neutral"),
    ("УДАЛЁН ДОМ", "neutral", "strong", "neutral"),
    ("DÉMOLI", "neutral", "strong", "neutral"),
    ("ZERSTÖRT", "neutral", "strong", "neutral"),
    ("откат", "exclude", "exclude", "neutral"),
    ("Откат", "neutral", "exclude", "neutral"),
    ("破坏", "exclude", "exclude", "neutral"),
    ("破壊", "exclude", "exclude", "neutral"),
    ("n'existe plus", "strong", "strong", "neutral"),
    ("n’existe plus", "strong", "strong", "neutral"),
    ("abgerissen", "strong", "strong", "neutral"),
    ("gesloopt", "strong", "strong", "neutral"),
    ("yıkıldı", "strong", "strong", "neutral"),
    ("rase campagne", "strong", "strong", "neutral"),
    ("destructive edit", "strong", "strong", "strong"),
    ("grass cutting", "neutral", "neutral", "neutral"),
    ("address data", "neutral", "neutral", "neutral"),
    ("terrasse", "neutral", "neutral", "neutral"),
    ("Paris", "neutral", "neutral", "neutral"),
]


@pytest.fixture(scope="module")
def classified(spark):
    df = spark.createDataFrame([(i, c) for i, (c, *_) in enumerate(GOLDEN)], "i int, c string")
    out = df.select(
        "i",
        comment_signal(F.col("c"), "full").alias("full"),
        comment_signal(F.col("c"), "full", unicode_case=True).alias("full_iu"),
        comment_signal(F.col("c"), "short").alias("short"),
    ).orderBy("i").collect()
    return {r["i"]: (r["full"], r["full_iu"], r["short"]) for r in out}


@pytest.mark.parametrize("idx", range(len(GOLDEN)))
def test_golden_phrase(classified, idx):
    comment, full, full_iu, short = GOLDEN[idx]
    assert classified[idx] == (full, full_iu, short), comment


def test_flags():
    neg, pos = signal_patterns("full")
    assert neg.startswith("(?i)(") and pos.startswith("(?i)(")
    assert signal_patterns("short")[0].startswith("(?iU)(")
    with pytest.raises(ValueError):
        signal_patterns("medium")


# Phrases whose match hangs on Unicode white space or word boundaries.
UNICODE = ["torn\u00a0down", "no\u00a0longer exists", "ya\u2003no existe", "burned\u202fdown", "étest", "test\u00a0edit", "\u00e9bot", "bot\u2028", "N\u00c3O EXISTE MAIS",
           "destru\u00cdda", "DEMOLI\u00c7\u00c3O", "wrongé", "(wrong)", "tiger\u0301", "não\u00a0existe\u00a0mais", "ımport", "İMPORT", "updateſ"]


def test_short_lexicon_agrees_with_python_re(spark):
    import re

    from strata.functions.lexicon import LEXICONS, alternation
    neg, pos = (re.compile(alternation(x), re.IGNORECASE) for x in LEXICONS["short"])
    phrases = UNICODE + [g[0] for g in GOLDEN if g[0]]
    want = ["exclude" if neg.search(p) else "strong" if pos.search(p) else "neutral" for p in phrases]
    df = spark.createDataFrame(list(enumerate(phrases)), "i int, c string")
    got = [r.s for r in df.select("i", comment_signal(F.col("c"), "short").alias("s")).orderBy("i").collect()]
    assert dict(zip(phrases, got)) == dict(zip(phrases, want))

"""Quality features against plain Python, and the cascade against its rules."""

import re
from collections import Counter

from strata.llm import quality
from strata.llm.common import prepare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = Counter(zip(w, w[1:], w[2:]))
    repeat = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, chars, symbols, dups = len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(repeat) > 50 * n
    bad = 10 * symbols > n or chars < 2 * n or chars > 15 * n or 10 * sum(c.isupper() for c in text) > 3 * chars or 10 * len(re.findall("[!?]", text)) > n or 20 * dups > n
    return n, chars, symbols, dups, len(repeat), failed, not (failed or bad)


def check(df, rows):
    prepare(df.sparkSession)
    got = Counter((r.doc_id, *(r[c] for c in (*quality.FEATURES, "base_failed", "kept"))) for r in quality.judge(df).collect())
    assert got == Counter((d, *brute(t)) for d, t in rows)
    return got


def test_awkward_documents(table, awkward):
    extra = [(200, "A B C " * 30), (201, "### " + "word " * 60), (202, "\n".join(["same line here"] * 40)), (203, "WHY " * 3 + "NOT!! " * 80), (204, "a\x0bb\x0cc\r\nd e f é🎉 " * 20),
             (205, " ".join(f"w{i}" for i in range(80))), (206, "%s " % ("supercalifragilistic" * 2) * 70)]
    check(table(awkward + extra), awkward + extra)


def test_small_table(table, documents):
    got = check(table(documents), documents)
    assert {k[-1] for k in got} == {True, False}


def test_empty_table(table):
    df = table([])
    out = quality.judge(df)
    assert out.collect() == [] and set(out.columns) == set(df.columns) | {*quality.FEATURES, "base_failed", "kept"}


def test_rules_are_ordered_by_rejections_per_cost(table):
    from pyspark.sql import functions as F
    df = table([(i, f"w{i} " * 60) for i in range(50)])
    order = quality.order_rules(df, {"never": F.col("n_words") < 0, "always": F.col("n_words") > 0})
    assert order == ["always", "never"]


def test_clean_labelled_documents_are_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    verdicts = Counter(map(tuple, quality.judge(docs).join(labels, "doc_id").where("n_words >= 50").select("quality", "kept").collect()))
    assert set(verdicts) == {(1, True), (0, False)}

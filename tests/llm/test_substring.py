"""Substring dedup against a dictionary of all windows."""

import hashlib
from collections import Counter

import pytest

from strata.llm import substring
from strata.llm.common import prepare
from strata.llm.queries import op2_substring_dedup


def brute(rows, window):
    first = {}
    split = [(d, (t or "").encode().split()) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - window + 1 if d is not None else 0):
            key = tuple(w[i:i + window])
            first[key] = min(first.get(key, d), d)
    out = Counter()
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1 if d is not None else 0):
            if first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def run(df, window):
    prepare(df.sparkSession)
    return Counter((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in substring.remove_repeats(df, window).collect())


@pytest.mark.parametrize("window", [50, 7, 1])
def test_awkward_documents(table, awkward, window):
    assert run(table(awkward), window) == brute(awkward, window)


@pytest.mark.parametrize("window", [50, 12])
def test_small_table(table, documents, window):
    got = run(table(documents), window)
    assert got == brute(documents, window) and any(k[2] for k in got)


def test_empty_table_and_columns(table):
    df = table([])
    out = substring.remove_repeats(df)
    assert out.collect() == [] and set(out.columns) == set(df.columns) | {"n_words", "n_removed"}


def test_query(spark, documents):
    got = Counter(map(tuple, op2_substring_dedup(spark, "/root/testdata/sf0.001").collect()))
    assert got == brute(documents, 50)

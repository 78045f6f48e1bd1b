"""The chosen-path join against all pairs."""

import numpy as np
import pytest

from strata.llm import jaccard
from strata.llm.common import prepare


def grams(text, n):
    w = (text or "").encode().split()
    k = min(n, len(w))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if k else set()


def brute(rows, n, threshold):
    rows = [(d, grams(t, n)) for d, t in rows if d is not None]
    root = {d: d for d, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for i, (a, x) in enumerate(rows):
        for j in range(i):
            b, y = rows[j]
            if x and y and len(x & y) >= threshold * len(x | y) - 1e-12:
                links[i] += 1
                links[j] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    return sorted((d, find(d), k) for (d, _), k in zip(rows, links))


def run(df, **more):
    prepare(df.sparkSession)
    return sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard.near_duplicates(df, **more).collect() if r.doc_id is not None)


def test_awkward_documents(table, awkward):
    seen = set()
    rows = [r for r in awkward if r[0] not in (60,) or (r[0] not in seen and not seen.add(r[0]))]
    assert run(table(rows)) == brute(rows, 5, 0.8)


def test_rows_that_repeat_a_doc_id_with_other_texts(table, awkward):
    got = {r[0]: r[1] for r in run(table(awkward))}
    assert got[60] == 6


def test_rows_that_repeat_the_smallest_doc_id_of_a_class(table):
    words = [f"w{i}" for i in range(100)]
    base, near = " ".join(words), " ".join([*words[:-1], "other"])
    rows = [(6, base), (6, base), (10, near)]
    assert run(table(rows)) == brute(rows, 5, 0.8) == [(6, 6, 2), (6, 6, 2), (10, 6, 2)]


def test_small_table(table, documents):
    got = run(table(documents))
    assert got == brute(documents, 5, 0.8) and len({r[1] for r in got}) < len(got)


def test_large_groups_meet_in_blocks(table, monkeypatch):
    import random
    rng = random.Random(2)
    base = [f"w{rng.randint(0, 400)}" for _ in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(120)] = f"e{rng.randint(0, 9)}"
        rows.append((i, " ".join(words)))
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    monkeypatch.setattr(jaccard, "GRAMS", 1000)
    got = run(table(rows), recall=0.9999)
    want = brute(rows, 5, 0.8)
    assert got == want and max(r[2] for r in want) > 30


def test_null_doc_ids_and_empty_table(table):
    out = jaccard.near_duplicates(table([(None, "a b c d e f"), (1, "a b c d e f")])).collect()
    assert sorted((r.doc_id or 0, r.class_id or 0, r.n_links) for r in out) == [(0, 0, 0), (1, 1, 0)]
    assert jaccard.near_duplicates(table([])).collect() == []


@pytest.mark.parametrize("depth", [1, 3])
def test_survival_is_that_of_the_splits(depth):
    assert 0 < jaccard.survival(0.8, depth) <= 1 - 0.2 * (1 - jaccard.EXTRA)
    assert jaccard.runs_for(0.999, 0.8) >= jaccard.runs_for(0.9, 0.8)


def test_recall_of_borderline_pairs_at_full_depth():
    """Pairs of signatures at similarity 0.8, all runs drawing from the same
    slots: a node that both reach goes on by its equal slots only."""
    pairs, runs = 50_000, jaccard.runs_for(0.999, 0.8)
    equal = np.random.default_rng(9).random((pairs, jaccard.SLOTS)) < 0.8
    found = np.zeros(pairs, bool)
    for r in range(runs):
        pair, node = np.arange(pairs), jaccard.mix(np.arange(pairs, dtype=np.uint64) * np.uint64(64) + np.uint64(r + 1))
        for _ in range(jaccard.DEPTH):
            first, other, both = jaccard._draw(node)
            keep, two = equal[pair, first], both & equal[pair, other]
            child = [jaccard.mix(node[k] * np.uint64(31) + s[k].astype(np.uint64)) for k, s in ((keep, first), (two, other))]
            pair, node = np.concatenate((pair[keep], pair[two])), np.concatenate(child)
        found[pair] = True
    found &= equal.sum(axis=1) >= jaccard.slots_for(0.999, 0.8)
    assert found.mean() >= 0.9988  # 0.999, less 1.4 standard deviations of its estimate

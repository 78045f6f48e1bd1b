"""Line dedup against the edit distance of all pairs of lines."""

import random
from collections import Counter

import pytest

from strata.llm import lines
from strata.llm.common import prepare


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def brute(rows, least=1, fuzzy=5):
    found = [(d, i, x.encode().split()) for d, t in {r for r in rows if r[0] is not None} for i, x in enumerate((t.split("\n") if t is not None else []))]
    found = [f for f in found if len(f[2]) >= least]
    by_line = {}
    for d, i, w in found:
        by_line.setdefault(tuple(w), []).append((d, i))
    first = {w: min(at) for w, at in by_line.items()}
    cut = dict(first)
    long = [w for w in first if len(w) >= fuzzy]
    for x in long:
        for y in long:
            if abs(len(x) - len(y)) <= 1 and first[y] < cut[x] and distance(x, y) <= 1:
                cut[x] = first[y]
    out = Counter()
    for d, t in rows:
        if t is None:
            out[d, None, 0, 0] += 1
            continue
        raw = t.split("\n")
        gone = [d is not None and len(w := x.encode().split()) >= least and cut[tuple(w)] < (d, i) for i, x in enumerate(raw)]
        out[d, "\n".join(x for x, g in zip(raw, gone) if not g), len(raw), sum(gone)] += 1
    return out


def run(df, **more):
    prepare(df.sparkSession)
    return Counter((r.doc_id, r.kept_text, r.n_lines, r.n_removed) for r in lines.remove_lines(df, **more).collect())


def edited(n, seed):
    """Documents of lines that are edits of a few lines."""
    rng = random.Random(seed)
    bases = [[rng.choice("abcdefghij") for _ in range(rng.randint(3, 16))] for _ in range(5)]
    rows = []
    for doc in range(n):
        text = []
        for _ in range(rng.randint(0, 6)):
            line = list(rng.choice(bases))
            for _ in range(rng.randint(0, 2)):
                at = rng.randrange(len(line))
                rng.choice([lambda: line.pop(at), lambda: line.insert(at, rng.choice("abc")), lambda: line.__setitem__(at, rng.choice("abc"))])() if len(line) > 1 else None
            text.append(rng.choice(["", " ", "\t"]).join(["", "  ".join(line), ""]))
        rows.append((doc, "\n".join(text)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_edited_lines(table, seed):
    rows = edited(60, seed)
    got = run(table(rows), least=4, fuzzy=6)
    assert got == brute(rows, 4, 6) and sum(k[3] for k in got) > 60


def test_awkward_documents(table, awkward):
    rows = [r for r in awkward if r[0] != 51]  # 50 and 51: one line of thousands of equal words each, too slow for the table of distances
    assert run(table(rows)) == brute(rows)


def test_long_lines_one_word_apart(table):
    long = [f"w{i * i % 97}" for i in range(3000)]
    rows = [(1, " ".join(long)), (2, " ".join([*long[:1500], "x", *long[1500:]])), (3, " ".join([*long[:700], "y", *long[701:]])), (4, " ".join([*long[:700], "y", *long[701:2000], "z"]))]
    assert {k[0]: k[3] for k in run(table(rows))} == {1: 0, 2: 1, 3: 1, 4: 0}


def test_small_table(table, documents):
    rows = [(d, t) for d, t in documents if len(t) < 6000]
    got = run(table(rows))
    assert got == brute(rows) and any(k[3] for k in got)


def test_short_lines_and_edits_in_them(table):
    rows = [(1, "Yes\nAll rights reserved.\na b c d\na b c d e"), (2, "All rights reserved.\nYes\n\na b c x\na b x d e\na c d e"), (3, "yes\nNo\n \nNo\nNo No\na b c d e f")]
    got = run(table(rows))
    assert got == brute(rows) and {k[0]: k[1] for k in got} == {
        1: "Yes\nAll rights reserved.\na b c d\na b c d e", 2: "\na b c x\na c d e", 3: "yes\nNo\n \nNo No"}


def test_empty_table(table):
    df = table([])
    out = lines.remove_lines(df)
    assert out.collect() == [] and set(out.columns) == set(df.columns) | {"n_lines", "n_removed"}


def test_long_lines_with_one_edit(spark, table):
    """Lines of several blocks of the scan, an edit at their ends and between blocks."""
    words = [f"w{i}" for i in range(200)]
    for n, at in ((63, 0), (64, 63), (65, 64), (128, 127), (129, 64), (200, 199)):
        line = words[:n]
        rows = [(1, " ".join(line)), (2, " ".join(line[:at] + ["edit"] + line[at + 1:])), (3, " ".join(line[:at] + line[at + 1:])), (4, " ".join(line[:at] + ["new"] + line[at:])),
                (5, " ".join(line[:at] + ["new", "more"] + line[at:]))]
        got = {r.doc_id: r.n_removed for r in lines.remove_lines(table(rows)).collect()}
        assert got == {1: 0, 2: 1, 3: 1, 4: 1, 5: 1}, n   # 5 is one edit from 4


def test_a_line_of_a_hundred_thousand_words(spark, table):
    line = [f"w{i % 977}" for i in range(100_000)]
    other = [*line[:50_000], "edit", *line[50_001:]]
    got = {r.doc_id: r.n_removed for r in lines.remove_lines(table([(1, " ".join(line)), (2, " ".join(other)), (3, " ".join(line[::-1]))])).collect()}
    assert got == {1: 0, 2: 1, 3: 0}


def test_scratch_holds_the_verdicts_only(spark, table, scratch, monkeypatch):
    import os
    monkeypatch.setattr("strata.scratch.checkpoint_dir", lambda spark: scratch)
    lines.remove_lines(table([(1, "a b c d e f"), (2, "a b c d e f")])).collect()
    assert [os.listdir(f"{scratch}/{d}") for d in os.listdir(scratch)] == [["gone"]]


def test_halves_are_gone_before_texts_are_shuffled(spark):
    """The scratch tables left when lines are fetched from their texts hold no keys of halves."""
    from strata.llm.common import Scratch
    seen = {}

    class Watched(Scratch):
        def save(self, df, name, seen_=()):
            if name == "chosen":
                left = spark._jvm.java.io.File(self.dir).list()
                seen.update({t: spark.read.parquet(self.path(t)).columns for t in left})
            return super().save(df, name, seen_)

    rows = [(i, "\n".join(f"one two three w{(i + j) % 7} five six" for j in range(4))) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    gone = lines.earlier_lines(df, Watched(spark, "watched"))
    assert gone.count() == 79 and set(seen) == {"keys", "places", "unique"}
    assert not [c for columns in seen.values() for c in columns if c.startswith("h")]

"""The filter audit against filters applied one by one, in every order."""

import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from strata.llm import interactions
from strata.llm.common import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fails(text, copy):
    words = text.encode().split()
    return {x for x, f in zip("ABCDE", (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
                                        bool(re.search(r"[#$%&*|]", text)), copy)) if f}


def brute(rows, labels):
    """Rows of (doc_id, text, source), labels {doc_id: (quality, toxic)}."""
    least = {}
    for d, t, _ in rows:
        if d is not None:
            least[t or ""] = min(least.get(t or "", d), d)
    parts = defaultdict(list)
    for d, t, s in rows:
        parts[s or ""].append((fails(t or "", d is not None and d > least[t or ""]), *labels.get(d, (0, 0))))
    out, total = {}, Counter()
    for part, docs in parts.items():
        for order in permutations("ABCDE"):
            left, gone = docs, []
            for step, x in enumerate(order, 1):
                hit = [r for r in left if x in r[0]]
                left = [r for r in left if x not in r[0]]
                out[part, "".join(order), step] = [len(left), len(hit), sum(x in r[0] for r in gone), sum(r[0] == {x} for r in docs),
                                                   sum(r[1] == 1 for r in hit), sum(r[2] == 1 for r in hit)]
                gone += hit
                total[part, x] += len(hit)
    return Counter((*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def check(spark, rows, labels, repeated=()):
    prepare(spark)
    docs = spark.createDataFrame([(d, t, "en", s, 0) for d, t, s in rows], SCHEMA)
    for name in ("part", "mask", "copy", "n", "good", "toxic", "rows"):
        docs = docs.withColumn(name, F.lit("extra"))
    marks = spark.createDataFrame([(d, q, t) for d, (q, t) in labels.items()] + list(repeated), "doc_id long, quality int, toxic int").withColumn("n", F.lit(1))
    got = interactions.audit(docs.repartition(3), marks).collect()
    assert Counter(tuple(r[c] for c in ("part", "filter_order", "step", *interactions.COUNTS)) for r in got) == brute(rows, labels)


def test_awkward_documents(spark, awkward):
    rows = [(d, t, (None, "", "a", "b")[i % 4]) for i, (d, t) in enumerate(awkward)]
    rows += [(100 + i, "A # " + awkward[5][1], "a") for i in range(30)] + [(90, "#" * 20_000 + " X", "c"), (91, "x " * 20_000, "c"), (91, "x " * 20_000, "c")]
    check(spark, rows, {6: (1, 0), 7: (0, 1), 12: (1, 1), 101: (1, 0), 500: (1, 1)}, [(None, 1, 1), (7, None, None)])


def test_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source").collect()
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select("doc_id", "quality", "toxic").collect()
    check(spark, [tuple(r) for r in docs], {r[0]: (r[1], r[2]) for r in labels})


def test_empty_table(spark):
    check(spark, [], {})


def test_removal_steps_of_any_number_of_filters():
    for n in (1, 2, 3):
        position, step = interactions.removal_steps(n)
        for order, at in zip(permutations(range(n)), range(len(position))):
            for mask in range(1 << n):
                assert step[mask, at] == next((i for i, f in enumerate(order) if mask >> f & 1), n)
    counts = np.ones((3, 1, 8), np.int64)
    out = interactions.audit_counts(counts, 3)
    assert (out["kept"][0, :, -1] == 1).all() and (out["removed"][0].sum(axis=1) == 7).all()

"""The pipeline's stages against the brute-force versions of their operators."""

from collections import Counter

import corpus_pipeline
from strata.llm.common import prepare

from . import test_jaccard, test_lines, test_packing, test_quality, test_substring

SF = "/root/testdata/sf0.001"


def removed(rows, window):
    first = {}
    split = [(d, t, t.encode().split()) for d, t in rows]
    for d, _, w in split:
        for i in range(len(w) - window + 1):
            first[tuple(w[i:i + window])] = min(first.get(tuple(w[i:i + window]), d), d)
    for d, t, w in split:
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < d for j in range(i, i + window)}
        yield d, " ".join(x.decode() for i, x in enumerate(w) if i not in gone) if gone else t


def expected(rows):
    rows = [(d, t) for d, t in rows if test_quality.brute(t)[-1]]
    yield rows
    rows = [(k[0], k[1]) for k in test_lines.brute(rows) if k[1].split()]
    yield rows
    rows = [r for r, k in zip(sorted(rows), test_jaccard.brute(sorted(rows), 5, 0.8)) if k[0] == k[1]]
    yield rows
    yield [(d, t) for d, t in removed(rows, 50) if t.split()]


def test_every_stage(spark, documents, scratch):
    prepare(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    rows = documents
    for i, ((name, stage), want) in enumerate(zip(corpus_pipeline.STAGES, expected(rows))):
        stage(spark, docs, SF).write.parquet(f"{scratch}/{i}")
        docs = spark.read.parquet(f"{scratch}/{i}")
        got = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        assert docs.columns == columns and Counter(got) == Counter(want), name
        assert docs.where("n_chars <> length(text)").isEmpty()
        rows = got
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in last) == test_packing.expected(rows, 1024)
    ours = corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect()
    assert Counter(map(tuple, ours)) == Counter(tuple(r)[:5] for r in last)


def test_stages_on_an_empty_table(spark, table):
    docs = table([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []


def test_texts_that_share_a_doc_id_and_null_doc_ids(spark, table, awkward):
    docs = table(awkward).select("doc_id", "text", "lang", "source", "n_chars")
    got = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, SF).collect())
    units = sorted({r for r in awkward if r[0] is not None}, key=lambda r: (r[0], r[1] or ""))
    classes = test_jaccard.brute([(i, t) for i, (_, t) in enumerate(units)], 5, 0.8)
    want = Counter([units[i] for i, root, _ in classes if i == root] + [r for r in awkward if r[0] is None])
    assert got == want and got[awkward[-1]] == 1 and (60, awkward[-3][1]) not in got

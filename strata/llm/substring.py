"""Substring deduplication over token k-mers (operator 2).

*De Bruijn compaction*: the edges of the graph are the windows of ``window``
consecutive words. Edges are dealt by their minimizer (the smallest hash of
the shorter word sequences inside them), and a maximal run of edges of one
text with one minimizer is a path, known by a 128-bit hash of its words. Where
all occurrences of a minimizer are the same path, the path does not branch:
it stands for all its edges, and one row for each occurrence settles them. Only
paths that branch (beside an edit, or at the ends of a shared passage) are
taken apart again, and only in the first document that holds each of them.
Joins bring the verdicts back to the source coordinates (document, word), where
adjoining repeated paths merge into spans.

About one row for 18 words is shuffled in place of one for each word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, Windows, map_rows, mix, second, signed, sliding_min, word_hashes

RUNS = "doc long, copy long, pos int, n int, m long, p1 long, p2 long"
EDGES = "doc long, copy long, pos int, w1 long, w2 long"


def _rows(docs: DataFrame) -> DataFrame:
    """(doc, copy, text) of rows with a doc_id; ``copy`` tells apart rows with
    the same doc_id and different texts (equal ones share their verdicts)."""
    text = F.col("text").cast("string")
    return docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("copy"), text.alias("text"))


def paths(docs: DataFrame, window: int) -> DataFrame:
    """The paths of every document: ``n`` edges from word ``pos`` on."""
    k = max(1, window // 3)

    def run(cols) -> Iterator[dict]:
        parts: list[tuple] = []
        held = 0
        for doc, copy, text in zip(cols["doc"].to_pylist(), cols["copy"].to_pylist(), cols["text"]):
            words = (text.as_py() or "").encode().split()
            if len(words) < window:
                continue
            h = word_hashes(words)
            one, two = Windows(h), Windows(second(h))
            least = sliding_min(one.all(k), window - k + 1)
            pos = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
            n = np.diff(pos, append=len(least))
            end = pos + n + (window - 1)
            size = n.astype(np.uint64)
            parts.append((np.full(len(pos), doc), np.full(len(pos), copy), pos.astype(np.int32), n.astype(np.int32),
                          signed(least[pos]), signed(mix(one(pos, end) + size)), signed(mix(two(pos, end) + size))))
            held += len(pos)
            if held > 100_000:
                yield dict(zip(("doc", "copy", "pos", "n", "m", "p1", "p2"), map(np.concatenate, zip(*parts))))
                parts, held = [], 0
        if parts:
            yield dict(zip(("doc", "copy", "pos", "n", "m", "p1", "p2"), map(np.concatenate, zip(*parts))))

    return map_rows(_rows(docs), run, RUNS)


def edges_of(docs: DataFrame, heads: DataFrame, window: int) -> DataFrame:
    """Every edge of the paths in ``heads`` (doc, copy, runs)."""
    def run(cols) -> Iterator[dict]:
        parts: list[tuple] = []
        held = 0
        for doc, copy, text, runs in zip(cols["doc"].to_pylist(), cols["copy"].to_pylist(), cols["text"], cols["runs"]):
            h = word_hashes((text.as_py() or "").encode().split())
            one, two = Windows(h), Windows(second(h))
            for r in runs.as_py():
                pos = np.arange(r["pos"], r["pos"] + r["n"])
                parts.append((np.full(len(pos), doc), np.full(len(pos), copy), pos.astype(np.int32), signed(one(pos, pos + window)), signed(two(pos, pos + window))))
                held += len(pos)
            if held > 100_000:
                yield dict(zip(("doc", "copy", "pos", "w1", "w2"), map(np.concatenate, zip(*parts))))
                parts, held = [], 0
        if parts:
            yield dict(zip(("doc", "copy", "pos", "w1", "w2"), map(np.concatenate, zip(*parts))))

    return map_rows(_rows(docs).join(heads, ["doc", "copy"]).select("doc", "copy", "text", "runs"), run, EDGES)


def repeated_edges(docs: DataFrame, window: int, scratch: Scratch) -> DataFrame:
    """(doc, copy, pos, n, source_doc, source_pos): the ``n`` windows from
    word ``pos`` on also start from ``source_pos`` on in ``source_doc``, a
    smaller doc_id."""
    all_paths = scratch.save(paths(docs, window), "paths")
    shared = scratch.save(all_paths.groupBy("m").agg(F.min("doc").alias("low"), F.max("doc").alias("high")).where("low < high").select("m"), "shared")
    found = scratch.save(all_paths.join(shared, "m"), "found")
    scratch.drop("paths")
    kinds = found.groupBy("p1", "p2").agg(F.first("m").alias("m"), F.min(F.struct("doc", "pos")).alias("first"))
    kinds = scratch.save(kinds, "kinds")
    forks = scratch.save(kinds.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m", F.lit(True).alias("forks")), "forks")
    kinds = scratch.save(kinds.join(forks, "m", "left").select("p1", "p2", "first", F.coalesce("forks", F.lit(False)).alias("forks")), "verdicts")
    settled = found.join(kinds, ["p1", "p2"]).where("first.doc < doc or (forks and first.doc = doc)")
    settled = scratch.save(settled.select("doc", "copy", "pos", "n", F.col("first.doc").alias("source_doc"), F.col("first.pos").alias("source_pos")), "settled")
    scratch.drop("found", "kinds", "verdicts")
    heads = settled.where("source_doc = doc").groupBy("doc", "copy").agg(F.collect_list(F.struct("pos", "n")).alias("runs"))
    edges = scratch.save(edges_of(docs, heads, window), "edges")
    first = scratch.save(edges.groupBy("w1", "w2").agg(F.min(F.struct("doc", "pos")).alias("first"), F.max("doc").alias("high")).where("first.doc < high").select("w1", "w2", "first"), "sources")
    branching = edges.join(first, ["w1", "w2"]).where("first.doc < doc").select(
        "doc", "copy", "pos", F.lit(1).alias("n"), F.col("first.doc").alias("source_doc"), F.col("first.pos").alias("source_pos"))
    return settled.where("source_doc < doc").unionByName(branching)


def repeated_spans(docs: DataFrame, window: int = 50, scratch: Scratch | None = None) -> DataFrame:
    """One row per (doc, copy) with a repeated window: ``spans``, an array of
    (pos, n words, source_doc, source_pos). A document's spans are no more
    than its words, so the list is as bounded as the text itself."""
    scratch = scratch or Scratch(docs.sparkSession, "substring")
    runs = repeated_edges(docs, window, scratch)
    return runs.groupBy("doc", "copy").agg(F.collect_list(F.struct("pos", (F.col("n") + (window - 1)).alias("n"), "source_doc", "source_pos")).alias("spans"))


def _covered(n: int, spans: list[dict]) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, [s["pos"] for s in spans], 1)
    np.add.at(step, [s["pos"] + s["n"] for s in spans], -1)
    return np.cumsum(step[:n]) > 0


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """``docs`` with ``kept_text`` (the words that are left, joined by one
    space), ``n_words`` and ``n_removed`` added.

    A word goes if a window of ``window`` words covers it whose word sequence
    also starts in a document with a smaller doc_id; windows are judged on the
    input. Null and empty texts have no words. Texts shorter than a window stay
    whole. Rows with a null doc_id are no source and stay whole. Rows that
    repeat a doc_id never remove each other's words. Columns that ``docs`` has
    under these names are replaced.
    """
    scratch = Scratch(docs.sparkSession, "substring")
    spans = scratch.save(repeated_spans(docs, window, scratch), "spans")
    scratch.keep("spans")
    kept = [c for c in docs.columns if c not in ("kept_text", "n_words", "n_removed")]
    rows = docs.select(*kept).withColumn("__doc", F.col("doc_id").cast("long")).withColumn("__copy", F.xxhash64(F.col("text").cast("string")))
    spans = spans.select(F.col("doc").alias("__doc"), F.col("copy").alias("__copy"), F.col("spans").alias("__spans"))
    joined = rows.join(spans, ["__doc", "__copy"], "left").select(*kept, "__spans")
    kinds = joined.drop("__spans").schema.add("kept_text", "string").add("n_words", "long").add("n_removed", "long")

    def run(cols) -> Iterator[dict]:
        texts, total, gone = [], [], []
        for text, spans in zip(cols["text"], cols["__spans"]):
            words = (text.as_py() or "").encode().split()
            found = spans.as_py()
            total.append(len(words))
            if found:
                out = _covered(len(words), found)
                gone.append(int(out.sum()))
                words = [words[i] for i in np.flatnonzero(~out)]
            else:
                gone.append(0)
            texts.append(b" ".join(words).decode())
        yield {c: cols[c] for c in kept} | dict(kept_text=texts, n_words=total, n_removed=gone)

    return map_rows(joined, run, kinds)




SQL = r"""
with d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
g as (select doc_id, unnest(range(len(w) - 49)) as i, w from d where len(w) >= 50),
h as (select doc_id, i, md5(array_to_string(w[i + 1:i + 50], ' ')) as k from g),
m as (select k, min(doc_id) as low from h group by k),
r as (select distinct h.doc_id, i + o as i from h join m using (k), range(50) t(o) where m.low < h.doc_id),
x as (select doc_id, unnest(range(len(w))) as i, unnest(w) as word from d),
s as (select x.doc_id, count(r.i) as gone, coalesce(string_agg(word, ' ' order by x.i) filter (where r.i is null), '') as kept
  from x left join r on r.doc_id = x.doc_id and r.i = x.i group by x.doc_id)
select d.doc_id, len(w)::bigint as n_words, coalesce(gone, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join s using (doc_id)
"""

"""An audit of how filters interact in every order (operator 11).

*Min-plus removal ranks*: a row's failed filters are a mask, an order of the
filters is a permutation, and its inverse says at which step each filter is
applied. In the (min, +) product of the masks (0 for a failed filter, else
infinite) with these positions, an entry is the step at which an order removes
a row of a mask. All counts follow from this small matrix and the number of
rows of each mask, scattered to their steps.

Rows are therefore counted by part, mask and label first, partially before the
shuffle. A part is then one row of ``2 ** filters`` counts, whatever it holds.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, map_rows

FILTERS = "ABCDE"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SYMBOLS = re.compile(rb"[#$%&*|]")
#: Failing this filter depends on the other rows of the table, the rest on the text.
COPY = FILTERS.index("E")
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def text_mask(text: bytes) -> int:
    """The filters that a text fails by itself, bit 0 for A: fewer than 200
    words; fewer than half of them distinct; more than 2 of 100 code points
    A to Z; one of ``#$%&*|``."""
    words = text.split()
    n = len(words)
    points = len(text) if text.isascii() else len(text.decode())
    capitals = len(text) - len(text.translate(None, CAPITALS))
    failed = (n < 200, 100 * len(set(words)) < 50 * n, 100 * capitals > 2 * points, SYMBOLS.search(text) is not None)
    return sum(f << i for i, f in enumerate(failed))


def masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, copy, mask) of every row: the mask of its text and a
    128-bit hash of it, by which equal texts are found. Null texts are empty."""
    def run(cols) -> Iterator[dict]:
        texts = [t.as_buffer().to_pybytes() if t.is_valid else b"" for t in cols["text"]]
        yield dict(doc_id=cols["doc_id"], part=cols["part"], copy=[hashlib.blake2b(t, digest_size=16).digest() for t in texts], mask=list(map(text_mask, texts)))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    return map_rows(rows, run, "doc_id long, part string, copy binary, mask int")


def failures(docs: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows counted by what they fail: (part, mask, n, good, toxic).

    A doc_id that ``labels`` repeats is good (toxic) if any row says so. Equal
    rows of a doc_id are counted into one row before anything else is asked; a
    text's copies meet in an aggregate by text, part and label, so a text that
    is a third of the table is a few rows where its smallest doc_id is joined.
    Rows with a null doc_id are no copies, have no copies and no label.
    """
    marked = lambda flag: F.max(F.when(F.col(flag) == 1, 1).otherwise(0))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(marked("quality").alias("good"), marked("toxic").alias("toxic"))
    rows = scratch.save(masks(docs), "masks")
    known = rows.where("doc_id is not null").groupBy("doc_id", "part", "copy", "mask").agg(F.count("*").alias("n")).join(marks, "doc_id", "left")
    label = [F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")]
    texts = known.groupBy("copy", "mask", "part", *label).agg(F.sum("n").alias("n"), F.min("doc_id").alias("first"), F.min_by("n", "doc_id").alias("n_first"))
    texts = scratch.save(texts, "texts")
    least = texts.groupBy("copy").agg(F.min("first").alias("least"))
    earliest = F.when(F.col("first") == F.col("least"), F.col("n_first")).otherwise(0)
    sides = F.array(F.struct(F.col("mask").alias("failed"), earliest.alias("rows")),
                    F.struct((F.col("mask") + (1 << COPY)).alias("failed"), (F.col("n") - earliest).alias("rows")))
    found = texts.join(least, "copy").select("part", "good", "toxic", F.inline(sides))
    free = rows.where("doc_id is null").select("part", F.lit(0).alias("good"), F.lit(0).alias("toxic"), F.col("mask").alias("failed"), F.lit(1).cast("long").alias("rows"))
    share = lambda flag: F.sum(F.col("rows") * F.col(flag)).cast("long").alias(flag)
    return found.unionByName(free).groupBy("part", F.col("failed").alias("mask")).agg(F.sum("rows").cast("long").alias("n"), share("good"), share("toxic"))


def removal_steps(filters: int) -> tuple[np.ndarray, np.ndarray]:
    """(orders x filters positions, masks x orders removal steps) from 0; a
    step of ``filters`` means that the row is kept."""
    orders = np.array(list(permutations(range(filters))))
    position = np.argsort(orders, axis=1)
    mask = np.where(np.arange(1 << filters)[:, None] >> np.arange(filters) & 1, 0, filters)
    step = np.minimum((mask[:, None, :] + position[None, :, :]).min(axis=2), filters)
    return position, step


def audit_counts(counts: np.ndarray, filters: int) -> dict[str, np.ndarray]:
    """COUNTS, each parts x orders x steps, from ``counts`` (3 x parts x masks:
    rows, good rows, toxic rows)."""
    position, step = removal_steps(filters)
    orders = np.argsort(position, axis=1)
    masks_n, orders_n = step.shape
    at = np.broadcast_to(np.arange(orders_n), step.shape)

    def scatter(weights):   # masks -> orders x steps
        out = np.zeros((orders_n, filters + 1), np.int64)
        np.add.at(out, (at, step), weights[:, None])
        return out[:, :filters]

    parts = counts.shape[1]
    out = {name: np.zeros((parts, orders_n, filters), np.int64) for name in COUNTS}
    failed = np.arange(masks_n)[:, None] >> np.arange(filters) & 1
    earlier = failed[:, None, :] * (step[:, :, None] < position[None, :, :])          # masks x orders x filters
    for p in range(parts):
        rows, good, toxic = counts[:, p]
        removed = scatter(rows)
        out["removed"][p] = removed
        out["kept"][p] = rows.sum() - removed.cumsum(axis=1)
        out["good_lost"][p], out["toxic_lost"][p] = scatter(good), scatter(toxic)
        by_filter = np.tensordot(rows, earlier, axes=1)                                # orders x filters
        out["redundant"][p] = np.take_along_axis(by_filter, orders, axis=1)
        out["unique_fails"][p] = rows[1 << orders]
        total = np.zeros(filters, np.int64)
        np.add.at(total, orders, removed)
        out["shapley"][p] = total[orders]
    return out


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part (the sources; null and empty are one part), order
    of the five filters and step: part, filter_order, step and COUNTS.

    ``removed`` rows fail the step's filter and none before it, ``redundant``
    ones fail it and were removed before, ``unique_fails`` fail it alone,
    ``shapley`` sums what the filter removes over all orders. Filter E fails
    rows whose text a smaller doc_id has. An empty table has no parts.
    """
    n = len(FILTERS)
    lists = failures(docs, labels, Scratch(docs.sparkSession, "interactions")).groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("counts"))   # at most 2 ** n
    names = ["".join(o) for o in permutations(FILTERS)]

    def run(cols) -> Iterator[dict]:
        parts = cols["part"].to_pylist()
        counts = np.zeros((3, len(parts), 1 << n), np.int64)
        for p, found in enumerate(cols["counts"].to_pylist()):
            for x in found:
                counts[:, p, x["mask"]] = x["n"], x["good"], x["toxic"]
        each = len(names) * n
        out = {k: v.ravel() for k, v in audit_counts(counts, n).items()}
        yield dict(part=[p for p in parts for _ in range(each)], filter_order=[o for o in names for _ in range(n)] * len(parts),
                   step=np.tile(np.arange(1, n + 1, dtype=np.int32), len(names) * len(parts)), **out)

    return map_rows(lists, run, "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))


SQL = r"""
with d as (select row_number() over () as rid, doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents),
w as (select *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') as ws from d),
e as (select text, min(doc_id) as least from d group by text),
l as (select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as toxic from labels group by doc_id),
m as (select w.part, coalesce(l.good, false) as good, coalesce(l.toxic, false) as toxic, {
  'A': len(ws) < 200, 'B': 100 * len(list_distinct(ws)) < 50 * len(ws),
  'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text), 'D': regexp_matches(text, '[#$%&*|]'),
  'E': coalesce(w.doc_id > e.least, false)} as f
  from w join e using (text) left join l on l.doc_id = w.doc_id),
c as (select part, f, count(*) as n, count(*) filter (where good) as good, count(*) filter (where toxic) as toxic from m group by all),
k as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (select a.x || b.x || c.x || d.x || e.x as filter_order from k a, k b, k c, k d, k e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select filter_order, unnest([1, 2, 3, 4, 5]) as step from o),
t as (select part, f, n, good, toxic, filter_order, list_position(list_transform(string_split(filter_order, ''), lambda x:
  case x when 'A' then f.A when 'B' then f.B when 'C' then f.C when 'D' then f.D else f.E end), true) as gone from c, o),
u as (select part, filter_order, step, filter_order[step] as x, n, good, toxic, gone,
  case filter_order[step] when 'A' then f.A when 'B' then f.B when 'C' then f.C when 'D' then f.D else f.E end as fails,
  f.A::int + f.B::int + f.C::int + f.D::int + f.E::int as failed from t join s using (filter_order)),
r as (select part, filter_order, step, x,
  coalesce(sum(n) filter (where gone is null or gone > step), 0)::bigint as kept, coalesce(sum(n) filter (where gone = step), 0)::bigint as removed,
  coalesce(sum(n) filter (where fails and gone < step), 0)::bigint as redundant, coalesce(sum(n) filter (where fails and failed = 1), 0)::bigint as unique_fails,
  coalesce(sum(good) filter (where gone = step), 0)::bigint as good_lost, coalesce(sum(toxic) filter (where gone = step), 0)::bigint as toxic_lost
  from u group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) over (partition by part, x))::bigint as shapley from r
"""

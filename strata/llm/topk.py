"""Exact top-k inner-product search without random access (operator 6).

*No-random-access aggregation*: each dimension of a block of candidates is a
list sorted by value. Read to some depth, every list gives the exact part of
the candidates seen in it, and for the others a bound: no better than the value
read last, no worse than the list's last value. So every candidate has an upper
and a lower bound of its score; once the k-th best lower bound of a query is above
the upper bounds of the rest, they cannot qualify, and only the final scores
of those left are resolved. Otherwise the lists are read deeper.

Queries and candidates fall into blocks, and every task compares one block of
each, whose k best go on. Blocks have a bounded size, so the work is dealt
evenly whatever the sizes of the two tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch

#: Candidates and queries of a block.
CANDIDATES, QUERIES = 8192, 512
#: Shares of the lists that are read before bounds are looked at again.
DEPTHS = (0.25, 0.5)
#: Left-over candidates of a query, as a share of a block, from which on the
#: lists are read deeper before scores are resolved.
FEW = 0.05


def quantize(vectors: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, v): components x as floor(scale * x) in double precision.
    Null vectors, and those with a null or non-finite component, drop out."""
    v = F.col("embedding").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x)).alias("v"))


def search_block(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, stops: dict | None = None) -> Iterator[tuple]:
    """(query, vec_ids, scores) of the up to ``k`` best candidates of a block
    for each query, by score and then by smaller id. ``x`` and ``q`` hold
    integers; where a score may pass 2**53, beyond which double precision has
    gaps, all scores are taken in 64-bit integers. ``stops`` gets the number
    of queries that stop at each depth; at 1.0 all scores are taken."""
    n = len(ids)
    largest = [float(np.abs(a.astype(np.float64)).max(initial=0)) for a in (x, q)]
    exact = largest[0] * largest[1] * x.shape[1] < 2.0 ** 53
    x, q = (a.astype(np.float64 if exact else np.int64, copy=False) for a in (x, q))
    x = x[np.argsort(ids, kind="stable")]
    ids = np.sort(ids)
    lists = np.sort(x, axis=0)  # ascending; read from either end
    plus, minus = np.maximum(q, 0), np.minimum(q, 0)
    own = ids[None, :] == query_ids[:, None]
    open_queries = np.arange(len(query_ids))
    for depth in (*DEPTHS, 1.0) if exact else (1.0,):
        if not len(open_queries):
            return
        p, m, mine = plus[open_queries], minus[open_queries], own[open_queries]
        read = min(n, math.ceil(depth * n))
        if read < n and n > 4 * k:
            top, bottom = lists[n - read], lists[read - 1]
            upper = p @ np.where(x >= top, x, top).T + m @ np.where(x <= bottom, x, bottom).T
            lower = p @ np.where(x >= top, x, lists[0]).T + m @ np.where(x <= bottom, x, lists[-1]).T
            lower[mine] = -np.inf
            upper[mine] = -np.inf
            bar = -np.partition(-lower, k - 1, axis=1)[:, k - 1]
            left = upper >= bar[:, None]
            done = left.sum(axis=1) <= max(4 * k, FEW * n)
        else:
            left = ~mine
            done = np.ones(len(open_queries), bool)
        if stops is not None:
            stops[depth] = int(done.sum())
        for at in np.flatnonzero(done):
            rows = np.flatnonzero(left[at])
            scores = x[rows] @ q[open_queries[at]]
            if len(rows) > 4 * k:  # the k best, with all ties of the last
                bar = -np.partition(-scores, k - 1)[k - 1]
                rows, scores = rows[scores >= bar], scores[scores >= bar]
            best = np.lexsort((ids[rows], -scores))[:k]
            yield query_ids[open_queries[at]], ids[rows[best]], scores[best]
        open_queries = open_queries[~done]


def top_k(vectors: DataFrame, k: int = 5, every: int = 50, scale: int = 256) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each query.

    Queries are the vectors whose vec_id is divisible by ``every``; candidates
    are all with another vec_id. Scores are integer inner products, ties go
    to the smaller vec_id. Vectors of other lengths than the query's are no
    candidates. Rows with a null vec_id take no part; a repeated row is a
    candidate as often as it occurs, and a query as one. Different vectors
    under one vec_id are one query: all of them are compared, and its ``k``
    results are the best of all their scores. Scores are exact as long as they
    fit 64 bits.
    """
    scratch = Scratch(vectors.sparkSession, "topk")
    rows = scratch.save(quantize(vectors, scale).withColumn("size", F.size("v")), "vectors")
    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    many, asked = rows.count(), queries.count()
    blocks, parts = max(1, math.ceil(many / CANDIDATES)), max(1, math.ceil(asked / QUERIES))
    number = lambda salt, n: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    cells = rows.withColumn("block", number(1, blocks)).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).withColumn("asks", F.lit(False))
    asks = queries.withColumn("part", number(2, parts)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("asks", F.lit(True))
    both = cells.select("block", "part", "size", "asks", "vec_id", "v").unionByName(asks.select("block", "part", "size", "asks", "vec_id", "v"))
    both = both.repartition(max(1, min(blocks * parts, 100_000)), "block", "part").sortWithinPartitions("block", "part", "size", "asks")

    def run(batches):
        import pyarrow as pa

        def cell(key, held):
            asks, ids, flat = (np.concatenate(x) for x in zip(*held))
            v = flat.reshape(len(ids), key[2])
            for query, found, scores in search_block(ids[~asks], v[~asks], ids[asks], v[asks], k):
                yield from zip([int(query)] * len(found), found.tolist(), scores.astype(np.int64).tolist())

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 3, names=["query_id", "vec_id", "score"])

        now, held = None, []
        for b in batches:
            cols = {n: b.column(i) for i, n in enumerate(b.schema.names)}
            keys = np.stack([cols[c].to_numpy() for c in ("block", "part", "size")])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                key = tuple(keys[:, lo])
                if now is not None and key != now:
                    yield batch(list(cell(now, held)))
                    held = []
                now = key
                held.append((cols["asks"].slice(lo, hi - lo).to_numpy(zero_copy_only=False), cols["vec_id"].slice(lo, hi - lo).to_numpy(),
                             cols["v"].slice(lo, hi - lo).flatten().to_numpy()))
        if held:
            yield batch(list(cell(now, held)))

    best = both.mapInArrow(run, "query_id long, vec_id long, score long")
    from pyspark.sql import Window
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


SQL = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 50 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""

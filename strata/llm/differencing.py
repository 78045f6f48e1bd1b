"""Packing token sequences by Karmarkar-Karp differencing (operator 12).

*Multiway differencing*: every piece begins as a partition of k windows of which
one is filled. The two partitions with the largest imbalance (fullest less
emptiest window) are merged so that imbalances oppose each other: the fullest
windows of one go with the emptiest of the other. The last partition has k
windows of nearly equal fill. If one is over the capacity, the number of
windows rises and the differencing is done anew.

Spark deals the documents by hash into tiles of about ``TILE`` windows, whose
number grows with the corpus; a tile is packed in one task from the documents'
lengths alone. Token ids are stored once, beside the plan, and joined to it by
a row number that is different for every row, so no key is hot.

A sequence is padded to the capacity unless its length is a power of two, so
the tokens of a tile that don't fill whole windows go into a few sequences of
such lengths.
"""

from __future__ import annotations

import bisect
import heapq
import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, map_rows
from strata.llm.wordids import WordIds

#: Windows of a tile, on average.
TILE = 512
#: Pieces shorter than this part of a window are bundled before the differencing.
BUNDLE = 64
#: The room left in a window rises to this part of it before what is over is cut
#: off; so at most two such parts of a tile are padding.
MOST = 512
ENCODED = "doc_id long, doc_tokens long, ids binary"
PLAN = "row long, pieces array<struct<start:long,length:long,sequence_id:long,offset:long>>"


def encode(docs: DataFrame, tokenizer: str, end: int = 2) -> DataFrame:
    """(doc_id, doc_tokens, ids) of every row: little-endian unsigned 32-bit
    ids with ``end`` at the end. Null and empty texts hold ``end`` only."""
    def run(cols) -> Iterator[dict]:
        coder = WordIds.shared(tokenizer)
        last = struct.pack("<I", end)

        def done(docs, texts):
            ids, edges, _ = coder.encode_batch(texts)
            data, edges = memoryview(ids.astype("<u4").tobytes()), edges.tolist()
            return dict(doc_id=docs, doc_tokens=[b - a + 1 for a, b in zip(edges, edges[1:])],
                        ids=[bytes(data[4 * a:4 * b]) + last for a, b in zip(edges, edges[1:])])

        held, group, texts = 0, [], []
        for doc, text in zip(cols["doc_id"].to_pylist(), cols["text"]):
            group.append(doc)
            texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held > 4_000_000:
                yield done(group, texts)
                held, group, texts = 0, [], []
        yield done(group, texts)

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, ENCODED)


def difference(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window, from 0 to ``k`` - 1, of each size by k-way differencing.

    A partition keeps its filled windows only, the emptiest first, as (fill,
    node): a node is an item, or two nodes put into one window by a merge.
    """
    n = len(sizes)
    parts: list = [[(s, i)] for i, s in enumerate(sizes.tolist())]
    heap = [(-p[0][0] if k > 1 else 0, i) for i, p in enumerate(parts)]
    heapq.heapify(heap)
    joined: list[tuple[int, int]] = []
    while len(heap) > 1:
        i, j = heapq.heappop(heap)[1], heapq.heappop(heap)[1]
        a, b = parts[i], parts[j]
        parts[i] = None
        both = len(a) + len(b) - k   # windows that are filled in both
        if both > 0:
            met = []
            for (x, left), (y, right) in zip(a[both - 1::-1], b):
                met.append((x + y, n + len(joined)))
                joined.append((left, right))
            a, b = a[both:], b[both:] + met
        if len(b) == 1:
            bisect.insort(a, b[0])
        elif len(a) == 1:
            bisect.insort(b, a[0])
            a = b
        else:
            a = sorted(a + b)
        parts[j] = a
        heapq.heappush(heap, ((a[0][0] if len(a) == k else 0) - a[-1][0], j))
    window = [0] * (n + len(joined))
    for w, (_, node) in enumerate(parts[heap[0][1]]):
        window[node] = w
    for at in range(len(joined) - 1, -1, -1):
        left, right = joined[at]
        window[left] = window[right] = window[n + at]
    return np.array(window[:n], np.int64)


def balanced(sizes: np.ndarray, k: int, least: int) -> np.ndarray:
    """``difference`` where sizes below ``least`` are bundled to about it."""
    small = sizes < least
    if small.sum() < 2:
        return difference(sizes, k)
    at = np.flatnonzero(small)
    _, bundle = np.unique(np.cumsum(sizes[at]) // least, return_inverse=True)
    large = np.flatnonzero(~small)
    whole = np.concatenate([sizes[large], np.bincount(bundle, weights=sizes[at]).astype(np.int64)])
    found = difference(whole, k)
    out = np.zeros(len(sizes), np.int64)
    out[large], out[at] = found[:len(large)], found[len(large) + bundle]
    return out


def fewest_bits(low: int, high: int) -> int:
    """The number from ``low`` to ``high`` with the fewest bits set."""
    best = low
    for bit in range(high.bit_length()):
        up = -(-low >> bit) << bit   # low rounded up to a multiple of 2**bit
        if up <= high and up.bit_count() < best.bit_count():
            best = up
    return best


def peel(pieces: list[list[int]], cut: set[int], tokens: int) -> list[list[list[int]]]:
    """Take ``tokens`` off the ends of ``pieces`` ([document, start, length],
    changed in place): for each bit of ``tokens`` a list of pieces of that
    many. Pieces of documents in ``cut``, which are cut already, come first."""
    order = sorted(pieces, key=lambda p: (p[0] in cut, p[2], p[0]))
    out = []
    for bit in range(tokens.bit_length() - 1, -1, -1):
        need, mine = tokens & 1 << bit, []
        while need:
            doc, start, length = piece = order[-1]
            took = min(need, length)
            mine.append([doc, start + length - took, took])
            piece[2] -= took
            need -= took
            if not piece[2]:
                order.pop()
        if mine:
            out.append(mine)
    return out


def level(windows: list[list[list[int]]], capacity: int) -> None:
    """Cut what is over ``capacity`` off windows and put it where there is room."""
    fill = [sum(p[2] for p in w) for w in windows]
    free = [i for i, f in enumerate(fill) if f < capacity]
    for i, f in enumerate(fill):
        over = f - capacity
        while over > 0:
            to = free[-1]
            piece = max(windows[i], key=lambda p: p[2])
            took = min(over, capacity - fill[to], piece[2])
            windows[to].append([piece[0], piece[1] + piece[2] - took, took])
            piece[2] -= took
            if not piece[2]:
                windows[i].remove(piece)
            over -= took
            fill[to] += took
            if fill[to] == capacity:
                free.pop()


def pack_tile(lengths: list[int], capacity: int) -> list[list[list[int]]]:
    """Sequences of pieces [document, start, length] of documents of these
    lengths. Documents over the capacity are cut into whole windows and a rest.

    The number of windows rises from the fewest in steps that double the room
    left in a window, up to a part of ``MOST``; tokens beyond whole windows go
    into sequences of a power of two. If pieces are too large to balance (say all
    a little over half a window), what is over is cut off and moved.
    """
    out, pieces, cut = [], [], set()
    for doc, n in enumerate(lengths):
        whole = n // capacity
        out += [[[doc, i * capacity, capacity]] for i in range(whole)]
        if n % capacity:
            pieces.append([doc, whole * capacity, n % capacity])
            if whole:
                cut.add(doc)
    total = sum(p[2] for p in pieces)
    room = 1
    while pieces:
        k = total // (capacity - room)
        rest = total - k * (capacity - room)
        if (k + 1) * (capacity - 2 * room) <= total:   # one more window leaves little room too
            k, rest = k + 1, 0
        elif rest:
            rest = fewest_bits(rest, min(total, rest + room * k))
        left = [list(p) for p in pieces]
        peeled = peel(left, cut, rest)
        left = [p for p in left if p[2]]
        if not left:
            return out + peeled
        sizes = np.array([p[2] for p in left], np.int64)
        window = balanced(sizes, k, max(1, capacity // BUNDLE))
        fits = np.bincount(window, weights=sizes, minlength=k).max() <= capacity
        if fits or 2 * room * MOST > capacity:
            windows: list = [[] for _ in range(k)]
            for p, w in zip(left, window.tolist()):
                windows[w].append(p)
            if not fits:
                level(windows, capacity)
            return out + peeled + windows
        room *= 2
    return out


def plan(stored: DataFrame, capacity: int = 4096, tile: int = TILE) -> DataFrame:
    """(row, pieces) of the stored rows (``row``, ``doc_tokens``)."""
    total = stored.agg(F.sum("doc_tokens")).first()[0] or 0
    tiles = max(1, math.ceil(total / (capacity * tile)))

    def run(table: pa.Table) -> pa.Table:
        rows = table.column("row").to_pylist()
        order = sorted(range(len(rows)), key=rows.__getitem__)
        lengths = table.column("doc_tokens").to_pylist()
        base = table.column("tile")[0].as_py() << 32
        pieces: list[list[dict]] = [[] for _ in rows]
        for at, sequence in enumerate(pack_tile([lengths[i] for i in order], capacity)):
            offset = 0
            for doc, start, length in sequence:
                pieces[doc].append(dict(start=start, length=length, sequence_id=base + at, offset=offset))
                offset += length
        kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "sequence_id", "offset")]))
        return pa.table({"row": [rows[i] for i in order], "pieces": pa.array([sorted(p, key=lambda x: x["start"]) for p in pieces], kind)})

    slim = stored.select("row", "doc_tokens", F.pmod(F.xxhash64("row"), F.lit(tiles)).alias("tile"))
    return slim.groupBy("tile").applyInArrow(run, PLAN)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end: int = 2, tile: int = TILE) -> DataFrame:
    """Every document's pieces: doc_id, start, length, doc_tokens, ids,
    sequence_id and offset (gapless from 0 in each sequence).

    Every token of every row, its ``end`` included, is in one piece. A null
    doc_id stays null, null and empty texts are ``end`` alone, repeated rows
    are packed each, an empty table gives no rows; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "differencing")
    stored = scratch.save(encode(docs, tokenizer, end).withColumn("row", F.monotonically_increasing_id()), "encoded")
    plans = scratch.save(plan(stored, capacity, tile), "plan")
    rows = stored.join(plans, "row").select("doc_id", "doc_tokens", "ids", F.inline("pieces"))
    return rows.select("doc_id", "start", "length", "doc_tokens", F.expr("substring(ids, int(4 * start + 1), int(4 * length))").alias("ids"), "sequence_id", "offset")

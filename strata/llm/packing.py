"""Best-fit packing of token sequences (operator 1).

*Minimum bin slack*: for each bin a bitset subset-sum search over the lengths
still available finds the fullest feasible combination, which is removed.

There are at most ``capacity`` different lengths, so the search needs only the
number of pieces of each length, whatever the size of the corpus: Spark counts
them, the search runs on those at most ``capacity`` numbers, and one found
combination is used for as many bins as its lengths allow. Spark then deals
every piece its bin: pieces get a rank within their length, and the plan says
which ranks go where.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, buckets_for, map_rows, ranked
from strata.llm.tokens import ByteBpe

PIECES = "doc_id long, piece int, start long, length long, ids binary"


def cut_documents(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """Token pieces of every document: (doc_id, piece, start, length, ids).

    ``ids`` holds little-endian unsigned 32-bit token ids; every document ends
    with ``end``. A document of more than ``capacity`` ids is cut into pieces
    of ``capacity``, of which only the first may be shorter. A null or empty
    text gives one piece holding ``end`` only; a null doc_id stays null;
    repeated rows give repeated pieces.
    """
    def cut(cols) -> Iterator[dict]:
        bpe = ByteBpe.shared(tokenizer)
        last = struct.pack("<I", end)
        doc, piece, start, length, ids = [], [], [], [], []
        held = 0
        for doc_id, text in zip(cols["doc_id"].to_pylist(), cols["text"]):
            all_ids = bpe.encode(text.as_py() or "") + last
            n = len(all_ids) // 4
            first = n % capacity or min(n, capacity)
            cuts = [0, *range(first, n + 1, capacity)]
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                doc.append(doc_id)
                piece.append(i)
                start.append(a)
                length.append(b - a)
                ids.append(all_ids[4 * a:4 * b])
            held += n
            if held > 1_000_000:
                yield dict(doc_id=doc, piece=piece, start=start, length=length, ids=ids)
                doc, piece, start, length, ids = [], [], [], [], []
                held = 0
        yield dict(doc_id=doc, piece=piece, start=start, length=length, ids=ids)

    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), cut, PIECES)


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination of available lengths, as {length: times}: the
    longest length is taken, the rest by subset sums kept as bits of an
    integer (bit s: the sum s can be reached with the lengths so far)."""
    first = max(counts)
    room = capacity - first
    mask = (1 << (room + 1)) - 1
    steps, reach = [], 1
    for length in sorted(counts, reverse=True):
        if reach >> room & 1:
            break
        left = min(counts[length] - (length == first), room // length)
        for _ in range(left):
            wider = (reach | reach << length) & mask
            if wider == reach:
                break
            steps.append((length, reach))
            reach = wider
    total, found = reach.bit_length() - 1, {first: 1}
    for length, before in reversed(steps):
        if not before >> total & 1:
            found[length] = found.get(length, 0) + 1
            total -= length
    return found


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """(bins, {length: times in each}) until no piece is left. Every entry
    takes a length below the number its combination needs, so there are at
    most sum(1 + capacity / length) entries, whatever the counts are."""
    counts, plan = {k: v for k, v in counts.items() if v}, []
    while counts:
        found = fullest(counts, capacity)
        bins = min(counts[k] // n for k, n in found.items())
        plan.append((bins, found))
        for k, n in found.items():
            counts[k] -= bins * n
            if not counts[k]:
                del counts[k]
    return plan


def assign(pieces: DataFrame, scratch: Scratch, capacity: int = 1024) -> DataFrame:
    """``pieces`` (a stored table with ``length`` from 1 to ``capacity``) with
    sequence_id and offset: the place of every piece, gapless from 0.

    Pieces of one length are interchangeable. Their ranks come from hashed
    sub-buckets, so a length that a third of all pieces have is no hot group.
    """
    keys = [c for c in ("doc_id", "piece") if c in pieces.columns]
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    at, base, rows = {}, 0, []
    for bins, found in plan_bins(counts, capacity):
        offset = 0
        for length, times in sorted(found.items(), reverse=True):
            rows.append((length, at.get(length, 0), at.get(length, 0) + bins * times, times, base, offset))
            at[length] = at.get(length, 0) + bins * times
            offset += length * times
        base += bins
    spark = pieces.sparkSession
    plan = spark.createDataFrame(rows, "__length long, __from long, __to long, __times long, __base long, __offset long")
    ranks = ranked(pieces, ["length"], keys, F.pmod(F.xxhash64(*keys), F.lit(buckets_for(pieces))), "__rank", scratch, "starts")
    # The plan has at most capacity * ln(capacity) combinations of at most
    # sqrt(2 * capacity) lengths, at any corpus size: it can be broadcast.
    at_plan = (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__to"))
    place = F.col("__rank") - F.col("__from")
    return ranks.join(F.broadcast(plan), at_plan).select(
        *pieces.columns,
        (F.col("__base") + F.expr("(__rank - __from) div __times")).alias("sequence_id"),
        (F.col("__offset") + place % F.col("__times") * F.col("length")).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """Every document's pieces with ids, sequence_id and offset."""
    scratch = Scratch(docs.sparkSession, "packing")
    return assign(scratch.save(cut_documents(docs, tokenizer, capacity, end), "pieces"), scratch, capacity)


def digests(packed: DataFrame) -> DataFrame:
    """Rows of ``pack`` with the CRC-32 of the ids in place of the ids."""
    return packed.select(*[F.crc32("ids").alias("ids_crc32") if c == "ids" else F.col(c) for c in packed.columns])


def pack_digests(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 2) -> DataFrame:
    """As ``pack``, with the CRC-32 of the ids in place of the ids."""
    return digests(pack(docs, tokenizer, capacity, end))

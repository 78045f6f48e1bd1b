"""N-gram Jaccard self-join of documents (operator 10).

*Chosen path*: every document is the set of its word n-grams, embedded as
``SLOTS`` minimum hashes. In each run the sets are split again and again: at a
node of the run's tree some slots are drawn, 1.25 on average, and every set
goes to the child named by its token in each drawn slot. Two sets of similarity
0.8 share a child for every node they share, on average, so a pair survives to
depth d with a probability that is known (``survival``) and runs are repeated
until the target recall. Small buckets are compared by brute force; buckets
that are still large at the greatest depth hold sets that are alike, and are
compared whole too, in blocks dealt over many tasks.

Comparisons inside buckets link sets whose signatures look alike; each bucket
gives a spanning star, never all pairs. The components of these links are
then verified: all pairs of a component are compared by exact Jaccard over
their whole n-gram sets, in blocks, and each block returns the number of links
of each document and a spanning star of the verified links. Documents with the
same n-gram set are one set throughout and count by their number.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, Windows, components, map_rows, mix, second, signed, word_hashes

SLOTS = 64
#: Sets of a bucket that one task compares, n-grams that they may hold
#: together, and the greatest depth of splits.
BLOCK, GRAMS, DEPTH = 256, 1_000_000, 4
#: Slots drawn at a node: one, and with this probability a second one.
EXTRA = 0.25
#: Signatures count as alike from this much below the threshold (four standard
#: deviations of an estimate from SLOTS minimum hashes at 0.8).
SLACK = 0.2

_rng = np.random.default_rng(20)
_MULTIPLY = _rng.integers(1, 1 << 63, SLOTS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, SLOTS, dtype=np.uint64)


def survival(similarity: float, depth: int) -> float:
    """Probability that two sets of this similarity share a node at ``depth``."""
    alive = 1.0
    for _ in range(depth):
        lost = 1 - similarity * alive
        alive = 1 - (1 - EXTRA) * lost - EXTRA * lost * lost
    return alive


def equal_slots(similarity: float) -> list[float]:
    """Probability of each number of equal slots of two sets of this similarity."""
    return [math.comb(SLOTS, k) * similarity ** k * (1 - similarity) ** (SLOTS - k) for k in range(SLOTS + 1)]


def slots_for(recall: float, similarity: float) -> int:
    """Equal slots from which on signatures count as alike: ``SLACK`` below
    the threshold, or fewer if that loses more than half of what may be lost."""
    chance, need = equal_slots(similarity), math.ceil((similarity - SLACK) * SLOTS)
    while need > 0 and sum(chance[:need]) > (1 - recall) / 2:
        need -= 1
    return max(need, 0)


def runs_for(recall: float, similarity: float) -> int:
    """Runs that find this share of the pairs of this similarity. All runs
    draw from the same slots, so a pair's chance in each is that of its equal
    slots, and pairs with too few of them count as lost."""
    chance, need = equal_slots(similarity), slots_for(recall, similarity)
    lost = [1 - survival(k / SLOTS, DEPTH) for k in range(SLOTS + 1)]
    runs = 1
    while sum(chance[:need]) + sum(c * x ** runs for c, x in zip(chance[need:], lost[need:])) > 1 - recall:
        runs += 1
    return runs


def shingles(text: str | None, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of the n-grams of a text, sorted, with a second
    hash of each. Fewer than ``n`` words are one gram; no words, none."""
    words = (text or "").encode().split()
    h = word_hashes(words)
    size = min(n, len(words))
    if not size:
        return h, h
    short = np.uint64(size if size < n else 0)
    one, at = np.unique(mix(Windows(h).all(size) + short), return_index=True)
    return one, Windows(second(h)).all(size)[at]


def identity(one: np.ndarray, two: np.ndarray) -> tuple[int, int]:
    """128 bits that equal n-gram sets share."""
    return int(signed(mix(one + np.uint64(len(one))).sum(dtype=np.uint64, keepdims=True))[0]), int(signed(mix(two).sum(dtype=np.uint64, keepdims=True))[0])


def signature(one: np.ndarray) -> np.ndarray:
    low = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(one), 4096):
        low = np.minimum(low, (one[at:at + 4096, None] * _MULTIPLY + _ADD).min(axis=0))
    return (mix(low) >> np.uint64(32)).astype(np.uint32)


def _texts(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))


def sketch(docs: DataFrame, n: int) -> DataFrame:
    """(doc_id, copy, k1, k2, grams, signature) of every row, ``copy`` a hash
    of its text; the k of documents without words, and signatures of those,
    are null."""
    def run(cols) -> Iterator[dict]:
        out = {c: [] for c in ("doc_id", "copy", "k1", "k2", "grams", "signature")}
        for doc, copy, text in zip(cols["doc_id"].to_pylist(), cols["copy"].to_pylist(), cols["text"]):
            one, two = shingles(text.as_py(), n)
            k1, k2 = identity(one, two) if len(one) else (None, None)
            for c, v in zip(out, (doc, copy, k1, k2, len(one), signature(one).tobytes() if len(one) else None)):
                out[c].append(v)
        yield out

    return map_rows(_texts(docs), run, "doc_id long, copy long, k1 long, k2 long, grams long, signature binary")


# ------------------------------------------------------------ chosen paths
def _draw(nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first slot drawn at each node, the second, and if that one counts."""
    r = mix(nodes)
    a = (r >> np.uint64(8)) % np.uint64(SLOTS)
    b = (a + np.uint64(1) + (r >> np.uint64(24)) % np.uint64(SLOTS - 1)) % np.uint64(SLOTS)
    return a.astype(np.int64), b.astype(np.int64), (r >> np.uint64(40)) < np.uint64(int(EXTRA * (1 << 24)))


def split(rows: DataFrame) -> DataFrame:
    """The children (node, id) of rows (node, id, signature)."""
    def run(cols) -> Iterator[dict]:
        node = cols["node"].to_numpy(zero_copy_only=False).view(np.uint64)
        doc = cols["id"].to_numpy(zero_copy_only=False)
        sig = np.frombuffer(b"".join(cols["signature"].to_pylist()), np.uint32).reshape(-1, SLOTS)
        first, other, both = _draw(node)
        at = np.arange(len(node))

        def child(rows, slot):
            return signed(mix(node[rows] * np.uint64(31) + mix((slot.astype(np.uint64) << np.uint64(32)) + sig[rows, slot])))

        two = at[both]
        yield dict(node=np.concatenate((child(at, first), child(two, other[both]))), id=np.concatenate((doc, doc[two])))

    return map_rows(rows.select("node", "id", "signature"), run, "node long, id long")


def _star(n: int, linked: np.ndarray) -> np.ndarray:
    """For each of ``n`` rows the smallest row of its component; ``linked`` is
    a matrix of which rows are linked."""
    low = np.arange(n)
    while True:
        near = np.where(linked, low[None, :], n).min(axis=1)
        new = np.minimum(low, near)
        new = np.minimum(new, new[new])
        if (new == low).all():
            return low
        low = new


def _groups(batches, keys: list[str]):
    """Runs of equal keys over sorted Arrow batches, as lists of dicts."""
    now, rows = None, []
    for batch in batches:
        cols = batch.to_pydict()
        names = list(cols)
        for row in zip(*cols.values()):
            row = dict(zip(names, row))
            key = tuple(row[k] for k in keys)
            if key != now and rows:
                yield now, rows
                rows = []
            now = key
            rows.append(row)
    if rows:
        yield now, rows


def alike(cells: DataFrame, need: int) -> DataFrame:
    """Spanning stars (a, b) of the signatures with ``need`` equal slots, in
    every cell (node, i, j) of rows (id, signature)."""
    def run(batches):
        import pyarrow as pa
        a, b = [], []
        for _, rows in _groups(batches, ["node", "i", "j"]):
            rows.sort(key=lambda r: r["id"])
            sig = np.frombuffer(b"".join(r["signature"] for r in rows), np.uint32).reshape(-1, SLOTS)
            n = len(rows)
            same = np.zeros((n, n), np.uint8)
            for s in range(SLOTS):
                same += sig[:, s, None] == sig[None, :, s]
            low = _star(n, same >= need)
            for x in np.flatnonzero(low != np.arange(n)):
                a.append(rows[x]["id"])
                b.append(rows[low[x]]["id"])
            if len(a) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                a, b = [], []
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return cells.mapInArrow(run, "a long, b long")


def _cells(rows: DataFrame, key: str, blocks: Column, payload: list[str]) -> DataFrame:
    """Every row once for each cell (key, i, j), i <= j, of its block: a group
    falls into ``blocks`` blocks, and two blocks meet in one cell. A group of
    one block has one cell."""
    mine = F.pmod(F.xxhash64(F.col("id"), F.lit(7)), F.col("__blocks")).cast("int")
    rows = rows.withColumn("__blocks", blocks.cast("int")).withColumn("__mine", mine)
    rows = rows.withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    return rows.select(F.col(key).alias("node"), F.least("__mine", "__other").alias("i"), F.greatest("__mine", "__other").alias("j"),
                       F.col("__mine").alias("block"), *payload).repartition("node", "i", "j").sortWithinPartitions("node", "i", "j")


def candidates(sets: DataFrame, threshold: float, recall: float, scratch: Scratch) -> DataFrame:
    """Links (a, b) between sets (id, signature) that look alike."""
    runs = runs_for(recall, threshold)
    seeds = F.array(*[F.lit(int(signed(mix(np.array([r + 1], np.uint64)))[0])) for r in range(runs)])
    live = sets.withColumn("node", F.explode(seeds))
    found = None
    for depth in range(1, DEPTH + 1):
        children = scratch.save(split(live), f"children{depth}")
        sizes = scratch.save(children.groupBy("node").agg(F.count("*").alias("size")).where("size > 1"), f"sizes{depth}")
        groups = children.join(sizes, "node")
        ready = groups if depth == DEPTH else groups.where(F.col("size") <= BLOCK)
        ready = scratch.save(ready.select("node", "id", "size"), f"ready{depth}")
        found = ready if found is None else found.unionByName(ready)
        if depth < DEPTH:
            larger = groups.where(F.col("size") > BLOCK).select("node", "id")
            live = scratch.save(larger.join(sets, "id").select("node", "id", "signature"), f"live{depth}")
            if live.isEmpty():
                break
    cells = _cells(found.join(sets, "id"), "node", F.ceil(F.col("size") / BLOCK), ["id", "signature"])
    links = scratch.save(alike(cells, slots_for(recall, threshold)).distinct(), "links")
    scratch.drop(*[f"{name}{d}" for name in ("children", "sizes", "ready", "live") for d in range(1, DEPTH + 1)])
    return links


# ------------------------------------------------------------ verification
def _common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many grams each two sets share."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    both = left + right
    grams, ids, counts = np.unique(np.concatenate(both), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(both)), [len(x) for x in both])
    keep = counts[ids] > 1  # a gram of one set is common to none
    number = np.cumsum(counts > 1) - 1
    row, col = row[keep], number[ids[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    out = np.zeros((len(left), len(right)), np.float64)
    width = 2048
    for at in range(0, int((counts > 1).sum()), width):
        lo, hi = np.searchsorted(col, [at, at + width])
        block = np.zeros((len(both), width), np.float32)
        block[row[lo:hi], col[lo:hi] - at] = 1
        out += block[:len(left)] @ block[len(left):].T
    return out.astype(np.int64)


def verify(cells: DataFrame, n: int, threshold: float) -> DataFrame:
    """Exact comparison in every cell: rows (a, null, links) with the number
    of documents that ``a`` is linked to, and (a, b, 0) of a spanning star."""
    share = threshold / (1 + threshold)  # Jaccard t means a common part of t / (1 + t) of both sizes

    def run(batches):
        import pyarrow as pa
        out: tuple[list, list, list] = ([], [], [])

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=["a", "b", "links"])

        for (_, i, j), rows in _groups(batches, ["node", "i", "j"]):
            sets = []
            for r in rows:
                one, two = shingles(r["text"], n)
                if len(one) and identity(one, two) == (r["k1"], r["k2"]):
                    sets.append((r["block"], r["id"], r["copies"], one))
            sets.sort(key=lambda s: (s[0], s[1]))
            left = [s for s in sets if s[0] == i]
            right = left if i == j else [s for s in sets if s[0] == j]
            if not left or not right:
                continue
            common = _common([s[3] for s in left], [s[3] for s in right])
            sizes = np.array([len(s[3]) for s in left])[:, None] + np.array([len(s[3]) for s in right])[None, :]
            linked = common >= share * sizes - 1e-9
            if i == j:
                np.fill_diagonal(linked, False)
            copies = [np.array([s[2] for s in side]) for side in (left, right)]
            both = left if i == j else left + right
            links = linked @ copies[1] if i == j else np.concatenate((linked @ copies[1], linked.T @ copies[0]))
            whole = np.zeros((len(both), len(both)), bool)
            if i == j:
                whole |= linked
            else:
                whole[:len(left), len(left):] = linked
                whole[len(left):, :len(left)] = linked.T
            low = _star(len(both), whole)
            for x, s in enumerate(both):
                if links[x]:
                    for c, v in zip(out, (s[1], None, int(links[x]))):
                        c.append(v)
                if low[x] != x:
                    for c, v in zip(out, (s[1], both[low[x]][1], 0)):
                        c.append(v)
            if len(out[0]) > 50_000:
                yield batch()
                out = ([], [], [])
        yield batch()

    return cells.mapInArrow(run, "a long, b long, links long")


def _classed(docs: DataFrame, n: int, threshold: float, recall: float, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``sketch`` of the rows, and their different n-gram sets (k1, k2, doc_id,
    copy, root, n_links): the smallest doc_id with the set and its text, one
    number for all sets that verified links lead to, and the number of other
    rows similar to one with the set.

    Sets go by numbers of their own, so texts under one doc_id stay apart."""
    rows = scratch.save(sketch(docs, n), "sketch")
    sets = rows.where("doc_id is not null and k1 is not null").groupBy("k1", "k2").agg(
        F.min(F.struct("doc_id", "copy")).alias("f"), F.count("*").alias("copies"), F.first("grams").alias("grams"), F.first("signature").alias("signature"))
    sets = scratch.save(sets.select(F.monotonically_increasing_id().alias("id"), "k1", "k2", "f.doc_id", "f.copy", "copies", "grams", "signature"), "sets")
    links = candidates(sets.select("id", "signature"), threshold, recall, scratch)
    member = components(links, scratch, "look")
    member = member.unionByName(member.select(F.col("root").alias("node"), "root").distinct())
    member = scratch.save(member, "member")
    size = member.join(sets.select(F.col("id").alias("node"), "grams"), "node").groupBy("root").agg(F.count("*").alias("size"), F.sum("grams").alias("total"))
    size = scratch.save(size, "size")
    inside = member.join(size, "root").withColumnRenamed("node", "id").join(sets.drop("grams", "signature"), "id")
    # A row that is stored more than once gives its set one text.
    inside = inside.join(_texts(docs), ["doc_id", "copy"]).dropDuplicates(["doc_id", "copy", "id"])
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("total") / GRAMS))
    cells = _cells(inside, "root", blocks, ["id", "copies", "k1", "k2", "text"])
    proved = scratch.save(verify(cells, n, threshold), "proved")
    degree = scratch.save(proved.where("b is null").groupBy("a").agg(F.sum("links").alias("links")), "degree")
    classes = components(proved.where("b is not null").select("a", "b"), scratch, "class")
    known = sets.drop("grams", "signature").join(degree.withColumnRenamed("a", "id"), "id", "left").join(classes.withColumnRenamed("node", "id"), "id", "left")
    known = known.select("k1", "k2", "doc_id", "copy", F.coalesce("root", "id").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = scratch.save(known, "known")
    scratch.keep("sketch", "known")
    return rows, known


def near_duplicates(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (the smallest doc_id that
    links of Jaccard ``threshold`` or more lead to), n_links (the number of
    other rows that similar, equal texts among them) and n_grams.

    Grams are sets of ``n`` words; a text of fewer words is one gram. Null and
    empty texts have no links and are classes of their own. Rows with a null
    doc_id get a null class and no links. Texts with words under one doc_id
    are compared and counted apart, but fall into one class.
    """
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows, known = _classed(docs, n, threshold, recall, scratch)
    several = rows.where("doc_id is not null and k1 is not null").groupBy("doc_id").agg(F.min(F.struct("k1", "k2")).alias("a"), F.max(F.struct("k1", "k2")).alias("b"))
    several = scratch.save(several.where("a <> b").select("doc_id"), "several")
    if not several.isEmpty():
        shared = rows.join(several, "doc_id").select("doc_id", "k1", "k2").distinct().join(known.select("k1", "k2", "root"), ["k1", "k2"])
        shared = scratch.save(shared.select("doc_id", F.col("root").alias("a")).distinct(), "shared")
        edges = shared.join(shared.groupBy("doc_id").agg(F.min("a").alias("b")), "doc_id").select("a", "b")
        joined = components(edges, scratch, "joined").select(F.col("node").alias("root"), F.col("root").alias("whole"))
        known = scratch.save(known.join(joined, "root", "left").withColumn("root", F.coalesce("whole", "root")).drop("whole"), "whole")
    known = known.join(known.groupBy("root").agg(F.min("doc_id").alias("class_id")), "root").select("k1", "k2", "class_id", "n_links")
    out = rows.alias("r").join(known.alias("k"), (F.col("r.k1") == F.col("k.k1")) & (F.col("r.k2") == F.col("k.k2")) & F.col("r.doc_id").isNotNull(), "left")
    return out.select("r.doc_id", F.coalesce("k.class_id", "r.doc_id").alias("class_id"), F.coalesce("k.n_links", F.lit(0)).cast("long").alias("n_links"), F.col("r.grams").alias("n_grams"))


def representatives(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.999) -> DataFrame:
    """(doc_id, copy) of the text to keep of each class of similar texts, the
    smallest by (doc_id, k1, k2); ``copy`` is ``xxhash64`` of the text. Texts
    under one doc_id are classed apart, and all without words are kept. Rows
    with a null doc_id are no one's copy and have none here."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    rows, known = _classed(docs, n, threshold, recall, scratch)
    first = known.groupBy("root").agg(F.min(F.struct("doc_id", "k1", "k2", "copy")).alias("f")).select("f.doc_id", "f.copy")
    first = scratch.save(first.unionByName(rows.where("doc_id is not null and k1 is null").select("doc_id", "copy").distinct()), "first")
    scratch.keep("first")
    return first


SQL = r"""
with recursive d as (select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
g as (select distinct doc_id, array_to_string(w[i + 1:i + 5], ' ') as gram from (select doc_id, w, unnest(range(greatest(len(w) - 4, 1))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from g group by doc_id),
c as (select a.doc_id as a, b.doc_id as b, count(*) as shared from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id group by all),
e as materialized (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 5 * shared >= 4 * (x.n + y.n - shared)),
r as (select doc_id as a, doc_id as b from d union select r.a, e.b from r join e on e.a = r.b),
k as (select a as doc_id, min(b) as class_id from r group by a),
l as (select a as doc_id, count(*) as n_links from e group by a)
select d.doc_id, class_id, coalesce(n_links, 0)::bigint as n_links, coalesce(n.n, 0)::bigint as n_grams
from d join k using (doc_id) left join l using (doc_id) left join n using (doc_id)
"""

"""A Merkle manifest of a table by butterfly exchange (operator 13).

Leaves are hashed in order, 16 by 16 (``FANOUT``), up to one root for each
source, and the sources' roots in the same way up to one for the table.

*Butterfly exchange*: aligned partitions of ``FANOUT ** DEPTH`` leaves hash
their own subtree. Then the partitions swap subtree roots round by round: in
round r those whose numbers differ in digit r only (to the base ``FANOUT``) meet
in one group. Every one of them hashes the group's common ancestor for itself
and keeps the others' roots, which are the next level of its proofs. So after
the last round every partition holds the root and its upper proof, and nothing
is handed down from the top. The last subtree of a level may hold fewer
partitions than the others; each of them then stands in for several numbers.

A partition is one row (its leaves packed), so a source with most rows is as
many rows as it has partitions, and every group has at most ``FANOUT`` rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import Scratch, buckets_for, map_rows

#: Children of a node, and levels that a partition hashes by itself.
FANOUT, DEPTH = 16, 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def hashed(parts: list[bytes]) -> bytes:
    """H of digests: SHA-256 of their hexadecimal texts, joined."""
    return hashlib.sha256(b"".join([p.hex().encode() for p in parts])).digest()


def field(value: Column) -> Column:
    """A field of a leaf: ``-`` for null, else bytes, ``:`` and the text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row, binary."""
    return F.unhex(F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))).cast("binary"), 256))


def leaves(docs: DataFrame) -> DataFrame:
    """(source, doc_id, leaf, tampered) of every row; ``tampered`` is the leaf
    after tampering, null where the row is left as it is (also with a null doc_id)."""
    key = F.col("doc_id").cast("long")
    kind = {"source": "string", "lang": "string", "n_chars": "long", "text": "string"}
    source, lang, n_chars, text = [F.col(c).cast(t) for c, t in kind.items()]
    changed = F.crc32(key.cast("string").cast("binary")) % 5 == 0
    return docs.select(source.alias("source"), key.alias("doc_id"), leaf(key, source, lang, n_chars, text).alias("leaf"),
                       F.when(changed, leaf(key, source, lang, n_chars, F.translate(text, UPPER, LOWER))).alias("tampered"))


def _same(left: str, right: str, *columns: str) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}"))
    return out


def numbered(rows: DataFrame, group: str, order: list[str], scratch: Scratch, label: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``at``, their place from 0 in their group (a column that
    may be null), and the groups' sizes (group, ``n``).

    Rows are range-partitioned by group and order and written with the slice
    they fell into; places count from where a slice begins in its group.
    """
    slices = buckets_for(rows) // 2
    cut = scratch.save(rows.repartitionByRange(slices, group, *order).withColumn("slice", F.spark_partition_id()), f"{label}-slices")
    counts = cut.groupBy(group, "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy(group).orderBy("slice")
    starts = scratch.save(counts.select(group, "slice", "n", (F.sum("n").over(before) - F.col("n")).alias("start")), f"{label}-starts")
    within = Window.partitionBy("slice", group).orderBy(*order)
    placed = cut.withColumn("row", F.row_number().over(within) - 1).alias("l").join(
        starts.alias("r"), (F.col("l.slice") == F.col("r.slice")) & _same("l", "r", group))
    sizes = scratch.save(starts.groupBy(group).agg(F.sum("n").cast("long").alias("n")), f"{label}-sizes")
    return placed.select(*[F.col(f"l.{c}") for c in rows.columns], (F.col("r.start") + F.col("l.row")).cast("long").alias("at")), sizes


def salted(sizes: DataFrame, rows: Column, salts: int) -> DataFrame:
    """``sizes`` once for each salt of a group: as many as it has ``rows``, at
    most ``salts``. A group with most rows is joined in that many parts."""
    return sizes.withColumn("salt", F.explode(F.sequence(F.lit(0), F.least(F.lit(salts - 1), rows.cast("int") - 1))))


@dataclass(frozen=True)
class Tree:
    """The shape of a tree: ``fanout`` children, partitions of ``depth`` levels."""

    fanout: int = FANOUT
    depth: int = DEPTH

    @property
    def part(self) -> int:
        """Leaves of a full partition."""
        return self.fanout ** self.depth


def runs_of(nodes: list[bytes], n: int, tree: Tree) -> list[list[list[bytes]]]:
    """The runs of each level of a partition of a group of ``n`` leaves, the
    leaves' first and its root alone last. A partition that is not alone in its
    group is hashed ``depth`` levels up, also where a run is a single node."""
    out, step = [], 0
    while step < tree.depth if n > tree.part else len(nodes) > 1:
        out.append([nodes[i:i + tree.fanout] for i in range(0, len(nodes), tree.fanout)])
        nodes, step = [hashed(r) for r in out[-1]], step + 1
    return [*out, [nodes]]


def partitions(rows: DataFrame, sizes: DataFrame, group: str, payload: list[str], tree: Tree) -> DataFrame:
    """One row for each partition: (group, part, n, nodes, root, payload
    lists). ``rows`` hold ``at``, ``leaf`` and the columns of ``payload``."""
    salts = buckets_for(rows)
    parts = rows.withColumn("part", F.floor(F.col("at") / tree.part).cast("long"))
    packed = parts.groupBy(group, "part").agg(F.sort_array(F.collect_list(F.struct("at", "leaf", *payload))).alias("nodes"))
    packed = packed.withColumn("salt", F.pmod("part", F.lit(salts)).cast("int"))
    n_parts = F.ceil(F.col("n") / tree.part)
    return packed.alias("l").join(salted(sizes, n_parts, salts).alias("r"), _same("l", "r", group, "salt")).select(
        F.col(f"l.{group}"), "part", "n", "nodes")


def with_roots(parts: DataFrame, group: str, key: str, tree: Tree) -> DataFrame:
    """The partitions' own roots: (group, part, n, root)."""
    def run(cols) -> Iterator[dict]:
        roots = [runs_of(nodes.as_py(), n, tree)[-1][0][0] for n, nodes in zip(cols["n"].to_pylist(), cols["leaf"])]
        yield {group: cols[group], "part": cols["part"], "n": cols["n"], "root": roots}

    return map_rows(parts.select(group, "part", "n", F.col("nodes.leaf").alias("leaf")), run, f"{group} {key}, part long, n long, root binary")


def butterfly(roots: DataFrame, group: str, tree: Tree, scratch: Scratch, label: str) -> DataFrame:
    """(group, part, n, top, proof): the group's root and, level by level, the
    siblings above the partition's own root, joined as hexadecimal text
    (``proof``: the ``left`` and ``right`` ones of each level), of every
    partition of ``roots`` (group, part, n, root), after all rounds."""
    most = roots.agg(F.max("n")).first()[0] or 0
    count = F.ceil(F.col("n") / tree.part).cast("long")      # partitions of the group
    now = roots.select(group, "part", "n", F.lower(F.hex("root")).alias("node"), F.array().cast("array<struct<left:string,right:string>>").alias("proof"))
    step, width = 0, 1                                   # partitions of a subtree in this round
    while tree.part * width < most:
        wide = width * tree.fanout
        own = F.floor(F.col("part") / width)             # the subtree, and its first partition's number
        size = F.least(F.lit(width), count - own * width)
        low = F.col("part") - own * width                # the partition's number in the subtree
        upper = F.floor(F.col("part") / wide)
        first = F.least(F.lit(width), count - upper * wide)   # partitions of the first subtree of the group
        sent = F.when(size < first, F.sequence(low, first - 1, size)).otherwise(F.array(low))
        active = now.where(count > width)
        swap = active.select(group, "n", upper.alias("upper"), F.explode(sent).alias("low"), F.struct(
            own.alias("own"), "part", "node", "proof", low.alias("was")).alias("one"))
        met = swap.groupBy(group, "n", "upper", "low").agg(F.sort_array(F.collect_list("one")).alias("met"))
        node = F.sha2(F.array_join("met.node", "").cast("binary"), 256)
        met = met.select(group, "n", "low", "met", node.alias("node"))
        each = met.select(group, "n", "low", "met", "node", F.explode("met").alias("one")).where("one.was = low")
        side = lambda keep: F.array_join(F.transform(F.filter("met", keep), lambda m: m["node"]), "")
        more = F.struct(side(lambda m: m["own"] < F.col("one.own")).alias("left"), side(lambda m: m["own"] > F.col("one.own")).alias("right"))
        after = each.select(group, F.col("one.part").alias("part"), "n", "node", F.concat("one.proof", F.array(more)).alias("proof"))
        now = scratch.save(after.unionByName(now.where(count <= width)), f"{label}-{step}")
        if step:
            scratch.drop(f"{label}-{step - 1}")
        step, width = step + 1, wide
    return now.select(group, "part", "n", F.col("node").alias("top"), "proof")


def proofs(nodes: list[bytes], n: int, upper: list[tuple[str, str]], tree: Tree) -> Iterator[list[tuple[bytes, bytes]]]:
    """Of each leaf of a partition its siblings to the left and to the right,
    level by level, the partition's ``upper`` ones last."""
    runs = [[[x.hex().encode() for x in run] for run in level] for level in runs_of(nodes, n, tree)[:-1]]
    fanout = tree.fanout
    around = lambda level, at: (b"".join(level[at // fanout][:at % fanout]), b"".join(level[at // fanout][at % fanout + 1:]))
    higher, tail = -1, []
    for i in range(len(nodes)):
        if i // fanout != higher:   # the leaves of a run share what is above it
            higher = i // fanout
            tail = [around(level, i // fanout ** k) for k, level in enumerate(runs[1:], 1)] + [(a.encode(), b.encode()) for a, b in upper]
        yield [around(level, i) for level in runs[:1]] + tail


def fold(digest: bytes, siblings: list[tuple[bytes, bytes]]) -> str:
    """The root that a leaf and its siblings lead to, as hexadecimal text."""
    node = digest.hex().encode()
    for left, right in siblings:
        node = hashlib.sha256(left + node + right).hexdigest().encode()
    return node.decode()


OUT = "doc_id long, source string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def manifest(docs: DataFrame, tree: Tree = Tree()) -> DataFrame:
    """Every row of ``docs`` with its leaf, its source's root (``subroot``),
    the table's ``root``, the SHA-256 of its proof, the root folded from the
    proof and the row's tampered or original leaf, and if that is the root.

    Leaves ascend by doc_id (null first) in their source; rows that share a
    doc_id come in the order of their leaves, so the root depends on the rows
    alone (equal ones, which may be most, are spread by a row number). Repeated rows have proofs of their own. A null source is a source,
    different from the empty one. An empty table gives no rows. Only the five
    columns of a leaf are read.
    """
    scratch = Scratch(docs.sparkSession, "merkle")
    read = scratch.save(leaves(docs).withColumn("row", F.monotonically_increasing_id()), "leaves")
    rows, sizes = numbered(read, "source", ["doc_id", "leaf", "row"], scratch, "rows")
    parts = scratch.save(partitions(rows, sizes, "source", ["doc_id", "tampered"], tree), "parts")
    scratch.drop("leaves", "rows-slices")
    tops = butterfly(scratch.save(with_roots(parts, "source", "string", tree), "roots"), "source", tree, scratch, "swap")
    tops = scratch.save(tops, "tops")

    # The sources' roots, in the order of their bytes, are the leaves of one more tree.
    every = tops.where("part = 0").select(F.lit(0).cast("long").alias("tree"), F.col("source").cast("binary").alias("name"), F.unhex("top").alias("leaf"))
    placed, one = numbered(every, "tree", ["name"], scratch, "sources")
    above = scratch.save(partitions(placed, one, "tree", ["name"], tree), "above")
    ends = butterfly(scratch.save(with_roots(above, "tree", "long", tree), "above-roots"), "tree", tree, scratch, "above-swap")

    def lift(cols) -> Iterator[dict]:
        out: dict[str, list] = {c: [] for c in ("name", "root", "higher")}
        for nodes, n, top, proof in zip(cols["nodes"], cols["n"].to_pylist(), cols["top"].to_pylist(), cols["proof"].to_pylist()):
            own = nodes.as_py()
            upper = [(p["left"], p["right"]) for p in proof]
            for node, found in zip(own, proofs([x["leaf"] for x in own], n, upper, tree)):
                out["name"].append(node["name"])
                out["root"].append(top)
                out["higher"].append([dict(left=a.decode(), right=b.decode()) for a, b in found])
        yield out

    higher = map_rows(above.join(ends.drop("n"), ["tree", "part"]).select("nodes", "n", "top", "proof"), lift,
                      "name binary, root string, higher array<struct<left:string,right:string>>")
    higher = higher.select(F.col("name").cast("string").alias("source"), "root", "higher").alias("l").join(sizes.alias("r"), _same("l", "r", "source"))
    salts = buckets_for(docs)
    higher = salted(higher.select("l.*", "n"), F.ceil(F.col("n") / tree.part), salts).drop("n")
    higher = scratch.save(higher, "higher")
    upper = tops.withColumn("salt", F.pmod("part", F.lit(salts)).cast("int")).alias("l").join(higher.alias("r"), _same("l", "r", "source", "salt"))
    upper = upper.select(F.col("l.source"), "part", "top", "root", F.concat("proof", "higher").alias("upper"))

    def finish(cols) -> Iterator[dict]:
        for source, nodes, n, top, root, upper in zip(*[cols[c] for c in ("source", "nodes", "n", "top", "root", "upper")]):
            own, top, root = nodes.as_py(), top.as_py(), root.as_py()
            digests, folded = [], []
            for node, found in zip(own, proofs([x["leaf"] for x in own], n.as_py(), [(p["left"], p["right"]) for p in upper.as_py()], tree)):
                digests.append(hashlib.sha256(b"".join([a + b for a, b in found])).hexdigest())
                folded.append(fold(node["tampered"] or node["leaf"], found))
            size = len(own)
            yield dict(doc_id=[x["doc_id"] for x in own], source=[source.as_py()] * size, leaf=[x["leaf"].hex() for x in own], subroot=[top] * size,
                       root=[root] * size, proof_sha256=digests, folded_root=folded, verified=[f == root for f in folded])

    joined = parts.alias("l").join(upper.alias("r"), _same("l", "r", "source", "part"))
    return map_rows(joined.select(F.col("l.source"), "nodes", "n", "top", "root", "upper"), finish, OUT)


def _sql(doc_levels: int = 8, source_levels: int = 6) -> str:
    """The manifest as DuckDB SQL: each level is an aggregate of the one
    below. It holds for up to 16 ** levels leaves."""
    part = lambda c: f"case when {c} is null then '-' else octet_length(encode({c}::varchar)) || ':' || {c}::varchar end"
    leaf = lambda text: "sha256(" + " || ".join(map(part, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    ctes = [
        "t0 as (select i as b, i as c from range(256) r(i))",
        *[f"t{k + 1} as (select b, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end as c from t{k})" for k in range(8)],
        "crc as (select list(c order by b) as tab from t8)",
        "raw as (select *, ascii_bytes(doc_id::varchar) as bytes from documents)".replace("ascii_bytes(doc_id::varchar)", "list_transform(string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)"),
        """marked as (select *, case when doc_id is null then null else xor(4294967295, list_reduce(list_prepend(4294967295, bytes),
          lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) end as crc from raw, crc)""",
        f"""leaves as (select doc_id, source, {leaf('text')} as leaf, case when crc % 5 = 0 then
          {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} end as tampered from marked)""",
        """placed as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as i,
          count(*) over (partition by source) as n from leaves)""",
        "d0 as (select source, i, leaf as h from placed)",
    ]
    for k in range(doc_levels):
        ctes += [f"r{k} as (select source, i // 16 as i, string_agg(h, '' order by i) as run, count(*) as n from d{k} group by all)",
                 f"m{k} as (select source, count(*) as n from d{k} group by all)",
                 f"d{k + 1} as (select r.source, r.i, case when m.n > 1 then sha256(run) else run end as h from r{k} r join m{k} m on m.source is not distinct from r.source)"]
    top = doc_levels
    ctes += [f"s0 as (select source, h, row_number() over (order by encode(source) nulls first) - 1 as i from d{top})"]
    for k in range(source_levels):
        ctes += [f"q{k} as (select i // 16 as i, string_agg(h, '' order by i) as run from s{k} group by all)",
                 f"s{k + 1} as (select i, case when (select count(*) from s{k}) > 1 then sha256(run) else run end as h from q{k})"]
    # the proof and the fold climb one level in each step
    ctes += ["p0 as (select *, coalesce(tampered, leaf) as node, '' as proof from placed)"]
    climb = """case when more then sha256(left(run, 64 * pos) || node || substr(run, 64 * pos + 65)) else node end as node,
          case when more then proof || left(run, 64 * pos) || substr(run, 64 * pos + 65) else proof end as proof"""
    for k in range(doc_levels):
        ctes += [f"""p{k + 1} as (select doc_id, source, leaf, i, {climb} from (select p.*, r.run, ((p.i // {16 ** k}) % 16)::bigint as pos, m.n > 1 as more
          from (select doc_id, source, leaf, i, node, proof from p{k}) p join r{k} r on r.source is not distinct from p.source and r.i = p.i // {16 ** (k + 1)}
          join m{k} m on m.source is not distinct from p.source))"""]
    ctes += [f"u0 as (select p.doc_id, p.source, p.leaf, s.h as subroot, s.i, p.node, p.proof from p{top} p join s0 s on s.source is not distinct from p.source)"]
    for k in range(source_levels):
        ctes += [f"""u{k + 1} as (select doc_id, source, leaf, subroot, i, {climb} from (select u.*, q.run, ((u.i // {16 ** k}) % 16)::bigint as pos,
          (select count(*) from s{k}) > 1 as more from u{k} u join q{k} q on q.i = u.i // {16 ** (k + 1)}))"""]
    return "with " + ",\n".join(ctes) + f"""
select doc_id, source, leaf, subroot, h as root, sha256(proof) as proof_sha256, node as folded_root, node = h as verified
from u{source_levels}, s{source_levels} s"""


SQL = _sql()

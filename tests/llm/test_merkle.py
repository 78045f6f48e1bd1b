"""The manifest against a tree that is built and climbed node by node."""

import hashlib
import zlib
from collections import Counter

import pytest

from strata.llm import merkle
from strata.llm.common import prepare

COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc, source, lang, n, text):
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in (doc, source, lang, n, text)))


def climb(nodes, fanout):
    """The root, and of each node its siblings to the left and right by level."""
    place, found = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, p in enumerate(place):
            run = nodes[p // fanout * fanout:(p // fanout + 1) * fanout]
            found[i].append((run[:p % fanout], run[p % fanout + 1:]))
            place[i] = p // fanout
        nodes = [h("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
    return nodes[0], found


def brute(rows, fanout):
    out, trees, every = Counter(), {}, {}
    for source in {r[1] for r in rows}:
        mine = sorted((r for r in rows if r[1] == source), key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        every[source] = mine
        trees[source] = climb([leaf(*r) for r in mine], fanout)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    root, above = climb([trees[s][0] for s in order], fanout) if order else (None, [])
    for source, up in zip(order, above):
        subroot, found = trees[source]
        for r, own in zip(every[source], found):
            changed = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[4] is not None:
                changed = (*r[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4]))
            node = leaf(*changed)
            for left, right in own + up:
                node = h("".join([*left, node, *right]))
            proof = h("".join(x for left, right in own + up for x in left + right))
            out[r[0], leaf(*r), subroot, root, proof, node, node == root] += 1
    return out


def check(spark, rows, tree):
    prepare(spark)
    docs = spark.createDataFrame([(*r, "extra", "extra") for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, part string")
    got = merkle.manifest(docs.repartition(3), tree).collect()
    assert Counter(tuple(r[c] for c in COLUMNS) for r in got) == brute(rows, tree.fanout)


def sample(awkward, many=0):
    rows = [(d, (None, "", "b", "B", "é", "日本", "c")[i % 7], (None, "en")[i % 2], (None, i)[i % 3 > 0], t) for i, (d, t) in enumerate(awkward)]
    rows += [(i, "hot", "en", i, f"Text {i} ÀB") for i in range(many)]
    return rows + [(5, "hot", "en", 1, "Twice")] * 3 + [(5, "hot", "en", 1, "Other"), (-7, "hot", None, None, None)]


@pytest.mark.parametrize("fanout, depth, many", [(16, 3, 300), (2, 1, 45), (3, 2, 150), (4, 1, 64), (2, 2, 129)])
def test_trees_of_several_rounds(spark, awkward, fanout, depth, many):
    check(spark, sample(awkward, many), merkle.Tree(fanout, depth))


def test_many_sources_and_one_leaf(spark):
    check(spark, [(i, f"s{i}", "en", 1, "One") for i in range(40)], merkle.Tree(3, 1))
    check(spark, [(1, None, None, None, None)], merkle.Tree())


def test_empty_table(spark):
    check(spark, [], merkle.Tree())


def test_long_texts(spark):
    check(spark, [(i, "s", "en", None, "Ab " * 400_000) for i in range(3)], merkle.Tree())


def test_groups_of_a_round_hold_a_fanout_at_most(spark, scratch):
    """Partitions meet in groups of a fanout, whatever the tree holds, and every
    one of them ends with the same root."""
    from strata.scratch import Scratch
    tree, n = merkle.Tree(3, 1), 3 * 23
    nodes = [h(str(i)) for i in range(n)]
    rows = [("g", p, n, bytes.fromhex(h("".join(nodes[3 * p:3 * p + 3])))) for p in range(23)]
    out = merkle.butterfly(spark.createDataFrame(rows, "source string, part long, n long, root binary"), "source", tree, Scratch(spark, "test"), "swap").collect()
    root, found = climb(nodes, 3)
    assert len(out) == 23 and {r.top for r in out} == {root}
    for r in out:
        assert [(p.left, p.right) for p in r.proof] == [("".join(a), "".join(b)) for a, b in found[3 * r.part][1:]]
        assert all(len(p.left + p.right) <= 2 * 64 for p in r.proof)

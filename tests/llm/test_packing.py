"""Packing against the library's ids, one piece at a time."""

import struct
import zlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from strata.llm import packing, queries
from strata.llm.common import prepare

PATH = public_tokenizers.path("byte_bpe_50k.json")


def expected(rows, capacity):
    t = Tokenizer.from_file(PATH)
    out = Counter()
    for doc, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % capacity or min(len(ids), capacity)
        at, i = 0, 0
        while at < len(ids):
            part = ids[at:at + (capacity if i else first)]
            out[doc, i, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
            at, i = at + len(part), i + 1
    return out


def first_fit(pieces, capacity):
    """Sequences that first-fit decreasing needs."""
    room = []
    for length in sorted((k[3] for k in pieces.elements()), reverse=True):
        at = next((i for i, r in enumerate(room) if r >= length), None)
        if at is None:
            room.append(capacity - length)
        else:
            room[at] -= length
    return len(room)


def check(spark, rows, df, capacity):
    prepare(spark)
    got = packing.pack_digests(df, PATH, capacity).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected(rows, capacity)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(bins), sum(r.length for r in got)


@pytest.mark.parametrize("capacity", [1024, 37])
def test_awkward_documents(spark, table, awkward, capacity):
    bins, total = check(spark, awkward, table(awkward), capacity)
    assert bins <= 1.01 * first_fit(expected(awkward, capacity), capacity)


def test_small_table(spark, table, documents):
    bins, total = check(spark, documents, table(documents), 1024)
    assert bins <= 1.01 * first_fit(expected(documents, 1024), 1024) and bins <= 1.01 * total / 1024 + 1


def test_empty_table(spark, table):
    assert packing.pack_digests(table([]), PATH).collect() == []


def test_the_operator_returns_ids(spark, table):
    r = packing.pack(table([(1, "a b")]), PATH).collect()
    assert [x.length for x in r] == [len(r[0].ids) // 4] and r[0].ids.endswith(struct.pack("<I", 2))


def test_the_pipeline_and_the_query_pack_ids(spark, table, monkeypatch):
    rows = [(1, "a b c " * 900), (1, "a b c " * 900), (2, None), (None, "x")]
    last = corpus_pipeline.STAGES[-1][1](spark, table(rows), None).collect()
    got = Counter((r.doc_id, r.piece, r.start, len(r.ids) // 4, zlib.crc32(r.ids)) for r in last)
    assert got == expected(rows, 1024) and all(r.length == len(r.ids) // 4 for r in last)
    called = []
    monkeypatch.setattr(packing, "pack", lambda *a, f=packing.pack, **b: called.append(f(*a, **b)) or called[-1])
    out = queries.op1_best_fit_packing(spark, "/root/testdata/sf0.001")
    assert called and "ids" in called[0].columns and out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_fullest_is_the_largest_subset_sum():
    import itertools
    import random
    rng = random.Random(1)
    for _ in range(200):
        counts = Counter(rng.choices(range(1, 20), k=rng.randint(1, 7)))
        items = list(counts.elements())
        items.remove(max(items))
        best = max(max(counts) + sum(c) for k in range(len(items) + 1) for c in itertools.combinations(items, k) if max(counts) + sum(c) <= 25)
        found = packing.fullest(counts, 25)
        assert sum(k * v for k, v in found.items()) == best and all(counts[k] >= v for k, v in found.items())


def test_texts_are_encoded_whole(monkeypatch):
    """One call a text and no cache of words; the ids are the library's."""
    from strata.llm import tokens

    texts = ["", " ", "a  b \n c\t d e 　f\x1f g", " it's 12 o'clock,  don't\r\n\r\n ", "été 中文字 한 \U0001f600\U0001f600 ال", "x " * 3000,
             "a <|endoftext|> b", " ".join(f"w{i * 7919:x}" for i in range(5000))]
    bpe, library, calls = tokens.ByteBpe(PATH), Tokenizer.from_file(PATH), []
    encode = bpe.ranked.encode_ordinary
    monkeypatch.setattr(bpe.ranked, "encode_ordinary", lambda text: calls.append(text) or encode(text))
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode(text) == struct.pack(f"<{len(ids)}I", *ids), text[:40]
    assert calls == [t for t in texts if "<|" not in t]

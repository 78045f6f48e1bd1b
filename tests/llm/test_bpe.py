"""BPE against the tokenizers library, and the segment tree against a scan."""

import random

import public_tokenizers
from tokenizers import Tokenizer

from strata.llm import bpe, wordids
from strata.llm.common import prepare

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "  a b\n \n c  d ", "IT'S we'll 'S 'LL", "<|endoftext|> a b<|endoftext|>x <|startoftext|>", "x\u0085y \x1c z \x1f w\xa0q　r​s t\x1cu",
       "日本 語 ｶﾞ　 x 🎉 🎉", "a" * 5000, "1 2  3   4 \t 5 \r\n 6 12345 ½ ²", "ΣΑΣ ΟΔΟΣ Σ", "İstanbul ẞ ǅ ﬁ Å é <|ENDOFTEXT|> 힣 각", "don't can't they've I'm he'd ''' 'ſ", "\x00 \x07 ﻿ �"]


def library(texts):
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    ids = [t.encode(x or "", add_special_tokens=False).ids for x in texts]
    return [(i, t.decode(i, skip_special_tokens=False)) for i in ids]


def check(df, rows):
    prepare(df.sparkSession)
    got = sorted(((r.doc_id is None, r.doc_id, list(r.ids), r.decoded) for r in bpe.encode_documents(df, PATH).collect()), key=str)
    assert got == sorted(((d is None, d, *x) for (d, _), x in zip(rows, library([t for _, t in rows]))), key=str)


def test_awkward_documents(table, awkward):
    check(table(awkward), awkward)


def test_odd_characters(table):
    rows = list(enumerate(ODD))
    check(table(rows), rows)


def test_small_table(table, documents):
    check(table(documents), documents)


def test_empty_table(table):
    assert bpe.encode_documents(table([]), PATH).collect() == []


def test_tree_merges_the_leftmost_lowest_pair():
    rng = random.Random(3)
    for _ in range(300):
        pairs = [(a, b) for a in range(6) for b in range(6)]
        rng.shuffle(pairs)
        merges = {p: (r, 6 + r) for r, p in enumerate(pairs[:12])}
        merges |= {(6 + r, rng.randint(0, 5)): (20 + r, 40 + r) for r in range(6)}
        symbols = [rng.randint(0, 5) for _ in range(rng.randint(0, 30))]
        want = list(symbols)
        while True:
            found = [(merges[p][0], i) for i, p in enumerate(zip(want, want[1:])) if p in merges]
            if not found:
                break
            i = min(found)[1]
            want[i:i + 2] = [merges[want[i], want[i + 1]][1]]
        assert bpe.merge(symbols, bpe.packed(merges)) == want


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 5)
    coder = bpe.WordBpe(PATH)
    texts = ["one two three four five six seven eight nine ten one two"] * 2
    assert [coder.encode(t) for t in texts] == [i for i, _ in library(texts)]


def test_word_ids_equal_the_library(awkward, documents):
    texts = ODD + [t or "" for _, t in awkward + documents]
    for coder in (wordids.WordIds(PATH), bpe.WordBpe(PATH)):
        ids, edges, _ = coder.encode_batch(texts)
        assert [ids[a:b].tolist() for a, b in zip(edges, edges[1:])] == [i for i, _ in library(texts)]
        assert coder.encode_batch([])[0].tolist() == [] and coder.encode_batch([""])[1].tolist() == [0, 0]
    assert wordids.WordIds(PATH).coder is not None

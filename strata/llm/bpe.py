"""BPE encoding and decoding of whole texts (operator 3).

*Segment tree over adjacent pair ranks*: the symbols of a word are leaves, each
holding (merge rank, place) of the pair it begins; the root holds the smallest,
which is the leftmost pair of the lowest rank. Merging it changes three leaves,
each in logarithmic time, until no pair can be merged. So a word of n symbols
takes O(n log n), however long it is.

The vocabulary file is one of the ``tokenizers`` library, of the kind with word
ends: texts are normalised, split by its pattern, and each piece is a word.
Workers number the words they have seen, within a bound in bytes, and keep their
ids in one array, so the ids of a batch of texts are one gather from it.
"""

from __future__ import annotations

import array
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import map_rows
from strata.llm.tokens import byte_of_symbol

#: Bytes of the words and pieces that a worker keeps between batches.
CACHED = 256 << 20
#: Bytes that a kept word or piece, and a word's tokens, take beside their characters.
ENTRY, SHOWN = 160, 60

#: Characters that ``str.split`` takes for white space and the library doesn't.
NOT_SPACE = "\x1c\x1d\x1e\x1f"

_shared: dict[str, WordBpe] = {}


#: Bits of an id in a packed pair or merge, and what a tree holds where no
#: pair can be merged.
ID, NONE = 17, 1 << 62


def packed(merges: dict[tuple[int, int], tuple[int, int]]) -> dict[int, int]:
    """{(left, right): (rank, merged id)} with both sides as one integer."""
    return {a << ID | b: rank << ID | new for (a, b), (rank, new) in merges.items()}


def merge(symbols: list[int], merges: dict[int, int]) -> list[int]:
    """The ids left after all merges (``merges`` as ``packed``).

    ``tree`` is a segment tree as a heap: leaf ``size + i`` holds the rank and
    the place of the pair that begins at symbol ``i``, an inner node the smaller
    of its two, so the root is the leftmost pair of the lowest rank.
    """
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 2).bit_length()
    tree, into, get = [NONE] * (2 * size), [0] * n, merges.get
    left, any_pair = symbols[0], False
    for i in range(1, n):
        right = symbols[i]
        if (m := get(left << ID | right)) is not None:
            tree[size + i - 1] = m >> ID << 32 | i - 1
            into[i - 1] = m & (1 << ID) - 1
            any_pair = True
        left = right
    if not any_pair:
        return symbols
    for i in range(size - 1, 0, -1):
        a, b = tree[2 * i], tree[2 * i + 1]
        tree[i] = a if a < b else b
    after, before, symbols = list(range(1, n + 1)), list(range(-1, n - 1)), list(symbols)
    while (top := tree[1]) != NONE:
        at = top & 0xFFFFFFFF
        gone = after[at]
        symbols[at] = left = into[at]
        symbols[gone] = -1
        end = after[at] = after[gone]
        changed = [at]
        if end < n:
            before[end] = at
            tree[size + gone] = NONE
            changed.append(gone)
            m = get(left << ID | symbols[end])
        else:
            m = None
        if m is None:
            tree[size + at] = NONE
        else:
            tree[size + at] = m >> ID << 32 | at
            into[at] = m & (1 << ID) - 1
        if (prior := before[at]) >= 0:
            m = get(symbols[prior] << ID | left)
            if m is None:
                tree[size + prior] = NONE
            else:
                tree[size + prior] = m >> ID << 32 | prior
                into[prior] = m & (1 << ID) - 1
            changed.append(prior)
        for i in changed:
            i = size + i >> 1
            while i:
                a, b = tree[2 * i], tree[2 * i + 1]
                best = a if a < b else b
                if tree[i] == best:
                    break
                tree[i] = best
                i >>= 1
    return [s for s in symbols if s >= 0]


class Forest:
    """``merge`` for many short words at once: one segment tree per row of an
    array, so each step (read the roots, merge, update the changed leaves and
    the nodes above them) runs over all words that still have a pair."""

    #: Symbols of the longest word of each forest.
    SIZES = (8, 16, 32, 64)

    def __init__(self, merges: dict[int, int]):
        self.pairs = np.array(sorted(merges), np.int64)
        self.found = np.array([merges[k] for k in self.pairs.tolist()], np.int64)

    def _leaf(self, left: np.ndarray, right: np.ndarray, place) -> tuple[np.ndarray, np.ndarray]:
        """What the leaves of these pairs hold, and the ids they merge into."""
        pair = left << ID | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        hit, m = self.pairs[at] == pair, self.found[at]
        return np.where(hit & (right >= 0), m >> ID << 32 | place, NONE), m & (1 << ID) - 1

    def merge(self, words: list[list[int]]) -> list[list[int]]:
        """The ids left of words of at most SIZES[-1] symbols."""
        out: list = [None] * len(words)
        groups: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            groups.setdefault(next(s for s in self.SIZES if len(w) <= s), []).append(i)
        for size, rows in groups.items():
            for lo in range(0, len(rows), 20_000):
                part = rows[lo:lo + 20_000]
                for i, ids in zip(part, self._merge([words[i] for i in part], size)):
                    out[i] = ids
        return out

    def _merge(self, words: list[list[int]], size: int) -> list[list[int]]:
        n = np.array([len(w) for w in words])
        symbols = np.full((len(words), size + 1), -1, np.int64)
        symbols[np.arange(size + 1) < n[:, None]] = np.concatenate([np.array(w, np.int64) for w in words])
        after = np.tile(np.arange(1, size + 2), (len(words), 1))
        before = np.tile(np.arange(-1, size), (len(words), 1))
        tree = np.full((len(words), 2 * size), NONE, np.int64)
        tree[:, size:], into = self._leaf(symbols[:, :-1], symbols[:, 1:], np.arange(size))
        level = size
        while level > 1:
            tree[:, level // 2:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level //= 2
        rows = np.arange(len(words))
        while len(rows := rows[tree[rows, 1] != NONE]):
            at = tree[rows, 1] & 0xFFFFFFFF
            gone = after[rows, at]
            symbols[rows, at] = into[rows, at]
            symbols[rows, gone] = -1
            end = np.minimum(after[rows, gone], size)
            after[rows, at] = end
            before[rows, end] = at
            prior = before[rows, at]
            tree[rows, size + np.minimum(gone, size - 1)] = NONE
            changed = [(rows, np.minimum(gone, size - 1)), (rows, at)]
            tree[rows, size + at], into[rows, at] = self._leaf(symbols[rows, at], symbols[rows, end], at)
            some = prior >= 0
            r, p = rows[some], prior[some]
            tree[r, size + p], into[r, p] = self._leaf(symbols[r, p], symbols[r, at[some]], p)
            changed.append((r, p))
            for r, i in changed:
                i = size + i >> 1
                while size > 1 and i[0:1].any():
                    tree[r, i] = np.minimum(tree[r, 2 * i], tree[r, 2 * i + 1])
                    i = i >> 1
        return [[x for x in row if x >= 0] for row in symbols.tolist()]


class Numbers(dict):
    """Numbers of words from 0; a word that has none gets the next and is put on ``new``."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n


def _put(values: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """``values`` with ``more`` from place ``at``; it doubles when it is full."""
    while at + len(more) > len(values):
        values = np.concatenate([values, np.zeros_like(values)])
    values[at:at + len(more)] = more
    return values


class WordBpe:
    """Encoder and decoder of a vocabulary file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        pairs = [pair.split(" ") if isinstance(pair, str) else pair for pair in model["merges"]]
        symbol = {b: c for c, b in byte_of_symbol().items()}
        self.inner = [self.vocab[symbol[b]] for b in range(256)]
        self.last = [self.vocab[symbol[b] + self.end] for b in range(256)]
        self.prepare(pairs)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) + ")").split if self.added else None
        parts = spec["pre_tokenizer"]["pretokenizers"]
        self.find = regex.compile(next(p["pattern"]["Regex"] for p in parts if p["type"] == "Split")).findall
        self.names = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.added.items()}
        self.marks = NOT_SPACE + "".join({t[0] for t in self.added})
        self.clear()

    @classmethod
    def shared(cls, path: str) -> WordBpe:
        key = f"{cls.__name__} {path}"
        if key not in _shared:
            _shared[key] = cls(path)
        return _shared[key]

    def prepare(self, pairs: list) -> None:
        """Set up the merges of the file, the first of equal ones counts."""
        merges: dict = {}
        for rank, (a, b) in enumerate(pairs):
            merges.setdefault((self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        self.merges = packed(merges)
        self.forest = Forest(self.merges)

    def merged(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece: short ones in one forest, others by a tree each."""
        symbols = []
        for p in pieces:
            data = p.encode()
            ids = [self.inner[b] for b in data]
            ids[-1] = self.last[data[-1]]
            symbols.append(ids)
        short = [i for i, ids in enumerate(symbols) if len(ids) <= Forest.SIZES[-1]]
        for i, ids in zip(short, self.forest.merge([symbols[i] for i in short])):
            symbols[i] = ids
        for i in set(range(len(pieces))).difference(short):
            symbols[i] = merge(symbols[i], self.merges)
        return [array.array("I", ids).tobytes() for ids in symbols]

    def pieces(self, word: str) -> list[str]:
        """The pieces of a word by the file's pattern. Letters alone, and
        letters before a comma or a full stop, need no pattern."""
        if word.isalpha():
            return [word]
        if not word:   # what Arrow sees before white space at a text's beginning
            return []
        if word[-1] in ",." and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return self.find(word)

    def clear(self) -> None:
        """An empty table of words: their numbers, and by number the ids, as one
        array with the place where each word's begin, and the tokens."""
        self.words, self.held = Numbers(), 0
        self.known = {" " + t: array.array("I", [i]).tobytes() for t, i in self.added.items()}
        self.ids, self.starts = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)
        self.shown: list[str] = []

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, one after the other, and how many each has."""
        pieces = [[w] if w[:1] == " " else self.pieces(w) for w in words]
        fresh = list({p for ps in pieces for p in ps}.difference(self.known))
        known = self.known
        known.update(zip(fresh, self.merged(fresh)))
        self.held += ENTRY * len(fresh) + 4 * sum(map(len, fresh))
        found = [known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps]) for ps in pieces]
        return np.frombuffer(b"".join(found), "<u4"), np.fromiter(map(len, found), np.int64, len(found)) // 4

    def learn(self) -> None:
        """Fill in the ids of the words that got a number since the last time."""
        new, self.words.new = self.words.new, []
        if not new:
            return
        ids, counts = self.ids_of(new)
        first = len(self.words) - len(new)
        begin = int(self.starts[first])
        self.ids = _put(self.ids, begin, ids)
        self.starts = _put(self.starts, first + 1, begin + np.cumsum(counts))
        self.held += ENTRY * len(new) + 4 * sum(map(len, new)) + 4 * len(ids)

    def show(self) -> None:
        """Bring the words' tokens up to their ids."""
        names, first = self.names, len(self.shown)
        ends = self.starts[first:len(self.words) + 1].tolist()
        ids = [names[i] for i in self.ids[ends[0]:ends[-1]].tolist()]
        more = [" ".join(ids[a - ends[0]:b - ends[0]]) for a, b in zip(ends, ends[1:])]
        self.shown += more
        self.held += SHOWN * len(more) + sum(map(len, more))

    @staticmethod
    def normalise(text: str) -> str:
        """NFC, and lower case of each character by itself (``str.lower``
        looks around a capital sigma). White space only separates."""
        text = unicodedata.normalize("NFC", text)
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def _is_odd(self, text: str) -> bool:
        return any(c in text for c in NOT_SPACE) or any(t in text for t in self.added)

    def _odd_words(self, text: str) -> list[str]:
        """The words of a text with an added token, which is one that begins with a
        space, or with white space that ``str.split`` takes for it and the
        library doesn't, which separates pieces only."""
        odd = any(c in text for c in NOT_SPACE)
        words: list[str] = []
        for part in self.cut(text) if self.cut else [text]:
            if part in self.added:
                words.append(" " + part)
                continue
            part = self.normalise(part)
            words += self.find(part) if odd else part.split()
        return words

    def encode_batch(self, texts: list[str], shown: bool = False) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """(ids of all texts, where each text's begin and the last ones end,
        with ``shown`` the tokens of each text joined by a space)."""
        if self.held > CACHED:
            self.clear()
        # Arrow splits at the same white space as ``str.split`` and numbers the words
        # of the batch, so only different ones are looked up in the table.
        odd = {i: self._odd_words(t) for i, t in enumerate(texts) if any(c in t for c in self.marks) and self._is_odd(t)}
        split = pc.utf8_split_whitespace(pa.array(["" if i in odd else self.normalise(t) for i, t in enumerate(texts)], pa.large_string()))
        sizes, words = np.diff(split.offsets.to_numpy()).astype(np.int64), split.flatten()
        if odd:
            lists = [odd.get(i) for i in range(len(texts))]
            sizes = np.array([len(x) if x is not None else n for x, n in zip(lists, sizes)], np.int64)
            words = pa.concat_arrays([pa.array(x, words.type) if x is not None else y.values for x, y in zip(lists, split)])
        words = words.dictionary_encode()
        at = np.fromiter(map(self.words.__getitem__, words.dictionary.to_numpy(zero_copy_only=False)), np.int64, len(words.dictionary))[words.indices.to_numpy()]
        self.learn()
        start, count = self.starts[at], self.starts[at + 1] - self.starts[at]
        ends = np.concatenate([[0], np.cumsum(count)])
        ids = self.ids[np.repeat(start - ends[:-1], count) + np.arange(ends[-1])]
        edges = np.concatenate([[0], np.cumsum(sizes)])
        tokens: list[str] = []
        if shown:
            self.show()
            get = self.shown.__getitem__
            at[count == 0] = -1
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                part = at[a:b]
                tokens.append(" ".join(map(get, part[part >= 0].tolist())))
        return ids, ends[edges], tokens

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """The tokens of the ids, joined by one space, as the library gives
        them for a file without a decoder."""
        names = self.names
        return " ".join([names[i] for i in ids])


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, ids, decoded) of every row of ``docs``.

    ``ids`` are those of the tokenizers library without special tokens added,
    ``decoded`` its decoding of them with special tokens kept. Null and empty
    texts have no ids. A null doc_id stays null, repeated rows are repeated.
    """
    def run(cols) -> Iterator[dict]:
        bpe = WordBpe.shared(vocabulary)
        docs, texts, held = [], [], 0

        def done():
            ids, edges, tokens = bpe.encode_batch(texts, shown=True)
            return dict(doc_id=docs, ids=pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(ids.view(np.int32))), decoded=tokens)

        for doc, text in zip(cols["doc_id"].to_pylist(), cols["text"]):
            docs.append(doc)
            texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held > 4_000_000:
                yield done()
                docs, texts, held = [], [], 0
        yield done()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_rows(rows, run, "doc_id long, ids array<int>, decoded string")

"""Ids of a vocabulary with word ends, for operators that only consume them.

New words are encoded by merge rank with ``tiktoken``, several times as fast as
the segment trees of operator 3. A word's end is a line feed, which no word
holds; joining it to the word's last byte ranks before all merges.
"""

from __future__ import annotations

import numpy as np
import tiktoken

from strata.llm.bpe import WordBpe
from strata.llm.tokens import byte_of_symbol

END = b"\n"


class WordIds(WordBpe):
    """As ``WordBpe``. A file whose ids don't follow its merge order, or that
    makes two tokens of the same bytes, goes through its segment trees."""

    def prepare(self, pairs: list) -> None:
        of = byte_of_symbol()

        def raw(token: str) -> bytes:
            ends = bool(self.end) and token.endswith(self.end)
            return bytes(of[c] for c in (token[:-len(self.end)] if ends else token)) + END * ends
        ids = [self.vocab[a + b] for a, b in pairs]
        ranks = {bytes([b]): i for b, i in enumerate(self.inner) if b != END[0]}
        ranks |= {bytes([b]) + END: i for b, i in enumerate(self.last) if b != END[0]}
        base = len(ranks)
        ranks |= {raw(a + b): i for (a, b), i in zip(pairs, ids)}
        self.coder = None
        if not self.end or len(ranks) != base + len(pairs) or ids != sorted(set(ids)) or max(*self.inner, *self.last) > ids[0]:
            super().prepare(pairs)
            return
        ranks[END] = self.alone = max(ranks.values()) + 1   # an empty piece
        self.ends = np.zeros(self.alone + 1, bool)
        self.ends[[i for t, i in ranks.items() if t.endswith(END)]] = True
        self.coder = tiktoken.Encoding("words", pat_str=r"[^\n]*\n", mergeable_ranks=ranks, special_tokens={})

    def ids_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.coder is None:
            return super().ids_of(words)
        plain = [w.isalpha() for w in words]
        pieces, at = [], []   # all pieces, and how many a word has that is not letters alone
        for w, letters in zip(words, plain):
            if letters:
                pieces.append(w)
            elif w[:1] == " ":   # an added token: an empty piece holds its place
                pieces.append("")
                at.append(1)
            else:
                found = self.pieces(w)
                pieces += found
                at.append(len(found))
        count = np.ones(len(words), np.int64)
        count[~np.array(plain, bool)] = at
        ids = np.array(self.coder.encode_ordinary("\n".join(pieces) + "\n" if pieces else ""), np.uint32)
        ends = np.flatnonzero(self.ends[ids]) + 1                 # where each piece's ids end
        edges = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(count)])]
        ids[ids == self.alone] = [self.added[w[1:]] for w in words if w[:1] == " "]
        return ids, np.diff(edges)

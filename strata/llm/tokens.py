"""Byte-level BPE ids of whole texts."""

from __future__ import annotations

import array
import json

import tiktoken
from tokenizers import Tokenizer

#: Fixed value: the pattern of byte-level pre-tokenizers, whose tokens the merges stay within.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_shared: dict[str, ByteBpe] = {}


def byte_of_symbol() -> dict[str, int]:
    """The byte each printable stand-in of a byte-level vocabulary means:
    printable Latin-1 characters mean themselves, and the other bytes are
    the characters from 256 on, in order."""
    own = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """The ids that the ``tokenizers`` library gives for the vocabulary file
    at ``path`` without special tokens added.

    When the file's ids follow its merge order (rank = id), texts are encoded
    by rank with ``tiktoken``, which is several times as fast as the library;
    other files, and texts that hold an added token, go through the library
    itself. Texts are encoded whole: a cache of their words costs more than it
    saves where most words are rare, and memory.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ranked = self._by_rank(spec)

    def _by_rank(self, spec: dict) -> tiktoken.Encoding | None:
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        ids = [vocab.get(a + b, -1) for a, b in pairs]
        pre = spec.get("pre_tokenizer") or {}
        plain = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
        of = byte_of_symbol()
        if not plain or any(a >= b for a, b in zip(ids, ids[1:])) or any(vocab.get(s, len(vocab)) >= ids[0] for s in of):
            return None
        added = set(self.special)
        ranks = {bytes(of[c] for c in t): i for t, i in vocab.items() if t not in added}
        return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def shared(cls, path: str) -> ByteBpe:
        if path not in _shared:
            _shared[path] = cls(path)
        return _shared[path]

    def encode(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit integers."""
        if self.ranked is None or any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ranked.encode_ordinary(text)
        return array.array("I", ids).tobytes()

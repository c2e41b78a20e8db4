"""Byte-level BPE by backtracking over longest matches: exact merges in linear time.

An automaton finds, for each place of a piece, the longest vocabulary token that starts there. A token may follow
another only if merging by rank would leave the boundary between them; a table of pairs remembers the answers. If the
longest token doesn't fit, the next shorter one is tried; if none fits, the previous token is taken back.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKENIZERS = os.environ.get("THREADMILL_TOKENIZERS", "/opt/tokenizers")
BYTE_BPE = "byte_bpe_50k.json"
#: Pieces that a worker remembers. Beyond that number new pieces are encoded each time they occur.
#: Pairs of tokens whose compatibility a worker remembers.
KNOWN_PAIRS = 1 << 20
KNOWN_PIECES = 1 << 19


def byte_letters() -> dict[int, str]:
    """The printable letter of each byte in the vocabulary file: itself where it is printable, else the next letter from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class Bpe:
    def __init__(self, path: str):
        import ahocorasick
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = {c: b for b, c in byte_letters().items()}
        raw = lambda t: bytes(byte_of[c] for c in t).decode("latin-1")
        special = {t["content"] for t in spec.get("added_tokens", [])}
        vocab = spec["model"]["vocab"]
        self.id_of = {raw(t): i for t, i in vocab.items() if t not in special}
        size = max(self.id_of.values()) + 1
        self.text_of = [""] * size
        for t, i in self.id_of.items():
            self.text_of[i] = t
        # Decoding: all tokens in one run of bytes, and where each begins.
        self.bytes = "".join(self.text_of).encode("latin-1")
        self.offsets = [0]
        for t in self.text_of:
            self.offsets.append(self.offsets[-1] + len(t))
        # Merges: what a pair becomes, its rank, and what a token was made of. Ids need not follow ranks.
        self.pair: dict[tuple[int, int], tuple[int, int]] = {}
        self.made_of: dict[int, tuple[int, int]] = {}
        self.rank = [-1] * size
        for rank, m in enumerate(spec["model"]["merges"]):
            left, right = (raw(x) for x in (m.split(" ") if isinstance(m, str) else m))
            a, b, c = self.id_of[left], self.id_of[right], self.id_of[left + right]
            self.pair[a, b] = (rank, c)
            if c not in self.made_of:
                self.made_of[c], self.rank[c] = (a, b), rank
        self.auto = ahocorasick.Automaton()
        for t, i in self.id_of.items():
            self.auto.add_word(t, i)
        self.auto.make_automaton()
        self.shorter = self._shorter_prefixes()
        self.fits: dict[tuple[int, int], bool] = {}
        self.known: dict[str, tuple[int, ...]] = {}
        # Fixed value: the public pattern of this vocabulary's word splitting.
        self.split = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

    def _shorter_prefixes(self) -> list[int]:
        out = [-1] * len(self.text_of)
        for t, i in self.id_of.items():
            for n in range(len(t) - 1, 0, -1):
                j = self.id_of.get(t[:n])
                if j is not None:
                    out[i] = j
                    break
        return out

    def compatible(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            known = self._compatible(left, right)
            if len(self.fits) < KNOWN_PAIRS:
                self.fits[left, right] = known
        return known

    def _compatible(self, left: int, right: int) -> bool:
        """Undo the merges of both tokens, latest first; the boundary holds unless a merge across it would have come earlier
        than the merge that took its left or right neighbour away."""
        limit = 1 << 60
        while True:
            across = self.pair.get((left, right))
            if across is not None and across[0] < limit:
                return False
            rl, rr = self.rank[left], self.rank[right]
            if rl < 0 and rr < 0:
                return True
            if rl > rr:
                limit, left = rl, self.made_of[left][1]
            else:
                # of two merges of one rank the left one comes first, so the one across counts as earlier here
                limit, right = rr + 1, self.made_of[right][0]

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        """``piece``: bytes as latin-1."""
        whole = self.id_of.get(piece)
        if whole is not None and (len(piece) == 1 or whole in self.made_of):
            return (whole,)
        n = len(piece)
        longest = [-1] * n
        text_of = self.text_of
        for end, i in self.auto.iter(piece):
            start = end - len(text_of[i]) + 1
            if longest[start] < 0 or len(text_of[i]) > len(text_of[longest[start]]):
                longest[start] = i
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, longest[0]
        while True:
            size = len(text_of[token])
            end = at + size
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at == n:
                    return tuple(out)
                token = longest[at]
                continue
            short = self.shorter[token]
            if short >= 0:
                token = short
                continue
            dead[at] = 1
            token = out.pop()
            at -= len(text_of[token])
            # the token that led here is tried again one size shorter
            while self.shorter[token] < 0:
                dead[at] = 1
                token = out.pop()
                at -= len(text_of[token])
            token = self.shorter[token]

    def encode(self, text: str | None) -> list[int]:
        """Ids without special tokens; their strings in a text are ordinary text. None and empty: no ids."""
        if not text:
            return []
        out: list[int] = []
        known = self.known
        for piece in self.split.findall(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.encode_piece(piece.encode("utf-8", "replace").decode("latin-1"))
                if len(known) < KNOWN_PIECES and len(piece) < 64:
                    known[piece] = ids
            out += ids
        return out

    def decode(self, ids: list[int]) -> str:
        o, b = self.offsets, self.bytes
        return b"".join(b[o[i] : o[i + 1]] for i in ids).decode("utf-8", "replace")


_LOADED: dict[str, Bpe] = {}


def load(path: str) -> Bpe:
    """Once per worker process."""
    if path not in _LOADED:
        _LOADED[path] = Bpe(path)
    return _LOADED[path]


def encoder(folder: str = TOKENIZERS, name: str = BYTE_BPE):
    path = os.path.join(folder, name)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path)
        for s in batches:
            yield pd.Series([bpe.encode(t) for t in s], dtype=object)

    return encode


def counter(folder: str = TOKENIZERS, name: str = BYTE_BPE):
    path = os.path.join(folder, name)

    @F.pandas_udf("int")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path)
        for s in batches:
            yield pd.Series([len(bpe.encode(t)) for t in s], dtype="int32")

    return count


def decoder(folder: str = TOKENIZERS, name: str = BYTE_BPE):
    path = os.path.join(folder, name)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bpe = load(path)
        for s in batches:
            yield pd.Series([None if ids is None else bpe.decode(list(ids)) for ids in s], dtype=object)

    return decode


def encode(text: str | Column, folder: str = TOKENIZERS, name: str = BYTE_BPE) -> Column:
    """array<int> of each text, never NULL: NULL and empty texts give an empty array."""
    return encoder(folder, name)(F.col(text) if isinstance(text, str) else text)

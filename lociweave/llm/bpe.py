"""Byte-level BPE with a given vocabulary: exact encoding by backtracking over longest matches, and decoding.

A piece of text is cut into tokens from the left. At each place the longest token that fits is tried first, then
shorter ones; a token may follow its predecessor only if the two are what the merges make of their joined bytes.
That test looks at two tokens alone and its answers are kept, so a piece takes linear time: every place in it is
given up at most once. The tokens that begin at a place are found with an Aho-Corasick automaton, whose keys are
the tokens' bytes read as Latin-1.

Defined results: a null or empty text has no tokens and decodes to no bytes; characters without UTF-8 form
(lone surrogates) become "?"; rows with equal ids are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import struct

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import AT_ONCE, extended, kept, map_batches, text_of

#: Entries of a cache of pieces or of token pairs; the pieces seen last stay in one of two caches.
CACHE = 50_000


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks; a rank that the file lacks is empty."""
    with open(path, "rb") as lines:
        ranks = {int(b): base64.b64decode(a) for a, b in (line.split() for line in lines if line.strip())}
    return [ranks.get(i, b"") for i in range(max(ranks, default=-1) + 1)]


class Codec:
    """Encodes pieces and decodes ids; one for each Python worker."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.pieces = regex.compile(pattern).findall
        self.rank = {t.decode("latin-1"): i for i, t in enumerate(tokens) if t}
        self.text = [t.decode("latin-1") for t in tokens]
        self.width = [len(t) for t in tokens]
        self.machine = ahocorasick.Automaton()
        for t, i in self.rank.items():
            self.machine.add_word(t, i)
        self.machine.make_automaton()
        self.shorter = [self._longest_inside(t) for t in self.text]
        self.pairs: dict[int, bool] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _longest_inside(self, t: str) -> int:
        """The longest other token that t begins with, or -1."""
        for end in range(len(t) - 1, 0, -1):
            if (r := self.rank.get(t[:end])) is not None:
                return r
        return -1

    def parts(self, token: int) -> tuple[int, int]:
        """The two tokens that the last merge of a token joins; a token of one byte is its own part."""
        if (found := self.split.get(token)) is None:
            t = self.text[token]
            if len(t) == 1:
                found = (token, token)
            else:
                left, right = self._merged([self.rank[c] for c in t], token)
                found = (left, right)
            self.split[token] = found
        return found

    def _merged(self, ids: list[int], below: int) -> list[int]:
        """Merges by rank, only with ranks under the given one."""
        while len(ids) > 1:
            best, at = below, -1
            for k in range(len(ids) - 1):
                r = self.rank.get(self.text[ids[k]] + self.text[ids[k + 1]], below)
                if r < best:
                    best, at = r, k
            if at < 0:
                break
            ids[at:at + 2] = [best]
        return ids

    def fits(self, a: int, b: int) -> bool:
        """Whether the merges leave a and b side by side.

        The merges along the border are undone from the latest: if, at a time when both neighbours of the border
        exist and neither has yet been used up, their join has an earlier rank, it would have been made.
        """
        x, y, limit, ok = a, b, 1 << 40, True
        while True:
            joined = self.rank.get(self.text[x] + self.text[y])
            if joined is not None and joined < limit:
                ok = False
                break
            # whichever neighbour was made last is taken apart; of equal ones the right one, as merges go from the left
            if x > y:
                left, right = self.parts(x)
                if left != x or right != x:
                    limit, x = x, right
                    continue
                left, right = self.parts(y)
                if left == y and right == y:
                    break
                limit, y = y + 1, left
            else:
                left, right = self.parts(y)
                if left != y or right != y:
                    limit, y = y + 1, left
                    continue
                left, right = self.parts(x)
                if left == x and right == x:
                    break
                limit, x = x, right
        if len(self.pairs) > CACHE:
            self.pairs.clear()
        self.pairs[a << 32 | b] = ok
        return ok

    def cut(self, piece: bytes) -> list[int]:
        """The tokens of one piece."""
        s = piece.decode("latin-1")
        whole = self.rank.get(s)
        if whole is not None:
            return [whole]
        n = len(s)
        longest = [-1] * n
        width, shorter, pairs, fits = self.width, self.shorter, self.pairs, self.fits
        for end, r in self.machine.iter(s):  # ends ascend, so the last match of a start is its longest
            longest[end + 1 - width[r]] = r
        out: list[int] = []
        at, token, before, lost = 0, longest[0], -1, set()
        while True:
            while token >= 0:
                end = at + width[token]
                if end not in lost:
                    if before < 0:
                        break
                    ok = pairs.get(before << 32 | token)
                    if fits(before, token) if ok is None else ok:
                        break
                token = shorter[token]
            if token >= 0:
                out.append(token)
                if end == n:
                    return out
                at, before, token = end, token, longest[end]
            else:
                if before < 0:
                    raise ValueError("the vocabulary lacks a byte")
                lost.add(at)
                out.pop()
                at -= width[before]
                token = shorter[before]
                before = out[-1] if out else -1

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        get = self.recent.get
        out = []
        for p in self.pieces(text):
            ids = get(p)
            if ids is None:
                ids = self.older.get(p)
                if ids is None:
                    cut = self.cut(p.encode("utf-8", "replace"))
                    ids = struct.pack(f"<{len(cut)}I", *cut)
                if len(p) <= 64:
                    if len(self.recent) >= CACHE:
                        self.older, self.recent = self.recent, {}
                        get = self.recent.get
                    self.recent[p] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def _codec(shared) -> Codec:
    """The worker's codec for a broadcast vocabulary; workers are used again by later tasks."""
    tokens, pattern, key = shared.value
    return kept(key, lambda: Codec(tokens, pattern))


def _share(docs: DataFrame, path: str, pattern: str):
    tokens = read_ranks(os.fspath(path))
    key = hashlib.sha256(b"".join(len(t).to_bytes(4, "big") + t for t in tokens) + pattern.encode()).hexdigest()
    # a vocabulary file is a parameter of fixed size (about 0.5 MB), not data
    return docs.sparkSession.sparkContext.broadcast((tokens, pattern, key))


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, ids (binary, little-endian 32-bit) and decoded (binary) of every whole text."""
    shared = _share(docs, path, pattern)

    def make():
        codec = _codec(shared)

        def step(batch):
            ids = [codec.encode(t) for t in batch.column("_text").to_pylist()]
            cols = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(ids, pa.binary()), pa.array([codec.decode(i) for i in ids], pa.binary())],
                [*keep, "ids", "decoded"])
        return step

    rows = docs.select(*keep, text_of(text).alias("_text"))
    return map_batches(rows, make, extended(docs, keep, "ids binary, decoded binary"), AT_ONCE)

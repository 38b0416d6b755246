"""Repeated passages of words by prefix-partitioned suffix trees.

Suffixes of the texts' repeated stretches (see repeats.py) are dealt to tasks by the words at their anchor: by a prefix of SEED words, or,
where that prefix is too common, by all words of the window. Inside a task they are split again by prefixes that are
lengthened, a word at a time, until each group has GROUP suffixes at most or the prefix is a whole window. For each group
the suffixes are put in order and their common prefixes with their neighbours taken, which is its suffix tree in array form;
an inner node at depth LENGTH or more is a stretch of neighbours that share so much. Its leaves are the places of a
repeated window.

Defined results: words are runs of characters other than the six ASCII white spaces, unchanged; a text with fewer than LENGTH words,
empty, blank or null, loses nothing; occurrences in the same document count, overlapping ones too, and so do rows that repeat an id
or have none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from .repeats import Method, repeated_spans

LENGTH = 35
SEED = 8
GROUP = 1 << 15


def _numbers(contents: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words of all contents as numbers from 1, with a 0 after each content; and how many words follow from each place."""
    known: dict[bytes, int] = {}
    rows, left = [], []
    for c in contents:
        words = c.split(b" ")
        rows += [known.setdefault(w, len(known) + 1) for w in words]
        rows.append(0)
        left += range(len(words), -1, -1)
    return np.array(rows, np.int64), np.array(left, np.int64)


def prefix_groups(words: np.ndarray, at: np.ndarray, length: int = LENGTH, most: int = GROUP) -> list[tuple[np.ndarray, int]]:
    """Splits suffixes by their first words, with longer prefixes for larger groups; (places, prefix length) of groups with two or more."""
    out: list[tuple[np.ndarray, int]] = []
    todo = [(at, 0)]
    while todo:
        group, depth = todo.pop()
        if len(group) < 2:
            continue
        if len(group) <= most or depth == length:
            out.append((group, depth))
            continue
        key = words[group + depth]
        order = np.argsort(key, kind="stable")
        group, key = group[order], key[order]
        todo += [(part, depth + 1) for part in np.split(group, np.flatnonzero(key[1:] != key[:-1]) + 1)]
    return out


def _sorted_suffixes(words: np.ndarray, group: np.ndarray, depth: int, length: int) -> np.ndarray:
    """A group's suffixes in the order of their first `length` words: the last columns first, four words at a time."""
    order = np.arange(len(group))
    size = int(words.max(initial=0)) + 1
    per = max(1, min(4, int(62 // max(1, size.bit_length()))))
    for end in range(length, depth, -per):
        begin = max(depth, end - per)
        key = np.zeros(len(group), np.int64)
        for k in range(begin, end):
            key = key * size + words[group + k]
        order = order[np.argsort(key[order], kind="stable")]
    return group[order]


def common_prefixes(words: np.ndarray, suffixes: np.ndarray, depth: int, length: int) -> np.ndarray:
    """Words, up to `length`, that each suffix shares with the one before it; the first shares none."""
    out = np.full(len(suffixes), depth, np.int64)
    out[:1] = 0
    open_ = np.arange(1, len(suffixes))
    for k in range(depth, length):
        same = words[suffixes[open_] + k] == words[suffixes[open_ - 1] + k]
        open_ = open_[same]
        out[open_] = k + 1
    return out


def classes(contents: list[bytes]) -> np.ndarray:
    """A number for every window of every content in turn, equal for equal windows."""
    words, left = _numbers(contents)
    at = np.flatnonzero(left >= LENGTH)
    number = np.full(len(words), -1, np.int64)
    number[at] = np.arange(len(at))  # a window that shares a node with none is its own
    free = len(at)
    for group, depth in prefix_groups(words, at):
        suffixes = _sorted_suffixes(words, group, depth, LENGTH)
        deep = common_prefixes(words, suffixes, depth, LENGTH) >= LENGTH
        number[suffixes] = free + np.cumsum(~deep)
        free += len(suffixes) + 1
    return np.unique(number[at], return_inverse=True)[1]


def _symbols(text: str) -> tuple[np.ndarray, list[bytes]]:
    words = text.encode("utf-8", "replace").split()
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), words


METHOD = Method(length=LENGTH, seed=SEED, symbols=_symbols, content=lambda words, a, b: b" ".join(words[a:b]), classes=classes,
                size=lambda c: c.count(b" ") + 1, across=False)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, spans (first and end word of each removed run) and kept (the remaining words joined by a space) of every document."""
    from .bwt_merge import spans_of

    def finish(words: list[bytes], mask: np.ndarray) -> tuple:
        starts, ends = spans_of(mask)
        kept = b" ".join(w for w, gone in zip(words, mask.tolist()) if not gone)
        return len(words), [{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())], kept
    return repeated_spans(docs, METHOD, finish, "n_words long, spans array<struct<start: int, end: int>>, kept binary")

"""Substring duplicates by merging Burrows-Wheeler transforms of shards.

The repeated stretches of the collection (see repeats.py) are indexed in shards. Each shard's suffixes are ordered once, which
gives its transform: the symbols before each suffix, in the suffixes' order. The shards' transforms are merged without ordering
suffixes again: the merge is a row of shard numbers, the interleave. Reading it from the start, each entry yields the next
suffix of its shard and the symbols before that suffix, RUN at a time as the rank of their run; dealing the
entries out by these symbols, in order, is the interleave of the suffixes that much longer. Two neighbours in the new order share their longer beginning exactly if
their symbols are equal and no border lay between them before, so the blocks of suffixes with a common beginning of
LENGTH bytes come along with the refinement: they are the repeated intervals.

Defined results: bytes are those of the UTF-8 text; matches never cross documents; a text under LENGTH bytes, empty or null, loses
nothing; a null doc_id counts as larger than every other; rows that repeat an id don't remove each other's bytes, and lose
what smaller ids hold; equal texts under other ids lose all but the smallest id's; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from .repeats import Method, repeated_spans

LENGTH = 50
SEED = 20
SHARDS = 4
#: Symbols before a suffix that one round of the merge deals by; what is left over is dealt by eight or fewer.
RUN = 16


def _before_end(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every byte of the joined contents: its place in its content, and how many bytes from it to the content's end."""
    start = np.cumsum(sizes) - sizes
    place = np.arange(sizes.sum(), dtype=np.int64) - np.repeat(start, sizes)
    return place, np.repeat(sizes, sizes) - place


def _eight(text: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The eight bytes from every place as one number, zero beyond the content's end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)])
    out = np.ndarray(len(text), ">u8", padded, strides=(1,)).astype(np.uint64)
    near = np.flatnonzero(left < 8)
    beyond = (8 * (8 - left[near])).astype(np.uint64)
    out[near] = out[near] >> beyond << beyond
    return out


def _in_order(key: np.ndarray, bits: int, kind: str = "stable") -> tuple[np.ndarray, np.ndarray]:
    """Places in the order of keys below 2^bits, equal ones in turn, and the sorted keys. Key and place are sorted as one number where they fit."""
    own = len(key).bit_length()
    if bits + own > 64:
        order = np.argsort(key, kind=kind)
        return order, key[order]
    both = key.astype(np.uint64) << np.uint64(own) | np.arange(len(key), dtype=np.uint64)
    both.sort()
    return (both & np.uint64((1 << own) - 1)).astype(np.int32 if own < 32 else np.int64), both >> np.uint64(own)


def _ranks(key: np.ndarray, bits: int = 64) -> np.ndarray:
    """Ranks from 1; equal keys have equal ranks."""
    order, s = _in_order(key, bits, "quicksort")
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(np.concatenate([[True], s[1:] != s[:-1]]))
    return out


def _doubled(rank: np.ndarray, left: np.ndarray, step: int) -> np.ndarray:
    """Ranks of the suffixes by `step` more bytes than those that `rank` goes by."""
    n, size = len(rank), int(rank.max(initial=0)) + 1
    later = np.zeros(n, np.int64)
    later[:n - step] = np.where(left[:n - step] > step, rank[step:], 0)
    return _ranks(rank * size + later, (size * size).bit_length())


def suffix_order(rank: np.ndarray, left: np.ndarray, done: int, length: int) -> np.ndarray:
    """Places of a shard in the order of their first `length` bytes, by doubling, from ranks by their first `done` bytes."""
    while done < length:
        step = min(done, length - done)
        rank = _doubled(rank, left, step)
        done += step
    return _in_order(rank, int(rank.max(initial=0)).bit_length())[0]


def merged_blocks(contents: list[bytes], length: int = LENGTH, shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray]:
    """Places (in the joined contents) of all windows of `length` bytes in merged order, and the number of each one's block of equal windows."""
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    text = np.frombuffer(b"".join(contents), np.uint8)
    place, left = _before_end(sizes)
    eight = _eight(text, left)
    by_run = {8: _ranks(eight)}
    if length >= RUN:
        by_run[RUN] = _doubled(by_run[8], left, RUN - 8)
    depth = max(by_run)
    wide = max(1, min(8, (64 - len(text).bit_length()) // 8))

    # the shards: whole contents, each shard's suffixes in order, its transform beside them
    goal = np.arange(1, shards + 1) * len(text) / shards
    ends = np.unique(np.concatenate([np.cumsum(sizes)[np.minimum(np.searchsorted(np.cumsum(sizes), goal), len(sizes) - 1)]]))
    orders, a = [], 0
    for b in ends.tolist():
        orders.append(a + suffix_order(by_run[depth][a:b], left[a:b], depth, length))
        a = b
    own = np.concatenate(orders).astype(np.int32)
    shard = np.repeat(np.arange(len(orders), dtype=np.uint8), [len(o) for o in orders])
    inside, rest = place[own].astype(np.int32), left[own].astype(np.int32)

    # the first interleave is that of the suffixes' first bytes; entries whose suffix is shorter than the depth are over
    live = np.flatnonzero(rest >= depth).astype(np.int32)
    order, key = _in_order(by_run[depth][own[live]], len(text).bit_length())
    interleave = shard[live][order]
    border = np.concatenate([[True], key[1:] != key[:-1]])[:len(key)]
    while depth < length:
        if not len(interleave):
            break
        # the k-th entry of a shard in the interleave is the k-th of its suffixes
        turn = _in_turn(interleave, live, len(orders))
        block = np.cumsum(border, dtype=np.int32)
        step = max((k for k in by_run if k <= length - depth), default=min(wide, length - depth))
        can = np.flatnonzero(inside[turn] >= step)
        turn, block = turn[can], block[can]
        from_ = own[turn] - step
        if step in by_run:
            order, before = _in_order(by_run[step][from_], len(text).bit_length())
        else:
            order, before = _in_order(eight[from_] >> np.uint64(64 - 8 * step), 8 * step)
        block, interleave = block[order], shard[turn[order]]
        border = np.concatenate([[True], (before[1:] != before[:-1]) | (block[1:] != block[:-1])])[:len(before)]
        depth += step
        live = live[rest[live] >= depth]
    turn = _in_turn(interleave, live, len(orders))
    return own[turn].astype(np.int64), np.cumsum(border)


def _in_turn(interleave: np.ndarray, live: np.ndarray, shards: int) -> np.ndarray:
    """The suffixes that the entries stand for: `live` holds all shards' suffixes, one shard after the other."""
    turn = np.empty(len(live), np.int32)
    a = 0
    for k in range(shards):
        at = np.flatnonzero(interleave == k)
        turn[at] = live[a:a + len(at)]
        a += len(at)
    return turn


def classes(contents: list[bytes]) -> np.ndarray:
    """A number for every window of every content in turn, equal for equal windows."""
    sizes = np.fromiter(map(len, contents), np.int64, len(contents))
    at, block = merged_blocks(contents)
    out = np.full(int(sizes.sum()), -1, np.int64)
    out[at] = block - 1
    return out[_before_end(sizes)[1] >= LENGTH]


def _symbols(text: str) -> tuple[np.ndarray, bytes]:
    raw = text.encode("utf-8", "replace")
    return np.frombuffer(raw, np.uint8).astype(np.uint64), raw


METHOD = Method(length=LENGTH, seed=SEED, symbols=_symbols, content=lambda raw, a, b: raw[a:b], classes=classes, size=len, across=True)


def spans_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of a mask."""
    edge = np.diff(np.concatenate([[0], mask.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (start and end byte of each removed run) and kept (the remaining bytes) of every document."""
    def finish(raw: bytes, mask: np.ndarray) -> tuple:
        starts, ends = spans_of(mask)
        kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
        return len(raw), [{"start": a, "end": b} for a, b in zip(starts.tolist(), ends.tolist())], kept
    return repeated_spans(docs, METHOD, finish, "n_bytes long, spans array<struct<start: int, end: int>>, kept binary")

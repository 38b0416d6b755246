"""Fill-in-the-middle: every text is cut in three at two ranks, and its middle is moved to the end.

A text is a row of units: the pieces that begin where `unit` matches, left to right, with what lies between. The two cut
ranks, drawn from a digest of the id, count units; where they lie in code points is looked up in an indexable skip list.
Its bottom lane is the text itself, matched again from a known place; each lane above keeps about one node in 16 of the lane below,
and with it the width in units and in code points up to the next node. A descent adds up widths, lane by lane, and reaches
a rank in steps that grow with the logarithm of the text's length.

Defined results: a null text is an empty one; an empty text, and one that holds a mark, stays as it is (`plain`). A null
id is written as nothing. Rows that repeat are cut alike. Other columns only pass through `keep`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import extended, map_batches, text_of

CODE_POINT = r"(?s:.)"
WORD = r"[^\x20\x09-\x0D]+"
PREFIX, SUFFIX, MIDDLE = MARKS = "<P>", "<S>", "<M>"
#: Binary logarithm of the lanes' thinning.
THIN = 4


#: Units that are numbered at a time while lanes are made.
CHUNK = 1 << 18


@dataclass(frozen=True)
class Lane:
    """Nodes of one lane: the width from each to the next, in units and in code points, and the place of each in the lane below."""

    units: np.ndarray
    points: np.ndarray
    below: np.ndarray


def _heights(ranks: np.ndarray) -> np.ndarray:
    """Lanes above the bottom that the units of these ranks take part in: pseudo-random, the same for the same rank."""
    x = ranks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    lowest = x & (~x + np.uint64(1))
    return np.log2(np.maximum(lowest, 1).astype(np.float64)).astype(np.int64) // THIN


class SkipList:
    """Places of units in a text, by lanes of accumulated widths."""

    def __init__(self, text: str, unit: str = CODE_POINT):
        self.text, self.unit, self.single = text, re.compile(unit), unit == CODE_POINT
        ranks, places, heights = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [np.full(1, 64)]  # the head is in every lane
        self.n = 0
        for starts in self._chunks():
            own = np.arange(self.n, self.n + len(starts))
            high = _heights(own)
            up = np.flatnonzero((high > 0) & (own > 0))
            ranks.append(own[up])
            places.append(starts[up])
            heights.append(high[up])
            self.n += len(starts)
        rank, place, height = map(np.concatenate, (ranks, places, heights))
        self.lanes: list[Lane] = []
        below = rank  # the bottom lane is the text
        while len(rank) > 1 or not self.lanes:
            self.lanes.append(Lane(np.diff(rank, append=self.n), np.diff(place, append=len(text)), below))
            below = np.flatnonzero(height > len(self.lanes))
            rank, place, height = rank[below], place[below], height[below]

    def _chunks(self) -> Iterator[np.ndarray]:
        """Places where units start, some at a time; the first unit starts with the text."""
        if self.single:
            for at in range(0, len(self.text), CHUNK):
                yield np.arange(at, min(at + CHUNK, len(self.text)))
            return
        found = self.unit.finditer(self.text)
        first = True
        while len(some := np.fromiter((m.start() for m in islice(found, CHUNK)), np.int64)):
            if first:
                some[0], first = 0, False
            yield some

    def place(self, rank: int) -> int:
        """Code points before the unit of that rank; those of the whole text for the number of units."""
        if rank >= self.n:
            return len(self.text)
        units = points = node = 0
        for lane in reversed(self.lanes):
            while units + lane.units[node] <= rank:
                units += int(lane.units[node])
                points += int(lane.points[node])
                node += 1
            node = int(lane.below[node])
        if self.single or units == rank:
            return points + rank - units
        return next(islice(self.unit.finditer(self.text, points), rank - units, None)).start()


def draws(doc_id: int | None, seed: int) -> list[int]:
    """Four numbers from the digest of the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


@dataclass(frozen=True)
class Cut:
    n: int
    form: str
    prefix: str | None
    middle: str | None
    output: str


def cut(text: str, doc_id: int | None, unit: str = CODE_POINT, rate: int = 90, suffix_first: int = 20, seed: int = 1) -> Cut:
    """One text in its form: `rate` of 100 texts are rearranged, `suffix_first` of 100 of those with the suffix in front."""
    lanes = SkipList(text, unit)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= rate:
        return Cut(lanes.n, "plain", None, None, text)
    a, b = (lanes.place(r) for r in sorted((h1 % (lanes.n + 1), h2 % (lanes.n + 1))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < suffix_first:
        return Cut(lanes.n, "spm", prefix, middle, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle)
    return Cut(lanes.n, "psm", prefix, middle, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle)


def restore(output: str, form: str) -> str:
    """The text that was cut. A rearranged text holds no mark of its own, so the first of each kind is the one set."""
    if form == "plain":
        return output
    first, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    one, rest = output.removeprefix(first).split(second, 1)
    two, middle = rest.split(MIDDLE, 1)
    return one + middle + two if form == "psm" else two + middle + one


COLUMNS = "n long, form string, prefix_chars long, middle_chars long, output string, restored string"


def transform(docs: DataFrame, unit: str = CODE_POINT, rate: int = 90, suffix_first: int = 20, seed: int = 1,
              keep: tuple[str, ...] = ("doc_id",), id_column: str = "doc_id") -> DataFrame:
    """Columns `keep`, units (n), form, lengths of prefix and middle (code points), output and the text rebuilt from it, of every whole text."""
    def make():
        def step(batch):
            ids, texts = batch.column("_id"), batch.column("_text")
            size = max(1, len(texts) * (1 << 24) // max(1 << 24, texts.nbytes))  # outputs of a few megabytes at a time
            for at in range(0, len(texts), size):
                cuts = [cut(t, i, unit, rate, suffix_first, seed) for i, t in zip(ids[at:at + size].to_pylist(), texts[at:at + size].to_pylist())]
                length = lambda name: pa.array([None if (x := getattr(c, name)) is None else len(x) for c in cuts], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(at, size) for c in keep), pa.array([c.n for c in cuts], pa.int64()), pa.array([c.form for c in cuts], pa.string()),
                     length("prefix"), length("middle"), pa.array([c.output for c in cuts], pa.string()),
                     pa.array([restore(c.output, c.form) for c in cuts], pa.string())],
                    [*keep, "n", "form", "prefix_chars", "middle_chars", "output", "restored"])
        return step

    rows = docs.select(*keep, docs[id_column].cast("long").alias("_id"), text_of().alias("_text"))
    return map_batches(rows, make, extended(docs, keep, COLUMNS))

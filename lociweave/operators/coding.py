"""Coding and non-coding counts straight from blocks: windows become codes of 10 bits, counted by code and flag.

An informative window has equal flanks and two middles that agree, so it is one of 1,024 codes, and a block is one code for each
base of the outgroup. The merged features that meet a block are attached to its codes as ranges (few rows: ids and spans alone go through
the range join). Only blocks that may be met go through the exchange that attaches them; the others are counted where they are.
Sequences are read once for the spans and once for the codes, and no window is a row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import bases as B
from ..functions.coords import to_plus
from ..session import cut_lineage
from .intervals import BIN, merge_intervals, overlap_join
from .membership import flagged
from .windows import TRIO

GAP = ord("-")
#: Number of each base, upper or lower case; 4 for all other symbols.
_BASE = np.full(256, 4, np.int16)
_BASE[list(b"ACGTacgt")] = [0, 1, 2, 3] * 2
#: Windows of three columns by code: two bits each for the flanks, then for the middles of a, b and c.
CODES = 1 << 10
_WINDOWS = [pa.array(["ACGT"[k >> 8] + "ACGT"[k >> at & 3] + "ACGT"[k >> 6 & 3] for k in range(CODES)]) for at in (4, 2, 0)]
#: Columns whose windows are coded at a time, and sequences that are unpacked at a time.
CHUNK, ROWS = 1 << 20, 256


def column_runs(seq: str, start: int, begs: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Flat (first column, end column, 1 inside a range) of the runs that a block's columns fall into.

    begs, ends: sorted, disjoint ranges of bases; start: the base of the block's first one. A run begins at the
    first base of a range and at the first base after it; gap columns go with the base before them.
    """
    places = np.flatnonzero(np.frombuffer(seq.encode("latin-1", "replace"), np.uint8) != GAP)
    edges = np.column_stack((begs, ends)).ravel() - start
    if not len(places):
        return np.array([0, len(seq), 0], np.int64) if seq else np.empty(0, np.int64)
    cuts = np.where(edges < len(places), places[np.clip(edges, 0, len(places) - 1)], len(seq))
    cuts[edges <= 0] = 0
    bounds = np.concatenate(([0], cuts, [len(seq)]))
    flags = np.arange(len(bounds) - 1) % 2
    some = bounds[1:] > bounds[:-1]
    return np.column_stack((bounds[:-1], bounds[1:], flags))[some].astype(np.int64).ravel()


def base_codes(seqs: Sequence[np.ndarray], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every base of the first sequence, the code of the window around it, -1 where it isn't informative; bases of each block.

    seqs: the symbols of a, b and c of all blocks in turn; sizes: columns of each block.
    """
    ends = np.cumsum(sizes)
    edges = np.concatenate((ends - sizes, ends - 1))[np.tile(sizes > 0, 2)]  # no window has its middle there
    total, out = len(seqs[0]), []
    for lo in range(0, total, CHUNK):
        hi = min(lo + CHUNK, total)
        cut = slice(max(lo - 1, 0), min(hi + 1, total))
        a, b, c = (_BASE[q[cut]] for q in seqs)
        known = (a < 4) & (b < 4) & (c < 4)
        flank = known & (a == b) & (a == c)
        code = np.full(len(a), -1, np.int16)
        middle = known[1:-1] & flank[:-2] & flank[2:] & ((a == b) | (a == c))[1:-1]
        code[1:-1][middle] = (a[:-2] << 8 | a[2:] << 6 | a[1:-1] << 4 | b[1:-1] << 2 | c[1:-1])[middle]
        code[edges[(edges >= cut.start) & (edges < cut.stop)] - cut.start] = -1
        own = slice(lo - cut.start, hi - cut.start)
        out.append(code[own][seqs[0][lo:hi] != GAP])
    solid = np.concatenate(([0], np.cumsum(seqs[0] != GAP)))
    return np.concatenate(out) if out else np.empty(0, np.int16), np.diff(solid[np.concatenate(([0], ends))])


def _symbols(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = [t or "" for t in column.to_pylist()]
    return np.frombuffer("".join(texts).encode("latin-1", "replace"), np.uint8), np.fromiter(map(len, texts), np.int64, len(texts))


def _groups(batch: pa.RecordBatch, keys: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's group of equal keys, and the first row of each group."""
    seen: dict = {}
    of_row = [seen.setdefault(repr(t), (len(seen), i))[0] for i, t in enumerate(zip(*(batch.column(k).to_pylist() for k in keys)))] if keys else [0] * batch.num_rows
    return np.array(of_row, np.int64), np.array([first for _, first in seen.values()] or [0], np.int64)


def _counted(batch: pa.RecordBatch, columns: Sequence[str], keys: Sequence[str], codes: np.ndarray, bases: np.ndarray, flags: np.ndarray) -> list[pa.Array]:
    """Columns of one row of each group, then coding, win_a, win_b, win_c and n, for the codes of a batch's blocks."""
    group, first = _groups(batch, keys)
    at = (np.repeat(group, bases) * 2 + flags) * CODES + codes
    at = at[codes >= 0]
    if len(first) * 2 * CODES <= max(len(at), 1 << 16):
        n = np.bincount(at, minlength=1)
        found = np.flatnonzero(n)
        n = n[found]
    else:
        found, n = np.unique(at, return_counts=True)
    rows, code = pa.array(first[found // (2 * CODES)]), pa.array(found % CODES)
    return [*(batch.column(c).take(rows) for c in columns), pa.array(found // CODES % 2 == 1), *(w.take(code) for w in _WINDOWS), pa.array(n, pa.int64())]


_COUNTS = "coding boolean, win_a string, win_b string, win_c string, n long"


def _coded(aln: DataFrame, keys: Sequence[str], key: str) -> DataFrame:
    """keys, key, start_a, _codes of blocks that are `_maybe` met; the others' counts, under the key of one of them."""
    rows = aln.select(*dict.fromkeys((*keys, key)), F.col("start_a").cast("long").alias("start_a"), *[f"seq_{s}" for s in TRIO], "_maybe")
    kept = list(dict.fromkeys((*keys, key, "start_a")))
    schema = T.StructType([*rows.select(*kept).schema.fields, T.StructField("_codes", T.BinaryType()), *T.StructType.fromDDL(_COUNTS).fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                batch = whole.slice(k, ROWS)
                seqs, sizes = zip(*(_symbols(batch.column(f"seq_{s}")) for s in TRIO))
                if any((n != sizes[0]).any() for n in sizes[1:]):
                    raise ValueError("aligned sequences of one block differ in length")
                codes, bases = base_codes(seqs, sizes[0])
                maybe = np.array(batch.column("_maybe").to_pylist(), bool)
                near = batch.filter(pa.array(maybe))
                if near.num_rows:
                    ends = np.cumsum(bases)
                    packed = pa.array([codes[e - n:e].tobytes() for e, n in zip(ends[maybe], bases[maybe])], pa.binary())
                    yield pa.RecordBatch.from_arrays([*(near.column(c) for c in kept), packed, *(pa.nulls(near.num_rows, t) for t in (pa.bool_(), *[pa.string()] * 3, pa.int64()))], names)
                far = batch.filter(pa.array(~maybe))
                if far.num_rows:
                    own = codes[np.repeat(~maybe, bases)]
                    columns = _counted(far, kept, keys, own, bases[~maybe], np.zeros(len(own), np.int64))
                    yield pa.RecordBatch.from_arrays([*columns[:len(kept)], pa.nulls(len(columns[-1]), pa.binary()), *columns[len(kept):]], names)

    return rows.mapInArrow(run, schema)


def _in_ranges(batch: pa.RecordBatch, bases: np.ndarray) -> np.ndarray:
    """1 for each base of the blocks, in turn, that lies in one of its block's ranges."""
    before, edges = 0, []
    for start, b, e, n in zip(batch.column("start_a").to_pylist(), batch.column("_begs"), batch.column("_ends"), bases):
        if b.is_valid and len(b):
            edges.append(np.clip(np.column_stack((b.values.to_numpy(), e.values.to_numpy())).ravel() - start, 0, n) + before)
        before += n
    return np.searchsorted(np.concatenate(edges), np.arange(before), side="right") & 1 if edges else np.zeros(before, np.int64)


def block_ranges(aln: DataFrame, merged: DataFrame, key: str = "block_id", bin_size: int = BIN) -> DataFrame:
    """key, _begs, _ends: the merged ranges that meet a block, in the coordinates of its own strand, ordered."""
    bases = F.length(F.translate("seq_a", "-", "")).cast("bigint")
    lo, hi = to_plus(F.col("start_a"), F.col("start_a") + bases, F.col("strand_a"), F.col("len_a"))
    # coalesce keeps the join from testing spans for null at the scan, which would measure every sequence twice
    spans = aln.select(key, F.col("chr_a").alias("chr"), F.coalesce(lo, F.lit(-1)).cast("bigint").alias("start"), F.coalesce(hi, F.lit(-1)).cast("bigint").alias("end"),
                       F.when(F.col("strand_a") == "-", F.col("len_a")).alias("_flip"))
    met = overlap_join(cut_lineage(spans), cut_lineage(merged), "r_", bin_size)  # narrow rows, read twice: sequences are measured once
    own = F.when(F.col("_flip").isNull(), F.struct(F.col("r_start").alias("b"), F.col("r_end").alias("e"))).otherwise(
        F.struct((F.col("_flip") - F.col("r_end")).alias("b"), (F.col("_flip") - F.col("r_start")).alias("e")))
    return met.groupBy(key).agg(F.sort_array(F.collect_list(own)).alias("_r")).select(key, F.col("_r.b").alias("_begs"), F.col("_r.e").alias("_ends"))


def coding_window_counts(aln: DataFrame, features: DataFrame, keys: Sequence[str] = (), key: str = "block_id", bin_size: int = BIN) -> DataFrame:
    """keys, win_a, win_b, win_c, coding, n: informative windows by whether the middle base of the outgroup lies in a feature."""
    ranges = cut_lineage(block_ranges(aln, merge_intervals(features.select("chr", "start", "end")), key, bin_size))
    rows = _coded(flagged(aln, ranges.select(key), key), keys, key).join(ranges, key, "left")
    rows = rows.select(*keys, "start_a", "_codes", "_begs", "_ends", "coding", *[f"win_{s}" for s in TRIO], "n")
    schema = T.StructType([*rows.select(*keys).schema.fields, *T.StructType.fromDDL(_COUNTS).fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            done = whole.column("_codes").is_null()
            yield whole.filter(done).select(names)
            met = whole.filter(whole.column("_codes").is_valid())
            for k in range(0, met.num_rows, ROWS):
                batch = met.slice(k, ROWS)
                packed = batch.column("_codes").to_pylist()
                bases = np.fromiter(map(len, packed), np.int64, len(packed)) // 2
                codes = np.frombuffer(b"".join(packed), np.int16)
                yield pa.RecordBatch.from_arrays(_counted(batch, keys, keys, codes, bases, _in_ranges(batch, bases)), names)

    counts = rows.mapInArrow(run, schema).groupBy(*keys, "coding", *[f"win_{s}" for s in TRIO]).agg(F.sum("n").alias("n"))
    return counts.select(*keys, *[f"win_{s}" for s in TRIO], "coding", "n")


def coding_split_of_blocks(aln: DataFrame, features: DataFrame, keys: Sequence[str] = (), key: str = "block_id", bin_size: int = BIN) -> DataFrame:
    """keys, species, kind ('s' or 'o'), label, cds, ncds, as `intervals.coding_split` gives them from sites, without making the sites."""
    raw = coding_window_counts(aln, features, keys, key, bin_size)
    changed = lambda s: F.when(B.base_at("win_a", 2) != B.base_at(f"win_{s}", 2), B.sbst_label("win_a", B.base_at(f"win_{s}", 2)))
    row = lambda sp, kind, label: F.struct(F.lit(sp).alias("species"), F.lit(kind).alias("kind"), label.alias("label"))
    each = raw.select(*keys, "coding", "n", F.inline(F.array(
        row("B", "o", B.canon_tri("win_a")), row("C", "o", B.canon_tri("win_a")), row("B", "s", changed("b")), row("C", "s", changed("c")))))
    part = lambda flag: F.sum(F.when((F.col("coding") == flag) & F.col("label").isNotNull(), F.col("n")).otherwise(0)).cast("bigint")
    out = each.groupBy(*keys, "species", "kind", "label").agg(part(True).alias("cds"), part(False).alias("ncds"))
    return out.where("label is not null")

"""Per-site substitution tables with genome coordinates.

A site's coordinate needs the number of bases before its column in each species.
Windows of interest hold only A, C, G, T, so blocks are first cut into runs of columns
where all species have one of the four; inside a run, offset = run offset + position.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import bases as B
from ..functions.coords import to_plus
from .windows import LONG, TRIO

GAP = ord("-")
_BASE = np.zeros(256, bool)
_BASE[[ord(c) for c in "ACGTacgt"]] = True


def base_runs(seqs: Sequence[str]) -> np.ndarray:
    """Flat int array (column, length, bases before it in each sequence) per run of plain bases."""
    codes = np.stack([np.frombuffer(s.encode("latin-1", "replace"), np.uint8) for s in seqs])
    whole = np.concatenate(([False], _BASE[codes].all(axis=0), [False]))
    edges = np.flatnonzero(whole[1:] != whole[:-1])
    begin, end = edges[::2], edges[1::2]
    before = np.concatenate((np.zeros((len(seqs), 1), np.int64), (codes != GAP).cumsum(axis=1)), axis=1)
    return np.column_stack((begin, end - begin, before[:, begin].T)).astype(np.int64).ravel()


@F.pandas_udf(T.ArrayType(T.LongType()))
def _runs3(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
    return pd.Series([base_runs(t) for t in zip(a, b, c)])


# kept where it is: as a deterministic call it would be repeated in null filters at the scan
_runs3 = _runs3.asNondeterministic()


def base_segments(aln: DataFrame, keep: Sequence[str] = (), shortest: int = 1) -> DataFrame:
    """Runs of at least `shortest` columns: keep, `seg_col`, and per side the bytes `_b_x` and `off_x`."""
    fields = 2 + len(TRIO)
    runs = aln.select(
        *keep, *[F.upper(F.col(f"seq_{s}")).cast("binary").alias(f"_s_{s}") for s in TRIO],
        _runs3("seq_a", "seq_b", "seq_c").alias("_runs"))
    each = runs.select(
        *keep, *[f"_s_{s}" for s in TRIO], "_runs",
        F.explode(F.when(F.size("_runs") > 0, F.sequence(F.lit(0), F.size("_runs") - fields, F.lit(fields)))).alias("_k"))
    at = lambda i: F.get("_runs", F.col("_k") + i)
    return each.where(at(1) >= shortest).select(
        *keep,
        at(0).alias("seg_col"),
        *[F.substring(F.col(f"_s_{s}"), (at(0) + 1).cast("int"), at(1).cast("int")).alias(f"_b_{s}") for s in TRIO],
        *[at(2 + i).alias(f"off_{s}") for i, s in enumerate(TRIO)],
    )


def located_windows(aln: DataFrame, width: int, keep: Sequence[str] = ()) -> DataFrame:
    """ACGT-only windows with `col` (0-based block column) and `off_x` (bases before the window)."""
    seg = base_segments(aln, keep, width)
    positions = F.sequence(F.lit(1), F.length("_b_a") - (width - 1))
    w = seg.select(*keep, "seg_col", *[f"_b_{s}" for s in TRIO], *[f"off_{s}" for s in TRIO],
                   F.explode(positions).alias("_i"))
    return w.select(
        *keep,
        (F.col("seg_col") + F.col("_i") - 1).alias("col"),
        *[F.substring(F.col(f"_b_{s}"), F.col("_i"), F.lit(width)).cast("string").alias(f"win_{s}") for s in TRIO],
        *[(F.col(f"off_{s}") + F.col("_i") - 1).alias(f"off_{s}") for s in TRIO],
    )


def site_windows(seqs: Sequence[str], width: int, changed: bool) -> np.ndarray:
    """Flat int array (column, bases before it in each sequence) per informative window: ACGT only, equal flanks, outgroup's inner
    bases shared with an ingroup. With `changed`, only where the other ingroup's differ."""
    codes = np.stack([np.frombuffer(s.encode("latin-1", "replace"), np.uint8) for s in seqs])
    at, gaps = _informative(codes, width, changed)
    return np.column_stack((at, (at - gaps[:, at]).T)).astype(np.int64).ravel()


def _informative(codes: np.ndarray, width: int, changed: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start columns of informative windows, and for each sequence and column the gaps before it."""
    gap = codes == GAP
    gaps = gap.cumsum(axis=1, dtype=np.int32) - gap
    starts = codes.shape[1] - width + 1
    if starts < 1:
        return np.zeros(0, np.int64), gaps
    whole, letter = _BASE[codes].all(axis=0), codes & 0xDF  # upper case; compared at bases only
    with_b, with_c = letter[0] == letter[1], letter[0] == letter[2]
    every = lambda mask, first, n: np.all([mask[first + i:first + i + starts] for i in range(n)], axis=0)
    same = with_b & with_c
    fits = every(whole, 0, width) & every(same, 0, 1) & every(same, width - 1, 1)
    b, c = every(with_b, 1, width - 2), every(with_c, 1, width - 2)
    return np.flatnonzero(fits & ((b != c) if changed else (b | c))), gaps


#: Columns of blocks that are looked at together, and what parts them; no window lies over it.
AT_ONCE, BETWEEN = 1 << 18, "#"


def _parts(batch: pa.RecordBatch, width: int) -> Iterator[tuple[int, int, list[int], list[str]]]:
    """(row, first column, bases before it in each sequence, sequences) of blocks in parts of LONG windows; a block without a sequence has none."""
    for row, seqs in enumerate(zip(*(batch.column(f"seq_{s}").to_pylist() for s in TRIO))):
        if any(q is None for q in seqs):
            continue
        if any(len(q) != len(seqs[0]) for q in seqs):
            raise ValueError("aligned sequences of one block differ in length")
        before = [0] * len(seqs)
        for lo in range(0, len(seqs[0]) - width + 1, LONG):
            yield row, lo, list(before), [q[lo:lo + LONG + width - 1] for q in seqs]
            before = [n + len(q[lo:lo + LONG]) - q.count("-", lo, lo + LONG) for n, q in zip(before, seqs)]


def _site_batches(batch: pa.RecordBatch, keep: Sequence[str], width: int, changed: bool) -> Iterator[pa.RecordBatch]:
    """keep, _col, _off, _s_x and _w of parts of blocks: first column, bases before it, symbols in upper case, and for each window in the
    part its column and the bases before it. A batch holds what AT_ONCE columns give, or one part."""
    names = [*keep, "_col", "_off", *[f"_s_{s}" for s in TRIO], "_w"]

    def made(parts) -> pa.RecordBatch:
        rows, cols, before, seqs = zip(*parts)
        sizes = np.fromiter((len(q[0]) + 1 for q in seqs), np.int32, len(seqs))
        bounds = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
        codes = np.stack([np.frombuffer("".join(q[k] + BETWEEN for q in seqs).encode("latin-1", "replace"), np.uint8) for k in range(len(TRIO))])
        at, gaps = _informative(codes, width, changed)
        part = np.searchsorted(bounds, at, side="right") - 1
        first = bounds[part]
        column = at - first
        windows = np.column_stack((column, (column - gaps[:, at] + gaps[:, first]).T)).astype(np.int32).ravel()
        ends = np.concatenate(([0], np.cumsum(np.bincount(part, minlength=len(seqs))))) * (1 + len(TRIO))
        upper = codes & 0xDF
        return pa.RecordBatch.from_arrays([
            *(batch.column(c).take(pa.array(rows)) for c in keep), pa.array(cols, pa.int64()), pa.array(before, pa.list_(pa.int64())),
            *(pa.Array.from_buffers(pa.binary(), len(seqs), [None, pa.py_buffer(bounds.tobytes()), pa.py_buffer(u.tobytes())]) for u in upper),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(windows))], names)

    held, size = [], 0
    for part in _parts(batch, width):
        if held and size + len(part[3][0]) > AT_ONCE:
            yield made(held)
            held, size = [], 0
        held.append(part)
        size += len(part[3][0])
    if held:
        yield made(held)


def informative_windows(aln: DataFrame, width: int, keep: Sequence[str] = (), changed: bool = False) -> DataFrame:
    """The informative ones of `located_windows`, with the same columns; other columns of a block are never rows.

    Windows are listed for parts of blocks, some megabytes at a time, so memory depends neither on a block's length nor on the rows of a batch.
    """
    fields = 1 + len(TRIO)
    blocks = aln.select(*dict.fromkeys(keep), *[f"seq_{s}" for s in TRIO])
    kept = blocks.select(*dict.fromkeys(keep))
    schema = T.StructType([*kept.schema.fields, *T.StructType.fromDDL(
        "_col long, _off array<long>, " + ", ".join(f"_s_{s} binary" for s in TRIO) + ", _w array<int>").fields])

    columns = kept.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _site_batches(batch, columns, width, changed)

    each = blocks.mapInArrow(run, schema).select(
        "*", F.explode(F.when(F.size("_w") > 0, F.sequence(F.lit(0), F.size("_w") - fields, F.lit(fields)))).alias("_k"))
    at = lambda i: F.get("_w", F.col("_k") + i)
    return each.select(
        *keep, (F.col("_col") + at(0)).alias("col"),
        *[F.substring(F.col(f"_s_{s}"), at(0) + 1, F.lit(width)).cast("string").alias(f"win_{s}") for s in TRIO],
        *[(F.get("_off", F.lit(i)) + at(1 + i)).alias(f"off_{s}") for i, s in enumerate(TRIO)])


_PLACE = [f"{f}_{s}" for s in TRIO for f in ("chr", "start", "strand", "len")]


def _span(side: str, width: int, coords: str) -> tuple[Column, Column]:
    """Forward-strand span of the bases inside the flanks."""
    start, strand, length = F.col(f"start_{side}"), F.col(f"strand_{side}"), F.col(f"len_{side}")
    if coords == "base":
        first = start + F.col(f"off_{side}") + 1
        return to_plus(first, first + (width - 2), strand, length)
    if coords == "column":  # older convention: gapped column index, block start flipped only
        first = F.when(strand == "-", length - start).otherwise(start) + F.col("col") + 1
        return first, first + (width - 2)
    raise ValueError("coords is 'base' or 'column'")


def _place_columns(width: int, coords: str, text) -> list[Column]:
    out = []
    for s in TRIO:
        u = s.upper()
        b, e = _span(s, width, coords)
        out += [F.col(f"chr_{s}").alias(f"chr{u}"), b.alias(f"start{u}"), e.alias(f"end{u}"),
                F.col(f"strand_{s}").alias(f"strand{u}"), text(s).alias(f"trinuc{u}")]
    return out


def sbst_sites(aln: DataFrame, keep: Sequence[str] = (), coords: str = "base") -> DataFrame:
    """Sites changed in exactly one ingroup, 15 columns."""
    mids = [B.base_at(f"win_{s}", 2) for s in TRIO]
    w = informative_windows(aln, 3, [*keep, *_PLACE], changed=True).where(B.site_class(*mids).isin("B", "C"))
    return w.select(*keep, *_place_columns(3, coords, lambda s: F.col(f"win_{s}")))


def counted_sites(aln: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every counted site once: 15 columns, oriType, sbstB and sbstC ('.' if unchanged)."""
    w = informative_windows(aln, 3, [*keep, *_PLACE])
    changed = lambda s: F.when(B.base_at("win_a", 2) != B.base_at(f"win_{s}", 2),
                               B.sbst_label("win_a", B.base_at(f"win_{s}", 2))).otherwise(F.lit("."))
    return w.select(*keep, *_place_columns(3, "base", lambda s: F.col(f"win_{s}")),
                    B.canon_tri("win_a").alias("oriType"), changed("b").alias("sbstB"), changed("c").alias("sbstC"))


def all_sites(aln: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Every counted site once per ingroup: `species`, 15 columns, oriType, sbstType ('.' if unchanged)."""
    sites = counted_sites(aln, keep)
    return sites.select(
        *[c for c in sites.columns if c not in ("sbstB", "sbstC")],
        F.inline(F.array(F.struct(F.lit("B").alias("species"), F.col("sbstB").alias("sbstType")),
                         F.struct(F.lit("C").alias("species"), F.col("sbstC").alias("sbstType")))))


def doublet_sites(aln: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Doublets with both bases changed in an ingroup; spans cover the two bases."""
    mid = lambda s: F.substring(F.col(f"win_{s}"), 2, 2)
    w = informative_windows(aln, 4, [*keep, *_PLACE], changed=True)
    label = lambda s: F.when(B.both_bases_differ(mid("a"), mid(s)), F.concat(mid("a"), F.lit(">"), mid(s)))
    w = w.withColumn("_b", label("b")).withColumn("_c", label("c")).where("_b is not null or _c is not null")
    sites = w.select(*keep, *_place_columns(4, "base", mid), "_b", "_c")
    return sites.select(
        *[c for c in sites.columns if c not in ("_b", "_c")],
        F.inline(F.array(F.struct(F.lit("B").alias("species"), F.col("_b").alias("sbstType")),
                         F.struct(F.lit("C").alias("species"), F.col("_c").alias("sbstType")))),
    ).where("sbstType is not null")


def split_sites(sites: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Site table -> one row in the changed species: species, chr, start, end, name, score, strand, sbstSig.

    A row that is not a one-species change is an error.
    """
    mids = [B.base_at(f"trinuc{u}", 2) for u in "ABC"]
    valid = B.flanks_equal("trinucA", "trinucB", "trinucC")
    cls = F.when(valid, B.site_class(*mids))
    species = F.when(cls.isin("B", "C"), cls).otherwise(
        F.raise_error(F.concat(F.lit("not a one-species change: "), F.concat_ws(" ", "trinucA", "trinucB", "trinucC"))))
    pick = lambda c: F.when(F.col("species") == "B", F.col(f"{c}B")).otherwise(F.col(f"{c}C"))
    return sites.withColumn("species", species).select(
        *keep, "species", pick("chr").alias("chr"), pick("start").alias("start"), pick("end").alias("end"),
        F.lit(".").alias("name"), F.lit(".").alias("score"), pick("strand").alias("strand"),
        B.majority_label("trinucA", "trinucB", "trinucC").alias("sbstSig"))

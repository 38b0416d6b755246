"""Sliding windows over alignment columns and genome sequences.

Blocks come as flat rows: chr_x, start_x, strand_x, len_x, seq_x for x = a, b, c.
A window is one row per start column. Sequences are cast to BINARY before the
explode, because a byte slice costs O(width) where a string slice scans from the
start of the text; nothing leaves whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

TRIO = ("a", "b", "c")
PAIR = ("a", "b")
#: Columns of a part of a long block: windows are made a part at a time.
LONG = 1 << 16


def _columns_count(sides: Sequence[str]) -> Column:
    head = F.length(F.col(f"seq_{sides[0]}"))
    same = F.lit(True)
    for s in sides[1:]:
        same = same & (F.length(F.col(f"seq_{s}")) == head)
    return F.when(same, head).otherwise(
        F.raise_error(F.lit("aligned sequences of one block differ in length")).cast("int"))


def windows(aln: DataFrame, width: int, sides: Sequence[str] = TRIO, keep: Sequence[str] = ()) -> DataFrame:
    """keep columns, `col` (0-based start column) and one `win_x` string per side, upper case.

    Positions are made LONG at a time, so a block of any length is neither copied nor listed as a whole.
    """
    prepared = aln.select(
        *keep,
        *[F.upper(F.col(f"seq_{s}")).cast("binary").alias(f"_b_{s}") for s in sides],
        (_columns_count(sides) - (width - 1)).alias("_n"),
    )
    # no filter on _n: it would be pushed to the scan and recompute the sequences there
    marks = F.when(F.col("_n") > 0, F.sequence(F.lit(1), F.col("_n"), F.lit(LONG)))
    marked = prepared.select("*", F.explode(marks).alias("_mark"))
    positions = F.sequence(F.col("_mark"), F.least(F.col("_n"), F.col("_mark") + (LONG - 1)))
    exploded = marked.select(*keep, *[f"_b_{s}" for s in sides], F.explode(positions).alias("_i"))
    return exploded.select(
        *keep,
        (F.col("_i") - 1).alias("col"),
        *[F.substring(F.col(f"_b_{s}"), F.col("_i"), F.lit(width)).cast("string").alias(f"win_{s}") for s in sides],
    )


def tri_windows(aln: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return windows(aln, 3, TRIO, keep)


def di_windows(aln: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Four columns: a doublet and its two flanks."""
    return windows(aln, 4, TRIO, keep)


def columns(aln: DataFrame, sides: Sequence[str] = TRIO, keep: Sequence[str] = ()) -> DataFrame:
    """One row per column; the bases are in win_a, win_b, ..."""
    return windows(aln, 1, sides, keep)


def window_counts(aln: DataFrame, width: int, sides: Sequence[str] = TRIO, keys: Sequence[str] = (),
                  rule: Column | None = None) -> DataFrame:
    """Number of times each raw window combination occurs, per key.

    Counting raw combinations first means one map-side combined aggregate over the
    big side; every rule (flanks, parsimony, strand) is then applied to the few
    distinct combinations only. `rule` is tied to the count, since a condition on
    grouping columns alone would be pushed down and evaluated once per column again.
    """
    w = windows(aln, width, sides, keys)
    counts = w.groupBy(*keys, *[f"win_{s}" for s in sides]).agg(F.count(F.lit(1)).alias("n"))
    return counts if rule is None else counts.where(F.when(rule, F.col("n")) > 0)


#: Stands for what lies behind the last column of a block.
BEHIND = "#"


def marginal_counts(aln: DataFrame, width: int, sides: Sequence[str] = TRIO, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of windows of `width` columns at every column, those at a block's end filled up with BEHIND.

    Every narrower window is the beginning of exactly one of them, so one pass over the alignment serves all widths (see `narrower`).
    """
    padded = aln.select(*keys, *[F.concat(F.col(f"seq_{s}"), F.lit(BEHIND * (width - 1))).alias(f"seq_{s}") for s in sides])
    return window_counts(padded, width, sides, keys)


def narrower(counts: DataFrame, width: int, sides: Sequence[str] = TRIO, keys: Sequence[str] = ()) -> DataFrame:
    """`window_counts` of `width` columns from `marginal_counts` of as many or more."""
    inside = F.substring(F.col(f"win_{sides[0]}"), width, 1) != BEHIND
    return counts.where(inside).groupBy(*keys, *[F.left(F.col(f"win_{s}"), F.lit(width)).alias(f"win_{s}") for s in sides]).agg(F.sum("n").alias("n"))


def _bases(text: Column) -> Column:
    return F.length(F.translate(text.cast("string"), "-", "")).cast("bigint")


def block_parts(aln: DataFrame, limit: int, overlap: int, sides: Sequence[str] = TRIO, ordinal: str | None = None) -> DataFrame:
    """Blocks as parts of `limit` columns that share `overlap` columns with the next; shorter blocks are one part.

    Sequences are cut as BINARY, and bases before a part come from counts of one pass, so the work grows with the
    block's length alone. start_x, end_x and plines of a part are its own; other columns are repeated.
    """
    names = set(aln.columns)
    n = F.length(F.col(f"seq_{sides[0]}"))
    seqs = {f"seq_{s}": s for s in sides}
    starts = {f"start_{s}" for s in sides} & names
    ends = {f"end_{s}" for s in sides if f"start_{s}" in names} & names
    rest = [c for c in aln.columns if c not in {*seqs, *starts, *ends, "plines"}]
    marks = F.sequence(F.lit(0), F.greatest(n - overlap - 1, F.lit(0)), F.lit(limit))
    cut = lambda c, at, size: F.substring(c, at + 1, F.lit(size))
    binary = aln.select(
        *rest, *sorted(starts), *[F.col(q).cast("binary").alias(q) for q in seqs], *(["plines"] if "plines" in names else []), marks.alias("_marks"))

    def counts(s: str) -> Column:
        return F.transform("_marks", lambda m: _bases(cut(F.col(f"seq_{s}"), m, limit))).alias(f"_n_start_{s}")

    counted = binary.select("*", *[counts(c[-1]) for c in sorted(starts)])
    each = counted.select("*", F.posexplode("_marks").alias("_part_no", "_from"))
    before = lambda c: F.aggregate(F.slice(f"_n_{c}", 1, F.col("_part_no")), F.lit(0).cast("bigint"), lambda x, y: x + y)
    part = lambda s: cut(F.col(f"seq_{s}"), F.col("_from"), limit + overlap).cast("string")
    return each.select(
        *rest, *[part(s).alias(q) for q, s in seqs.items()],
        *[(F.col(c) + before(c)).alias(c) for c in sorted(starts)],
        *[(F.col(f"start_{c[-1]}") + before(f"start_{c[-1]}") + _bases(part(c[-1]))).alias(c) for c in sorted(ends)],
        *([F.transform("plines", lambda p: cut(p.cast("binary"), F.col("_from"), limit + overlap).cast("string")).alias("plines")] if "plines" in names else []),
        *([F.col("_part_no").alias(ordinal)] if ordinal else []))


def split_long_blocks(aln: DataFrame, limit: int = LONG, overlap: int = 3, sides: Sequence[str] = TRIO, ordinal: str = "_part") -> DataFrame:
    """Cut blocks longer than `limit` columns into parts that share `overlap` columns (see `block_parts`).

    Use overlap = window width - 1: each window then falls in exactly one part. Only the long blocks are moved
    (rebalanced by size at run time), short ones stay where they are.
    """
    n = F.length(F.col(f"seq_{sides[0]}"))
    plain = aln.where(n <= limit).withColumn(ordinal, F.lit(0))
    parts = block_parts(aln.where(n > limit), limit, overlap, sides, ordinal)
    return plain.unionByName(parts.hint("rebalance"))


def kmers(fasta: DataFrame, k: int = 3, keep: Sequence[str] = (), chunk: int = 1 << 20) -> DataFrame:
    """k-letter windows of whole sequences (`seq` column); long sequences are cut into chunks."""
    one = fasta.select(*keep, F.col("seq").alias("seq_a"))
    return windows(split_long_blocks(one, chunk, k - 1, ("a",)), k, ("a",), keep).select(
        *keep, F.col("win_a").alias("kmer"))

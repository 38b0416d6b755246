"""Counts over overlaps that never list the overlapping pairs.

The owners (reads, introns) of parts that meet an interval are counted by subtraction: the merged parts of one owner lie apart
and in order, so those that meet an interval are neighbours, and owners = parts met - neighbouring pairs both met. A pair's gap is
met on both sides unless it lies before, behind or around the interval; the gaps around it are points in a quadrant.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .intervals import merge_intervals, overlap_count
from .scans import WIDTH, scan

#: A coordinate is LEVELS digits of 4 bits.
LEVELS = 9
_DIGIT = 4


def _digits(df: DataFrame, column: str, kept) -> DataFrame:
    """One row for each digit of a coordinate that `kept` admits: _level, _parent (the digits above it), _digit."""
    at = F.when(F.col(column).between(0, (1 << _DIGIT * LEVELS) - 1), F.col(column)).otherwise(F.raise_error(F.lit("coordinate out of range")).cast("bigint"))
    digit = lambda k: F.shiftright(at, _DIGIT * k).bitwiseAND((1 << _DIGIT) - 1).cast("int")
    rows = F.array(*[F.struct(F.lit(k).alias("_level"), F.shiftright(at, _DIGIT * (k + 1)).alias("_parent"), digit(k).alias("_digit")) for k in range(LEVELS)])
    return df.select("*", F.inline(F.filter(rows, lambda r: kept(r["_digit"]))))


def count_around(queries: DataFrame, spans: DataFrame, name: str = "count", width: int = WIDTH) -> DataFrame:
    """chr, start, end, name: spans (chr, x, y) with x <= start and end <= y, for every distinct query that has any.

    Two-dimensional dominance by digits: a span's x is below start + 1 at exactly one place, the highest digit in which they differ.
    There both share the digits above, so at each place one scan in the order of y, with a running count for each digit, answers all queries.
    Rows are LEVELS times the input's at most, whatever the overlaps; a scan's buckets keep a hot place from being one task.
    """
    top = (1 << _DIGIT) - 1
    points = spans.groupBy("chr", "x", "y").agg(F.count(F.lit(1)).alias("n"))
    placed = (_digits(points, "x", lambda d: d < top).groupBy("chr", "_level", "_parent", "_digit", "y").agg(F.sum("n").alias("n"))
              .select("chr", "_level", "_parent", "_digit", (-F.col("y")).alias("pos"), F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("start"), "n"))
    asked = _digits(queries.select("chr", "start", "end", (F.col("start") + 1).alias("_s")).distinct(), "_s", lambda d: d > 0).select(
        "chr", "_level", "_parent", "_digit", (-F.col("end")).alias("pos"), F.lit(1).alias("kind"), "start", F.lit(0).cast("bigint").alias("n"))
    ran = scan(placed.unionByName(asked), ["chr", "_level", "_parent"], "pos", ["kind", "_digit", "start"], width,
               sums={f"_n{d}": F.when(F.col("_digit") == d, F.col("n")).otherwise(0) for d in range(top)})
    below = F.lit(0).cast("bigint")
    for d in range(top):
        below = below + F.when(F.col("_digit") > d, F.col(f"_n{d}")).otherwise(0)
    return (ran.where("kind = 1").select("chr", "start", (-F.col("pos")).alias("end"), below.alias("_c"))
            .groupBy("chr", "start", "end").agg(F.sum("_c").alias(name)))


def count_owners(queries: DataFrame, parts: DataFrame, owner: str, name: str = "count", width: int = WIDTH) -> DataFrame:
    """Distinct queries (chr, start, end) and the number of owners with a part (owner, chr, start, end) that overlaps them."""
    asked = queries.select("chr", "start", "end").distinct()
    # read five times below
    merged = cut_lineage(merge_intervals(parts.where(F.col(owner).isNotNull()).select(owner, "chr", "start", "end"), [owner, "chr"], width))
    met = overlap_count(asked, merged, "_met", width)
    gaps = (scan(merged, [owner, "chr"], "start", width=width, lags={"x": F.col("end")}).where("x is not null")
            .select("chr", "x", F.col("start").alias("y")))
    # gaps that don't lie before or behind the interval; one with both ends outside is counted as -1 + 1 and one around it as 0 - 1
    touched = overlap_count(asked, gaps.select("chr", F.col("y").alias("start"), F.col("x").alias("end")), "_touched", width)
    around = count_around(asked, gaps, "_around", width)
    on = ["chr", "start", "end"]
    both = met.join(touched, on).join(around, on, "left")
    return both.select(*on, (F.col("_met") - F.col("_touched") - F.coalesce("_around", F.lit(0))).alias(name))


def count_covering(points: DataFrame, spans: DataFrame, name: str = "count", width: int = WIDTH) -> DataFrame:
    """Distinct (chr, pos) and the number of spans (chr, start, end) with start < pos < end."""
    asked = points.select("chr", F.col("pos").alias("start"), F.col("pos").alias("end")).distinct()
    return overlap_count(asked, spans, name, width).select("chr", F.col("start").alias("pos"), name)


def count_rows(queries: DataFrame, parts: DataFrame, keys: Sequence[str], name: str = "count", width: int = WIDTH) -> DataFrame:
    """Distinct queries (keys, start, end) and the number of parts of the same keys that overlap them."""
    return overlap_count(queries.select(*keys, "start", "end").distinct(), parts, name, width, keys)

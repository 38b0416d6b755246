"""Per-alignment statistics of pairwise blocks (seq_a reference, seq_b query)."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

_ACGTU = np.zeros(256, bool)
_ACGTU[[ord(c) for c in "ACGTU"]] = True
_STATS = T.StructType([T.StructField("cigar", T.StringType())] + [
    T.StructField(n, T.LongType()) for n in
    ("columns", "matches", "mismatches", "base_mismatches", "ambiguous", "edit_distance", "gap_opens", "gapless_blocks")])


def describe(ref: str, qry: str) -> tuple:
    """CIGAR (= X I D) without clips, and counts, of one alignment."""
    r = np.frombuffer(ref.upper().encode("latin-1", "replace"), np.uint8)
    q = np.frombuffer(qry.upper().encode("latin-1", "replace"), np.uint8)
    gap = ord("-")
    ins, dele = r == gap, q == gap
    same = (r == q) & ~ins
    ops = np.where(r == q, ord("="), np.where(ins, ord("I"), np.where(dele, ord("D"), ord("X")))).astype(np.uint8)
    cuts = np.flatnonzero(np.diff(ops)) + 1
    lo = np.concatenate(([0], cuts)) if len(ops) else np.empty(0, np.int64)
    lens = np.diff(np.concatenate((lo, [len(ops)]))) if len(ops) else lo
    cigar = "".join(f"{n}{chr(ops[i])}" for n, i in zip(lens, lo.astype(int)))
    runs = lambda m: int(np.count_nonzero(np.diff(np.concatenate(([False], m)).astype(np.int8)) == 1))
    paired = ~ins & ~dele
    known = paired & _ACGTU[r] & _ACGTU[q]
    return (cigar, len(r), int(same.sum()), int((paired & ~same).sum()), int((known & (r != q)).sum()),
            int((paired & ~known).sum()), int((r != q).sum()), runs(ins) + runs(dele), runs(paired))


@F.pandas_udf(_STATS)
def _describe(ref: pd.Series, qry: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([describe(r, q) for r, q in zip(ref, qry)], columns=[f.name for f in _STATS.fields])


def alignment_stats(aln2: DataFrame, keep: list[str]) -> DataFrame:
    """keep columns, CIGAR and counts; `identity` = 100 * matches / columns."""
    out = aln2.select(*keep, _describe("seq_a", "seq_b").alias("s")).select(*keep, "s.*")
    return out.withColumn("identity", F.col("matches") * 100.0 / F.nullif(F.col("columns"), F.lit(0)))


def with_clips(stats: DataFrame, start: str = "r_start", end: str = "r_end", length: str = "r_len") -> DataFrame:
    """CIGAR with hard clips for the unaligned ends of the read."""
    clip = lambda n: F.when(n > 0, F.concat(n.cast("string"), F.lit("H"))).otherwise(F.lit(""))
    return stats.withColumn("cigar", F.concat(clip(F.col(start)), F.col("cigar"), clip(F.col(length) - F.col(end))))

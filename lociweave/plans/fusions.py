"""Spliced reads -> feature fusions supported by enough reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions import splice
from ..operators import reads as R


def feature_fusions(reads: DataFrame, features: DataFrame, differ: str | None = "kind", minimum_reads: int = 5,
                    major_signals: bool = True, drop_chromosome: str | None = None) -> DataFrame:
    """Introns joining two features: intron key, support, signal, kind linear/trans and both features.

    Introns are counted and filtered before the feature join, so its size depends on
    supported introns, not on reads.
    """
    if drop_chromosome:
        reads = R.drop_chromosome(reads, drop_chromosome, split_only=True)
    junctions = R.junctions(reads)
    introns = R.well_supported(R.intron_table(junctions), minimum_reads)
    if major_signals:
        introns = introns.where(splice.is_major_signal("don", "acc"))
    ends = introns.withColumns({"left": F.least("start", "end"), "right": F.greatest("start", "end")})
    flanked = R.flank_join(ends, features, differ=differ)
    return ends.join(flanked, ["left", "right"]).withColumn(
        "splicing", F.when(F.col("trans"), F.lit("trans")).otherwise(F.lit("linear")))

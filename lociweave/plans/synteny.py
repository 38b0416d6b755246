"""Aligned segments -> gene relations on both genomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators.intervals import BIN, overlap_join


def segment_gene_pairs(query_segments: DataFrame, query_cds: DataFrame, ref_segments: DataFrame, ref_cds: DataFrame,
                       bin_size: int = BIN) -> DataFrame:
    """Segments with the coding features they meet on the query and on the reference.

    query_segments: chr, start, end, segment_id; ref_segments: the same plus strand. Two
    binned overlap joins and one equi join on segment_id.
    """
    q = overlap_join(query_segments.select("chr", "start", "end", "segment_id"), query_cds, "q_", bin_size).select(
        "segment_id", "q_gene", "q_strand", F.col("q_feature_id").alias("feature_id"))
    r = overlap_join(ref_segments.select("chr", "start", "end", "segment_id", "strand"), ref_cds, "r_", bin_size).select(
        "segment_id", "strand", "r_gene", "r_strand", F.col("r_start").alias("g_start"))
    return q.join(r, "segment_id")

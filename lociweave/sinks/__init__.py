"""Writers. All write folders of part files from all tasks; nothing passes the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def spectrum_order() -> list[Column]:
    """Original middle base, alternative, 5' and 3' neighbour of an `x[y>w]z` label."""
    at = lambda i: F.substring("mutType", i, 1)
    return [at(3), at(5), at(1), at(7)]


def write_spectrum(spectrum: DataFrame, path: str, partition_by: Sequence[str] = (), dinucleotide: bool = False,
                   mode: str = "error") -> None:
    """Tab-separated, header, fixed class order inside each file; one folder per partition value."""
    order = [F.col("mutType")] if dinucleotide else spectrum_order()
    # without folders the classes are dealt in order to as many files as the rows need: one for one spectrum's 96 rows
    rows = spectrum.repartition(*partition_by) if partition_by else spectrum.repartitionByRange(*order)
    (rows.sortWithinPartitions(*partition_by, *order).write.mode(mode).partitionBy(*partition_by)
     .csv(path, sep="\t", header=True))


def write_sites(sites: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "error") -> None:
    """Per-site table: parquet, or csv with tabs on request."""
    w = sites.write.mode(mode).partitionBy(*partition_by)
    if fmt == "csv":
        w.csv(path, sep="\t", header=True)
    else:
        w.format(fmt).save(path)


def maf_text(aln: DataFrame, sides: Sequence[str] = ("a", "b", "c"), head: Column | None = None) -> DataFrame:
    """One `value` string per block; sequences are joined by single blanks."""
    def row(s: str) -> Column:
        span = F.length(F.translate(f"seq_{s}", "-", ""))
        return F.concat_ws(" ", F.lit("s"), f"chr_{s}", F.col(f"start_{s}").cast("string"), span.cast("string"), f"strand_{s}",
                           F.col(f"len_{s}").cast("string"), f"seq_{s}")
    lines = [head if head is not None else F.lit("a"), *[row(s) for s in sides]]
    return aln.select(F.concat(F.concat_ws("\n", *lines), F.lit("\n")).alias("value"))


def pair_head() -> Column:
    """`a` line of a pairwise alignment."""
    opt = lambda k: F.when(F.length(F.col(k).cast("string")) > 0, F.concat(F.lit(f"{k}="), F.col(k).cast("string")))
    return F.concat_ws(" ", F.lit("a"), opt("score"), opt("mismap"), opt("sense"), opt("don"), opt("acc"))


def write_maf(aln: DataFrame, path: str, sides: Sequence[str] = ("a", "b", "c"), head: Column | None = None,
              mode: str = "error") -> None:
    maf_text(aln, sides, head).write.mode(mode).text(path)


def write_introns(introns: DataFrame, path: str, mode: str = "error") -> None:
    """One line per intron, a map of its key to its fields, which `read_introns_json` reads back."""
    intron_json(introns).write.mode(mode).text(path)


def _intron_fields() -> list[Column]:
    return [F.col("start").alias("intronStart"), F.col("end").alias("intronEnd"), F.col("length").alias("intronLength"), F.array("don", "acc").alias("splicingSignal")]


def cluster_json(members: DataFrame) -> DataFrame:
    """`value` rows, one a cluster: a map of its name to its introns, by start and end, each with the number of its reads.

    members: cluster, start, end, length, don, acc, reads (number). A cluster is one row, as its readers want it.
    """
    one = F.struct(*_intron_fields(), F.col("reads").cast("bigint").alias("reads"))
    listed = members.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct("start", "end", one.alias("v")))).alias("m"))
    return listed.select(F.to_json(F.create_map("cluster", F.transform("m", lambda x: x["v"]))).alias("value"))


def intron_json(introns: DataFrame) -> DataFrame:
    """`value` rows of introns with key, start, end, length, don, acc, reads and, where there is such a column, alignments."""
    more = [F.col("alignments")] if "alignments" in introns.columns else []
    fields = F.struct(*_intron_fields(), F.col("reads").alias("readIDs"), *more)
    return introns.select(F.to_json(F.create_map("key", fields)).alias("value"))


def write_partitioned(df: DataFrame, column: str, path: str, fmt: str = "parquet", mode: str = "error",
                      files_per_value: int = 0) -> None:
    """One folder per value. With `files_per_value`, rows are first spread over that many tasks per value, so a
    hot value is written by several tasks and a rare one makes no flood of small files."""
    if files_per_value:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_value))
        df = df.repartition(F.col(column), salt)
    df.write.mode(mode).partitionBy(column).format(fmt).save(path)

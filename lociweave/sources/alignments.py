"""Alignment text files. Files are split at the lines that begin a block, whatever their line ends, so a large MAF is
read by many tasks; compressed files are opened by their extension. Each reader is a parser of text rows and a read.
Blocks are numbered by file and place (see `splits`)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .features import after_equals
from .splits import place_ids, split_lines

SIDES = "abcdefgh"
PSL_SCHEMA = (
    "matches bigint, mismatches bigint, rep_matches bigint, n_count bigint, q_gaps bigint, q_gap_bases bigint, "
    "t_gaps bigint, t_gap_bases bigint, strand string, q_name string, q_size bigint, q_start bigint, q_end bigint, "
    "t_name string, t_size bigint, t_start bigint, t_end bigint, block_count bigint, block_sizes string, "
    "q_starts string, t_starts string")


def maf_parts(spark: SparkSession, path) -> DataFrame:
    """`value` rows of whole blocks, with file and split. The mark that ends a row is the next block's `a` at the start of a line, which is put back."""
    raw = split_lines(spark, path, "\na")
    return raw.select("file", "at", F.when(F.col("value").rlike(r"^([ \t\r\n]|$)"), F.concat(F.lit("a"), F.col("value"))).otherwise(F.col("value")).alias("value"))


def _blocks(parts: DataFrame) -> DataFrame:
    """One row per block: block_id, lines (comments dropped). Lines of white space also end a block; a row may hold several.

    Rows from files (file, at) are numbered by their place. Rows made otherwise get the digest of their lines, so equal blocks have one number.
    """
    placed = {"file", "at"} <= set(parts.columns)
    extra = ["file", "at"] if placed else []
    each = parts.select(*extra, F.explode(F.split(F.regexp_replace("value", "\r", ""), r"\n[ \t]*\n")).alias("t"))
    lines = F.filter(F.split("t", "\n"), lambda l: ~l.startswith("#") & (F.length(F.trim(l)) > 0))
    found = each.select(*extra, lines.alias("lines")).where(F.exists("lines", lambda l: l.rlike(r"^s\s")))
    return place_ids(found, parts.inputFiles()) if placed else found.select(F.xxhash64("lines").alias("block_id"), "lines")


def _fields(kind: str) -> Column:
    rows = F.filter("lines", lambda l: l.startswith(kind + " ") | l.startswith(kind + "\t"))
    return F.transform(rows, lambda l: F.split(F.trim(l), r"\s+"))


def _seq(f: Column) -> Column:
    start = f[2].cast("bigint")
    return F.struct(f[1].alias("chr"), start.alias("start"), (start + f[3].cast("bigint")).alias("end"),
                    f[4].alias("strand"), f[5].cast("bigint").alias("len"), f[6].alias("seq"))


def read_maf(spark: SparkSession, path, with_plines: bool = False) -> DataFrame:
    return parse_maf(maf_parts(spark, path), with_plines)


def parse_maf(parts: DataFrame, with_plines: bool = False) -> DataFrame:
    """block_id, seqs ARRAY<STRUCT<chr, start, end, strand, len, seq>> and, on request, plines ARRAY<STRING>."""
    cols = [F.col("block_id"), F.transform(_fields("s"), _seq).alias("seqs")]
    if with_plines:
        cols.append(F.transform(_fields("p"), lambda f: f[1]).alias("plines"))
    return _blocks(parts).select(*cols)


def flatten_trio(blocks: DataFrame, sides: str = "abc") -> DataFrame:
    """seqs array -> chr_x, start_x, end_x, strand_x, len_x, seq_x columns; a wrong number of rows is an error."""
    n = len(sides)
    checked = F.when(F.size("seqs") == n, F.col("seqs")).otherwise(
        F.raise_error(F.concat(F.lit(f"block without exactly {n} sequences: "), F.col("block_id").cast("string"))))
    b = blocks.withColumn("_q", checked)
    flat = [F.col("_q")[i][f].alias(f"{f}_{s}") for i, s in enumerate(sides) for f in ("chr", "start", "end", "strand", "len", "seq")]
    return b.select(*[c for c in blocks.columns if c != "seqs"], *flat)


def read_maf_pairs(spark: SparkSession, path) -> DataFrame:
    return parse_maf_pairs(maf_parts(spark, path))


def parse_maf_pairs(parts: DataFrame) -> DataFrame:
    """Pairwise blocks with the key=value fields of the `a` line; score and mismap must be there."""
    b = _blocks(parts)
    words = F.filter(F.flatten(_fields("a")), lambda w: w.contains("="))
    info = F.map_from_entries(F.transform(words, lambda w: F.struct(F.split_part(w, F.lit("="), F.lit(1)), after_equals(w))))
    got = flatten_trio(b.select("block_id", F.transform(_fields("s"), _seq).alias("seqs"), info.alias("_a")), "ab")
    need = lambda k, t: F.coalesce(F.col("_a")[k], F.raise_error(F.lit(f"alignment without {k}"))).cast(t).alias(k)
    side = lambda s, p: [F.col(f"{f}_{s}").alias(f"{p}_{f}") for f in ("start", "end", "strand", "len", "seq")]
    return got.select(
        F.col("block_id").alias("aln_id"), need("score", "bigint"), need("mismap", "double"),
        F.col("_a")["sense"].cast("double").alias("sense"), F.col("_a")["don"].alias("don"), F.col("_a")["acc"].alias("acc"),
        F.col("chr_a").alias("g_chr"), *side("a", "g"), F.col("chr_b").alias("r_id"), *side("b", "r"))


def parse_psl(lines: DataFrame) -> DataFrame:
    """PSL columns of tab-separated `value` rows."""
    return lines.where(F.length(F.trim("value")) > 0).select(F.from_csv(F.regexp_replace("value", "\r$", ""), PSL_SCHEMA, {"sep": "\t"}).alias("r")).select("r.*")


def read_psl(spark: SparkSession, path) -> DataFrame:
    return parse_psl(spark.read.text(path))


def psl_segments(psl: DataFrame, prefix: str = "") -> DataFrame:
    """Query-first segment rows (forward coordinates) with prefixed chromosome names."""
    name = lambda c: F.concat(F.lit(prefix), F.col(c))
    return psl.select(name("q_name").alias("q_chr"), "q_start", "q_end", "strand", name("t_name").alias("r_chr"),
                      F.col("t_start").alias("r_start"), F.col("t_end").alias("r_end"))


def ref_first(segments: DataFrame) -> DataFrame:
    rest = [c for c in segments.columns if c not in ("q_chr", "q_start", "q_end", "strand", "r_chr", "r_start", "r_end")]
    return segments.select("r_chr", "r_start", "r_end", "q_chr", "q_start", "q_end", "strand", *rest)


def query_first(segments: DataFrame) -> DataFrame:
    rest = [c for c in segments.columns if c not in ("q_chr", "q_start", "q_end", "strand", "r_chr", "r_start", "r_end")]
    return segments.select("q_chr", "q_start", "q_end", "strand", "r_chr", "r_start", "r_end", *rest)


def strand_coordinates(psl: DataFrame) -> DataFrame:
    """The six coordinates as the alignment writes them: query positions on the alignment's strand."""
    rev = F.col("strand") == "-"
    return psl.select(F.col("t_name").alias("g_chr"), F.col("t_start").alias("g_start"), F.col("t_end").alias("g_end"),
                      F.col("q_name").alias("r_id"),
                      F.when(rev, F.col("q_size") - F.col("q_end")).otherwise(F.col("q_start")).alias("r_start"),
                      F.when(rev, F.col("q_size") - F.col("q_start")).otherwise(F.col("q_end")).alias("r_end"),
                      F.col("strand").alias("r_strand"))

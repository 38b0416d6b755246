"""Sequence files."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .splits import mapped, split_lines


def read_fasta(spark: SparkSession, path) -> DataFrame:
    return parse_fasta(spark.read.option("lineSep", "\n>").text(path).select("value", F.col("_metadata.file_path").alias("file")))


def parse_fasta(records: DataFrame) -> DataFrame:
    """name, description, seq, file: one row per record; `value` holds a record with or without its mark."""
    raw = records.select(F.regexp_replace(F.regexp_replace("value", "\r", ""), "^>", "").alias("t"), "file")
    head = F.split_part("t", F.lit("\n"), F.lit(1))
    body = F.when(F.instr("t", "\n") > 0, F.regexp_replace(F.substring("t", F.instr("t", "\n") + 1, F.length("t")), r"\s+", "")).otherwise(F.lit(""))
    return raw.where(F.length(F.trim("t")) > 0).select(
        F.split_part(F.trim(head), F.lit(" "), F.lit(1)).alias("name"), F.trim(head).alias("description"), body.alias("seq"), "file")


#: Bases of a piece of a sequence.
PIECE = 1 << 16


def _fasta_step(size: int):
    def step(key: tuple[str, int], values: Iterator[list]) -> Iterator[tuple]:
        file, at = key
        part, head, done, held, bases = 0, None, 0, [], 0

        def piece():
            return file, at, part, head, done, "".join(held)

        for lines in values:
            for line in lines:
                if line.startswith(">"):
                    if held or head is not None:
                        yield piece()
                    part, head, done, held, bases = part + 1, line[1:].strip(), 0, [], 0
                    continue
                held.append("".join(line.split()))
                bases += len(held[-1])
                if bases >= size:
                    yield piece()
                    head, done, held, bases = (head, done + bases, [], 0)
        if held or (head is not None and done == 0):
            yield piece()
    return step


def read_fasta_pieces(spark: SparkSession, path, size: int = PIECE) -> DataFrame:
    return fasta_pieces(split_lines(spark, path), size)


def fasta_pieces(lines: DataFrame, size: int = PIECE) -> DataFrame:
    """name, description, file, start, seq: a sequence in pieces of about `size` bases (one line more at most), wherever its lines lie.

    lines: value, file, at, in file order within a split. A record may reach over any number of splits: pieces get their place within the split
    first, and those before a split's first header get name and place from one row a split. A sequence without bases is one empty piece.
    """
    ddl = "file string, at bigint, part int, head string, done bigint, seq string"
    found = mapped(lines, _fasta_step(size), ddl, [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.string()], 64)
    n = F.length("seq").cast("bigint")
    last = F.max(F.struct("part", "head", (F.col("done") + n).alias("end")))
    sums = found.groupBy("file", "at").agg(last.alias("last"))
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    through = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    has = F.col("last.part") > 0
    run = sums.withColumn("_run", F.sum(has.cast("int")).over(through)).withColumn("_head", F.last(F.when(has, F.col("last.head")), True).over(earlier))
    before = F.sum("last.end").over(Window.partitionBy("file", "_run").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    reach = run.withColumn("_reach", before)  # bases of the open record at the end of each split
    carried = reach.select("file", "at", "_head", F.coalesce(F.lag("_reach").over(Window.partitionBy("file").orderBy("at")), F.lit(0)).alias("_before"))
    inside = found.where("part > 0").select("file", "head", F.col("done").alias("start"), "seq")
    over = found.where("part = 0").join(carried, ["file", "at"]).where("_head is not null or seq <> ''").select(
        "file", F.coalesce("_head", F.raise_error(F.concat(F.lit("bases before the first header: "), F.col("file")))).alias("head"),
        (F.col("done") + F.col("_before")).alias("start"), "seq")
    return inside.unionByName(over).select(F.split_part("head", F.lit(" "), F.lit(1)).alias("name"), F.col("head").alias("description"), "file", "start", "seq")


def on_grid(pieces: DataFrame, size: int = PIECE) -> DataFrame:
    """name, piece, start, seq: sequences (name, seq and, where they are pieces already, start) cut at multiples of `size`."""
    start = F.col("start") if "start" in pieces.columns else F.lit(0).cast("bigint")
    n = F.length("seq").cast("bigint")
    cells = F.when(n > 0, F.sequence(F.floor(start / size), F.floor((start + n - 1) / size)))
    each = pieces.select("name", start.alias("_s"), F.col("seq").cast("binary").alias("_q"), F.explode(cells).alias("piece"))
    lo = F.greatest(F.col("_s"), F.col("piece") * size)
    hi = F.least(F.col("_s") + F.length("_q"), (F.col("piece") + 1) * size)
    return each.select("name", "piece", lo.alias("start"), F.substring(F.col("_q"), (lo - F.col("_s") + 1).cast("int"), (hi - lo).cast("int")).cast("string").alias("seq"))


def _records_of(lines: list[str], out: list[tuple], file: str) -> list[str]:
    """Takes whole four-line records off the front; what is left is fewer than four lines."""
    at, n = 0, len(lines)
    while at < n:
        if not lines[at].strip():  # blank lines between records
            at += 1
            continue
        if not lines[at].startswith("@"):
            raise ValueError(f"not a four-line record: {lines[at][:200]}")
        if at + 4 > n:
            break
        out.append((0, file, None, None, lines[at][1:], lines[at + 1], lines[at + 3], None))
        at += 4
    return lines[at:]


def _fastq_step(key: tuple[str, int], values: Iterator[list]) -> Iterator[tuple]:
    """Records inside the split (kind 0) and lines at its edges (kind 1; part 0 goes with what came before, part 1 begins a record)."""
    file, at = key
    held, known = [], at == 0
    for lines in values:
        held += lines
        if not known:
            # a header has a '+' line two lines on; a quality line, which may begin with '@' too, has bases there
            first = next((i for i in range(len(held) - 2) if held[i].startswith("@") and held[i + 2].startswith("+")), None)
            if first is None:
                continue
            known = True
            if first:
                yield 1, file, at, 0, None, None, None, held[:first]
            held = held[first:]
        out: list[tuple] = []
        held = _records_of(held, out, file)
        yield from out
    if held:
        yield 1, file, at, int(known), None, None, None, held


def read_fastq(spark: SparkSession, path) -> DataFrame:
    return parse_fastq(split_lines(spark, path))


def parse_fastq(lines: DataFrame) -> DataFrame:
    """id, description, seq, qual, file of four-line records; lines: value, file, at, in file order within a split.

    Records that lie inside a split are finished there. Only the lines of those that reach over an edge, at most three on each side
    of it, are moved and put together. An unfinished record at a file's end is an error.
    """
    ddl = "kind int, file string, at bigint, part int, head string, seq string, qual string, lines array<string>"
    found = mapped(lines, _fastq_step, ddl, [pa.int32(), pa.string(), pa.int64(), pa.int32(), *[pa.string()] * 3, pa.list_(pa.string())])
    order = Window.partitionBy("file").orderBy("at", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = (found.where("kind = 1").select("file", "at", "part", "lines", F.sum("part").over(order).alias("run"))
             .groupBy("file", "run").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "part", "lines"))), lambda x: x["lines"])).alias("lines")))

    def put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for file, rows in zip(batch.column("file").to_pylist(), batch.column("lines").to_pylist()):
                if rest := _records_of(rows, out, file):
                    raise ValueError(f"unfinished record: {rest[0][:200]}")
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in (1, 4, 5, 6)], ["file", "head", "seq", "qual"])

    joined = edges.select("file", "lines").mapInArrow(put_together, "file string, head string, seq string, qual string")
    rec = found.where("kind = 0").select("file", "head", "seq", "qual").unionByName(joined)
    return rec.select(F.split_part("head", F.lit(" "), F.lit(1)).alias("id"), F.col("head").alias("description"), "seq", "qual", "file")


def with_mate_suffix(reads: DataFrame, number: int) -> DataFrame:
    """`/n` at the end of read ids."""
    return reads.withColumn("id", F.concat("id", F.lit(f"/{number}")))


def good_quality(reads: DataFrame, quality: int = 30, percent: float = 70) -> DataFrame:
    """Reads with at least `percent` of their bases at `quality` or better.

    Characters below the limit are deleted in one pass and lengths compared.
    """
    low = "".join(chr(c) for c in range(33, 33 + quality))
    good = F.length(F.translate("qual", low, ""))
    return reads.where(good * 100 >= percent * F.length("qual"))


def subsequence(fasta: DataFrame, name: str, start: int, end: int) -> DataFrame:
    """One range of one sequence."""
    return fasta.where(F.col("name") == name).select("name", F.substring("seq", start + 1, end - start).alias("seq"))


def subsequences_of_pieces(pieces: DataFrame, intervals: DataFrame, key: str, size: int = PIECE) -> DataFrame:
    """key, chr, start, end, seq: the range of a sequence for each interval, from the pieces it lies in.

    pieces: name, piece, start, seq, as `on_grid` cuts them; intervals: chr, start, end and a unique `key`. An interval asks only for the pieces
    it touches, so what travels is in proportion to the ranges and a piece's size, not to the sequence. Ranges are cut at the sequence's end.
    """
    asked = intervals.where("start < end").select(F.col(key), "chr", "start", "end", F.explode(F.sequence(F.floor(F.col("start") / size), F.floor((F.col("end") - 1) / size))).alias("piece"))
    have = pieces.select(F.col("name").alias("chr"), "piece", F.col("start").alias("_s"), "seq")
    lo, hi = F.greatest("start", "_s"), F.least(F.col("end"), F.col("_s") + F.length("seq"))
    met = asked.join(have, ["chr", "piece"]).where(lo < hi).select(
        key, "chr", "start", "end", lo.alias("_lo"), F.substring(F.col("seq"), (lo - F.col("_s") + 1).cast("int"), (hi - lo).cast("int")).alias("_part"))
    return met.groupBy(key, "chr", "start", "end").agg(F.sort_array(F.collect_list(F.struct("_lo", "_part"))).alias("_p")).select(
        key, "chr", "start", "end", F.array_join(F.transform("_p", lambda x: x["_part"]), "").alias("seq"))


def subsequences(fasta: DataFrame, intervals: DataFrame) -> DataFrame:
    """Range of a sequence per interval (chr, start, end, ...), for sequences that are short rows; see `subsequences_of_pieces`."""
    return intervals.join(fasta.select(F.col("name").alias("chr"), "seq"), "chr").withColumn(
        "seq", F.substring(F.col("seq"), (F.col("start") + 1).cast("int"), (F.col("end") - F.col("start")).cast("int")))

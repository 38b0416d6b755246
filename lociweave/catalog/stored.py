"""Queries that write files to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks
from ..operators import multispecies as M
from ..operators import sites as T
from ..operators import spectra as S
from ..session import shared_folder
from ..sources import alignments as AL
from ..sources import sequences as SQ
from . import inputs
from .base import query
from .intervals import segments
from .sites import SITES
from .spectra import SPECTRUM_CTE, aln3, genome
from .synteny import _features

LETTERS = "regexp_replace(text, '[^a-zA-Z]+', ''{g})"


def _letters(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").selectExpr("doc_id", "source", f"{LETTERS.format(g='')} as seq")


def _md5(column):
    return F.md5(F.col(column).cast("binary"))


# the quality begins with the mark of a record, and every third record has no bases
@query("fastq_records", f"""select 'r' || doc_id as id, 'r' || doc_id || ' ' || source as description, length(s) as n, md5(s) as seq, md5(repeat('@', length(s))) as qual from
  (select doc_id, source, case when doc_id % 3 = 0 then '' else {LETTERS.format(g=", 'g'")} end as s from documents)""")
def _(spark, sf):
    path = shared_folder(spark, "fastq")
    seq = F.when(F.col("doc_id") % 3 == 0, F.lit("")).otherwise(F.col("seq"))
    _letters(spark, sf).select(F.concat_ws("\n", F.concat(F.lit("@r"), F.col("doc_id").cast("string"), F.lit(" "), "source"), seq, F.lit("+"),
                                           F.repeat(F.lit("@"), F.length(seq))).alias("value")).write.text(path)
    back = SQ.read_fastq(spark, path)
    return back.select("id", "description", F.length("seq").cast("long").alias("n"), _md5("seq").alias("seq"), _md5("qual").alias("qual"))


@query("fasta_pieces", f"""select 's' || doc_id as name, 's' || doc_id || ' ' || source as description, length(s) as n, md5(s) as seq from
  (select doc_id, source, {LETTERS.format(g=", 'g'")} as s from documents)""")
def _(spark, sf):
    path = shared_folder(spark, "fasta")
    wrapped = F.regexp_replace("seq", "(.{60})", "$1\n")
    _letters(spark, sf).select(F.concat(F.lit(">s"), F.col("doc_id").cast("string"), F.lit(" "), "source", F.lit("\n"), wrapped).alias("value")).write.text(path)
    pieces = SQ.read_fasta_pieces(spark, path, 1 << 10)
    whole = pieces.groupBy("name", "description").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("start", "seq"))), lambda x: x["seq"]), "").alias("seq"), F.sum(F.length("seq")).alias("n"))
    return whole.select("name", "description", F.col("n").cast("long").alias("n"), _md5("seq").alias("seq"))


@query("subsequences_by_piece", f"""with {inputs.cte('segments', 'aln3')}, g as (select block_id, replace(seq_a, '-', '') as seq from aln3),
  s as (select segment_id, block_id, substr(seq, cast(start - block_id * 200000 + 1 as integer), cast("end" - start as integer)) as seq
    from segments join g on block_id = cast(floor(start / 200000) as bigint)) select * from s where seq <> ''""")
def _(spark, sf):
    size = 1 << 9
    pieces = SQ.on_grid(genome(spark, sf).select("name", "seq"), size)
    place = F.floor(F.col("start") / 200000)
    asked = segments(spark, sf).select("segment_id", place.alias("chr"), (F.col("start") % 200000).alias("start"), (F.col("start") % 200000 + F.col("end") - F.col("start")).alias("end"))
    return SQ.subsequences_of_pieces(pieces, asked, "segment_id", size).select("segment_id", F.col("chr").alias("block_id"), "seq")


@query("stored_spectrum", f"""{SPECTRUM_CTE} select trio, species, "mutType", "mutNum", "totalRootNum" from spectrum""")
def _(spark, sf):
    path = shared_folder(spark, "spectrum")
    sinks.write_spectrum(S.tri_spectrum(aln3(spark, sf), ["trio"]), path, ["trio", "species"])
    back = spark.read.csv(path, sep="\t", header=True, schema="mutType string, mutNum bigint, totalRootNum bigint, trio string, species string")
    return back.select("trio", "species", "mutType", "mutNum", "totalRootNum")


@query("stored_sites", f"{SITES} select * from sites")
def _(spark, sf):
    path = shared_folder(spark, "sites")
    sites = T.sbst_sites(aln3(spark, sf), ["block_id"])
    sinks.write_sites(sites, path, "csv")
    return spark.read.csv(path, sep="\t", header=True, schema=sites.schema)


@query("stored_by_value", f"""with {inputs.cte('segments')} select segment_id, chr, start, "end" from segments""")
def _(spark, sf):
    path = shared_folder(spark, "values")
    rows = segments(spark, sf).select("segment_id", "chr", "start", "end")
    sinks.write_partitioned(rows, "chr", path, files_per_value=2)
    return spark.read.schema("segment_id bigint, start bigint, end bigint, chr string").parquet(path).select("segment_id", "chr", "start", "end")


@query("gzip_blocks", f"""with {inputs.cte('aln3')} select chr_a, start_a, start_a + length(replace(seq_a, '-', '')) as end_a, strand_b, start_b, len_b, md5(seq_b) as b, chr_c, md5(seq_c) as c from aln3""")
def _(spark, sf):
    path = shared_folder(spark, "maf")
    sinks.maf_text(aln3(spark, sf)).write.option("compression", "gzip").text(path)
    return AL.flatten_trio(AL.read_maf(spark, path)).select(
        "chr_a", "start_a", "end_a", "strand_b", "start_b", "len_b", _md5("seq_b").alias("b"), "chr_c", _md5("seq_c").alias("c"))


@query("variance_checks", "select cast(c as integer) as component, true as in_range, true as descending, true as within_all from range(1, 4) t(c)")
def _(spark, sf):
    _p, v = M.principal_components(M.feature_vectors(_features(spark, sf), "sample"), "sample", 3)
    rows = [(i + 1, 0 <= x <= 1, i == 0 or v[i - 1] >= x, sum(v) <= 1 + 1e-9) for i, x in enumerate(v)]
    return spark.createDataFrame(rows, "component int, in_range boolean, descending boolean, within_all boolean")

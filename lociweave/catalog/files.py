"""Parsers and text writers of every file kind, over text lines built from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sinks
from ..sources import alignments as AL
from ..sources import features as FE
from ..sources import sequences as SQ
from ..sources import tables as TB
from . import inputs
from .base import query, rnd
from .spectra import aln3

TAB = "chr(9)"


def lines(spark, sf, table, expression, *more):
    return spark.read.parquet(f"{sf}/{table}.parquet").selectExpr(f"{expression} as value", *more)


def tabs(*fields):
    return f" || {TAB} || ".join(f"({f})" for f in fields)


ENDS = "case when {} % 2 = 0 then chr(13) else '' end"  # every other line ends as on Windows


@query("maf_text", f"""with {inputs.cte('aln3')} select 'a' || chr(10) || 's ' || chr_a || ' ' || start_a || ' ' || length(replace(seq_a, '-', '')) || ' ' || strand_a || ' ' || len_a || ' ' || seq_a || chr(10)
  || 's ' || chr_b || ' ' || start_b || ' ' || length(replace(seq_b, '-', '')) || ' ' || strand_b || ' ' || len_b || ' ' || seq_b || chr(10)
  || 's ' || chr_c || ' ' || start_c || ' ' || length(replace(seq_c, '-', '')) || ' ' || strand_c || ' ' || len_c || ' ' || seq_c || chr(10) as value from aln3""")
def _(spark, sf):
    return sinks.maf_text(aln3(spark, sf))


def _maf(spark, sf):
    """Blocks as text; every other one with comments, p lines, tabs between fields and Windows line ends."""
    odd = F.col("start_a") % 400000 == 0
    plain = sinks.maf_text(aln3(spark, sf).where(~odd))
    dressed = sinks.maf_text(aln3(spark, sf).where(odd)).select(F.replace(F.concat(
        F.lit("# note\n"), F.regexp_replace("value", "\ns ", "\ns\t"), F.lit("p 99\np 88\n")), F.lit("\n"), F.lit("\r\n")).alias("value"))
    return plain.unionByName(dressed)


@query("maf_blocks", f"""with {inputs.cte('aln3')} select chr_a, start_a, start_a + length(replace(seq_a, '-', '')) as end_a, chr_b, strand_b, len_b, start_b + length(replace(seq_b, '-', '')) as end_b,
  seq_b, chr_c, strand_c, start_c, md5(seq_a) as a, md5(seq_c) as c, case when start_a % 400000 = 0 then '99,88' else '' end as plines from aln3""")
def _(spark, sf):
    b = AL.flatten_trio(AL.parse_maf(_maf(spark, sf), with_plines=True))
    return b.select("chr_a", "start_a", "end_a", "chr_b", "strand_b", "len_b", "end_b", "seq_b", "chr_c", "strand_c", "start_c",
                    F.md5(F.col("seq_a").cast("binary")).alias("a"), F.md5(F.col("seq_c").cast("binary")).alias("c"), F.array_join("plines", ",").alias("plines"))


_PAIR = ("'a score=' || l_partkey || ' mismap=' || l_linenumber / 8.0 || case when l_suppkey % 3 = 0 then ' don=G=T acc=AG' else ' sense=-1.5' end || chr(10) || 's g' || l_suppkey || ' ' || l_partkey "
         "|| ' 3 + 1000 AC-G' || chr(10) || 's read' || l_orderkey || ' ' || l_linenumber || ' 4 - 500 ACTG' || chr(10)")


@query("maf_pairs", """select l_partkey as score, l_linenumber / 8.0 as mismap, case when l_suppkey % 3 = 0 then null else cast(-1.5 as double) end as sense, case when l_suppkey % 3 = 0 then 'G=T' end as don,
  case when l_suppkey % 3 = 0 then 'AG' end as acc, 'g' || l_suppkey as g_chr, l_partkey as g_start, l_partkey + 3 as g_end, 'read' || l_orderkey as r_id, cast(l_linenumber + 4 as bigint) as r_end, '-' as r_strand, 'AC-G' as g_seq from lineitem""")
def _(spark, sf):
    text = lines(spark, sf, "lineitem", _PAIR)
    return AL.parse_maf_pairs(text).select("score", "mismap", "sense", "don", "acc", "g_chr", "g_start", "g_end", "r_id", "r_end", "r_strand", "g_seq")


@query("psl_rows", """select o_custkey as matches, '-' as strand, 'q' || o_orderkey as q_name, o_custkey + 2000 as q_size, o_custkey + 10 as q_start, o_custkey + 500 as q_end, 't' || o_custkey as t_name,
  o_orderkey as t_start, '9,9,' as block_sizes, cast(2000 - 500 as bigint) as r_start, cast(2000 - 10 as bigint) as r_end from orders""")
def _(spark, sf):
    row = tabs("o_custkey", "1", "0", "0", "0", "0", "0", "0", "'-'", "'q' || o_orderkey", "o_custkey + 2000", "o_custkey + 10", "o_custkey + 500", "'t' || o_custkey", "90000000", "o_orderkey",
               "o_orderkey + 490", "2", "'9,9,'", "'1,2,'", "'3,4,'")
    psl = AL.parse_psl(lines(spark, sf, "orders", f"{row} || {ENDS.format('o_orderkey')}"))
    c = AL.strand_coordinates(psl).select("r_id", "r_start", "r_end")
    return psl.join(c, psl["q_name"] == c["r_id"]).select("matches", "strand", "q_name", "q_size", "q_start", "q_end", "t_name", "t_start", "block_sizes", "r_start", "r_end")


@query("gff_rows", """select 'chr' || l_suppkey as chr, l_partkey as start, l_partkey + l_linenumber as "end", case when l_linenumber % 2 = 0 then '-' else '+' end as strand,
  'id' || l_orderkey as id, case when l_linenumber % 3 = 0 then 'x=y' else 'n' end as note from lineitem where l_linenumber <> 4""")
def _(spark, sf):
    row = tabs("'chr' || l_suppkey", "'src'", "case when l_linenumber = 4 then 'gene' else 'CDS' end", "l_partkey + 1", "l_partkey + l_linenumber", "'.'",
               "case when l_linenumber % 2 = 0 then '-' else '+' end", "'0'", "'ID=old; ID=id' || l_orderkey || ';note=' || case when l_linenumber % 3 = 0 then 'x=y' else 'n' end")
    text = lines(spark, sf, "lineitem", f"{row} || {ENDS.format('l_orderkey')}").unionByName(lines(spark, sf, "region", "'##gff-version 3'"))
    return FE.with_attributes(FE.parse_gff(text, ["CDS"]), "ID", "note").select("chr", "start", "end", "strand", F.col("ID").alias("id"), "note")


@query("repeatmasker_rows", """select 'chr' || l_suppkey as chr, l_partkey - 1 as start, l_partkey + 50 as "end", case when l_linenumber % 2 = 0 then '-' else '+' end as strand, 'rep' || l_orderkey as name,
  case when l_linenumber = 1 then 'LINE/L1' else 'DNA' end as class from lineitem""")
def _(spark, sf):
    row = ("'   ' || l_orderkey || '  1.3 0.6  1.7  chr' || l_suppkey || '   ' || l_partkey || ' ' || (l_partkey + 50) || ' (99) ' || case when l_linenumber % 2 = 0 then 'C' else '+' end || '  rep' || l_orderkey "
           f"|| ' ' || case when l_linenumber = 1 then 'LINE/L1' else 'DNA' end || ' 712 1' || {ENDS.format('l_orderkey')}")
    text = lines(spark, sf, "lineitem", row).unionByName(lines(spark, sf, "region", "case when r_regionkey = 0 then '' else 'score  div. del. ins. query begin end left x name class' end"))
    return FE.parse_repeatmasker(text, base=1)


@query("tandem_repeat_rows", """select 'c' || p_size as chr, p_partkey as start, p_partkey + p_size as "end", p_name || ',2' as rest from part""")
def _(spark, sf):
    text = lines(spark, sf, "part", tabs("'c' || p_size", "p_partkey", "p_partkey + p_size", "p_name", "2") + f" || {ENDS.format('p_partkey')}").unionByName(lines(spark, sf, "region", f"'#' || r_name || {TAB} || 'a' || {TAB} || 'b'"))
    return FE.parse_tandem_repeats(text).withColumn("rest", F.array_join("rest", ","))


@query("fasta_records", """select 's' || doc_id as name, 's' || doc_id || ' ' || source as description, md5(regexp_replace(text, '[^a-zA-Z]+', '', 'g')) as seq, length(regexp_replace(text, '[^a-zA-Z]+', '', 'g')) as n from documents""")
def _(spark, sf):
    body = "regexp_replace(regexp_replace(text, '[^a-zA-Z]+', ''), '(.{60})', concat('$1', chr(10)))"
    text = lines(spark, sf, "documents", f"case when doc_id % 3 = 0 then '>' else '' end || 's' || doc_id || ' ' || source || chr(13) || chr(10) || {body}", "source as file")
    return SQ.parse_fasta(text).select("name", "description", F.md5(F.col("seq").cast("binary")).alias("seq"), F.length("seq").cast("long").alias("n"))


@query("spectrum_rows", """select 'GCA_' || p_partkey as accession, p_brand as short_name, case when p_size % 2 = 0 then '2025' else '' end as date, 'A[C>T]' || p_size as "mutType", p_partkey as "mutNum",
  p_partkey * 3 as "totalRootNum", 'ACG' as "oriType", p_size + 1::bigint as s_cds from part""")
def _(spark, sf):
    text = lines(spark, sf, "part", tabs("'A[C>T]' || p_size", "p_partkey", "p_partkey * 3", "'ACG'", "p_size + 1"),
                 "concat('GCA_', p_partkey, '_', p_brand, case when p_size % 2 = 0 then '_2025' else '' end, '.tsv') as file")
    head = text.select(F.concat(F.lit("mutType\tmutNum\ttotalRootNum\toriType\ts_cds"), F.substring("file", 1, 0)).alias("value"), "file").distinct()
    return TB.parse_spectra(text.unionByName(head), ["mutType", "mutNum", "totalRootNum", "oriType", "s_cds"])


@query("metadata_documents", """select 'GCA_' || n_nationkey as accession, case when n_nationkey % 5 = 0 then null else n_name end as organism,
  case when n_nationkey % 2 = 0 and n_nationkey % 5 <> 0 then 's' || n_nationkey else '' end as infraspecific from nation""")
def _(spark, sf):
    text = lines(spark, sf, "nation", "case when n_nationkey % 5 = 0 then '{}' else concat('{\"reports\":[{\"accession\":\"x\",\"organism\":{\"organism_name\":\"', n_name, '\"', "
                 "case when n_nationkey % 2 = 0 then concat(',\"infraspecific_names\":{\"strain\":\"s', n_nationkey, '\"}') else '' end, '}}]}') end", "concat('GCA_', n_nationkey, '.json') as file")
    return TB.parse_metadata(text).withColumn("infraspecific", F.coalesce(F.array_join("infraspecific", ","), F.lit("")))


@query("trio_entries", f"""select c_mktsegment as taxon, 'GCA_' || c_custkey as acc1, 'GCF_' || c_custkey as acc2, 'GCA_' || c_custkey || ' ' || c_name as name1, {rnd('70 + c_custkey % 300 / 10.0')} as identity
  from customer where c_custkey % 7 <> 0""")
def _(spark, sf):
    text = lines(spark, sf, "customer", "'GCA_' || c_custkey || ' ' || c_name || chr(10) || 'GCF_' || c_custkey || ' 1' || chr(10) || case when c_custkey % 7 = 0 then '' else '# substitution percent identity: ' || (70 + c_custkey % 300 / 10.0) end "
                 "|| case when c_custkey % 2 = 0 then chr(13) else '' end || chr(10)", "concat(c_mktsegment, '.txt') as file")
    return TB.parse_trios(text).select("taxon", "acc1", "acc2", "name1", (F.round("identity", 6) + F.lit(0.0)).alias("identity"))


@query("intron_json", """select 'i' || l_orderkey || '_' || l_linenumber as key, 'c' || l_suppkey as chr, l_partkey as pos, l_partkey + 100 as end_pos, cast(100 as bigint) as length, 'GT' as don,
  case when l_linenumber % 2 = 0 then null else 'AG' end as acc, 'r' || l_orderkey || ',r' || l_linenumber as reads from lineitem""")
def _(spark, sf):
    introns = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "concat('i', l_orderkey, '_', l_linenumber) as key", "struct(concat('c', l_suppkey) as chr, l_partkey as pos, '+' as strand) as start",
        "struct(concat('c', l_suppkey) as chr, l_partkey + 100 as pos, '-' as strand) as end", "cast(100 as bigint) as length", "'GT' as don",
        "case when l_linenumber % 2 = 0 then null else 'AG' end as acc", "array(concat('r', l_orderkey), concat('r', l_linenumber)) as reads")
    back = TB.parse_introns(sinks.intron_json(introns))
    return back.select("key", F.col("start.chr").alias("chr"), F.col("start.pos").alias("pos"), F.col("end.pos").alias("end_pos"), "length", "don", "acc", F.array_join("reads", ",").alias("reads"))

"""Segments, genes and neighbours; sorting and set operators."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..functions import rates
from ..functions.coords import natural_key, prefix_chr, strip_chr
from ..operators import multispecies as M
from ..operators import spectra as S
from ..operators import synteny as Y
from ..operators import normalise as N
from ..sources import sequences as Q
from ..sources.alignments import query_first, ref_first
from . import inputs
from .base import query, rnd, rounded
from .inputs import register
from .intervals import features, segments
from .reads import reads
from .sites import OBS
from .spectra import COLS, SPECTRUM_CTE, aln3, genome, spectrum

register("gene_spans", "part", [
    ("chr", "concat('ref', p_partkey % 5)"), ("start", "p_partkey * 400"), ("\"end\"", "p_partkey * 400 + 40 + p_size * 3 + case when p_partkey % 10 = 0 then 2100 else 0 end"),
    ("strand", "case when p_partkey % 2 = 0 then '+' else '-' end"), ("gene", "p_partkey % 700"), ("product", "p_name"),
])
register("ref_segments", "orders", [
    # segments of one query place lie around one reference place; one gene in ten reaches over the next one
    ("segment_id", "o_orderkey"), ("chr", "concat('ref', (o_orderkey % 2000 + case when o_custkey % 6 = 0 then 7 else 0 end) % 5)"), ("start", "(o_orderkey % 2000 + case when o_custkey % 6 = 0 then 7 else 0 end) * 400 + (o_custkey * 41) % 400"),
    ("\"end\"", "(o_orderkey % 2000 + case when o_custkey % 6 = 0 then 7 else 0 end) * 400 + (o_custkey * 41) % 400 + 1 + o_custkey % 90"), ("strand", "case when o_orderkey % 3 = 0 then '-' else '+' end"),
])
# every other query place has two genes, the rest none
register("query_genes", "part", [
    ("chr", "concat('src', (p_partkey - p_partkey % 2) % 20)"), ("start", "(p_partkey - p_partkey % 2) * 200000 + (p_partkey * 997) % 3500"),
    ("\"end\"", "(p_partkey - p_partkey % 2) * 200000 + (p_partkey * 997) % 3500 + 100 + p_size * 12"), ("gene", "p_partkey"),
])
register("pair_blocks", "lineitem", [
    ("block_id", "l_orderkey * 10000000 + l_linenumber * 1000000 + l_partkey * 50 + cast(l_quantity as bigint)"),
    ("chr_a", "concat('a', l_suppkey % 4)"), ("strand_a", "'+'"), ("start_a", "l_orderkey * 3 + l_linenumber * 90"),
    ("end_a", "l_orderkey * 3 + l_linenumber * 90 + cast(l_quantity as bigint)"),
    ("chr_b", "concat('b', l_suppkey % 4)"), ("strand_b", "case when l_suppkey % 8 < 4 then '+' else '-' end"),
    ("start_b", "l_orderkey * 3 + l_linenumber * 91 + l_partkey % 3"),
    ("end_b", "l_orderkey * 3 + l_linenumber * 91 + l_partkey % 3 + cast(l_quantity as bigint)"),
])
# near-collinear blocks: one in 150 reaches over the next ones, one in 97 is shifted, one in 211 starts where its neighbour does
register("chain_blocks", "orders", [
    ("block_id", "o_orderkey"), ("chr_a", "concat('a', o_orderkey - o_orderkey % 3000)"), ("strand_a", "'+'"),
    ("start_a", "(o_orderkey - case when o_custkey % 211 = 7 then 1 else 0 end) * 100"),
    ("end_a", "(o_orderkey - case when o_custkey % 211 = 7 then 1 else 0 end) * 100 + 60 + case when o_custkey % 150 = 9 then 300 else 0 end"),
    ("chr_b", "concat('b', o_orderkey - o_orderkey % 5000)"), ("strand_b", "case when o_orderkey % 2500 < 1250 then '+' else '-' end"),
    ("start_b", "o_orderkey * 110 + case when o_custkey % 97 = 11 then 5000 else 0 end"),
    ("end_b", "o_orderkey * 110 + case when o_custkey % 97 = 11 then 5000 else 0 end + 70 + o_custkey % 30"),
])
register("trio_pairs", "customer", [
    ("taxon", "c_mktsegment"), ("trio_id", "c_custkey"), ("ab", "90 + (c_custkey % 90) / 10.0"),
    ("ca", "80 + (c_custkey % 70) / 10.0"), ("cb", "80 + (c_custkey % 61) / 10.0"), ("identity", "78 + c_acctbal / 600.0"),
])


def _load(name):
    return lambda spark, sf: inputs.load(spark, sf, name)


gene_spans, ref_segments, pair_blocks, trio_pairs, query_genes = (_load(n) for n in ("gene_spans", "ref_segments", "pair_blocks", "trio_pairs", "query_genes"))

SEG = f"with {inputs.cte('segments')}"
CLOSE = f"""{SEG}, g0 as (select *, start - lag("end") over w as gap from segments window w as (partition by chr order by start, "end", segment_id)),
  g1 as (select *, sum(case when gap between 0 and 500 then 0 else 1 end) over (partition by chr order by start, "end", segment_id) as g from g0),
  close as materialized (select chr, min(start) over (partition by chr, g) as "group", segment_id, start, "end", g, count(*) over (partition by chr, g) as c from g1),
  members as materialized (select chr, cast("group" as bigint) as "group", segment_id from close where c > 1)"""


@query("close_groups", f"{CLOSE} select * from members")
def _(spark, sf):
    return Y.close_groups(segments(spark, sf), 500, "segment_id")


@query("overlap_groups", f"""{SEG}, g0 as (select *, max("end") over (partition by chr order by start, "end", segment_id rows between unbounded preceding and 1 preceding) as reach from segments),
  g1 as (select *, sum(case when reach is null or start >= reach then 1 else 0 end) over (partition by chr order by start, "end", segment_id) as g from g0),
  g2 as (select chr, min(start) over (partition by chr, g) as "group", segment_id, count(*) over (partition by chr, g) as c from g1)
  select chr, cast("group" as bigint) as "group", segment_id from g2 where c > 1""")
def _(spark, sf):
    return Y.overlap_groups(segments(spark, sf), "segment_id")


PB = f"with {inputs.cte('pair_blocks')}"


@query("joined_blocks", f"""{PB}, l as (select *, lag(row(chr_a, strand_a, end_a, chr_b, strand_b, end_b)) over (partition by chr_a order by start_a, block_id) as p from pair_blocks),
  f as (select *, case when p is not null and p[2] = strand_a and start_a - p[3] between 0 and 200 and p[4] = chr_b and p[5] = strand_b
     and start_b - p[6] between 0 and 200 then 0 else 1 end as o from l)
  select block_id, chr_a, cast(sum(o) over (partition by chr_a order by start_a, block_id) as bigint) as joined from f""")
def _(spark, sf):
    return Y.joined_blocks(pair_blocks(spark, sf), 200).select("block_id", "chr_a", "joined")


def _links_sql(s: str, blocks: str = "pair_blocks") -> str:
    return f"""{s}0 as (select block_id, chr_{s} as chr, strand_{s} as strand, start_{s} as start, end_{s} as e,
      lag(block_id) over w as prev_id, lag(end_{s}) over w as pe, lead(start_{s}) over w as ns,
      max(end_{s}) over (partition by chr_{s}, strand_{s} order by start_{s}, block_id rows between unbounded preceding and 2 preceding) as reach
      from {blocks} window w as (partition by chr_{s}, strand_{s} order by start_{s}, block_id)),
    {s}1 as (select prev_id, block_id from {s}0 where prev_id is not null and start - pe between 0 and 2000 and (reach is null or pe > reach) and (ns is null or start < ns))"""


@query("unique_links", f"{PB}, {_links_sql('a')}, {_links_sql('b')} select prev_id, block_id from a1 intersect select prev_id, block_id from b1")
def _(spark, sf):
    return Y.unique_links(pair_blocks(spark, sf), 2000)


@query("block_chains", f"""with recursive {inputs.cte('chain_blocks')}, {_links_sql('a', 'chain_blocks')}, {_links_sql('b', 'chain_blocks')},
  links as materialized (select prev_id, block_id from a1 intersect select prev_id, block_id from b1),
  chains as (select block_id, block_id as chain, cast(0 as bigint) as place from chain_blocks where block_id not in (select block_id from links)
    union all select l.block_id, c.chain, c.place + 1 from chains c join links l on l.prev_id = c.block_id)
  select * from chains""")
def _(spark, sf):
    return Y.block_chains(inputs.load(spark, sf, "chain_blocks"), 2000)


# ---- genes -----------------------------------------------------------------

QG = f"""{inputs.cte('query_genes', 'gene_spans', 'ref_segments')},
  qg as materialized (select distinct s.segment_id, f.gene from segments s left join query_genes f on f.chr = s.chr and s.start < f."end" and f.start < s."end"),
  rg as materialized (select distinct s.segment_id, f.gene from ref_segments s left join gene_spans f on f.chr = s.chr and s.start < f."end" and f.start < s."end")"""


def _genes(spark, sf):
    q = Y.genes_per_segment(segments(spark, sf), query_genes(spark, sf), "segment_id", bin_size=1024)
    r = Y.genes_per_segment(ref_segments(spark, sf), gene_spans(spark, sf), "segment_id", bin_size=256)
    return q, r


@query("genes_per_segment", f"{SEG}, {QG} select 'query' as side, * from qg union all select 'ref', * from rg")
def _(spark, sf):
    q, r = _genes(spark, sf)
    return q.select(F.lit("query").alias("side"), "*").unionByName(r.select(F.lit("ref").alias("side"), "*"))


@query("group_classes", f"""{CLOSE}, {QG},
  multi as (select segment_id from qg group by 1 having count(gene) > 1 union select segment_id from rg group by 1 having count(gene) > 1),
  c as (select m.chr, m."group", count(distinct r.gene) as r, count(distinct q.gene) as q, bool_or(x.segment_id is not null) as multi
    from members m left join rg r using (segment_id) left join qg q using (segment_id) left join multi x using (segment_id) group by 1, 2)
  select chr, "group", case when multi then 'multiCDSOnOneSeg' when r = 0 and q <> 0 then 'nonCDSOnRef_CDSOnQuery' when r <> 0 and q = 0 then 'cdsOnRef_nonCDSOnQuery'
    when r = 0 and q = 0 then 'nonCDSOnRef_nonCDSOnQuery' when r = 1 and q = 1 then 'sameOnRef_sameOnQuery' when r = 1 then 'sameOnRef_diffOnQuery'
    when q = 1 then 'diffOnRef_sameOnQuery' else 'diffOnRef_diffOnQuery' end as class from c""")
def _(spark, sf):
    q, r = _genes(spark, sf)
    members = Y.close_groups(segments(spark, sf), 500, "segment_id")
    return Y.group_classes(members, r, q, "segment_id").select("chr", "group", "class")


@query("gene_relation", f"""{CLOSE}, {QG}, f as (select m.chr, m."group", count(distinct r.gene) as g, bool_or(r.gene is null) as n
   from members m join rg r using (segment_id) group by 1, 2)
  select chr, "group", case when g = 1 and not n then 'sameGene' when g = 0 then 'allNoGene' when n then 'diffGene_icldNoGene' else 'diffGene_noNoGene' end as class from f""")
def _(spark, sf):
    members = Y.close_groups(segments(spark, sf), 500, "segment_id")
    r = Y.genes_per_segment(ref_segments(spark, sf), gene_spans(spark, sf), "segment_id", bin_size=256)
    return Y.gene_relation(members.join(r, "segment_id"), ["chr", "group"]).select("chr", "group", "class")


@query("segments_per_gene", f"{SEG}, {QG} select gene, count(*) as segments, case when count(*) = 1 then 'single' else 'multiple' end as class from qg where gene is not null group by 1")
def _(spark, sf):
    q, _r = _genes(spark, sf)
    return Y.segments_per_gene(q.where("gene is not null"), "gene")


@query("reference_genes_per_gene", f"""{SEG}, {QG} select q.gene, count(distinct r.gene) as ref_genes, case when count(distinct r.gene) = 1 then 'same' else 'different' end as class
  from qg q join rg r using (segment_id) where q.gene is not null and r.gene is not null group by 1""")
def _(spark, sf):
    q, r = _genes(spark, sf)
    both = q.where("gene is not null").join(r.where("gene is not null").withColumnRenamed("gene", "ref_gene"), "segment_id")
    return Y.reference_genes_per_gene(both, "gene", "ref_gene")


SYN = f"""{SEG}, {inputs.cte('features', 'gene_spans', 'ref_segments')},
  pairs as materialized (select s.segment_id, t.strand, f.gene as q_gene, f.strand as q_strand, g.gene as r_gene, g.strand as r_strand, f.feature_id, g.start as g_start
    from segments s join features f on f.chr = s.chr and s.start < f."end" and f.start < s."end"
    join ref_segments t using (segment_id) join gene_spans g on g.chr = t.chr and t.start < g."end" and g.start < t."end")"""


def _pairs(spark, sf):
    from ..plans.synteny import segment_gene_pairs
    return segment_gene_pairs(segments(spark, sf), features(spark, sf), ref_segments(spark, sf), gene_spans(spark, sf))


@query("segment_gene_pairs", f"{SYN} select segment_id, strand, q_gene, q_strand, r_gene, r_strand from pairs")
def _(spark, sf):
    return _pairs(spark, sf).select("segment_id", "strand", "q_gene", "q_strand", "r_gene", "r_strand")


@query("strand_consistency", f"{SYN} select (strand = '+') = (q_strand = r_strand) as consistent, count(*) as n from pairs group by 1")
def _(spark, sf):
    return _pairs(spark, sf).groupBy(Y.strand_consistent("strand", "q_strand", "r_strand").alias("consistent")).agg(F.count(F.lit(1)).alias("n"))


@query("first_pair_per_segment", f"""{SYN} select segment_id, arg_min(q_gene, row(q_gene, r_gene, feature_id, g_start)) as q_gene,
  arg_min(r_gene, row(q_gene, r_gene, feature_id, g_start)) as r_gene from pairs group by 1""")
def _(spark, sf):
    p = _pairs(spark, sf).select("segment_id", "q_gene", "r_gene", "feature_id", "g_start")
    return Y.first_per_key(p, ["segment_id"], ["q_gene", "r_gene", "feature_id", "g_start"]).select("segment_id", "q_gene", "r_gene")


@query("neighbour_relations_2", f"""{SYN}, o as (select distinct segment_id, q_gene, r_gene from pairs),
  s as (select g.chr, g.start, o.* from o join segments g using (segment_id)),
  n as (select *, lag(q_gene) over w as pq, lag(r_gene) over w as pr from s window w as (partition by chr order by start, segment_id, q_gene, r_gene))
  select chr, segment_id, q_gene, r_gene, case when pq = q_gene then 'same' else 'diff' end || '-' || case when pr = r_gene then 'same' else 'diff' end as relation
  from n where pq is not null""")
def _(spark, sf):
    o = _pairs(spark, sf).select("segment_id", "q_gene", "r_gene").distinct()
    s = o.join(segments(spark, sf).select("segment_id", "chr", "start"), "segment_id")
    return Y.neighbour_relations(s, ["chr"], "start", ["segment_id", "q_gene", "r_gene"], ["q_gene", "r_gene"]).select(
        "chr", "segment_id", "q_gene", "r_gene", "relation")


@query("neighbour_relations_3", """with e as (select l_orderkey as pos, l_linenumber as n, l_suppkey % 4 as g1, l_partkey % 3 as g2, l_linenumber % 2 as g3,
    l_partkey as k1, l_suppkey as k2, cast(l_quantity as bigint) as k3, l_returnflag as chr, l_extendedprice as k4 from lineitem),
  n as (select *, lag(g1) over w as p1, lag(g2) over w as p2, lag(g3) over w as p3 from e window w as (partition by chr order by pos, n, k1, k2, k3, k4))
  select chr, case when p1 = g1 then 'same' else 'diff' end || '-' || case when p2 = g2 then 'same' else 'diff' end || '-' || case when p3 = g3 then 'same' else 'diff' end as relation,
    count(*) as c from n where p1 is not null group by 1, 2""")
def _(spark, sf):
    e = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "l_orderkey as pos", "l_linenumber as n", "l_suppkey % 4 as g1", "l_partkey % 3 as g2", "l_linenumber % 2 as g3",
        "l_partkey as k1", "l_suppkey as k2", "cast(l_quantity as bigint) as k3", "l_returnflag as chr", "l_extendedprice as k4")
    r = Y.neighbour_relations(e, ["chr"], "pos", ["n", "k1", "k2", "k3", "k4"], ["g1", "g2", "g3"])
    return r.groupBy("chr", "relation").agg(F.count(F.lit(1)).alias("c"))


@query("gene_dimension_join", f"""{SEG}, {QG}, dim as (select gene, max(row(chr, start, "end", strand)) as g from gene_spans group by 1)
  select segment_id, r.gene, g[1] as gene_chr, g[2] as gene_start, g[3] as gene_end from rg r join dim using (gene)""")
def _(spark, sf):
    _q, r = _genes(spark, sf)
    return Y.with_gene_span(r.where("gene is not null"), gene_spans(spark, sf).drop("product")).select(
        "segment_id", "gene", "gene_chr", "gene_start", "gene_end")


@query("listed_alignments", f"""with {inputs.cte('reads')}, w as (select distinct g_chr, g_start, g_end, r_start, r_end, r_strand from reads where score > 104000)
  select aln_id, r_id from reads join w using (g_chr, g_start, g_end, r_start, r_end, r_strand)""")
def _(spark, sf):
    r = reads(spark, sf)
    keys = ["g_chr", "g_start", "g_end", "r_start", "r_end", "r_strand"]
    return Y.listed_alignments(r, r.where("score > 104000"), keys).select("aln_id", "r_id")


@query("lift_by_reference", f"""{SEG}, {inputs.cte('features')} select distinct s.segment_id from segments s join features f
  on f.chr = s.chr and s.start < f."end" and f.start < s."end" where f.strand = '+'""")
def _(spark, sf):
    return Y.lift_by_reference(features(spark, sf).where("strand = '+'"), segments(spark, sf), bin_size=1024).select("segment_id")


MATE = """with a as (select distinct l_orderkey as pair_id from lineitem where l_returnflag = 'A'), b as (select distinct l_orderkey as pair_id from lineitem where l_returnflag = 'R')"""


@query("mate_pairs", f"""{MATE} select pair_id, 'pair' as kind from a join b using (pair_id) union all select pair_id, 'single_1' from a anti join b using (pair_id)
  union all select pair_id, 'single_2' from b anti join a using (pair_id)""")
def _(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    side = lambda f: li.where(F.col("l_returnflag") == f).select(F.col("l_orderkey").alias("pair_id")).distinct()
    both, one, two = Y.mates(side("A"), side("R"))
    tag = lambda d, k: d.select("pair_id", F.lit(k).alias("kind"))
    return tag(both, "pair").unionByName(tag(one, "single_1")).unionByName(tag(two, "single_2"))


# every line is on one side or the other
@query("mate_pairs_of_all_rows", """with a as (select distinct l_orderkey as pair_id from lineitem where l_linenumber % 2 = 1), b as (select distinct l_orderkey as pair_id from lineitem where l_linenumber % 2 = 0)
  select pair_id, 'pair' as kind from a join b using (pair_id) union all select pair_id, 'single_1' from a anti join b using (pair_id)
  union all select pair_id, 'single_2' from b anti join a using (pair_id)""")
def _(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    side = lambda odd: li.where((F.col("l_linenumber") % 2 == odd)).select(F.col("l_orderkey").alias("pair_id")).distinct()
    both, one, two = Y.mates(side(1), side(0))
    tag = lambda d, k: d.select("pair_id", F.lit(k).alias("kind"))
    return tag(both, "pair").unionByName(tag(one, "single_1")).unionByName(tag(two, "single_2"))


@query("distinct_rows", f"{SEG} select distinct chr, start, \"end\" from segments")
def _(spark, sf):
    return segments(spark, sf).select("chr", "start", "end").distinct()


@query("distinct_descriptions", f"with {inputs.cte('gene_spans')} select count(distinct product) as products from gene_spans")
def _(spark, sf):
    return gene_spans(spark, sf).agg(F.count_distinct("product").alias("products"))


@query("frequent_descriptions", f"with {inputs.cte('gene_spans')} select product, count(*) as \"count\" from gene_spans group by 1 order by 2 desc, 1 limit 10")
def _(spark, sf):
    return Y.top_values(gene_spans(spark, sf), "product", 10)


@query("map_keys", "select k, count(*) as n from (select unnest(json_keys(props)) as k from events) e group by 1")
def _(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    keys = e.select(F.explode(F.map_keys(F.from_json("props", "map<string,string>"))).alias("k"))
    return keys.groupBy("k").agg(F.count(F.lit(1)).alias("n"))


@query("latest_run", """select cast(o_custkey as varchar) as dataset, max(strftime(o_orderdate, '%Y%m%d')) as run from orders group by 1""")
def _(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return Y.latest_run(o.select(F.col("o_custkey").cast("string").alias("dataset"), F.date_format("o_orderdate", "yyyyMMdd").alias("run")))


@query("sorted_by_query", f"""with {inputs.cte('reads')}, p as (select aln_id, r_id, case when r_strand = '-' then r_len - r_end else r_start end as r_pstart,
  case when r_strand = '-' then r_len - r_start else r_end end as r_pend from reads)
  select aln_id, r_id, r_pstart, r_pend from p order by r_id, r_pstart, r_pend, aln_id""")
def _(spark, sf):
    from ..operators.reads import placed
    return placed(reads(spark, sf)).select("aln_id", "r_id", "r_pstart", "r_pend").orderBy("r_id", "r_pstart", "r_pend", "aln_id")


@query("sorted_by_reference", f"with {inputs.cte('reads')} select aln_id, g_chr, g_start, g_end from reads order by g_chr, g_start, g_end, aln_id")
def _(spark, sf):
    return reads(spark, sf).select("aln_id", "g_chr", "g_start", "g_end").orderBy("g_chr", "g_start", "g_end", "aln_id")


@query("natural_chromosome_order", f"""with {inputs.cte('aln3')}, c as (select distinct chr_a as chr from aln3)
  select chr, 'src' || lpad(regexp_extract(chr, '([0-9]+)', 1), 20, '0') as key from c order by key""")
def _(spark, sf):
    chrs = aln3(spark, sf).select(F.col("chr_a").alias("chr")).distinct()
    return chrs.withColumn("key", natural_key("chr")).orderBy("key")


@query("column_orders", f"""{SEG}, {inputs.cte('ref_segments')} select 'chr_' || r.chr as r_chr, r.start as r_start, r."end" as r_end, s.chr as q_chr, s.start as q_start, s."end" as q_end, r.strand
  from segments s join ref_segments r using (segment_id)""")
def _(spark, sf):
    q = segments(spark, sf).select("segment_id", F.col("chr").alias("q_chr"), F.col("start").alias("q_start"), F.col("end").alias("q_end"))
    r = ref_segments(spark, sf).select("segment_id", prefix_chr("chr", "chr_").alias("r_chr"), F.col("start").alias("r_start"),
                                       F.col("end").alias("r_end"), "strand")
    both = q.join(r, "segment_id").drop("segment_id")
    back = query_first(ref_first(both)).withColumn("r_chr", strip_chr("r_chr", "chr_"))
    return ref_first(back.withColumn("r_chr", prefix_chr("r_chr", "chr_")))


# ---- trios and species -----------------------------------------------------

@query("branch_rates", f"""with {inputs.cte('trio_pairs')}, p as (select trio_id, round((100 - ab + 100 - ca - (100 - cb)) / 2, 9) as a, round((100 - ab + 100 - cb - (100 - ca)) / 2, 9) as b,
  round((100 - ca + 100 - cb - (100 - ab)) / 2, 9) as c from trio_pairs)
  select trio_id, {rnd('a')} as rate_a, {rnd('b')} as rate_b, {rnd('c')} as rate_c,
   {rnd('(a/3 * (100-b) * (100-c)) / nullif((100-a) * (b/3) * (c/3), 0)', 3)} as odds_a,
   {rnd('((100-a) * (b/3) * (100-c)) / nullif((a/3) * (100-b) * (c/3), 0)', 3)} as odds_b from p""")
def _(spark, sf):
    t = trio_pairs(spark, sf)
    out = t.select("trio_id", *[c.alias(n) for n, c in rates.branch_rates("ab", "ca", "cb").items()])
    return rounded(rounded(out, "rate_a", "rate_b", "rate_c"), "odds_a", "odds_b", places=3)


@query("trio_statistics", f"""with {inputs.cte('trio_pairs')} select taxon, count(*) as pairs, {rnd('min(identity)')} as lowest, {rnd('avg(identity)')} as mean,
  {rnd('max(identity)')} as highest, bool_and(identity >= 80) as all_recommended from trio_pairs group by 1""")
def _(spark, sf):
    return rounded(M.trio_statistics(trio_pairs(spark, sf)), "lowest", "mean", "highest")


META = """meta as (select 'src' || n_nationkey as accession, case when n_nationkey % 4 = 3 then null else n_name || ' ' || r_name end as organism
  from nation join region on r_regionkey = n_regionkey)"""


def _metadata(spark, sf):
    n, r = spark.read.parquet(f"{sf}/nation.parquet"), spark.read.parquet(f"{sf}/region.parquet")
    name = F.when(F.col("n_nationkey") % 4 != 3, F.concat("n_name", F.lit(" "), "r_name"))
    return n.join(r, F.col("r_regionkey") == F.col("n_regionkey")).select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("accession"), name.alias("organism"))


@query("species_metadata", f"""with {inputs.cte('aln3')}, {META}, s as (select distinct chr_a as accession from aln3)
  select s.accession, coalesce(organism, s.accession) as organism, coalesce(split_part(organism, ' ', 1), 'Unknown') as genus,
    case when organism is null then 'sp (' || s.accession || ')' else replace(organism, ' ', '_') || ' (sp)' end as label
  from s left join meta m on m.accession = s.accession""")
def _(spark, sf):
    s = aln3(spark, sf).select(F.col("chr_a").alias("accession")).distinct()
    meta = _metadata(spark, sf).withColumn("label", M.species_label(
        "organism", F.lit(None).cast("array<string>"), F.lit("sp"), "accession"))
    j = M.with_metadata(s, meta)
    return j.select("accession", "organism", "genus", F.coalesce("label", F.concat(F.lit("sp ("), "accession", F.lit(")"))).alias("label"))


def species_spectra(spark, sf):
    """One spectrum per source genome and ingroup species; each of the two is a sample."""
    a = aln3(spark, sf).drop("trio").withColumnRenamed("chr_a", "genome")
    return S.tri_spectrum(a, ["genome"]).withColumn("sample", F.concat_ws("_", "genome", "species")).drop("genome", "species")


def _features(spark, sf):
    f = N.log_ratio_smooth(species_spectra(spark, sf), ["sample"])
    return M.feature_table(f, "sample", "feature")


SAMPLE_SPECTRUM = SPECTRUM_CTE.replace("lang as trio", "source as trio")


@query("feature_table", f"""{SAMPLE_SPECTRUM}, o as (select trio || '_' || species as trio, "mutType", coalesce({OBS}, 0.0) as obs from spectrum),
  f as (select trio as sample, "mutType", log2((obs + 1e-12) / greatest(avg(obs) over (partition by trio), 1e-12)) as v from o)
  select sample, {', '.join(rnd(f'''max(case when "mutType" = '{l}' then v end)''') + f' as "{l}"' for l in M.LABELS)} from f group by 1""")
def _(spark, sf):
    t = _features(spark, sf)
    return t.select("sample", *[(F.round(F.col(f"`{l}`"), 6) + F.lit(0.0)).alias(l) for l in M.LABELS])


FEATURES = f"""{SAMPLE_SPECTRUM}, o as (select trio || '_' || species as trio, "mutType", coalesce({OBS}, 0.0) as obs from spectrum),
  f as (select trio as sample, "mutType", log2((obs + 1e-12) / greatest(avg(obs) over (partition by trio), 1e-12)) as v from o)"""


@query("standardised_features", f"""{FEATURES}, z as (select sample, "mutType", v - avg(v) over w as d, stddev_samp(v) over w as s from f window w as (partition by "mutType"))
  select sample, "mutType", {rnd('case when s > 0 then d / s else 0.0 end', 5)} as z from z""")
def _(spark, sf):
    scaled = M.standardised(M.feature_vectors(_features(spark, sf), "sample"))
    z = scaled.select("sample", F.posexplode(vector_to_array("scaled")).alias("i", "z"))
    return rounded(z.select("sample", F.array(*[F.lit(l) for l in M.LABELS])[F.col("i")].alias("mutType"), "z"), "z", places=5)


SAMPLES = "n as (select count(distinct source) * 2 as n from documents)"


@query("component_checks", f"""with {SAMPLES} select cast(c as integer) as component, n as samples, true as centred, true as in_order from n, range(1, 4) t(c)""")
def _(spark, sf):
    projected, _variance = M.principal_components(M.feature_vectors(_features(spark, sf), "sample"), "sample", 3)
    pc = projected.select("sample", F.posexplode(vector_to_array("pc")).alias("i", "v"))
    per = pc.groupBy((F.col("i") + 1).alias("component")).agg(F.count("*").alias("samples"), (F.abs(F.avg("v")) < 1e-6).alias("centred"), F.var_samp("v").alias("variance"))
    one = F.collect_list(F.struct("component", "samples", "centred", "variance"))  # three rows
    rows = per.agg(F.array_sort(one).alias("r")).select(F.posexplode("r").alias("k", "x"), "r")
    return rows.select("x.component", "x.samples", "x.centred",
                       ((F.col("k") == 0) | (F.get("r", F.col("k") - 1)["variance"] + 1e-9 >= F.col("x.variance"))).alias("in_order"))


@query("cluster_checks", f"""with {SAMPLES} select n as placed, n as counted, true as k_in_range, true as complete from n""")
def _(spark, sf):
    projected, _v = M.principal_components(M.feature_vectors(_features(spark, sf), "sample"), "sample", 2)
    clusters, scores = M.best_kmeans(projected, "sample")
    t = M.cluster_table(projected, clusters, "sample")
    per = t.groupBy("cluster").agg(F.count("*").alias("n"), F.first("samples").alias("samples"))
    n = F.sum("n")
    return per.agg(n.alias("placed"), F.sum("samples").alias("counted"), F.count("*").between(F.lit(2), F.least(F.lit(10), n - 1)).alias("k_in_range"),
                   (F.lit(len(scores)) == F.least(F.lit(10), n - 1) - 1).alias("complete"))


@query("principal_components")
def _(spark, sf):
    projected, _variance = M.principal_components(M.feature_vectors(_features(spark, sf), "sample"), "sample", 2)
    return M.vector_columns(projected, "sample", 2)


@query("explained_variance")
def _(spark, sf):
    _p, variance = M.principal_components(M.feature_vectors(_features(spark, sf), "sample"), "sample", 3)
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(variance)], "component int, explained double")


@query("species_clusters")
def _(spark, sf):
    projected, _v = M.principal_components(M.feature_vectors(_features(spark, sf), "sample"), "sample", 2)
    clusters, _scores = M.best_kmeans(projected, "sample")
    return M.cluster_table(projected, clusters, "sample")


# ---- summary ---------------------------------------------------------------

IDENT = f"""with {inputs.cte('aln3')}, {COLS}, {META},
  ident as (select trio, 'B' as species, count(*) filter (where a = b) * 100.0 / count(*) as v from cols where a <> '-' and b <> '-' group by 1
    union all select trio, 'C', count(*) filter (where a = c) * 100.0 / count(*) from cols where a <> '-' and c <> '-' group by 1),
  ratio as (select trio, 'B' as species, count(*) filter (where a = c and a <> b) * 100.0 / count(*) filter (where a = b or a = c and a <> b) as v
      from cols where a <> '-' and b <> '-' and c <> '-' group by 1
    union all select trio, 'C', count(*) filter (where a = b and a <> c) * 100.0 / count(*) filter (where a = c or a = b and a <> c)
      from cols where a <> '-' and b <> '-' and c <> '-' group by 1),
  gc as (select trio, 'B' as species, count(*) filter (where b in ('C', 'G')) * 100.0 / count(*) filter (where b in ('A', 'C', 'G', 'T')) as v from cols group by 1
    union all select trio, 'C', count(*) filter (where c in ('C', 'G')) * 100.0 / count(*) filter (where c in ('A', 'C', 'G', 'T')) from cols group by 1),
  expected as (select t.trio, s.species from (select distinct trio from aln3 union select 'none') t, (values ('B'), ('C')) s(species))"""


def _summary_inputs(spark, sf):
    a = aln3(spark, sf)
    from ..plans.trio import trio_metrics
    metrics = trio_metrics(a, ["trio"])
    trios = a.select("trio").distinct().unionByName(spark.range(1).select(F.lit("none").alias("trio")))
    expected = trios.select("trio", F.explode(F.array(F.lit("B"), F.lit("C"))).alias("species"))
    return expected, metrics


@query("species_summary", f"""{IDENT} select e.trio, e.species, {rnd('i.v')} as identity, {rnd('r.v')} as substitution_ratio, {rnd('g.v')} as gc,
   coalesce(m.organism, '(missing)') as organism from expected e left join ident i using (trio, species) left join ratio r using (trio, species)
   left join gc g using (trio, species) left join (select trio, species, case when trio = 'en' then 'Anglia' end as organism from expected) m using (trio, species)""")
def _(spark, sf):
    expected, metrics = _summary_inputs(spark, sf)
    names = expected.withColumn("organism", F.when(F.col("trio") == "en", F.lit("Anglia")))
    out = M.species_summary(expected, {**metrics, "organism": names}, ["trio", "species"], texts=["organism"])
    return rounded(out, "identity", "substitution_ratio", "gc")


@query("missing_results", f"""{IDENT} select e.trio, e.species, m.metric from expected e, (values ('identity'), ('substitution_ratio'), ('gc')) m(metric)
  where (e.trio, e.species, m.metric) not in (select (trio, species, 'identity') from ident union select (trio, species, 'substitution_ratio') from ratio
    union select (trio, species, 'gc') from gc)""")
def _(spark, sf):
    expected, metrics = _summary_inputs(spark, sf)
    return M.missing_results(expected, metrics, ["trio", "species"])


# ---- sequences -------------------------------------------------------------

@query("mate_suffix", "select cast(o_orderkey as varchar) || '/1' as id from orders")
def _(spark, sf):
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return Q.with_mate_suffix(o.select(F.col("o_orderkey").cast("string").alias("id")), 1)


@query("subsequences", f"""{SEG}, {inputs.cte('aln3')}, g as (select 'src' || (block_id % 20) as chr, block_id, replace(seq_a, '-', '') as seq from aln3)
  select s.segment_id, g.block_id, substr(g.seq, cast(s.start - g.block_id * 200000 + 1 as integer), cast(s."end" - s.start as integer)) as seq
  from segments s join g on g.block_id = cast(floor(s.start / 200000) as bigint)""")
def _(spark, sf):
    seqs = genome(spark, sf).select(F.col("name").cast("bigint").alias("name"), "seq")
    s = segments(spark, sf).select("segment_id", F.floor(F.col("start") / 200000).alias("chr"),
                                   (F.col("start") % 200000).alias("start"), (F.col("start") % 200000 + F.col("end") - F.col("start")).alias("end"))
    return Q.subsequences(seqs, s).select("segment_id", F.col("chr").alias("block_id"), "seq")


@query("good_quality", f"""with {inputs.cte('aln3')}, q as (select block_id, p1 as qual, length(regexp_replace(p1, '[!-7]', '', 'g')) as good from aln3)
  select block_id from q where good * 100 >= 83 * length(qual)""")
def _(spark, sf):
    return Q.good_quality(aln3(spark, sf).select("block_id", F.col("p1").alias("qual")), quality=23, percent=83).select("block_id")


@query("gff_features", """with gff as (
   select 'src' || (l_partkey % 20) as chr, 'CDS' as type, l_orderkey * 10 + 1 as start, l_orderkey * 10 + cast(l_quantity as bigint) as "end",
     case when l_linenumber % 2 = 0 then '+' else '-' end as strand, l_orderkey || '.' || l_linenumber as id, l_suppkey as gene from lineitem where l_quantity % 2 = 0)
   select chr, start - 1 as start, "end", strand, type, id, cast(gene as varchar) as gene from gff""")
def _(spark, sf):
    from ..sources.features import parse_attributes
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    lines = li.select(
        F.concat(F.lit("src"), (F.col("l_partkey") % 20).cast("string")).alias("chr"),
        F.when(F.col("l_quantity") % 2 == 0, F.lit("CDS")).otherwise(F.lit("gene")).alias("type"),
        (F.col("l_orderkey") * 10 + 1).alias("start"), (F.col("l_orderkey") * 10 + F.col("l_quantity").cast("bigint")).alias("end"),
        F.when(F.col("l_linenumber") % 2 == 0, F.lit("+")).otherwise(F.lit("-")).alias("strand"),
        F.concat(F.lit("ID="), "l_orderkey", F.lit("."), "l_linenumber", F.lit(";gene="), "l_suppkey", F.lit(";")).alias("attributes"))
    g = lines.where("type = 'CDS'").withColumn("attrs", parse_attributes("attributes"))
    return g.select("chr", (F.col("start") - 1).alias("start"), "end", "strand", "type", F.col("attrs")["ID"].alias("id"), F.col("attrs")["gene"].alias("gene"))

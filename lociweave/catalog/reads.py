"""Spliced reads, introns, feature fusions and alignment statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rates
from ..functions import splice as P
from ..operators import normalise as N
from ..operators import pairs as A
from ..operators import reads as R
from ..session import cut_lineage
from . import inputs
from .base import query, rnd, rounded
from .inputs import register
from .spectra import COLS, aln3

# a read = an order, its alignments = its lines; positions repeat, so introns gather support
_P0 = "(l_linenumber - 1) * 100"
_P1 = "(l_linenumber - 1) * 100 + case when l_partkey % 5 = 0 then 96 else 100 end"
_STR = "case when l_suppkey % 4 = 0 then '-' else '+' end"
register("reads", "lineitem", [
    ("aln_id", "l_orderkey * 10000000 + l_linenumber * 1000000 + l_partkey * 50 + cast(l_quantity as bigint)"),
    ("r_id", "concat('read', l_orderkey, case when l_orderkey % 3 = 0 then '/1' when l_orderkey % 3 = 1 then '/2' else '' end)"),
    ("score", "cast(l_extendedprice as bigint)"), ("mismap", "l_tax * l_discount * 10"),
    ("sense", "cast(l_quantity - 25 as double)"),
    ("don", "case l_partkey % 6 when 0 then null when 1 then 'GC' when 2 then 'gt' when 3 then 'CT' else 'GT' end"),
    ("acc", "case l_suppkey % 5 when 0 then null when 1 then 'AC' when 2 then 'ag' else 'AG' end"),
    ("g_chr", "concat('g', l_suppkey % 3)"), ("g_start", "(l_partkey % 12) * 40"), ("g_end", "(l_partkey % 12) * 40 + 30 + l_partkey % 2"),
    ("g_strand", "'+'"), ("g_len", "cast(100000 as bigint)"),
    ("r_start", f"cast(case when {_STR} = '-' then 1000 - ({_P1}) else {_P0} end as bigint)"),
    ("r_end", f"cast(case when {_STR} = '-' then 1000 - ({_P0}) else {_P1} end as bigint)"),
    ("r_strand", _STR), ("r_len", "cast(1000 as bigint)"),
    ("cigar", "concat(cast(l_quantity as integer), '=', l_partkey % 60, 'D', l_suppkey % 9 + 1, 'X', l_orderkey % 45, 'D', 7, '=')"),
])
register("elements", "supplier", [
    ("feature_id", "s_suppkey"), ("chr", "concat('g', s_suppkey % 3)"), ("start", "(s_suppkey * 37) % 520"),
    ("\"end\"", "(s_suppkey * 37) % 520 + 12 + s_nationkey"), ("strand", "case when s_suppkey % 2 = 0 then '+' else '-' end"),
    ("gene", "s_nationkey"), ("kind", "case when s_nationkey % 3 = 0 then 'TE' else 'CDS' end"),
    ("class", "case s_nationkey % 6 when 0 then 'LINE' when 1 then 'Simple_repeat' when 2 then 'DNA' when 3 then 'rRNA' when 4 then 'LTR' else 'Unknown' end"),
])


def reads(spark, sf):
    return inputs.load(spark, sf, "reads")


def elements(spark, sf):
    return inputs.load(spark, sf, "elements")


RS = f"with {inputs.cte('reads')}, " + """
placed as materialized (select *, case when r_strand = '-' then r_len - r_end else r_start end as r_pstart,
  case when r_strand = '-' then r_len - r_start else r_end end as r_pend from reads),
ordered as materialized (select *, row_number() over w as k, lead(aln_id) over w as n_id, lead(r_start) over w as n_rs,
  lead(r_end) over w as n_re, lead(r_strand) over w as n_st, lead(g_chr) over w as n_chr, lead(g_start) over w as n_gs,
  lead(g_end) over w as n_ge, lead(don) over w as n_don, lead(acc) over w as n_acc, count(*) over (partition by r_id) as alignments
  from placed window w as (partition by r_id order by r_pstart, aln_id)),
facts as materialized (select r_id, any_value(alignments) as alignments,
  case when bool_or(k = 1 and don is not null and acc is null) or bool_or(k = alignments and don is null and acc is not null) then '+'
       when bool_or(k = alignments and don is not null and acc is null) or bool_or(k = 1 and don is null and acc is not null) then '-' end as read_strand
  from ordered group by 1)"""
JX = f"""{RS}, pairing as (
  select o.r_id, read_strand, case when read_strand = '+' then aln_id else n_id end as id1, case when read_strand = '+' then n_id else aln_id end as id2,
    alignments, n_id from ordered o join (select r_id, read_strand from facts where alignments > 1 and read_strand is not null) f using (r_id)
    where n_id is not null),
 j0 as (select b.r_id, read_strand, id1, id2, x.r_strand as s1, y.r_strand as s2, x.don, y.acc,
    case when x.r_strand = read_strand then x.r_end else x.r_len - x.r_start end as e1,
    case when y.r_strand = read_strand then y.r_start else y.r_len - y.r_end end as b2,
    x.g_chr as sc, case when x.r_strand = read_strand then x.g_end else x.g_start end as sp, case when x.r_strand = read_strand then '+' else '-' end as ss,
    y.g_chr as ec, case when y.r_strand = read_strand then y.g_start else y.g_end end as ep, case when y.r_strand = read_strand then '+' else '-' end as es
    from pairing b join placed x on x.aln_id = b.id1 and x.r_id = b.r_id join placed y on y.aln_id = b.id2 and y.r_id = b.r_id),
 jx as materialized (select *, concat_ws('_', sc, sp, ss, ec, ep, es) as key, (sc <> ec or ss <> es) as trans,
    least(row(sc, sp, ss), row(ec, ep, es)) as l, greatest(row(sc, sp, ss), row(ec, ep, es)) as r from j0 where e1 = b2)"""


@query("read_strands", f"{RS} select r_id, alignments, read_strand from facts")
def _(spark, sf):
    return R.read_facts(reads(spark, sf))


@query("read_neighbours", f"{RS} select r_id, aln_id, n_id as next_id from ordered")
def _(spark, sf):
    return R.neighbours(reads(spark, sf)).select("r_id", "aln_id", F.col("next.aln_id").alias("next_id"))


@query("junctions", f"""{JX} select r_id, read_strand, id1 as aln1_id, id2 as aln2_id, don, acc, sc as start_chr, sp as start_pos,
  ss as start_strand, ec as end_chr, ep as end_pos, es as end_strand, trans, key from jx""")
def _(spark, sf):
    return R.junctions(reads(spark, sf)).select(
        "r_id", "read_strand", "aln1_id", "aln2_id", "don", "acc", F.col("start.chr").alias("start_chr"), F.col("start.pos").alias("start_pos"),
        F.col("start.strand").alias("start_strand"), F.col("end.chr").alias("end_chr"), F.col("end.pos").alias("end_pos"),
        F.col("end.strand").alias("end_strand"), "trans", "key")


INTRONS = f"""{JX}, introns as materialized (select key, any_value(sc) as sc, any_value(sp) as sp, any_value(ss) as ss, any_value(ec) as ec,
  any_value(ep) as ep, any_value(es) as es, any_value(trans) as trans, case when any_value(trans) then null else any_value(ep) - any_value(sp) end as length,
  arg_min(coalesce(don, ''), row(r_id, id1)) as don, arg_min(coalesce(acc, ''), row(r_id, id1)) as acc, count(*) as reads from jx group by 1)"""


def introns(spark, sf):
    return R.intron_table(R.junctions(reads(spark, sf)))


@query("intron_table", f"{INTRONS} select key, sp as start_pos, ep as end_pos, trans, length, don, acc, reads from introns")
def _(spark, sf):
    blank = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return introns(spark, sf).select("key", F.col("start.pos").alias("start_pos"), F.col("end.pos").alias("end_pos"), "trans", "length",
                                     blank("don"), blank("acc"), "reads")


@query("intron_reads", f"{JX} select key, count(*) as reads, count(distinct r_id) as ids, min(id1) as first_aln, max(id2) as last_aln from jx group by 1")
def _(spark, sf):
    rows = R.intron_reads(R.junctions(reads(spark, sf)), per_row=3).select("key", F.explode("support").alias("s"))
    return rows.groupBy("key").agg(F.count(F.lit(1)).alias("reads"), F.count_distinct("s.r_id").alias("ids"),
                                   F.min("s.aln1_id").alias("first_aln"), F.max("s.aln2_id").alias("last_aln"))


@query("linear_and_trans_introns", f"{INTRONS} select 'linear' as kind, key, reads from introns where not trans union all select 'trans', key, reads from introns where trans")
def _(spark, sf):
    lin, tr = R.split_linear_trans(introns(spark, sf))
    tag = lambda d, k: d.select(F.lit(k).alias("kind"), "key", "reads")
    return tag(lin, "linear").unionByName(tag(tr, "trans"))


@query("well_supported_introns", f"{INTRONS} select key, reads from introns where reads >= 5")
def _(spark, sf):
    return R.well_supported(introns(spark, sf), 5).select("key", "reads")


@query("short_linear_introns", f"{INTRONS} select key, length from introns where not trans and abs(length) <= 100")
def _(spark, sf):
    return R.short_linear(introns(spark, sf), 100).select("key", "length")


@query("signal_classes", f"""{INTRONS} select key, coalesce((upper(don) = 'GT' and upper(acc) = 'AG') or (upper(don) = 'CT' and upper(acc) = 'AC'), false) as canonical,
  coalesce(upper(don) in ('GT','GA','GC','GG') and upper(acc) = 'AG', false) as major from introns""")
def _(spark, sf):
    return introns(spark, sf).select("key", P.is_canonical("don", "acc").alias("canonical"), P.is_major_signal("don", "acc").alias("major"))


@query("signals_by_reads", f"{JX} select don, acc, count(*) as \"count\" from jx group by 1, 2")
def _(spark, sf):
    return R.signals_by_reads(R.junctions(reads(spark, sf)))


SITE = f"""{JX}, site as materialized (select key, min(upper(coalesce(don, '')) || '-' || upper(coalesce(acc, ''))) as lo,
  max(upper(coalesce(don, '')) || '-' || upper(coalesce(acc, ''))) as hi from jx group by 1)"""


@query("signals_by_sites", f"{SITE} select split_part(lo, '-', 1) as don, split_part(lo, '-', 2) as acc, count(*) as \"count\" from site where lo = hi group by 1, 2")
def _(spark, sf):
    return R.signals_by_sites(R.junctions(reads(spark, sf)))


@query("conflicting_sites", f"{SITE} select key from site where lo <> hi")
def _(spark, sf):
    return R.conflicting_sites(R.junctions(reads(spark, sf)))


@query("canonical_counts", f"""{SITE}, c as (select count(*) filter (where lo = hi and lo in ('GT-AG', 'CT-AC')) as canonical,
  count(*) filter (where lo = hi and lo not in ('GT-AG', 'CT-AC')) as non_canonical, count(*) filter (where lo <> hi) as conflicts from site)
  select *, {rnd('non_canonical * 100.0 / (canonical + non_canonical)')} as non_canonical_pct from c""")
def _(spark, sf):
    return rounded(R.canonical_counts(R.junctions(reads(spark, sf))), "non_canonical_pct")


@query("top_signals", f"""{JX}, s as (select coalesce(don, '') as don, coalesce(acc, '') as acc, count(*) as n from jx group by 1, 2)
  select don, acc, n as "count", cast(row_number() over (order by n desc, don, acc) as integer) as rank from s order by n desc, don, acc limit 10""")
def _(spark, sf):
    s = R.signals_by_reads(R.junctions(reads(spark, sf)).withColumns(
        {"don": F.coalesce("don", F.lit("")), "acc": F.coalesce("acc", F.lit(""))}))
    top = s.orderBy(F.col("count").desc(), "don", "acc").limit(10)
    return N.ranked(top.withColumn("tie", F.struct("don", "acc")), [], "count", 10, "tie").drop("tie")


@query("frequent_signals", f"{JX} select don, acc, count(*) as \"count\" from jx group by 1, 2 having count(*) >= 400")
def _(spark, sf):
    return R.signals_by_reads(R.junctions(reads(spark, sf))).where(F.col("count") >= 400)


# ---- features at intron ends -----------------------------------------------

FLANK = f"{JX}, {inputs.cte('elements')}, ends as materialized (select distinct l, r from jx)"
_ELL = """x.start < l[2] and l[2] <= x."end" and x.chr = l[1]"""
_ROR = """y.start <= r[2] and r[2] < y."end" and y.chr = r[1]"""
_ROL = """y.start < r[2] and r[2] <= y."end" and y.chr = r[1]"""
_ORDER = """(x.chr, x.start, x."end", x.strand, x.feature_id) < (y.chr, y.start, y."end", y.strand, y.feature_id)"""


def _flank_sql(extra: str, right: str, stranded: bool) -> str:
    st = "and x.strand = l[3] and y.strand = r[3]" if stranded else ""
    return (f"{FLANK} select l[1] as l_chr, l[2] as l_pos, l[3] as l_strand, r[1] as r_chr, r[2] as r_pos, r[3] as r_strand, "
            f"x.feature_id as f1, y.feature_id as f2 from ends join elements x on {_ELL} join elements y on {right} where {_ORDER} {st} {extra}")


def _places(features, *more):
    """What a join of features at intron ends needs of them."""
    return features.select("chr", "start", "end", "strand", "feature_id", *more)


def _ends(df):
    s = lambda p: [F.col(f"{p[0]}.chr").alias(f"{p[1]}_chr"), F.col(f"{p[0]}.pos").alias(f"{p[1]}_pos"), F.col(f"{p[0]}.strand").alias(f"{p[1]}_strand")]
    return df.select(*s(("left", "l")), *s(("right", "r")), F.col("f1_feature_id").alias("f1"), F.col("f2_feature_id").alias("f2"))


@query("fusions_gene_gene", _flank_sql("and x.gene <> y.gene and x.kind = 'CDS' and y.kind = 'CDS'", _ROR, True))
def _(spark, sf):
    cds = elements(spark, sf).where("kind = 'CDS'")
    return _ends(R.flank_join(R.junctions(reads(spark, sf)), _places(cds, "gene"), differ="gene"))


@query("fusions_te_te", _flank_sql("and x.kind = 'TE' and y.kind = 'TE'", _ROR, True))
def _(spark, sf):
    te = elements(spark, sf).where("kind = 'TE'")
    return _ends(R.flank_join(R.junctions(reads(spark, sf)), _places(te)))


@query("fusions_te_gene", _flank_sql("and x.kind <> y.kind", _ROR, True))
def _(spark, sf):
    return _ends(R.flank_join(R.junctions(reads(spark, sf)), _places(elements(spark, sf), "kind"), differ="kind"))


@query("fusions_repeat_repeat", _flank_sql("", _ROL, False))
def _(spark, sf):
    return _ends(R.flank_join(R.junctions(reads(spark, sf)), _places(elements(spark, sf)), stranded=False, right_rule="open_left"))


@query("first_repeat_classes", f"""{FLANK},
  pts as (select sc as chr, sp as pos from jx union select ec, ep from jx),
  hit as materialized (select p.chr, p.pos, (arg_min(x.feature_id, row(x.start, x."end", x.feature_id))) as f from pts p
    join elements x on x.chr = p.chr and x.start < p.pos and p.pos <= x."end" group by 1, 2)
  select j.r_id, j.id1 as aln1_id, a.f as s_repeat, b.f as e_repeat, case when a.f = b.f and s1 = s2 then 'tandem_expansion' else 'repeat_pair' end as class
  from jx j join hit a on a.chr = sc and a.pos = sp join hit b on b.chr = ec and b.pos = ep""")
def _(spark, sf):
    return R.first_repeat_class(R.junctions(reads(spark, sf)), elements(spark, sf)).select("r_id", "aln1_id", "s_repeat", "e_repeat", "class")


@query("transposable_elements", f"""with {inputs.cte('elements')} select feature_id, class from elements
  where class not in ('Simple_repeat', 'rRNA', 'Unknown')""")
def _(spark, sf):
    return elements(spark, sf).where(P.is_transposable("class")).select("feature_id", "class")


@query("tagged_feature_union", f"""with {inputs.cte('elements')} select 'CDS' as tag, chr, start, "end", strand, feature_id from elements where kind = 'CDS'
  union all select 'TE', chr, start, "end", strand, feature_id from elements where class not in ('Simple_repeat', 'rRNA', 'Unknown')""")
def _(spark, sf):
    e = elements(spark, sf)
    cols = ("chr", "start", "end", "strand", "feature_id")
    tag = lambda df, t: df.select(F.lit(t).alias("tag"), *cols)
    return (tag(e.where("kind = 'CDS'"), "CDS").unionByName(tag(e.where(P.is_transposable("class")), "TE"))
            .orderBy("chr", "start", "end", "strand", "tag", "feature_id"))


SETS = f"""{JX}, sets as materialized (select key, bool_or(right(r_id, 2) = '/1') as a, bool_or(right(r_id, 2) = '/2') as b,
  bool_or(right(r_id, 2) not in ('/1', '/2')) as c from jx group by 1)"""


@query("three_set_overlaps", f"{SETS} select a as in_a, b as in_b, c as in_c, count(*) as n from sets group by 1, 2, 3")
def _(spark, sf):
    from ..operators.synteny import set_regions
    j = R.junctions(reads(spark, sf))
    end = F.right("r_id", F.lit(2))
    sets = {"in_a": end == "/1", "in_b": end == "/2", "in_c": ~end.isin("/1", "/2")}
    return set_regions(j, "key", sets)


@query("alternative_support", f"""{INTRONS},
  span as (select key, reads, sc as chr, least(sp, ep) as b, greatest(sp, ep) as e, sp, ep from introns where not trans),
  single as (select p.* from placed p join facts f using (r_id) where f.alignments = 1),
  parts as materialized (select distinct j.key as other, j.r_id, p.g_chr, p.g_start, p.g_end from jx j join placed p on p.r_id = j.r_id and (p.aln_id = j.id1 or p.aln_id = j.id2)),
  o as (select s.key, count(distinct other) as other_introns, count(distinct p.r_id) as other_reads from span s join parts p
    on p.g_chr = s.chr and p.g_start < s.e and s.b < p.g_end and p.other <> s.key and s.b < s.e group by 1),
  u as (select s.key, count(distinct case when g_start < sp and sp < g_end then r_id end) as don_side_reads,
    count(distinct case when g_start < ep and ep < g_end then r_id end) as acc_side_reads from span s join single p
    on p.g_chr = s.chr and p.g_start < s.e and s.b < p.g_end and s.b < s.e group by 1)
  select s.key, s.reads, coalesce(other_introns, 0) as other_introns, coalesce(other_reads, 0) as other_reads,
    coalesce(don_side_reads, 0) as don_side_reads, coalesce(acc_side_reads, 0) as acc_side_reads
  from span s left join o using (key) left join u using (key)""")
def _(spark, sf):
    r = reads(spark, sf)
    j = cut_lineage(R.junctions(r, parts=True).select("r_id", "aln1_id", "don", "acc", "start", "end", "key", "trans", "parts"))  # read twice
    return R.alternative_support(R.intron_table(j), j, r)


# ---- clusters --------------------------------------------------------------

def _positions(spark, sf):
    i = introns(spark, sf).where("not trans")
    return i.select("key", "reads", "start", "end", F.col("start.strand").alias("strand"), F.col("start.chr").alias("chr"),
                    F.least("start.pos", "end.pos").alias("left"), F.greatest("start.pos", "end.pos").alias("right"))


ANCHORED = f"""with recursive {INTRONS[5:]},
  pos as materialized (select key, sc as chr, least(sp, ep) as l, greatest(sp, ep) as r from introns where not trans),
  heads as materialized (select chr, l, arg_min(r, row(r, key)) as r, arg_min(key, row(r, key)) as key from pos group by 1, 2),
  sweep(chr, l, reach, name) as (
    select chr, min(l), arg_min(r, l), arg_min(key, l) from heads group by 1
    union all select h.chr, min(h.l), arg_min(h.r, h.l), arg_min(h.key, h.l) from sweep s join heads h on h.chr = s.chr and h.l >= s.reach group by h.chr),
  spans as (select *, lead(l) over (partition by chr order by l) as nxt from sweep),
  members as materialized (select s.name as cluster, p.key from spans s join pos p on p.chr = s.chr and p.l >= s.l and (s.nxt is null or p.l < s.nxt))"""


@query("anchor_clusters", f"{ANCHORED} select cluster, key from members where cluster in (select cluster from members group by 1 having count(*) > 1)")
def _(spark, sf):
    return R.anchor_clusters(_positions(spark, sf))


# the predicates on the clusters of introns that the sweep gives
AM = f"""{ANCHORED}, am as materialized (select m.cluster, m.key, i.reads, i.ss as strand, i.sc || '_' || i.sp || '_' || i.ss as s, i.ec || '_' || i.ep || '_' || i.es as e
  from members m join introns i using (key) where m.cluster in (select cluster from members group by 1 having count(*) > 1))"""


def _anchored(spark, sf):
    positions = cut_lineage(_positions(spark, sf))  # read by the sweep and by the join with it
    return R.anchor_clusters(positions).join(positions.select("key", "reads", "strand", "start", "end"), "key")


@query("anchored_on_both_strands", f"{AM} select cluster from am group by 1 having count(distinct strand) = 2")
def _(spark, sf):
    return R.clusters_on_both_strands(_anchored(spark, sf))


@query("anchored_well_supported", f"{AM} select cluster from am group by 1 having min(reads) >= 2")
def _(spark, sf):
    return R.clusters_well_supported(_anchored(spark, sf), 2)


@query("anchored_with_unshared_intron", f"""{AM} select distinct m.cluster from am m where not exists (
  select 1 from am o where o.cluster = m.cluster and o.key <> m.key and (m.s in (o.s, o.e) or m.e in (o.s, o.e)))""")
def _(spark, sf):
    return R.clusters_with_unshared_intron(_anchored(spark, sf))


@query("cluster_json", f"""{ANCHORED} select m.cluster, i.sc || ':' || i.sp || i.ss as start, i.ec || ':' || i.ep || i.es as "end", i.reads
  from members m join introns i using (key) where m.cluster in (select cluster from members group by 1 having count(*) > 1)""")
def _(spark, sf):
    from .. import sinks
    from ..session import shared_folder
    from ..sources import tables
    path = shared_folder(spark, "clusters")
    table = cut_lineage(introns(spark, sf).where("not trans"))
    anchored = R.anchor_clusters(table.select("key", F.col("start.chr").alias("chr"), F.least("start.pos", "end.pos").alias("left"), F.greatest("start.pos", "end.pos").alias("right")))
    sinks.cluster_json(anchored.join(table, "key")).write.text(path)
    back = tables.parse_clusters(spark.read.text(path))
    place = lambda c: F.concat(F.col(f"{c}.chr"), F.lit(":"), F.col(f"{c}.pos").cast("string"), F.col(f"{c}.strand"))
    return back.select("cluster", place("start").alias("start"), place("end").alias("end"), "reads")


CL = f"""{INTRONS}, members as materialized (select concat_ws(':', sc, least(sp, ep), greatest(sp, ep)) as cluster, key, reads, ss as strand,
   sc || '_' || sp || '_' || ss as s, ec || '_' || ep || '_' || es as e from introns where not trans)"""


def _members(spark, sf):
    p = _positions(spark, sf)
    span = F.concat_ws(":", "chr", F.col("left").cast("string"), F.col("right").cast("string"))
    return p.withColumn("cluster", span).select("cluster", "key", "reads", "strand", "start", "end")


@query("clusters_on_both_strands", f"{CL} select cluster from members group by 1 having count(distinct strand) = 2")
def _(spark, sf):
    return R.clusters_on_both_strands(_members(spark, sf))


@query("clusters_well_supported", f"{CL} select cluster from members group by 1 having min(reads) >= 2")
def _(spark, sf):
    return R.clusters_well_supported(_members(spark, sf), 2)


@query("clusters_with_unshared_intron", f"""{CL} select distinct m.cluster from members m where not exists (
  select 1 from members o where o.cluster = m.cluster and o.key <> m.key and (m.s in (o.s, o.e) or m.e in (o.s, o.e)))""")
def _(spark, sf):
    return R.clusters_with_unshared_intron(_members(spark, sf))


# ---- reads -----------------------------------------------------------------

@query("read_groups", f"""{RS}, f as (select r_id, alignments, case when n_id is not null then
   (case when n_st = '+' then n_rs else r_len - n_re end) = r_pend end as ex from ordered)
  select r_id, any_value(alignments) as alignments, coalesce(bool_or(not ex), false) as has_inexact, coalesce(bool_or(ex), false) as any_exact from f group by 1""")
def _(spark, sf):
    return R.read_groups(reads(spark, sf))


@query("unspliced_reads", f"{RS} select r_id, aln_id from ordered where alignments = 1")
def _(spark, sf):
    return R.unspliced(reads(spark, sf)).select("r_id", "aln_id")


@query("drop_chromosome", f"{RS} select aln_id, r_id from reads where r_id not in (select r_id from reads where contains(g_chr, '2'))")
def _(spark, sf):
    return R.drop_chromosome(reads(spark, sf), "2").select("aln_id", "r_id")


@query("drop_chromosome_split_reads", f"{RS} select aln_id, r_id from ordered where alignments > 1 and r_id not in (select r_id from reads where contains(g_chr, '2'))")
def _(spark, sf):
    return R.drop_chromosome(reads(spark, sf), "2", split_only=True).select("aln_id", "r_id")


@query("read_lookup", f"{RS} select aln_id, r_id from reads where r_id = 'read77'")
def _(spark, sf):
    return reads(spark, sf).where("r_id = 'read77'").select("aln_id", "r_id")


RUNS = f"""{RS}, lk as (select *, lag(g_chr) over w as pc, lag(r_strand) over w as ps, lag(g_end) over w as pe, lag(r_end) over w as pr
   from placed window w as (partition by r_id order by r_pstart, aln_id)),
  l2 as (select *, (pc = g_chr and ps = r_strand and pe < g_start) as lin, pr = r_start as ex from lk),
  runs as materialized (select *, cast(sum(case when pc is not null and not lin then 1 else 0 end) over w as bigint) as linear,
    cast(sum(case when pc is not null and not (lin and ex) then 1 else 0 end) over w as bigint) as run,
    case when lin and ex then g_start - pe end as skipped from l2 window w as (partition by r_id order by r_pstart, aln_id rows unbounded preceding))"""


@query("run_groups", f"{RUNS} select aln_id, r_id, linear, run, skipped from runs")
def _(spark, sf):
    return R.run_groups(reads(spark, sf)).select("aln_id", "r_id", "linear", "run", "skipped")


@query("run_records", f"""{RUNS}, x as (select r_id, linear, run, count(*) as parts, arg_min(row(g_chr, g_start, r_strand, r_start, r_len), row(r_pstart, aln_id)) as f,
   arg_max(r_end, row(r_pstart, aln_id)) as re, coalesce(cast(sum(skipped) as bigint), 0) as skipped,
   string_agg(case when skipped > 0 then skipped || 'N' else '' end || cigar, '' order by r_pstart, aln_id) as body, cast(sum(aln_id % 7) as bigint) as edit_distance from runs group by 1, 2, 3)
  select regexp_replace(r_id, '/[12]$', '') as name, linear, run,
   cast(case when r_id like '%/1' then case when f[3] = '+' then 99 else 83 end when r_id like '%/2' then case when f[3] = '+' then 163 else 147 end
     else case when f[3] = '+' then 0 else 16 end end + case when linear > 0 then 2048 else 0 end as integer) as flag,
   f[1] as chr, f[2] + 1 as pos, parts, f[4] as clip_before, f[5] - re as clip_after, skipped, edit_distance,
   case when f[4] > 0 then f[4] || 'H' else '' end || body || case when f[5] - re > 0 then f[5] - re || 'H' else '' end as cigar from x""")
def _(spark, sf):
    return R.run_records(R.run_groups(reads(spark, sf).withColumn("edit_distance", F.col("aln_id") % 7)))


@query("mapping_quality", f"""with {inputs.cte('reads')} select aln_id, cast(case when mismap is null then 255 when mismap = 0 then 254
  else least(254, round_even(-10 * log10(mismap), 0)) end as integer) as mapq from reads""")
def _(spark, sf):
    return reads(spark, sf).select("aln_id", rates.mapq("mismap").alias("mapq"))


# ---- distributions ---------------------------------------------------------

DEL = f"with {inputs.cte('reads')}, d as materialized (select cast(unnest(regexp_extract_all(cigar, '([0-9]+)D', 1)) as integer) as length from reads)"


@query("deletion_lengths", f"{DEL} select length, count(*) as \"count\" from d group by 1")
def _(spark, sf):
    return R.deletion_lengths(reads(spark, sf))


@query("log_length_summary", f"""{DEL} select count(*) as n, {rnd('avg(length)')} as mean, {rnd('stddev_samp(length)')} as sd,
  {rnd('avg(ln(length))')} as mean_ln, {rnd('stddev_samp(ln(length))')} as sd_ln from d where length >= 35""")
def _(spark, sf):
    return rounded(R.log_length_summary(R.deletion_runs(reads(spark, sf))), "mean", "sd", "mean_ln", "sd_ln")


@query("coverage_summary", f"""select event_type, {rnd('avg(value)')} as mean, {rnd('stddev_samp(value)')} as sd, count(value) as n from events group by 1""")
def _(spark, sf):
    return rounded(R.coverage_summary(spark.read.parquet(f"{sf}/events.parquet"), "value", ["event_type"]), "mean", "sd")


@query("coverage_histogram", """select event_type, cast(case when value < 0 then 0 when value >= 100 then 21 else floor(value / 5) + 1 end as bigint) as bin,
  count(*) as "count" from events where value is not null group by 1, 2""")
def _(spark, sf):
    return R.histogram(spark.read.parquet(f"{sf}/events.parquet"), "value", 0, 100, 20, ["event_type"])


# ---- pairwise alignment statistics -----------------------------------------

STATS = f"""with {inputs.cte('aln3')}, {COLS},
  g as materialized (select block_id, i, a, b, lag(a) over w as pa, lag(b) over w as pb from cols window w as (partition by block_id order by i))
  select block_id, count(*) as columns, count(*) filter (where a = b and a <> '-') as matches,
    count(*) filter (where a <> b and a <> '-' and b <> '-') as mismatches,
    count(*) filter (where a <> b and contains('ACGTU', a) and contains('ACGTU', b)) as base_mismatches,
    count(*) filter (where a <> '-' and b <> '-' and not (contains('ACGTU', a) and contains('ACGTU', b))) as ambiguous,
    count(*) filter (where a <> b) as edit_distance,
    count(*) filter (where a = '-' and coalesce(pa, 'x') <> '-') + count(*) filter (where b = '-' and coalesce(pb, 'x') <> '-') as gap_opens,
    count(*) filter (where a <> '-' and b <> '-' and (pa is null or pa = '-' or pb = '-')) as gapless_blocks,
    """ + rnd("count(*) filter (where a = b and a <> '-') * 100.0 / count(*)") + " as identity from g group by 1"


@query("alignment_stats", STATS)
def _(spark, sf):
    return rounded(A.alignment_stats(aln3(spark, sf), ["block_id"]).drop("cigar"), "identity")


@query("alignment_cigars", f"""with {inputs.cte('aln3')}, {COLS},
  o as (select block_id, i, case when a = b then '=' when a = '-' then 'I' when b = '-' then 'D' else 'X' end as op from cols),
  r as (select *, case when lag(op) over (partition by block_id order by i) = op then 0 else 1 end as f from o),
  n as (select block_id, i, op, sum(f) over (partition by block_id order by i) as run from r),
  c as (select block_id, run, any_value(op) as op, count(*) as k from n group by 1, 2)
  select block_id, string_agg(k || op, '' order by run) as cigar from c group by 1""")
def _(spark, sf):
    return A.alignment_stats(aln3(spark, sf), ["block_id"]).select("block_id", "cigar")

"""Spectra, ratios and composition over three-way and pairwise alignments."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bases as B
from ..operators import spectra as S
from ..operators import windows as W
from . import inputs
from .base import query, rnd, rounded

# ---- shared check fragments ------------------------------------------------

COLS = """
cols as materialized (
  select block_id, trio, generate_subscripts(string_split(seq_a, ''), 1) as i,
         unnest(string_split(upper(seq_a), '')) as a, unnest(string_split(upper(seq_b), '')) as b,
         unnest(string_split(upper(seq_c), '')) as c,
         unnest(string_split(p1, '')) as p1, unnest(string_split(p2, '')) as p2
  from aln3)"""
WIN3 = """
win3 as materialized (
  select * from (
    select block_id, trio, i,
           a || lead(a, 1) over w || lead(a, 2) over w as wa,
           b || lead(b, 1) over w || lead(b, 2) over w as wb,
           c || lead(c, 1) over w || lead(c, 2) over w as wc,
           p1 || lead(p1, 1) over w || lead(p1, 2) over w || p2 || lead(p2, 1) over w || lead(p2, 2) over w as pp
    from cols window w as (partition by block_id order by i)) q
  where wc is not null)"""
WIN4 = """
win4 as materialized (
  select * from (
    select block_id, trio, i,
           a || lead(a, 1) over w || lead(a, 2) over w || lead(a, 3) over w as wa,
           b || lead(b, 1) over w || lead(b, 2) over w || lead(b, 3) over w as wb,
           c || lead(c, 1) over w || lead(c, 2) over w || lead(c, 3) over w as wc
    from cols window w as (partition by block_id order by i)) q
  where wc is not null)"""
FLANKS3 = "wa[1] = wb[1] and wa[1] = wc[1] and wa[3] = wb[3] and wa[3] = wc[3]"
ACGT3 = "regexp_full_match(wa, '[ACGT]+') and regexp_full_match(wb, '[ACGT]+') and regexp_full_match(wc, '[ACGT]+')"
OK3 = f"{FLANKS3} and (wa[2] = wb[2] or wa[2] = wc[2]) and {ACGT3}"
FLANKS4 = "wa[1] = wb[1] and wa[1] = wc[1] and wa[4] = wb[4] and wa[4] = wc[4]"
OK4 = f"{FLANKS4} and (wa[2:3] = wb[2:3] or wa[2:3] = wc[2:3]) and {ACGT3}"


def rc(e: str) -> str:
    return f"reverse(translate({e}, 'ACGT', 'TGCA'))"


def fold(tri: str) -> str:
    return f"case when {tri}[2] in ('C','T') then {tri} else {rc(tri)} end"


def fold_alt(tri: str, alt: str) -> str:
    return f"case when {tri}[2] in ('C','T') then {alt} else translate({alt}, 'ACGT', 'TGCA') end"


def label3(tri: str, alt: str) -> str:
    f = f"({fold(tri)})"
    return f"({f}[1] || '[' || {f}[2] || '>' || ({fold_alt(tri, alt)}) || ']' || {f}[3])"


DIM = """
acgt(x) as (values ('A'), ('C'), ('G'), ('T')),
dim3 as (select l.x || m.x || r.x as ori, v.x as alt, l.x || '[' || m.x || '>' || v.x || ']' || r.x as label
         from acgt l, acgt m, acgt r, acgt v where m.x in ('C', 'T') and m.x <> v.x),
species(s) as (values ('B'), ('C')),
keys as (select distinct trio from aln3)"""

FLIP_DOUBLETS = "('AA','AG','CA','GA','GG','GT')"
FLIP_CHANGES = "('AT>GG','AT>TC','AT>TG','CG>AA','CG>AC','CG>GA','GC>CT','GC>TG','GC>TT','TA>AC','TA>AG','TA>CC')"


def di_label_sql(o: str, m: str) -> str:
    raw = f"({o} || '>' || {m})"
    return f"case when {o} in {FLIP_DOUBLETS} or {raw} in {FLIP_CHANGES} then {rc(o)} || '>' || {rc(m)} else {raw} end"


SPECTRUM = f"""
hit as materialized (select trio, {fold('wa')} as ori, {fold_alt('wa', 'wb[2]')} as vb, {fold_alt('wa', 'wc[2]')} as vc from okwin),
tot as (select trio, ori, count(*) as n from hit group by 1, 2),
mut as (select trio, 'B' as s, ori, vb as alt, count(*) as n from hit where vb <> ori[2] group by all
        union all select trio, 'C', ori, vc, count(*) from hit where vc <> ori[2] group by all),
spectrum as (
  select k.trio, sp.s as species, d.ori as "oriType", d.label as "mutType",
         cast(coalesce(m.n, 0) as bigint) as "mutNum", cast(coalesce(t.n, 0) as bigint) as "totalRootNum"
  from keys k cross join species sp cross join dim3 d
  left join mut m on m.trio = k.trio and m.s = sp.s and m.ori = d.ori and m.alt = d.alt
  left join tot t on t.trio = k.trio and t.ori = d.ori)"""

ALN3 = f"with {inputs.cte('aln3')}, {COLS}, {WIN3}, {DIM}"
SPECTRUM_CTE = f"{ALN3}, okwin as (select * from win3 where {OK3}), {SPECTRUM}"


def aln3(spark, sf):
    return inputs.load(spark, sf, "aln3")


def spectrum(spark, sf):
    return S.tri_spectrum(aln3(spark, sf), ["trio"], with_ori=True)


# ---- windows ---------------------------------------------------------------

@query("tri_windows", f"""{ALN3} select trio, wa as win_a, wb as win_b, wc as win_c, count(*) as n,
  cast(sum(i - 1) as bigint) as col_sum from win3 group by all""")
def _(spark, sf):
    return (W.tri_windows(aln3(spark, sf), ["trio"]).groupBy("trio", "win_a", "win_b", "win_c")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("col").alias("col_sum")))


@query("di_windows", f"""with {inputs.cte('aln3')}, {COLS}, {WIN4}
  select trio, wa as win_a, wb as win_b, wc as win_c, count(*) as n,
  cast(sum(i - 1) as bigint) as col_sum from win4 group by all""")
def _(spark, sf):
    return (W.di_windows(aln3(spark, sf), ["trio"]).groupBy("trio", "win_a", "win_b", "win_c")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("col").alias("col_sum")))


@query("column_bases", f"""with {inputs.cte('aln3')}, {COLS}
  select trio, a as win_a, b as win_b, c as win_c, count(*) as n from cols group by all""")
def _(spark, sf):
    return (W.columns(aln3(spark, sf), keep=["trio"]).groupBy("trio", "win_a", "win_b", "win_c")
            .agg(F.count(F.lit(1)).alias("n")))


@query("tri_windows_in_parts", f"""{ALN3} select trio, wa as win_a, wb as win_b, wc as win_c, count(*) as n
  from win3 group by all""")
def _(spark, sf):
    parts = W.split_long_blocks(aln3(spark, sf), 4096, 2)
    return W.window_counts(parts, 3, keys=["trio"])


# ---- predicates and labels on windows --------------------------------------

@query("flank_and_base_predicates", f"""{ALN3}
  select {FLANKS3} as flanks_equal, {ACGT3} as acgt_only, count(*) as n from win3 group by all""")
def _(spark, sf):
    w = W.tri_windows(aln3(spark, sf))
    return (w.groupBy("win_a", "win_b", "win_c").agg(F.count(F.lit(1)).alias("n"))
            .groupBy(B.flanks_equal("win_a", "win_b", "win_c").alias("flanks_equal"),
                     (B.is_acgt("win_a") & B.is_acgt("win_b") & B.is_acgt("win_c")).alias("acgt_only"))
            .agg(F.sum("n").alias("n")))


@query("low_error_windows", f"""{ALN3}
  select block_id, count(*) as windows, count(*) filter (where regexp_full_match(pp, '[5-~]+')) as low_error
  from win3 group by 1""")
def _(spark, sf):
    a = aln3(spark, sf).withColumn("plines", F.array("p1", "p2"))
    # the predicate itself, per window, on the p lines cut to three columns
    w = W.windows(a.withColumnRenamed("p1", "seq_p").withColumnRenamed("p2", "seq_q"), 3, ("p", "q"), ["block_id"])
    low = B.low_error(F.array("win_p", "win_q"), F.lit(1))
    return w.groupBy("block_id").agg(F.count(F.lit(1)).alias("windows"),
                                     F.count(F.when(low, 1)).alias("low_error"))


@query("canonical_trinucleotides", f"""{ALN3} select {fold('wa')} as tri, count(*) as n from win3
  where regexp_full_match(wa, '[ACGT]+') group by 1""")
def _(spark, sf):
    return (W.window_counts(aln3(spark, sf), 3, ("a",), rule=B.is_acgt("win_a"))
            .groupBy(B.canon_tri("win_a").alias("tri")).agg(F.sum("n").alias("n")))


@query("substitution_labels", f"""{ALN3} select wa as tri, wb[2] as alt, {label3('wa', 'wb[2]')} as "mutType", count(*) as n
  from win3 where {FLANKS3} and wa[2] <> wb[2] and {ACGT3} group by all""")
def _(spark, sf):
    raw = W.window_counts(aln3(spark, sf), 3, rule=
        B.flanks_equal("win_a", "win_b", "win_c") & B.is_acgt("win_a") & B.is_acgt("win_b") & B.is_acgt("win_c")
        & (B.base_at("win_a", 2) != B.base_at("win_b", 2)))
    alt = B.base_at("win_b", 2)
    return raw.groupBy(F.col("win_a").alias("tri"), alt.alias("alt"), B.sbst_label("win_a", alt).alias("mutType")).agg(
        F.sum("n").alias("n"))


@query("doublet_classes", f"""with {inputs.cte('aln3')}, {COLS}, {WIN4}
  select wa[2:3] as ori, wb[2:3] as mut, {di_label_sql('wa[2:3]', 'wb[2:3]')} as "mutType", count(*) as n
  from win4 where wa[2] <> wb[2] and wa[3] <> wb[3] and {ACGT3} group by all""")
def _(spark, sf):
    mid = lambda w: F.substring(w, 2, 2)
    raw = W.window_counts(aln3(spark, sf), 4, rule=
        B.is_acgt("win_a") & B.is_acgt("win_b") & B.is_acgt("win_c") & B.both_bases_differ(mid("win_a"), mid("win_b")))
    return (raw.groupBy(mid("win_a").alias("ori"), mid("win_b").alias("mut")).agg(F.sum("n").alias("n"))
            .withColumn("mutType", B.di_label("ori", "mut")))


@query("site_classes", f"""{ALN3}
  select trio, case when wa[2] = wb[2] and wa[2] = wc[2] then 'none' when wa[2] = wc[2] then 'B' when wa[2] = wb[2] then 'C'
    when wb[2] = wc[2] then 'outgroup' else 'triple' end as site_class, count(*) as n
  from win3 where {FLANKS3} and {ACGT3} group by all""")
def _(spark, sf):
    raw = W.window_counts(aln3(spark, sf), 3, keys=["trio"], rule=
        B.flanks_equal("win_a", "win_b", "win_c") & B.is_acgt("win_a") & B.is_acgt("win_b") & B.is_acgt("win_c"))
    mids = [B.base_at(w, 2) for w in ("win_a", "win_b", "win_c")]
    return raw.groupBy("trio", B.site_class(*mids).alias("site_class")).agg(F.sum("n").alias("n"))


# ---- spectra ---------------------------------------------------------------

@query("tri_spectrum", f"""{SPECTRUM_CTE}
  select trio, species, "mutType", "mutNum", "totalRootNum" from spectrum""")
def _(spark, sf):
    return S.tri_spectrum(aln3(spark, sf), ["trio"])


@query("tri_spectrum_low_error", f"""{ALN3}, okwin as (select * from win3 where {OK3} and regexp_full_match(pp, '[5-~]+')), {SPECTRUM}
  select trio, species, "mutType", "mutNum", "totalRootNum" from spectrum""")
def _(spark, sf):
    return S.tri_spectrum_low_error(aln3(spark, sf).withColumn("plines", F.array("p1", "p2")), ["trio"])


@query("tri_spectrum_weighted", f"""{ALN3},
  site as materialized (select trio, wa, wb, wc from win3 where {FLANKS3} and {ACGT3}),
  entry as (
    select trio, d.label as label, 0.0 as m, 1.0 as t from site join dim3 d on d.ori = {fold('wa')}
      where wa = wb and wa = wc
    union all select trio, {label3('wa', 'wb[2]')}, 1.0, 1.0 from site where wa = wc and wa <> wb
    union all select trio, {label3('wa', 'wc[2]')}, 1.0, 1.0 from site where wa = wb and wa <> wc
    union all select trio, {label3('wa', 'wb[2]')}, 0.5, 0.5 from site where wb = wc and wa <> wb
    union all select trio, {label3('wb', 'wa[2]')}, 0.5, 0.5 from site where wb = wc and wa <> wb)
  select k.trio, d.label as "mutType", cast(coalesce(sum(m), 0) as double) as "mutNum",
         cast(coalesce(sum(t), 0) as double) as "totalRootNum"
  from keys k cross join dim3 d left join entry e on e.trio = k.trio and e.label = d.label group by 1, 2""")
def _(spark, sf):
    return S.tri_spectrum_weighted(aln3(spark, sf), ["trio"])


DI_SPECTRUM = f"""
hit2 as materialized (select trio, wa[2:3] as o, wb[2:3] as vb, wc[2:3] as vc from win4 where {OK4}),
tot2 as (select trio, case when o in {FLIP_DOUBLETS} then {rc('o')} else o end as ori, count(*) as n from hit2 group by 1, 2),
mut2 as (select trio, 'B' as s, {di_label_sql('o', 'vb')} as label, count(*) as n from hit2
          where o[1] <> vb[1] and o[2] <> vb[2] group by all
        union all select trio, 'C', {di_label_sql('o', 'vc')}, count(*) from hit2
          where o[1] <> vc[1] and o[2] <> vc[2] group by all),
dim2 as (select distinct {di_label_sql('(p.x || q.x)', '(r.x || t.x)')} as label
         from acgt p, acgt q, acgt r, acgt t where p.x <> r.x and q.x <> t.x),
doublets as (select k.trio, sp.s as species, d.label as "mutType", cast(coalesce(m.n, 0) as bigint) as "mutNum",
       cast(coalesce(t.n, 0) as bigint) as "totalRootNum"
  from keys k cross join species sp cross join dim2 d
  left join mut2 m on m.trio = k.trio and m.s = sp.s and m.label = d.label
  left join tot2 t on t.trio = k.trio and t.ori = d.label[1:2])"""


@query("di_spectrum", f"with {inputs.cte('aln3')}, {COLS}, {WIN4}, {DIM}, {DI_SPECTRUM} select * from doublets")
def _(spark, sf):
    return S.di_spectrum(aln3(spark, sf), ["trio"])


PAIR_CHANGE = ("wa[1] = wb[1] and wa[3] = wb[3] and wa[2] <> wb[2] and regexp_full_match(wa, '[ACGT]+') "
               "and regexp_full_match(wb, '[ACGT]+')")


@query("pair_changes", f"""{ALN3} select block_id, wa as "refTri", wb as "qryTri", {label3('wa', 'wb[2]')} as "mutType"
  from win3 where {PAIR_CHANGE}""")
def _(spark, sf):
    return S.tri_changes(aln3(spark, sf), ["block_id"])


@query("pair_change_percentages", f"""{ALN3},
  hit as (select trio, {label3('wa', 'wb[2]')} as label, count(*) as n from win3 where {PAIR_CHANGE} group by 1, 2),
  allh as (select trio, sum(n) as t from hit group by 1)
  select k.trio, d.label as "mutType", cast(coalesce(h.n, 0) as bigint) as "mutNum",
         {rnd('coalesce(h.n, 0) * 100.0 / a.t')} as percentage
  from keys k cross join dim3 d left join hit h on h.trio = k.trio and h.label = d.label left join allh a on a.trio = k.trio""")
def _(spark, sf):
    return rounded(S.tri_changes_pct(aln3(spark, sf), ["trio"]), "percentage")


CHANGE_ROWS = """
change(r, q, type, category) as (values
 ('A','A','no_mutation','TtoT/AtoA'), ('A','C','transversion','TtoG/AtoC'), ('A','G','transition','TtoC/AtoG'),
 ('A','T','transversion','TtoA/AtoT'), ('A','-','deletion','Tto-/Ato-'),
 ('C','A','transversion','CtoA/GtoT'), ('C','C','no_mutation','CtoC/GtoG'), ('C','G','transversion','CtoG/GtoC'),
 ('C','T','transition','CtoT/GtoA'), ('C','-','deletion','Cto-/Gto-'),
 ('G','A','transition','CtoT/GtoA'), ('G','C','transversion','CtoG/GtoC'), ('G','G','no_mutation','CtoC/GtoG'),
 ('G','T','transversion','CtoA/GtoT'), ('G','-','deletion','Cto-/Gto-'),
 ('T','A','transversion','TtoA/AtoT'), ('T','C','transition','TtoC/AtoG'), ('T','G','transversion','TtoG/AtoC'),
 ('T','T','no_mutation','TtoT/AtoA'), ('T','-','deletion','Tto-/Ato-'),
 ('-','A','insertion','-toA/-toT'), ('-','C','insertion','-toC/-toG'), ('-','G','insertion','-toC/-toG'), ('-','T','insertion','-toA/-toT'))"""
MATRIX = f"""with {inputs.cte('aln3')}, {COLS}, {CHANGE_ROWS},
  matrix as (select trio, a as "refBase", c as "qryBase", count(*) as "count", coalesce(max(k.type), 'exception') as type,
    coalesce(max(k.category), 'exception') as category
  from cols left join change k on k.r = a and k.q = c group by 1, 2, 3)"""


def _pair_ac(spark, sf):
    return aln3(spark, sf).drop("seq_b").withColumnRenamed("seq_c", "seq_b")


@query("base_change_matrix", f"{MATRIX} select * from matrix")
def _(spark, sf):
    return S.change_matrix(_pair_ac(spark, sf), ["trio"])


@query("base_change_totals", f"""{MATRIX}
  select trio, category, type, cast(sum("count") as bigint) as total_count,
    {rnd('sum("count") * 100.0 / sum(sum("count")) over (partition by trio)')} as percentage from matrix group by 1, 2, 3""")
def _(spark, sf):
    return rounded(S.change_totals(S.change_matrix(_pair_ac(spark, sf), ["trio"]), ["trio"]), "percentage")


@query("substitution_ratio", f"""with {inputs.cte('aln3')}, {COLS},
  w as (select trio, count(*) filter (where a = c and a <> b) as sub_b, count(*) filter (where a = b) as same_b,
    count(*) filter (where a = b and a <> c) as sub_c, count(*) filter (where a = c) as same_c
  from cols where a <> '-' and b <> '-' and c <> '-' group by 1)
  select trio, 'B' as species, sub_b as sbst, same_b as unchanged, {rnd('sub_b * 100.0 / (sub_b + same_b)')} as percentage from w
  union all select trio, 'C', sub_c, same_c, {rnd('sub_c * 100.0 / (sub_c + same_c)')} from w""")
def _(spark, sf):
    return rounded(S.sbst_ratio(aln3(spark, sf), ["trio"]), "percentage")


@query("percent_identity", f"""with {inputs.cte('aln3')}, {COLS},
  w as (select trio, count(*) filter (where a = b) as matches, count(*) filter (where a <> b) as mismatches
  from cols where a <> '-' and b <> '-' group by 1)
  select trio, matches, mismatches, {rnd('matches * 100.0 / (matches + mismatches)')} as identity from w""")
def _(spark, sf):
    return rounded(S.percent_identity(aln3(spark, sf), ["trio"]), "identity")


# ---- genome composition ----------------------------------------------------

def genome(spark, sf):
    return aln3(spark, sf).select(F.col("chr_a").alias("genome"), F.col("block_id").alias("name"),
                                  F.replace("seq_a", F.lit("-"), F.lit("")).alias("seq"))


GENOME = f"with {inputs.cte('aln3')}, genome as materialized (select chr_a as genome, block_id as name, replace(seq_a, '-', '') as seq from aln3)"
GCOL = """gcol as materialized (select genome, name, generate_subscripts(string_split(seq, ''), 1) as i, unnest(string_split(upper(seq), '')) as a from genome)"""


@query("genome_kmers", f"""{GENOME}, {GCOL},
  k as (select genome, a || lead(a, 1) over w || lead(a, 2) over w as kmer from gcol window w as (partition by name order by i))
  select genome, kmer, count(*) as n from k where kmer is not null group by 1, 2""")
def _(spark, sf):
    return W.kmers(genome(spark, sf), 3, ["genome"], chunk=8192).groupBy("genome", "kmer").agg(F.count(F.lit(1)).alias("n"))


@query("genome_trinucleotides", f"""{GENOME}, {GCOL},
  k as (select genome, a || lead(a, 1) over w || lead(a, 2) over w as kmer from gcol window w as (partition by name order by i)),
  n as (select genome, {fold('kmer')} as tri, count(*) as n from k where regexp_full_match(kmer, '[ACGT]+') group by 1, 2),
  acgt(x) as (values ('A'), ('C'), ('G'), ('T')),
  dim as (select g.genome, l.x || m.x || r.x as tri from (select distinct genome from genome) g, acgt l, acgt m, acgt r where m.x in ('C','T'))
  select d.genome, d.tri as trinuc, cast(coalesce(n.n, 0) as bigint) as num from dim d left join n on n.genome = d.genome and n.tri = d.tri""")
def _(spark, sf):
    return S.genome_trinucleotides(genome(spark, sf), ["genome"])


@query("gc_content", f"""{GENOME} select genome, cast(sum(length(regexp_replace(seq, '[^CGcg]', '', 'g'))) as bigint) as gc,
  cast(sum(length(regexp_replace(seq, '[^ACGTacgt]', '', 'g'))) as bigint) as acgt,
  {rnd("sum(length(regexp_replace(seq, '[^CGcg]', '', 'g'))) * 100.0 / sum(length(regexp_replace(seq, '[^ACGTacgt]', '', 'g')))")} as gc_pct
  from genome group by 1""")
def _(spark, sf):
    return rounded(S.gc_content(genome(spark, sf), ["genome"]), "gc_pct")


@query("genome_bases", f"{GENOME} select genome, cast(sum(length(seq)) as bigint) as bases from genome group by 1")
def _(spark, sf):
    return S.base_count(genome(spark, sf), ["genome"])

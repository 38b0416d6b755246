"""Site tables and the statistics on spectra."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bases as B
from ..operators import normalise as N
from ..operators import sites as T
from . import inputs
from .base import query, rnd, rounded
from .spectra import (ACGT3, ALN3, COLS, FLANKS3, OK3, OK4, SPECTRUM_CTE, aln3, fold, label3, spectrum)

# bases before each column, per species; coordinates of the inner bases of a window
LOC = """
loc as materialized (
  select block_id, i, a, b, c,
    count(*) filter (where a <> '-') over w - cast(a <> '-' as int) as oa,
    count(*) filter (where b <> '-') over w - cast(b <> '-' as int) as ob,
    count(*) filter (where c <> '-') over w - cast(c <> '-' as int) as oc
  from cols window w as (partition by block_id order by i rows unbounded preceding))"""


def _win(width: int) -> str:
    cat = lambda s: " || ".join([s] + [f"lead({s}, {k}) over w" for k in range(1, width)])
    return f"""lwin as materialized (select * from (
      select block_id, oa, ob, oc, {cat('a')} as wa, {cat('b')} as wb, {cat('c')} as wc
      from loc window w as (partition by block_id order by i)) q where wc is not null)"""


def _place(side: str, width: int, text: str) -> str:
    u = side.upper()
    s = f"(start_{side} + o{side} + 1)"
    e = f"(start_{side} + o{side} + {width - 1})"
    return (f"chr_{side} as \"chr{u}\", case when strand_{side} = '-' then len_{side} - {e} else {s} end as \"start{u}\", "
            f"case when strand_{side} = '-' then len_{side} - {s} else {e} end as \"end{u}\", "
            f"strand_{side} as \"strand{u}\", {text} as \"trinuc{u}\"")


PLACE3 = ", ".join(_place(s, 3, f"w{s}") for s in "abc")
PLACE4 = ", ".join(_place(s, 4, f"w{s}[2:3]") for s in "abc")
SITE_CTE = f"with {inputs.cte('aln3')}, {COLS}, {LOC}, {_win(3)}"
SITES = f"""{SITE_CTE}, sites as (select block_id, {PLACE3} from lwin join aln3 using (block_id)
  where {OK3} and wb[2] <> wc[2])"""


@query("substitution_sites", f"{SITES} select * from sites")
def _(spark, sf):
    return T.sbst_sites(aln3(spark, sf), ["block_id"])


ALL_SITES = f"""{SITE_CTE}, hits as materialized (
    select block_id, {PLACE3}, {fold('wa')} as "oriType", wa, wb, wc from lwin join aln3 using (block_id) where {OK3}),
  allsites as materialized (
    select * exclude (wa, wb, wc), 'B' as species, case when wa[2] <> wb[2] then {label3('wa', 'wb[2]')} else '.' end as "sbstType" from hits
    union all select * exclude (wa, wb, wc), 'C', case when wa[2] <> wc[2] then {label3('wa', 'wc[2]')} else '.' end from hits)"""


@query("all_sites", f"""{ALL_SITES}
  select "chrA", "strandB", "strandC", species, "oriType", "sbstType", count(*) as n,
    cast(sum("startA") as bigint) as sum_a, cast(sum("startB") as bigint) as sum_b, cast(sum("endC") as bigint) as sum_c,
    cast(min("startB") as bigint) as min_b, cast(max("endC") as bigint) as max_c
  from allsites group by 1, 2, 3, 4, 5, 6""")
def _(spark, sf):
    # the table itself has two rows per column; it is compared by groups of all its rows
    s = T.all_sites(aln3(spark, sf))
    return s.groupBy("chrA", "strandB", "strandC", "species", "oriType", "sbstType").agg(
        F.count(F.lit(1)).alias("n"), F.sum("startA").alias("sum_a"), F.sum("startB").alias("sum_b"),
        F.sum("endC").alias("sum_c"), F.min("startB").alias("min_b"), F.max("endC").alias("max_c"))


@query("doublet_sites", f"""with {inputs.cte('aln3')}, {COLS}, {LOC}, {_win(4)},
  hits as (select block_id, {PLACE4} from lwin join aln3 using (block_id) where {OK4})
  select *, 'B' as species, "trinucA" || '>' || "trinucB" as "sbstType" from hits
    where "trinucA"[1] <> "trinucB"[1] and "trinucA"[2] <> "trinucB"[2]
  union all select *, 'C', "trinucA" || '>' || "trinucC" from hits
    where "trinucA"[1] <> "trinucC"[1] and "trinucA"[2] <> "trinucC"[2]""")
def _(spark, sf):
    return T.doublet_sites(aln3(spark, sf), ["block_id"])


@query("sites_per_species", f"""{SITES}
  select block_id, 'B' as species, "chrB" as chr, "startB" as start, "endB" as "end", '.' as name, '.' as score, "strandB" as strand,
    {label3('"trinucA"', '"trinucB"[2]')} as "sbstSig" from sites where "trinucA" <> "trinucB"
  union all select block_id, 'C', "chrC", "startC", "endC", '.', '.', "strandC", {label3('"trinucA"', '"trinucC"[2]')}
    from sites where "trinucA" <> "trinucC" """)
def _(spark, sf):
    return T.split_sites(T.sbst_sites(aln3(spark, sf), ["block_id"]), ["block_id"])


@query("base_offsets", f"""{SITE_CTE} select block_id, count(*) as n, cast(sum(oa) as bigint) as sum_a,
   cast(sum(ob) as bigint) as sum_b, cast(sum(oc) as bigint) as sum_c from lwin
   where {ACGT3} group by 1""")
def _(spark, sf):
    w = T.located_windows(aln3(spark, sf), 3, ["block_id"])
    return w.groupBy("block_id").agg(F.count(F.lit(1)).alias("n"), F.sum("off_a").alias("sum_a"),
                                     F.sum("off_b").alias("sum_b"), F.sum("off_c").alias("sum_c"))


# ---- statistics ------------------------------------------------------------

KEYS = ["trio", "species"]
OBS = '"mutNum" / nullif(cast("totalRootNum" as double), 0.0)'


@query("normalised_spectrum", f"""{SPECTRUM_CTE} select trio, species, "mutType", "mutNum", "totalRootNum",
  {rnd(f'100 * {OBS}')} as percentage from spectrum""")
def _(spark, sf):
    return rounded(N.normalised(spectrum(spark, sf).drop("oriType")), "percentage")


def log2_sql(e: str) -> str:
    return f"case when ({e}) > 0 then log2({e}) when ({e}) = 0 then cast('-inf' as double) end"


@query("log_ratio_mean", f"""{SPECTRUM_CTE}, o as (select *, {OBS} as obs from spectrum),
  m as (select *, obs / nullif(avg(obs) over (partition by trio, species), 0.0) as q from o)
  select trio, species, "mutType", {rnd('obs')} as obs, {rnd(log2_sql('q'))} as log_ratio from m""")
def _(spark, sf):
    out = N.log_ratio_mean(spectrum(spark, sf), KEYS).select("trio", "species", "mutType", "obs", "log_ratio")
    return rounded(out, "obs", "log_ratio")


@query("log_ratio_feature", f"""{SPECTRUM_CTE}, o as (select *, coalesce({OBS}, 0.0) as obs from spectrum)
  select trio, species, "mutType",
    {rnd('log2((obs + 1e-12) / greatest(avg(obs) over (partition by trio, species), 1e-12))')} as feature from o""")
def _(spark, sf):
    return rounded(N.log_ratio_smooth(spectrum(spark, sf), KEYS).select("trio", "species", "mutType", "feature"), "feature")


@query("change_shares", f"""{SPECTRUM_CTE}, o as (select *, {OBS} as obs from spectrum)
  select trio, species, {rnd('''sum(case when "mutType" like '%C>T%' then obs else 0 end) / sum(obs)''')} as c_to_t,
   {rnd('''sum(case when "mutType" like '%T>C%' then obs else 0 end) / sum(obs)''')} as t_to_c,
   {rnd('''sum(case when "mutType" like '%C>T]G%' then obs else 0 end) / sum(obs)''')} as cpg_to_tpg from o group by 1, 2""")
def _(spark, sf):
    return rounded(N.change_shares(spectrum(spark, sf), KEYS), "c_to_t", "t_to_c", "cpg_to_tpg")


@query("original_context_counts", f"""{SPECTRUM_CTE} select distinct trio, species,
  "mutType"[1] || "mutType"[3] || "mutType"[7] as "oriType", "totalRootNum" from spectrum""")
def _(spark, sf):
    return N.original_counts(spectrum(spark, sf).drop("oriType"), KEYS)


@query("label_names", f"""{SPECTRUM_CTE} select distinct "mutType", "mutType"[1] || "mutType"[3] || "mutType"[7] as context,
  "mutType"[1] || "mutType"[3] || "mutType"[7] || ' → ' || "mutType"[1] || "mutType"[5] || "mutType"[7] as display from spectrum""")
def _(spark, sf):
    return spectrum(spark, sf).select("mutType", B.label_context("mutType").alias("context"),
                                      B.label_display("mutType").alias("display")).distinct()


def _ranked_check(direction: str) -> str:
    return f"""{SPECTRUM_CTE}, r as (select trio, species, "mutType", 100 * {OBS} as p from spectrum),
      k as (select *, row_number() over (partition by trio, species order by p {direction} nulls last, "mutType") as rank from r)
      select trio, species, "mutType", {rnd('p')} as percentage, cast(rank as integer) as rank from k where rank <= 10"""


@query("top_labels", _ranked_check("desc"))
def _(spark, sf):
    out = N.top_labels(spectrum(spark, sf), KEYS).select("trio", "species", "mutType", "percentage", "rank")
    return rounded(out, "percentage")


@query("bottom_labels", _ranked_check("asc"))
def _(spark, sf):
    out = N.top_labels(spectrum(spark, sf), KEYS, largest=False).select("trio", "species", "mutType", "percentage", "rank")
    return rounded(out, "percentage")


def _share_check(direction: str) -> str:
    from .spectra import PAIR_CHANGE
    return f"""{ALN3}, hit as (select trio, {label3('wa', 'wb[2]')} as label, count(*) as n from win3 where {PAIR_CHANGE} group by 1, 2),
      allh as (select trio, sum(n) as t from hit group by 1),
      p as (select k.trio, d.label, coalesce(h.n, 0) * 100.0 / a.t as p from keys k cross join dim3 d
            left join hit h on h.trio = k.trio and h.label = d.label left join allh a on a.trio = k.trio),
      r as (select *, row_number() over (partition by trio order by p {direction} nulls last, label) as rank from p)
      select trio, label as "mutType", {rnd('p')} as percentage, cast(rank as integer) as rank from r where rank <= 5"""


def _shares(spark, sf, largest):
    from ..operators.spectra import tri_changes_pct
    pct = tri_changes_pct(aln3(spark, sf), ["trio"])
    return rounded(N.ranked(pct, ["trio"], "percentage", 5, "mutType", largest)
                   .select("trio", "mutType", "percentage", "rank"), "percentage")


@query("top_change_shares", _share_check("desc"))
def _(spark, sf):
    return _shares(spark, sf, True)


@query("bottom_change_shares", _share_check("asc"))
def _(spark, sf):
    return _shares(spark, sf, False)


@query("spectra_side_by_side", f"""{SPECTRUM_CTE} select "mutType",
  {', '.join(rnd(f"max(case when trio = '{t}' and species = '{s}' then 100 * {OBS} end)") + f' as {t}_{s}' for t in ('de', 'en', 'es', 'fr') for s in 'BC')}
  from spectrum group by 1""")
def _(spark, sf):
    labels = [f"{t}_{s}" for t in ("de", "en", "es", "fr") for s in "BC"]
    return rounded(N.wide_spectra(spectrum(spark, sf), KEYS, labels), *labels)

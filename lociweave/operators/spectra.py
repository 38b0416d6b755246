"""Substitution spectra: counts of context-dependent changes under parsimony."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions import bases as B
from .windows import PAIR, TRIO, columns, kmers, window_counts, windows

BASES = "ACGT"


# ---- class dimensions (fixed size: 32, 96, 16 and 78 rows) -----------------

def tri_contexts(spark: SparkSession) -> DataFrame:
    """The 32 contexts with a pyrimidine in the middle."""
    return spark.createDataFrame([(x + y + z,) for x in BASES for y in "CT" for z in BASES], "oriType string")


def tri_classes(spark: SparkSession) -> DataFrame:
    """96 classes: oriType, alt, mutType."""
    alts = spark.createDataFrame([(b,) for b in BASES], "alt string")
    return (
        tri_contexts(spark).join(F.broadcast(alts), B.base_at("oriType", 2) != F.col("alt"))
        .withColumn("mutType", B.tri_label("oriType", "alt"))
    )


def di_labels() -> list[str]:
    """The 78 `XY>ZW` classes: both bases differ, one of each pair of strand forms."""
    pairs = [(x + y, b + c) for x in BASES for y in BASES for b in BASES for c in BASES if x != b and y != c]
    return [f"{o}>{m}" for o, m in pairs
            if o not in B.FLIPPED_DOUBLETS and f"{o}>{m}" not in B.FLIPPED_PALINDROME_CHANGES]


def di_classes(spark: SparkSession) -> DataFrame:
    """78 classes: oriType, mutType."""
    return spark.createDataFrame([(l[:2], l) for l in di_labels()], "oriType string, mutType string")


def _with_zero_rows(counts: DataFrame, dim: DataFrame, source: DataFrame, keys: Sequence[str],
                    numbers: Sequence[str]) -> DataFrame:
    """Sum counts per key and class, with a zero row for every (key in source) x (fixed class).

    The zero rows join the aggregate as a union: no join, and no null filter that
    the optimizer would push below the counting of raw windows.
    """
    frame = source.select(*keys).distinct().join(F.broadcast(dim)) if keys else dim
    classes = [c for c in dim.columns]
    zeros = frame.select(*keys, *classes, *[F.lit(0).cast(dict(counts.dtypes)[c]).alias(c) for c in numbers])
    return (counts.select(*keys, *classes, *numbers).unionByName(zeros)
            .groupBy(*keys, *classes).agg(*[F.sum(c).alias(c) for c in numbers]))


def _by_species(wide: DataFrame, keys: Sequence[str], lead: Sequence[str] = ()) -> DataFrame:
    return wide.select(
        *keys,
        *lead,
        F.inline(F.array(
            F.struct(F.lit("B").alias("species"), F.col("mut_b").alias("mutNum"), F.col("total").alias("totalRootNum")),
            F.struct(F.lit("C").alias("species"), F.col("mut_c").alias("mutNum"), F.col("total").alias("totalRootNum")),
        )),
    )


# ---- trinucleotides --------------------------------------------------------

def informative_tri(wa="win_a", wb="win_b", wc="win_c") -> Column:
    """Equal flanks, no symbol but ACGT, and the outgroup middle shared with B or C."""
    mid = lambda w: B.base_at(w, 2)
    return (
        B.flanks_equal(wa, wb, wc)
        & ((mid(wa) == mid(wb)) | (mid(wa) == mid(wc)))
        & B.is_acgt(wa) & B.is_acgt(wb) & B.is_acgt(wc)
    )


def _tri_spectrum(raw: DataFrame, aln: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counts of informative raw windows -> (keys, oriType, mutType, mut_b, mut_c, total)."""
    hit = lambda v: F.when(F.col(v) == F.col("alt"), F.col("n")).otherwise(F.lit(0).cast("bigint"))
    counts = (
        raw.select(
            *keys,
            B.canon_tri("win_a").alias("oriType"),
            B.canon_alt("win_a", B.base_at("win_b", 2)).alias("vb"),
            B.canon_alt("win_a", B.base_at("win_c", 2)).alias("vc"),
            "n",
            F.explode(F.array(*[F.lit(b) for b in BASES])).alias("alt"),
        )
        .where(F.col("alt") != B.base_at("oriType", 2))
        .select(*keys, "oriType", B.tri_label("oriType", "alt").alias("mutType"),
                hit("vb").alias("mut_b"), hit("vc").alias("mut_c"), F.col("n").alias("total"))
    )
    dim = tri_classes(aln.sparkSession).select("oriType", "mutType")
    return _with_zero_rows(counts, dim, aln, keys, ("mut_b", "mut_c", "total"))


def tri_spectrum(aln: DataFrame, keys: Sequence[str] = (), with_ori: bool = False) -> DataFrame:
    """96-class spectrum of ingroups B and C: keys, species, mutType, mutNum, totalRootNum."""
    return tri_spectrum_of(window_counts(aln, 3, TRIO, keys), aln, keys, with_ori)


def tri_spectrum_of(raw: DataFrame, aln: DataFrame, keys: Sequence[str] = (), with_ori: bool = False) -> DataFrame:
    """`tri_spectrum` from the counts of raw windows; `aln` names the keys that zero rows are made for."""
    wide = _tri_spectrum(_where(raw, informative_tri()), aln, keys)
    return _by_species(wide, keys, ("oriType", "mutType") if with_ori else ("mutType",))


def _where(raw: DataFrame, rule: Column) -> DataFrame:
    """Counts that pass a rule, which is tied to the count so that it isn't pushed below the counting."""
    return raw.where(F.when(rule, F.col("n")) > 0)


def tri_spectrum_low_error(aln: DataFrame, keys: Sequence[str] = (), lowest: str = "5") -> DataFrame:
    """As `tri_spectrum`, only over windows where every p-line character is >= `lowest`.

    `plines` is ARRAY<STRING>. The p lines are folded into one string (the lowest
    character per column is what matters) before the windows are made.
    """
    if len(lowest) != 1:
        raise ValueError("lowest is one character")
    marks = "".join(map(chr, range(32, 127)))
    passed = "".join("!" if c < lowest else "1" for c in marks)
    flags = F.aggregate(
        F.transform(F.col("plines"), lambda p: F.translate(p, marks, passed)),
        F.regexp_replace(F.upper("seq_a"), ".", "1"),
        lambda acc, p: F.when(~p.contains("!"), acc).when(~acc.contains("!"), p).otherwise(
            F.concat_ws("", F.zip_with(F.split(acc, ""), F.split(p, ""), lambda u, v: F.least(u, v)))),
    )
    masked = aln.withColumn("seq_p", flags)
    raw = window_counts(masked, 3, (*TRIO, "p"), keys, informative_tri() & (F.col("win_p") == "111"))
    return _by_species(_tri_spectrum(raw, aln, keys), keys, ("mutType",))


def tri_spectrum_weighted(aln: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One spectrum where a change of the outgroup counts half in each direction.

    An unchanged site adds to the total of the three labels of its context, a
    changed site only to its own label.
    """
    a, b, c = (B.base_at(f"win_{s}", 2) for s in TRIO)
    raw = (
        window_counts(aln, 3, TRIO, keys,
                      B.flanks_equal("win_a", "win_b", "win_c") & (B.site_class(a, b, c) != "triple")
                      & B.is_acgt("win_a") & B.is_acgt("win_b") & B.is_acgt("win_c"))
        .withColumn("_cls", B.site_class(a, b, c))
    )
    # n sits inside the entries, so nothing here can move below the count
    n = F.col("n").cast("double")
    entry = lambda label, mut, total: F.struct(
        label.alias("mutType"), (mut * n).alias("mutNum"), (total * n).alias("totalRootNum"))
    unchanged = F.transform(
        F.filter(F.array(*[F.lit(x) for x in BASES]), lambda v: v != a),
        lambda v: F.struct(B.sbst_label("win_a", v).alias("mutType"), (0.0 * n).alias("mutNum"), n.alias("totalRootNum")))
    labels = (
        F.when(F.col("_cls") == "none", unchanged)
        .when(F.col("_cls") == "B", F.array(entry(B.sbst_label("win_a", b), 1.0, 1.0)))
        .when(F.col("_cls") == "C", F.array(entry(B.sbst_label("win_a", c), 1.0, 1.0)))
        .otherwise(F.array(entry(B.sbst_label("win_a", b), 0.5, 0.5), entry(B.sbst_label("win_b", a), 0.5, 0.5)))
    )
    counts = raw.select(*keys, F.inline(labels))
    dim = tri_classes(aln.sparkSession).select("mutType")
    return _with_zero_rows(counts, dim, aln, keys, ("mutNum", "totalRootNum"))


# ---- dinucleotides ---------------------------------------------------------

def informative_di(wa="win_a", wb="win_b", wc="win_c") -> Column:
    mid = lambda w: F.substring(F.col(w), 2, 2)
    return (
        B.flanks_equal(wa, wb, wc)
        & ((mid(wa) == mid(wb)) | (mid(wa) == mid(wc)))
        & B.is_acgt(wa) & B.is_acgt(wb) & B.is_acgt(wc)
    )


def di_spectrum(aln: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """78-class doublet spectrum of B and C; a change needs both bases to differ."""
    return di_spectrum_of(window_counts(aln, 4, TRIO, keys), aln, keys)


def di_spectrum_of(raw: DataFrame, aln: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`di_spectrum` from the counts of raw windows of four columns."""
    mid = lambda w: F.substring(F.col(w), 2, 2)
    # every informative combination is listed once per class of its original doublet
    listed = _where(raw, informative_di()).select(
        *keys, "n", B.canon_doublet(mid("win_a")).alias("oriType"),
        B.di_label(mid("win_a"), mid("win_b")).alias("to_b"), B.di_label(mid("win_a"), mid("win_c")).alias("to_c"),
        F.explode(F.array(*[F.lit(l) for l in di_labels()])).alias("mutType"))
    hit = lambda v: F.when(F.col(v) == F.col("mutType"), F.col("n")).otherwise(F.lit(0).cast("bigint"))
    counts = listed.where(F.left("mutType", F.lit(2)) == F.col("oriType")).select(
        *keys, "oriType", "mutType", hit("to_b").alias("mut_b"), hit("to_c").alias("mut_c"), F.col("n").alias("total"))
    wide = _with_zero_rows(counts, di_classes(aln.sparkSession), aln, keys, ("mut_b", "mut_c", "total"))
    return _by_species(wide, keys, ("mutType",))


# ---- pairwise changes, context-free ratios, genome composition -------------

def tri_changes(aln2: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Pairwise windows with equal flanks and a changed middle: refTri, qryTri, mutType."""
    w = windows(aln2, 3, PAIR, keep).where(_pair_change())
    return w.select(*keep, F.col("win_a").alias("refTri"), F.col("win_b").alias("qryTri"),
                    B.sbst_label("win_a", B.base_at("win_b", 2)).alias("mutType"))


def _pair_change() -> Column:
    return (
        B.flanks_equal("win_a", "win_b") & (B.base_at("win_a", 2) != B.base_at("win_b", 2))
        & B.is_acgt("win_a") & B.is_acgt("win_b")
    )


def tri_changes_pct(aln2: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of each of the 96 labels among all changes, in percent."""
    counts = window_counts(aln2, 3, PAIR, keys, _pair_change()).select(
        *keys, B.sbst_label("win_a", B.base_at("win_b", 2)).alias("mutType"), F.col("n").alias("mutNum"))
    full = _with_zero_rows(counts, tri_classes(aln2.sparkSession).select("mutType"), aln2, keys, ("mutNum",))
    whole = F.sum("mutNum").over(W.partitionBy(*keys))  # 96 rows per key
    return full.select(*keys, "mutType", "mutNum", (F.col("mutNum") * 100.0 / F.nullif(whole, F.lit(0))).alias("percentage"))


def change_matrix(aln2: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of every (refBase, qryBase) pair with type and strand-folded category."""
    return window_counts(aln2, 1, PAIR, keys).select(
        *keys, F.col("win_a").alias("refBase"), F.col("win_b").alias("qryBase"), F.col("n").alias("count"),
        B.change_type("win_a", "win_b").alias("type"), B.change_category("win_a", "win_b").alias("category"))


def change_totals(matrix: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Totals per category and type, with the percentage of all columns."""
    totals = matrix.groupBy(*keys, "category", "type").agg(F.sum("count").alias("total_count"))
    whole = F.sum("total_count").over(W.partitionBy(*keys))  # a few classes per key
    return totals.select(*keys, "category", "type", "total_count", (F.col("total_count") * 100.0 / whole).alias("percentage"))


def sbst_ratio(aln: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Context-free substitution counts and percentage of B and C; only '-' is excluded."""
    return sbst_ratio_of(window_counts(aln, 1, TRIO, keys), keys)


def sbst_ratio_of(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """`sbst_ratio` from the counts of single columns."""
    raw = _where(counts, F.expr("win_a <> '-' and win_b <> '-' and win_c <> '-'"))
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n")).otherwise(0)), F.lit(0)).cast("bigint")
    cls = B.site_class("win_a", "win_b", "win_c")
    wide = raw.groupBy(*keys).agg(
        total(cls == "B").alias("sub_b"), total(cls.isin("none", "C")).alias("same_b"),
        total(cls == "C").alias("sub_c"), total(cls.isin("none", "B")).alias("same_c"))
    side = lambda s, u, v: F.struct(F.lit(s).alias("species"), F.col(u).alias("sbst"), F.col(v).alias("unchanged"),
                                    (F.col(u) * 100.0 / F.nullif(F.col(u) + F.col(v), F.lit(0))).alias("percentage"))
    return wide.select(*keys, F.inline(F.array(side("B", "sub_b", "same_b"), side("C", "sub_c", "same_c"))))


def genome_trinucleotides(fasta: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Counts of the 32 canonical contexts in genomes, zero filled; non-ACGT windows are dropped."""
    counts = (
        kmers(fasta, 3, keys).groupBy(*keys, "kmer").agg(F.count(F.lit(1)).alias("n"))
        .where(F.when(B.is_acgt("kmer"), F.col("n")) > 0)
        .select(*keys, B.canon_tri("kmer").alias("trinuc"), F.col("n").alias("num"))
    )
    dim = tri_contexts(fasta.sparkSession).withColumnRenamed("oriType", "trinuc")
    return _with_zero_rows(counts, dim, fasta, keys, ("num",))


def _letters(seq, letters: str) -> Column:
    """Occurrences of any of `letters` in a string, without a regex pass."""
    s = F.col(seq)
    return F.length(s) - F.length(F.translate(s, letters, ""))


def gc_content(fasta: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """GC percentage with A, C, G, T (either case) as denominator."""
    return fasta.groupBy(*keys).agg(
        F.sum(_letters("seq", "CGcg")).cast("bigint").alias("gc"),
        F.sum(_letters("seq", "ACGTacgt")).cast("bigint").alias("acgt"),
    ).withColumn("gc_pct", F.col("gc") * 100.0 / F.nullif(F.col("acgt"), F.lit(0)))


def gc_of(counts: DataFrame, side: str, keys: Sequence[str] = ()) -> DataFrame:
    """`gc_content` of one sequence of an alignment from the counts of single columns."""
    among = lambda letters: F.sum(F.when(F.col(f"win_{side}").isin(*letters), F.col("n")).otherwise(0)).cast("bigint")
    return counts.groupBy(*keys).agg(among("CG").alias("gc"), among("ACGT").alias("acgt")).withColumn(
        "gc_pct", F.col("gc") * 100.0 / F.nullif(F.col("acgt"), F.lit(0)))


def base_count(fasta: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return fasta.groupBy(*keys).agg(F.sum(F.length("seq")).cast("bigint").alias("bases"))


def percent_identity(aln2: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """100 * matches / (matches + mismatches) over columns without a gap."""
    return percent_identity_of(window_counts(aln2, 1, PAIR, keys), keys)


def percent_identity_of(counts: DataFrame, keys: Sequence[str] = (), other: str = "b") -> DataFrame:
    """`percent_identity` of A and another sequence from the counts of single columns."""
    raw = _where(counts.withColumn("win_b", F.col(f"win_{other}")), F.expr("win_a <> '-' and win_b <> '-'"))
    out = raw.groupBy(*keys).agg(
        F.sum(F.when(F.col("win_a") == F.col("win_b"), F.col("n")).otherwise(0)).alias("matches"),
        F.sum(F.when(F.col("win_a") != F.col("win_b"), F.col("n")).otherwise(0)).alias("mismatches"))
    return out.withColumn("identity", F.col("matches") * 100.0 / (F.col("matches") + F.col("mismatches")))

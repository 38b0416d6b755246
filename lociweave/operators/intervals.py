"""Interval operators on (chr, start, end), 0-based half open.

Overlap joins are equi joins on (chr, level, bin): bins of a level are 16 times as wide as those of the level
below, an interval lives at the lowest level where it touches MOST bins or fewer, and a pair meets at the
higher of its two levels, in the first bin both share. Hot bins are left to AQE's skew split, or salted with `salt_above`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .scans import WIDTH, positions, scan

BIN = 1 << 14
#: Bins that an interval is listed in at most, width of a level's bins over those below, number of levels.
MOST, WIDER, LEVELS = 16, 16, 8


# ---- merging ---------------------------------------------------------------

def islands(df: DataFrame, touching: bool, keys: Sequence[str] = ("chr",), width: int = WIDTH) -> DataFrame:
    """Distinct starts with the start of the island they belong to: keys, start, n, island.

    `touching`: whether an interval that begins exactly where the island ends joins it.
    """
    pre = positions(df, keys, "start", F.max("end").alias("end"), F.count(F.lit(1)).alias("n"))
    seen = scan(pre, keys, "start", width=width, max_before={"reach": F.col("end")})
    gap = F.col("start") > F.col("reach") if touching else F.col("start") >= F.col("reach")
    first = F.col("reach").isNull() | gap
    return scan(seen, keys, "start", width=width, max_through={"island": F.when(first, F.col("start"))}).select(
        *keys, "start", "end", "n", "island")


def merge_intervals(df: DataFrame, keys: Sequence[str] = ("chr",), width: int = WIDTH, touching: bool = True) -> DataFrame:
    """Overlapping (and touching) intervals merged: keys, start, end."""
    return (islands(df, touching, keys, width).groupBy(*keys, "island")
            .agg(F.max("end").alias("end")).select(*keys, F.col("island").alias("start"), "end"))


def shrink(merged: DataFrame, rule: str | None) -> DataFrame:
    """Shrink by one base each side: rule "empty" keeps length >= 0, "one" length >= 1, None leaves as is."""
    if rule is None:
        return merged
    b, e = F.col("start"), F.col("end")
    if rule == "empty":
        return merged.withColumns({"start": b + 1, "end": F.greatest(e - 1, b + 1)})
    if rule == "one":
        nb = F.least(b + 1, e - 1)
        return merged.withColumns({"start": nb, "end": F.greatest(e - 1, nb + 1)})
    raise ValueError("rule is None, 'empty' or 'one'")


# ---- overlap joins ---------------------------------------------------------

def with_bins(df: DataFrame, bin_size: int, start: str = "start", end: str = "end", closed: bool = False) -> DataFrame:
    """One row per bin; `_bin0` is the interval's first bin. `closed` also lists the bin of `end` itself."""
    last = F.col(end) if closed else F.greatest(F.col(end) - 1, F.col(start))
    lo, hi = F.floor(F.col(start) / bin_size), F.floor(last / bin_size)
    return df.withColumns({"_bin0": lo, "_bin": F.explode(F.sequence(lo, hi))})


def _salted(left: DataFrame, right: DataFrame, on: list[str], salt_above: int) -> tuple[DataFrame, DataFrame]:
    """Spread the left rows of hot bins over salts and repeat the right rows of those bins."""
    hot = left.groupBy(*on).count().where(F.col("count") > salt_above).select(
        *on, F.ceil(F.col("count") / salt_above).cast("int").alias("_salts"))
    l = left.join(hot, on, "left").withColumn(
        "_salt", F.pmod(F.xxhash64(*left.columns), F.coalesce("_salts", F.lit(1)).cast("bigint")).cast("int")).drop("_salts")
    r = right.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return l, r


def _level(bin_size: int, first: Column, last: Column) -> Column:
    """The lowest level where the interval touches MOST bins or fewer."""
    level = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        width = bin_size * WIDER ** k
        level = F.when(F.floor(last / width) - F.floor(first / width) < MOST, F.lit(k)).otherwise(level)
    return level


def _last(start: str, end: str, closed: bool) -> Column:
    return F.col(end) if closed else F.greatest(F.col(end) - 1, F.col(start))


def _levels(df: DataFrame, bin_size: int, start: str, end: str, closed: bool) -> DataFrame:
    """One row: the levels that a table's intervals live at, LEVELS at most. Only the two columns are read for it."""
    at = df.select(F.col(start).alias("s"), _last(start, end, closed).alias("e"))
    return at.select(_level(bin_size, F.col("s"), F.col("e")).alias("l")).agg(F.collect_set("l").alias("_all"))


def _listed(df: DataFrame, bin_size: int, start: str, end: str, closed: bool, others: DataFrame) -> DataFrame:
    """Rows per level and bin: _own (the interval's level), _lvl (that, or a higher one of `others`), _bin0 (its first bin there), _bin."""
    placed = df.withColumns({"_last": _last(start, end, closed), "_own": _level(bin_size, F.col(start), _last(start, end, closed))})
    at = placed.join(F.broadcast(others)).withColumn("_lvl", F.explode(F.array_union(  # one row
        F.array("_own"), F.filter("_all", lambda k: k > F.col("_own"))))).drop("_all")
    width = (F.lit(bin_size) * F.pow(F.lit(WIDER), F.col("_lvl"))).cast("bigint")
    lo, hi = F.floor(F.col(start) / width), F.floor(F.col("_last") / width)
    return at.withColumns({"_bin0": lo, "_bin": F.explode(F.sequence(lo, hi))}).drop("_last")


def overlap_join(a: DataFrame, b: DataFrame, prefix: str = "b_", bin_size: int = BIN, salt_above: int | None = None,
                 condition: Column | None = None, closed: bool = False) -> DataFrame:
    """All pairs sharing at least one base; columns of a, then those of b with `prefix`.

    `condition` replaces the overlap test (on a's columns and prefixed b's); with
    `closed`, intervals that only touch end-to-start are candidates too. Starts and ends of both sides are read once
    more to see which levels occur; an interval is listed at its own and at the higher ones of the other side. A long interval has MOST bins,
    which it fills but for the first and last, so candidates stay in proportion to the pairs.
    """
    right = b.select([F.col(c).alias(prefix + c) for c in b.columns])
    r = _listed(right, bin_size, prefix + "start", prefix + "end", closed, _levels(a, bin_size, "start", "end", closed))
    l = _listed(a, bin_size, "start", "end", closed, _levels(right, bin_size, prefix + "start", prefix + "end", closed))
    r = r.withColumnsRenamed({"_bin0": "_rbin0", "_bin": "_rbin", "_own": "_rown", "_lvl": "_rlvl"})
    on_l, on_r = ["chr", "_lvl", "_bin"], [prefix + "chr", "_rlvl", "_rbin"]
    if salt_above:
        l, r2 = _salted(l, r.withColumnsRenamed(dict(zip(on_r, on_l))), on_l, salt_above)
        r = r2.withColumnsRenamed({**dict(zip(on_l, on_r)), "_salt": "_rsalt"})
        on_l, on_r = on_l + ["_salt"], on_r + ["_rsalt"]
    match = F.lit(True)
    for x, y in zip(on_l, on_r):
        match = match & (l[x] == r[y])
    if condition is None:
        condition = (F.col("start") < F.col(prefix + "end")) & (F.col(prefix + "start") < F.col("end"))
    met = (F.col("_lvl") == F.greatest("_own", "_rown")) & (F.col("_bin") == F.greatest("_bin0", "_rbin0"))
    return l.join(r, match & met & condition).select(*a.columns, *right.columns)


def overlap_clip(a: DataFrame, b: DataFrame, prefix: str = "b_", bin_size: int = BIN) -> DataFrame:
    """Overlap join with a's span cut to the common part."""
    return overlap_join(a, b, prefix, bin_size).withColumns({
        "start": F.greatest("start", prefix + "start"), "end": F.least("end", prefix + "end")})


def overlap_outer(a: DataFrame, b: DataFrame, a_key: Sequence[str], prefix: str = "b_", bin_size: int = BIN) -> DataFrame:
    """Overlap join that keeps rows of `a` (identified by a_key) without a partner, with nulls."""
    pairs = overlap_join(a, b, prefix, bin_size)
    lonely = a.join(pairs.select(*a_key).distinct(), list(a_key), "left_anti")
    return pairs.unionByName(lonely, allowMissingColumns=True)


def overlap_count(a: DataFrame, b: DataFrame, name: str = "count", width: int = WIDTH, keys: Sequence[str] = ("chr",)) -> DataFrame:
    """Number of b intervals overlapping each a interval with the same keys, zero kept.

    Count = (starts of b before a's end) - (ends of b at or before a's start): one
    ordered scan over boundaries, so a pile-up makes no pairs.
    """
    keys = list(keys)
    queries = a.select(*keys, "start", "end").distinct()
    mark = lambda df, pos, kind, s, e, ref: df.select(
        *keys, F.col(pos).alias("pos"), F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"), ref.alias("other"))
    zero, none = F.lit(0).cast("bigint"), F.lit(0).cast("bigint")
    starts = b.groupBy(*keys, "start").count()
    ends = b.groupBy(*keys, "end").count()
    events = (
        mark(queries, "end", 0, zero, zero, F.col("start"))
        .unionByName(mark(starts, "start", 1, F.col("count"), zero, none))
        .unionByName(mark(ends, "end", 2, zero, F.col("count"), none))
        .unionByName(mark(queries, "start", 3, zero, zero, F.col("end")))
    )
    ran = scan(events, keys, "pos", ["kind", "other"], width, sums={"begun": F.col("s"), "ended": F.col("e")})
    at_end, at_start = F.col("kind") == 0, F.col("kind") == 3
    counts = ran.where(at_end | at_start).groupBy(
        *keys, F.when(at_end, F.col("other")).otherwise(F.col("pos")).alias("start"),
        F.when(at_end, F.col("pos")).otherwise(F.col("other")).alias("end"),
    ).agg(F.sum(F.when(at_end, F.col("begun")).otherwise(-F.col("ended"))).alias(name))
    return a.join(counts, [*keys, "start", "end"]).select(*a.columns, name)


# ---- coding / non-coding ---------------------------------------------------

def mark_coding(sites: DataFrame, features: DataFrame, name: str = "coding", bin_size: int = BIN) -> DataFrame:
    """Flag single-base rows (end = start + 1) that lie in any feature.

    Features are merged first, so a base has at most one partner: one left join on
    (chr, bin) with a range test, which cannot grow the sites.
    """
    merged = with_bins(merge_intervals(features.select("chr", "start", "end")), bin_size).select(
        F.col("chr").alias("_fchr"), F.col("_bin").alias("_fbin"), F.col("start").alias("_fs"), F.col("end").alias("_fe"))
    base = F.when(F.col("end") - F.col("start") == 1, F.col("start")).otherwise(
        F.raise_error(F.lit("coding marks need single-base sites")).cast("bigint"))
    left = sites.withColumn("_bin", F.floor(base / bin_size))
    hit = ((F.col("chr") == F.col("_fchr")) & (F.col("_bin") == F.col("_fbin"))
           & (F.col("_fs") <= F.col("start")) & (F.col("start") < F.col("_fe")))
    return left.join(merged, hit, "left").select(*sites.columns, F.col("_fchr").isNotNull().alias(name))


def coding_split(sites: DataFrame, features: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per label: coding and non-coding substitutions; per original context: the same for originals.

    sites: output of `counted_sites` (oriType, sbstB, sbstC, chrA, startA, endA). Returns
    keys, species, kind ('s' or 'o'), label, cds, ncds. Sites are counted per (context,
    labels, flag) before they are listed per species.
    """
    placed = sites.select(*keys, "oriType", "sbstB", "sbstC", F.col("chrA").alias("chr"),
                          F.col("startA").alias("start"), F.col("endA").alias("end"))
    per = mark_coding(placed, features).groupBy(*keys, "oriType", "sbstB", "sbstC", "coding").agg(F.count(F.lit(1)).alias("n"))
    row = lambda sp, kind, label: F.struct(F.lit(sp).alias("species"), F.lit(kind).alias("kind"), F.col(label).alias("label"), F.col("n").alias("n"))
    long_ = per.select(*keys, "coding", F.inline(F.array(
        row("B", "o", "oriType"), row("C", "o", "oriType"), row("B", "s", "sbstB"), row("C", "s", "sbstC"))))
    part = lambda flag: F.sum(F.when((F.col("coding") == flag) & (F.col("label") != "."), F.col("n")).otherwise(0)).cast("bigint")
    out = long_.groupBy(*keys, "species", "kind", "label").agg(part(True).alias("cds"), part(False).alias("ncds"))
    return out.where("label <> '.'")


def annotate_spectrum(spectrum: DataFrame, split: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spectrum with s_cds, s_ncds, o_cds, o_ncds (zero when a label never occurs)."""
    side = lambda kind, on: split.where(F.col("kind") == kind).select(
        *keys, F.col("label").alias(on), F.col("cds").alias(f"{kind}_cds"), F.col("ncds").alias(f"{kind}_ncds"))
    out = spectrum.join(side("s", "mutType"), [*keys, "mutType"], "left").join(side("o", "oriType"), [*keys, "oriType"], "left")
    return out.na.fill(0, ["s_cds", "s_ncds", "o_cds", "o_ncds"])


def annotation_violations(annotated: DataFrame) -> DataFrame:
    """Rows where coding + non-coding does not add up; empty when the counts are sound."""
    return annotated.where("mutNum <> s_cds + s_ncds or totalRootNum <> o_cds + o_ncds")

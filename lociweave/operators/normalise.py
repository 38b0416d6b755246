"""Normalised and log-ratio statistics over spectra (mutType, mutNum, totalRootNum)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import bases as B

EPS = 1e-12


def _over(keys: Sequence[str]):
    # a spectrum holds 96 (or 78) rows per key, so these windows are small by construction
    return Window.partitionBy(*keys)


def rate(num="mutNum", total="totalRootNum") -> Column:
    return F.col(num) / F.nullif(F.col(total).cast("double"), F.lit(0.0))


def normalised(spectrum: DataFrame) -> DataFrame:
    """Adds `percentage` = 100 * mutNum / totalRootNum, null without originals."""
    return spectrum.withColumn("percentage", 100 * rate())


def log_ratio_mean(spectrum: DataFrame, keys: Sequence[str]) -> DataFrame:
    """log2 of the rate over the mean rate of the key; null rates are left out of the mean."""
    mean = F.avg("obs").over(_over(keys))
    return spectrum.withColumn("obs", rate()).withColumn("log_ratio", _log2(F.col("obs") / F.nullif(mean, F.lit(0.0))))


def _log2(c: Column) -> Column:
    return F.when(c > 0, F.log2(c)).when(c == 0, F.lit(float("-inf")))


def log_ratio_null(annotated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """log2 of the rate over the global null rate, for all and for non-coding counts.

    The null divides all substitutions by the sum of the distinct (oriType, total)
    pairs. Input: mutType, oriType, mutNum, totalRootNum, s_ncds, o_ncds.
    """
    w = _over(keys)
    distinct_sum = lambda total: F.aggregate(
        F.collect_set(F.struct("oriType", total)).over(w), F.lit(0).cast("bigint"), lambda acc, x: acc + x[total])
    null_all = F.sum("mutNum").over(w) / F.nullif(distinct_sum("totalRootNum").cast("double"), F.lit(0.0))
    null_nc = F.sum("s_ncds").over(w) / F.nullif(distinct_sum("o_ncds").cast("double"), F.lit(0.0))
    return annotated.select(
        *keys, "mutType", F.substring("mutType", 3, 3).alias("change"),
        _log2(rate() / F.nullif(null_all, F.lit(0.0))).alias("log_ratio"),
        _log2(rate("s_ncds", "o_ncds") / F.nullif(null_nc, F.lit(0.0))).alias("log_ratio_ncds"))


def log_ratio_bands(ratios: DataFrame, keys: Sequence[str], column: str = "log_ratio_ncds") -> DataFrame:
    """Mean, sample deviation and the +-1, +-2 deviation bands; infinite values give no finite band."""
    finite = F.when(F.abs(F.col(column)) < float("inf"), F.col(column))
    out = ratios.groupBy(*keys).agg(F.avg(finite).alias("mean"), F.stddev_samp(finite).alias("sd"))
    for name, k in (("minus_2sd", -2), ("minus_1sd", -1), ("plus_1sd", 1), ("plus_2sd", 2)):
        out = out.withColumn(name, F.col("mean") + k * F.col("sd"))
    return out


def log_ratio_smooth(spectrum: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Feature for the species map: log2((rate + eps) / max(mean rate, eps)), rate 0 without originals."""
    mean = F.avg("obs").over(_over(keys))
    return spectrum.withColumn("obs", F.coalesce(rate(), F.lit(0.0))).withColumn(
        "feature", F.log2((F.col("obs") + EPS) / F.greatest(mean, F.lit(EPS))))


def change_shares(spectrum: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Shares of C>T, T>C and CpG>TpG in the sum of all rates."""
    part = lambda cond: (F.sum(F.when(cond, rate()).otherwise(0.0)) / F.sum(rate()))
    t = F.col("mutType")
    return spectrum.groupBy(*keys).agg(
        part(t.contains("C>T")).alias("c_to_t"), part(t.contains("T>C")).alias("t_to_c"),
        part(t.contains("C>T]G")).alias("cpg_to_tpg"))


def original_counts(spectrum: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The 32 distinct (context, originals) pairs."""
    return spectrum.select(*keys, B.label_context("mutType").alias("oriType"), "totalRootNum").distinct()


def coding_percentages(annotated: DataFrame) -> DataFrame:
    """Coding and non-coding share of each label's substitutions and originals."""
    pct = lambda part, whole: 100 * F.col(part) / F.nullif(F.col(whole).cast("double"), F.lit(0.0))
    return (annotated.withColumn("s_cds_pct", pct("s_cds", "mutNum")).withColumn("s_ncds_pct", pct("s_ncds", "mutNum"))
            .withColumn("o_cds_pct", pct("o_cds", "totalRootNum")).withColumn("o_ncds_pct", pct("o_ncds", "totalRootNum")))


def ranked(df: DataFrame, keys: Sequence[str], by: str, k: int, tie: str, largest: bool = True) -> DataFrame:
    """First k rows per key by a value (nulls last), ties broken by `tie`; adds `rank`."""
    order = F.col(by).desc_nulls_last() if largest else F.col(by).asc_nulls_last()
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(order, tie))).where(F.col("rank") <= k)


def top_labels(spectrum: DataFrame, keys: Sequence[str], k: int = 10, largest: bool = True) -> DataFrame:
    """Top or bottom labels by normalised percentage, with the display name."""
    return ranked(normalised(spectrum), keys, "percentage", k, "mutType", largest).withColumn(
        "display", B.label_display("mutType"))


def wide_spectra(spectra: DataFrame, keys: Sequence[str], labels: Sequence[str], value: str = "percentage") -> DataFrame:
    """One column per key value, rows by mutType: merge of spectra side by side."""
    key = F.concat_ws("_", *keys)
    return normalised(spectra).withColumn("_key", key).groupBy("mutType").pivot("_key", list(labels)).agg(F.first(value))

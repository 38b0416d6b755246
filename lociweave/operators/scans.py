"""Ordered scans over coordinates that never put a whole chromosome into one task.

A running aggregate over (keys, position) is computed inside fixed-width position
buckets; one summary row per bucket then carries the state across buckets. After
rows are pre-aggregated by position a bucket holds at most `width` positions, so
the work of a task is bounded however uneven the chromosomes are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

WIDTH = 1 << 20


def scan(df: DataFrame, keys: Sequence[str], pos: str, order: Sequence[str] | None = None, width: int = WIDTH, *,
         sums: Mapping[str, Column] | None = None, max_before: Mapping[str, Column] | None = None,
         max_through: Mapping[str, Column] | None = None, lags: Mapping[str, Column] | None = None,
         leads: Mapping[str, Column] | None = None, peers: bool = False) -> DataFrame:
    """Add running columns over `keys`, ordered by `pos` and then `order`.

    sums: inclusive running sum; max_before / max_through: running max without / with
    the current row; lags / leads: value of the neighbour row. (pos, order) should be
    unique per key, else ties are in no fixed order. With `peers`, tied rows all get the
    sum through the last of them, as SQL's default frame gives it.
    """
    sums, max_before, max_through = dict(sums or {}), dict(max_before or {}), dict(max_through or {})
    lags, leads = dict(lags or {}), dict(leads or {})
    order = [pos, *(order or [])]
    base = df.withColumn("_bkt", F.floor(F.col(pos) / width))
    bucket = [*keys, "_bkt"]
    rank = F.struct(*order)
    local = Window.partitionBy(*bucket).orderBy(*order)
    through = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = local.rowsBetween(Window.unboundedPreceding, -1)
    summed = local.rangeBetween(Window.unboundedPreceding, Window.currentRow) if peers else through

    local_cols, summary, carry, final = [], [], [], []
    across = Window.partitionBy(*keys).orderBy("_bkt")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    for n, c in sums.items():
        local_cols.append(F.sum(c).over(summed).alias(f"_l_{n}"))
        summary.append(F.sum(c).alias(f"_s_{n}"))
        carry.append(F.sum(f"_s_{n}").over(earlier).alias(f"_c_{n}"))
        final.append((F.col(f"_l_{n}") + F.coalesce(f"_c_{n}", F.lit(0))).alias(n))
    for group, frame in ((max_before, before), (max_through, through)):
        for n, c in group.items():
            local_cols.append(F.max(c).over(frame).alias(f"_l_{n}"))
            summary.append(F.max(c).alias(f"_s_{n}"))
            carry.append(F.max(f"_s_{n}").over(earlier).alias(f"_c_{n}"))
            final.append(F.greatest(f"_l_{n}", f"_c_{n}").alias(n))
    for n, c in lags.items():
        local_cols.append(F.lag(F.struct(c.alias("v"))).over(local).alias(f"_l_{n}"))
        summary.append(F.max_by(F.struct(c.alias("v")), rank).alias(f"_s_{n}"))
        carry.append(F.lag(f"_s_{n}").over(across).alias(f"_c_{n}"))
        final.append(F.coalesce(f"_l_{n}", f"_c_{n}")["v"].alias(n))
    for n, c in leads.items():
        local_cols.append(F.lead(F.struct(c.alias("v"))).over(local).alias(f"_l_{n}"))
        summary.append(F.min_by(F.struct(c.alias("v")), rank).alias(f"_s_{n}"))
        carry.append(F.lead(f"_s_{n}").over(across).alias(f"_c_{n}"))
        final.append(F.coalesce(f"_l_{n}", f"_c_{n}")["v"].alias(n))

    inside = base.select("*", *local_cols)
    carried = base.groupBy(*bucket).agg(*summary).select(*bucket, *carry)
    return inside.join(carried, bucket).select(*df.columns, *final)


def positions(df: DataFrame, keys: Sequence[str], start: str, *aggs: Column) -> DataFrame:
    """One row per (keys, start): the map-side combined form that scans run on."""
    return df.groupBy(*keys, start).agg(*aggs)

"""Numeric column functions: branch rates, mapping quality, identity."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .bases import _c


def branch_rates(ab, ca, cb) -> dict[str, Column]:
    """Per-branch substitution rates and parsimony odds from three identities (percent).

    ab: between the ingroups; ca, cb: outgroup against each ingroup.
    """
    far = {k: F.lit(100.0) - _c(v) for k, v in (("bc", ab), ("ba", ca), ("ca", cb))}  # percent that differ, by pair of leaves

    def branch(leaf: str) -> Column:
        """Length of a leaf's own branch: half of what its two distances exceed the third by; noise of the arithmetic is zero."""
        own = [v for k, v in far.items() if leaf in k]
        other = [v for k, v in far.items() if leaf not in k]
        return F.round((own[0] + own[1] - other[0]) / 2, 9)

    one, two, root = branch("b"), branch("c"), branch("a")
    changed, kept = (lambda r: r / 3), (lambda r: 100 - r)

    def odds(here: Column, there: Column) -> Column:
        """One change on the branch against one on each of the two others; null where those can't be."""
        both = kept(here) * changed(there) * changed(root)
        return F.when(both != 0, changed(here) * kept(there) * kept(root) / F.nullif(both, F.lit(0.0)))

    return {"rate_a": one, "rate_b": two, "rate_c": root, "odds_a": odds(one, two), "odds_b": odds(two, one)}


def mapq(p) -> Column:
    """Phred mapping quality of an error probability: clamp at 254, 255 when missing."""
    p = _c(p).cast("double")
    phred = F.bround(-10 * F.log10(F.when(p > 0, p)), 0)
    return (
        F.when(p.isNull() | F.isnan(p), F.lit(255))
        .when((p < 0) | (p > 1), F.raise_error(F.concat(F.lit("bad probability: "), p.cast("string"))).cast("int"))
        .when(p == 0, F.lit(254))
        .otherwise(F.least(F.lit(254), phred.cast("int")))
    )

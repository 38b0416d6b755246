"""Coordinate functions. Intervals are 0-based, half open, on the row's own strand."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .bases import _c


def to_plus(start, end, strand, length) -> tuple[Column, Column]:
    """Forward-strand (start, end) of an interval given on `strand`."""
    s, e, st, n = _c(start), _c(end), _c(strand), _c(length)
    return F.when(st == "-", n - e).otherwise(s), F.when(st == "-", n - s).otherwise(e)


def _ends(a1, b1, a2, b2) -> dict[str, Column]:
    """How the ends of two intervals lie: crossing (they share positions), nested, twins, sharing an end, meeting, apart."""
    a1, b1, a2, b2 = _c(a1), _c(b1), _c(a2), _c(b2)
    return {
        "crossing": (a1 < b2) & (a2 < b1),
        "nested": ((a1 <= a2) & (b2 <= b1)) | ((a2 <= a1) & (b1 <= b2)),
        "twins": (a1 == a2) & (b1 == b2),
        "one_end": (a1 == a2) | (b1 == b2),
        "meeting": (b1 == a2) | (b2 == a1),
        "apart": (b1 < a2) | (b2 < a1),
    }


def interval_relation(chr1, a1, b1, chr2, a2, b2) -> Column:
    """none, touch, equal, include or overlap, for intervals that aren't empty."""
    e = _ends(a1, b1, a2, b2)
    return (
        F.when(_c(chr1) != _c(chr2), F.lit("none"))
        .when(e["crossing"] & e["twins"], F.lit("equal"))
        .when(e["crossing"] & e["nested"], F.lit("include"))
        .when(e["crossing"], F.lit("overlap"))
        .when(e["meeting"], F.lit("touch"))
        .otherwise(F.lit("none"))
    )


def interval_predicates(chr1, a1, b1, chr2, a2, b2) -> dict[str, Column]:
    """The five tests on their own; they are not exclusive.

    `equal` holds as soon as one end agrees, `include` also for twins, and `overlap` (never one inside the
    other) includes a touch.
    """
    e = _ends(a1, b1, a2, b2)
    same_chr = _c(chr1) == _c(chr2)
    return {
        "none": ~same_chr | e["apart"],
        "touch": same_chr & e["meeting"],
        "equal": same_chr & e["crossing"] & e["one_end"],
        "include": same_chr & e["crossing"] & e["nested"],
        "overlap": same_chr & ((e["crossing"] & ~e["nested"]) | e["meeting"]),
    }


def natural_key(name) -> Column:
    """Sort key that puts chr2 before chr10: digit groups padded to one width."""
    padded = F.regexp_replace(_c(name), r"(\d+)", "00000000000000000000$1")
    return F.regexp_replace(padded, r"0*(\d{20})(?!\d)", "$1")


def prefix_chr(name, prefix: str) -> Column:
    return F.concat(F.lit(prefix), _c(name))


def strip_chr(name, prefix: str) -> Column:
    return F.regexp_replace(_c(name), "^" + prefix, "")

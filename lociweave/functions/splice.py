"""Column functions on spliced reads: strands, junction coordinates, signals.

A placed alignment is a struct with chr, g_start, g_end, strand, r_start, r_end, r_len
(read coordinates on the alignment's own strand), don and acc.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .bases import _c

CANONICAL = (("GT", "AG"), ("CT", "AC"))
MAJOR_DONORS = ("GT", "GA", "GC", "GG")

# Repeat classes that are not transposable elements.
NOT_TRANSPOSABLE = (
    "Acromeric", "Artifact", "Centromeric", "Low_complexity", "Macro", "Normally_Non-integrating_Virus", "Other",
    "Segmental_Duplication", "Simple_repeat", "Subtelomeric", "Unknown", "W-chromosomal", "Y-chromosomal", "rRNA",
    "scRNA", "snRNA", "tRNA",
)


def _has(c: Column) -> Column:
    return F.coalesce(F.length(c) > 0, F.lit(False))


def read_strand(first, last) -> Column:
    """Transcript strand from the signals of the first and last alignment (structs with don, acc); null if undecided."""
    f, l = _c(first), _c(last)
    opens = lambda x: _has(x["don"]) & ~_has(x["acc"])
    closes = lambda x: ~_has(x["don"]) & _has(x["acc"])
    return F.when(opens(f) | closes(l), F.lit("+")).when(opens(l) | closes(f), F.lit("-"))


def on_strand(aln, strand) -> tuple[Column, Column]:
    """(start, end) of an alignment in the coordinates of the given read strand."""
    a, s = _c(aln), _c(strand)
    same = a["strand"] == s
    return (F.when(same, a["r_start"]).otherwise(a["r_len"] - a["r_end"]),
            F.when(same, a["r_end"]).otherwise(a["r_len"] - a["r_start"]))


def is_exact_split(strand, aln1, aln2) -> Column:
    """The second alignment starts on the read exactly where the first ends."""
    return on_strand(aln2, strand)[0] == on_strand(aln1, strand)[1]


def intron_coords(strand, aln1, aln2) -> tuple[Column, Column]:
    """(start, end) structs chr, pos, strand of the intron between donor-side aln1 and acceptor-side aln2."""
    a, b, s = _c(aln1), _c(aln2), _c(strand)
    place = lambda x, pos, st: F.struct(x["chr"].alias("chr"), x[pos].alias("pos"), F.lit(st).alias("strand"))
    start = F.when(a["strand"] == s, place(a, "g_end", "+")).otherwise(place(a, "g_start", "-"))
    end = F.when(b["strand"] == s, place(b, "g_start", "+")).otherwise(place(b, "g_end", "-"))
    return start, end


def intron_key(start, end) -> Column:
    s, e = _c(start), _c(end)
    return F.concat_ws("_", s["chr"], s["pos"].cast("string"), s["strand"], e["chr"], e["pos"].cast("string"), e["strand"])


def is_trans(start, end) -> Column:
    s, e = _c(start), _c(end)
    return (s["chr"] != e["chr"]) | (s["strand"] != e["strand"])


def is_canonical(don, acc) -> Column:
    """GT-AG or CT-AC, in either case."""
    d, a = F.upper(_c(don)), F.upper(_c(acc))
    test = F.lit(False)
    for x, y in CANONICAL:
        test = test | ((d == x) & (a == y))
    return F.coalesce(test, F.lit(False))


def is_major_signal(don, acc) -> Column:
    return F.coalesce(F.upper(_c(don)).isin(*MAJOR_DONORS) & (F.upper(_c(acc)) == "AG"), F.lit(False))


def is_transposable(repeat_class) -> Column:
    return ~_c(repeat_class).isin(*NOT_TRANSPOSABLE)

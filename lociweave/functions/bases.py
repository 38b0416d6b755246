"""Column functions on bases, trinucleotides and dinucleotides.

All inputs are upper-case string columns. Everything here is a built-in
expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PYRIMIDINES = ("C", "T")

# Dinucleotides that are read on the opposite strand, and the
# substitutions of the four self-complementary ones that are.
FLIPPED_DOUBLETS = ("AA", "AG", "CA", "GA", "GG", "GT")
FLIPPED_PALINDROME_CHANGES = ("AT>GG", "AT>TC", "AT>TG", "CG>AA", "CG>AC", "CG>GA",
                              "GC>CT", "GC>TG", "GC>TT", "TA>AC", "TA>AG", "TA>CC")


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def base_at(seq, i: int) -> Column:
    """1-based base of a short string."""
    return F.substring(_c(seq), i, 1)


def complement(seq) -> Column:
    return F.translate(_c(seq), "ACGT", "TGCA")


def revcomp(seq) -> Column:
    return F.reverse(complement(seq))


def is_acgt(seq) -> Column:
    """True when a non-empty string holds only the four bases (no gap, no N)."""
    return _c(seq).rlike("^[ACGT]+$")


def on_pyrimidine_strand(tri) -> Column:
    return base_at(tri, 2).isin(*PYRIMIDINES)


def canon_tri(tri) -> Column:
    """Trinucleotide written on the strand where its middle base is C or T."""
    t = _c(tri)
    return F.when(on_pyrimidine_strand(t), t).otherwise(revcomp(t))


def canon_alt(tri, alt) -> Column:
    """The changed middle base on the strand that `canon_tri` picks."""
    return F.when(on_pyrimidine_strand(tri), _c(alt)).otherwise(complement(alt))


def tri_label(ori, alt) -> Column:
    """`x[y>alt]z` for an already canonical context."""
    o = _c(ori)
    return F.concat(base_at(o, 1), F.lit("["), base_at(o, 2), F.lit(">"), _c(alt), F.lit("]"), base_at(o, 3))


def sbst_label(tri, alt) -> Column:
    """Strand-folded substitution label of a raw context and its new middle base."""
    return tri_label(canon_tri(tri), canon_alt(tri, alt))


def canon_doublet(di) -> Column:
    d = _c(di)
    return F.when(d.isin(*FLIPPED_DOUBLETS), revcomp(d)).otherwise(d)


def di_label(ori, mut) -> Column:
    """Strand-folded `XY>ZW`, one of 78 classes when both bases differ."""
    o, m = _c(ori), _c(mut)
    raw = F.concat(o, F.lit(">"), m)
    flipped = F.concat(revcomp(o), F.lit(">"), revcomp(m))
    return F.when(o.isin(*FLIPPED_DOUBLETS) | raw.isin(*FLIPPED_PALINDROME_CHANGES), flipped).otherwise(raw)


def both_bases_differ(ori, mut) -> Column:
    return (base_at(ori, 1) != base_at(mut, 1)) & (base_at(ori, 2) != base_at(mut, 2))


def flanks_equal(*windows) -> Column:
    """First and last base agree over all windows (any width)."""
    head, *rest = [_c(w) for w in windows]
    cond = F.lit(True)
    for w in rest:
        cond = cond & (F.left(head, F.lit(1)) == F.left(w, F.lit(1))) & (F.right(head, F.lit(1)) == F.right(w, F.lit(1)))
    return cond


def low_error(plines, start, width: int = 3, lowest: str = "5") -> Column:
    """Every p-line character over the window is at or above `lowest` (error <= 0.01).

    `start` is the 1-based first column.
    """
    pattern = f"^[{lowest}-~]{{{width}}}$"
    return F.forall(_c(plines), lambda p: F.substring(p, _c(start), F.lit(width)).rlike(pattern))


def site_class(a, b, c) -> Column:
    """Parsimony class of the middle bases of outgroup a and ingroups b, c."""
    a, b, c = _c(a), _c(b), _c(c)
    return (
        F.when((a == b) & (a == c), F.lit("none"))
        .when((a == c) & (a != b), F.lit("B"))
        .when((a == b) & (a != c), F.lit("C"))
        .when(b == c, F.lit("outgroup"))
        .otherwise(F.lit("triple"))
    )


def majority_label(tri_a, tri_b, tri_c) -> Column:
    """`majority>minority` label of a site changed in B or in C, null for other classes."""
    mids = [base_at(t, 2) for t in (tri_a, tri_b, tri_c)]
    cls = site_class(*mids)
    return F.when(cls == "B", sbst_label(tri_a, mids[1])).when(cls == "C", sbst_label(tri_a, mids[2]))


def label_context(label) -> Column:
    """`x[y>w]z` -> `xyz`."""
    l = _c(label)
    return F.concat(F.substring(l, 1, 1), F.substring(l, 3, 1), F.substring(l, 7, 1))


def label_display(label) -> Column:
    """`x[y>w]z` -> `xyz → xwz`; anything shorter is kept."""
    l = _c(label)
    shown = F.concat(label_context(l), F.lit(" → "), F.substring(l, 1, 1), F.substring(l, 5, 1), F.substring(l, 7, 1))
    return F.when(F.length(l) >= 7, shown).otherwise(l)


def change_type(ref, qry) -> Column:
    """no_mutation, transition, transversion, insertion, deletion or exception."""
    r, q = _c(ref), _c(qry)
    bases = ("A", "C", "G", "T")
    purines = ("A", "G")
    return (
        F.when(r.isin(*bases) & (r == q), F.lit("no_mutation"))
        .when(r.isin(*bases) & q.isin(*bases),
              F.when(r.isin(*purines) == q.isin(*purines), F.lit("transition")).otherwise(F.lit("transversion")))
        .when(r.isin(*bases) & (q == "-"), F.lit("deletion"))
        .when((r == "-") & q.isin(*bases), F.lit("insertion"))
        .otherwise(F.lit("exception"))
    )


def change_category(ref, qry) -> Column:
    """Strand-folded category `XtoY/X'toY'` with the pyrimidine form first.

    Insertions are folded on the inserted base, with the A and C forms first.
    """
    r, q = _c(ref), _c(qry)
    fwd = F.concat(r, F.lit("to"), q)
    rev = F.concat(complement(r), F.lit("to"), complement(q))
    leads = F.when(r == "-", q.isin("A", "C")).otherwise(r.isin(*PYRIMIDINES))
    return F.when(change_type(r, q) == "exception", F.lit("exception")).when(
        leads, F.concat(fwd, F.lit("/"), rev)).otherwise(F.concat(rev, F.lit("/"), fwd))

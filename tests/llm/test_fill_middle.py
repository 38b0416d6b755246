"""Cuts by rank, against plain slicing; forms, edge rows and the way back."""

import hashlib
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from lociweave.llm import fill_middle as fim

UNITS = [fim.CODE_POINT, fim.WORD, r"[^\n]*\n?"]


def starts(text, unit):
    at = [m.start() for m in re.finditer(unit, text)]
    return [0, *at[1:]] if at else []


@given(st.text(alphabet="ab \nß日\U0001f600", max_size=400), st.sampled_from(UNITS))
@settings(max_examples=150, deadline=None)
def test_places_of_all_ranks(text, unit):
    lanes, want = fim.SkipList(text, unit), starts(text, unit)
    assert lanes.n == len(want)
    assert [lanes.place(r) for r in range(len(want) + 1)] == [*want, len(text)]


@pytest.mark.parametrize("unit", UNITS)
def test_lanes_thin_out(unit):
    text = "ab ß\n日 " * 60000
    lanes, want = fim.SkipList(text, unit), starts(text, unit)
    sizes = [len(x.units) for x in lanes.lanes]
    assert sizes[0] < len(want) / 8 and all(b < a / 4 or b < 30 for a, b in zip(sizes, sizes[1:]))
    for lane in lanes.lanes:
        assert lane.units.sum() == len(want) and lane.points.sum() == len(text)
    for r in range(0, len(want), 997):
        assert lanes.place(r) == want[r]


def plain(text, i):
    """The rules read literally, over code points."""
    x = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(x[k:k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(text)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if text == "" or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return ("spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else ("psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_documents(spark):
    rows = [(i, f"text {i} <é> 日本 \U0001f600\x00\n" * (i % 7)) for i in range(300)]
    rows += [(None, "no id"), (None, None), (-5, "minus"), (7, None), (8, "has <P> in it"), (9, "<S"), (9, "<S"), (10, "<"), (11, "x" * 400000), (12, "<M>")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("n", "form", "output", "restored", "_id", "_text"):
        docs = docs.withColumn(name, F.lit("x"))
    got = fim.transform(docs, keep=("doc_id",)).collect()
    want = sorted(((i, t or "", len(t or ""), *plain(t or "", i)) for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.restored, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == want
    assert {r.form for r in got} == {"plain", "psm", "spm"}
    assert fim.transform(docs.where("false")).count() == 0


def test_words_stay_whole(spark):
    docs = spark.createDataFrame([(i, "alpha beta  gamma\ndelta " * 20) for i in range(40)], "doc_id long, text string")
    for r in fim.transform(docs, unit=fim.WORD, rate=100, suffix_first=50).collect():
        assert r.n == 80 and r.restored == "alpha beta  gamma\ndelta " * 20
        for part in re.split("<[PSM]>", r.output):
            assert not part or part[0] in "abgd"


def test_marks_across_a_cut():
    for text in ("a<", "<S", "x<P<S<M", "<<<", ">P>S>M>"):
        for i in range(200):
            c = fim.cut(text, i, rate=100)
            assert fim.restore(c.output, c.form) == text

"""Personal data in texts: fixed patterns, and a semi-Markov conditional random field for spans that those miss.

Base spans come from patterns for e-mail and IP addresses, card and phone numbers. The random field works on stretches around
digits, at signs and their spelt-out forms. Every candidate segment of up to LONGEST tokens is scored as a whole
(digit groups, check digit, number ranges, address parts, separators, what stands next to it), together with the kinds of
neighbouring segments; a dynamic programme over segment ends chooses boundaries and kinds jointly. A chosen segment
that meets no base span is added, so that spelt-out addresses and numbers in other layouts are found too.

The field is fitted on the driver by maximum likelihood, on stretches of SAMPLE documents at most: their base spans are its
examples, as they stand and rewritten (at and dot spelt out, other number layouts), and with broken check digits or ranges as
counter-examples. Defined results: null and empty texts have no spans; offsets count code points, ends exclusive; without any
base span in the sample nothing is added to the base; repeated ids are rows of their own; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import AT_ONCE, extended, map_batches, text_of
from .samples import draw, texts_of

KINDS = ("email", "ip", "card", "phone")
#: Documents that the field is fitted on, and stretches of them, at most.
SAMPLE, STRETCHES = 6000, 240
LONGEST = 24
EPOCHS = 12
_LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _in_range(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, found from their at signs so that long runs of letters take linear time."""
    free = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            free = m.end()
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[Span]:
    """Pattern matches by kind, then start."""
    out: list[Span] = [("email", *x) for x in emails(text)]
    out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_in_range, m[0].split(".")))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = re.sub(r"[\x20-]", "", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


# ---------------------------------------------------------------- segments and their features

_TOKEN = re.compile(r"[^\W\d_]+|\d+|_|[^\w\s]")
_CUE = re.compile(r"[0-9@]|[\[({<]\s*(?:at|dot)\s*[\])}>]|\b(?:at|AT)\b(?=\s+\S+\s+(?:dot|DOT)\b)")
_AT = re.compile(r"\s*(?:@|[\[({<]\s*at\s*[\])}>]|\sat\s)\s*", re.I)
_DOT = re.compile(r"\s*(?:\.|[\[({<]\s*dot\s*[\])}>]|\sdot\s)\s*", re.I)
_ADDRESS = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_NUMERIC = re.compile(r"[0-9\s().+/-]+")

FEATURES = (
    "bias", "address", "plain at", "spelt at", "inner space", "four parts in range", "parts out of range", "check digit", "no check digit",
    "13 to 19 digits", "9 to 15 digits", "7 or 8 digits", "few digits", "many digits", "plus", "brackets", "3-3-4 groups", "groups of four",
    "one run", "dots only", "odd separators", "glued before", "glued after", "number before", "number after", "tokens")
_AT_PLACE = {name: k for k, name in enumerate(FEATURES)}


@dataclass
class Stretch:
    """Part of a text around cues, as tokens; offsets are those of the whole text."""

    text: str
    tokens: list[tuple[int, int]]
    segments: list[tuple[int, int, int]]  # first token, end token, kind
    values: np.ndarray                     # a row of features for each segment


def _features(text: str, tokens: list[tuple[int, int]], i: int, j: int, kind: int) -> np.ndarray | None:
    """Features of the whole span of tokens i to j as a kind; None where it can't be one."""
    start, end = tokens[i][0], tokens[j - 1][1]
    s = text[start:end]
    f = np.zeros(len(FEATURES))
    put = lambda name, on=1.0: f.__setitem__(_AT_PLACE[name], on)
    put("bias")
    put("tokens", (j - i) / LONGEST)
    put("inner space", float(any(c.isspace() for c in s)))
    before, after = text[start - 1:start], text[end:end + 1]
    put("glued before", float(before.isalnum() or before in "._-@" and before != ""))
    put("glued after", float(after.isalnum() or after == "@"))
    if kind == 0:
        if not _AT.search(s):
            return None
        plain = _DOT.sub(".", _AT.sub("@", s, count=1))
        if plain.count("@") != 1:
            return None
        put("address", float(bool(_ADDRESS.fullmatch(plain))))
        put("plain at", float("@" in s))
        put("spelt at", float("@" not in s))
        return f
    if not _NUMERIC.fullmatch(s):
        return None
    digits = re.sub(r"\D", "", s)
    n = len(digits)
    if not 4 <= n <= 19:
        return None
    groups = re.findall(r"\d+", s)
    put("number before", float(bool(re.search(r"[0-9][\s.,/+()-]{0,2}$", text[max(0, start - 4):start]))))
    put("number after", float(bool(re.match(r"[\s.,/()-]{0,2}[0-9]", text[end:end + 4]))))
    four = len(groups) == 4 and re.fullmatch(r"\d+(?:\s?\.\s?\d+){3}", s) is not None
    put("four parts in range", float(four and all(map(_in_range, groups))))
    put("parts out of range", float(four and not all(map(_in_range, groups))))
    put("check digit", float(13 <= n <= 19 and luhn(digits)))
    put("no check digit", float(13 <= n <= 19 and not luhn(digits)))
    put("13 to 19 digits", float(13 <= n))
    put("9 to 15 digits", float(9 <= n <= 15))
    put("7 or 8 digits", float(7 <= n <= 8))
    put("few digits", float(n < 7))
    put("many digits", float(n > 15))
    put("plus", float(s[0] == "+"))
    put("brackets", float(re.search(r"\(\d{2,4}\)", s) is not None))
    sizes = [len(g) for g in groups]
    put("3-3-4 groups", float(sizes[-3:] == [3, 3, 4]))
    put("groups of four", float(len(sizes) > 2 and set(sizes[:-1]) == {4}))
    put("one run", float(len(sizes) == 1))
    marks = set(re.sub(r"\d", "", s))
    put("dots only", float(marks == {"."}))
    put("odd separators", float("/" in marks or "\n" in marks or re.search(r"[\s.()/-]{3}|\([^)]*$|^[^(]*\)|\+.*\+|.\+", s) is not None))
    return f


def _can_start(kind: int, s: str) -> bool:
    return s[0].isalnum() if kind == 0 else s.isdigit() or kind == 3 and s in "+("


def _can_end(kind: int, s: str) -> bool:
    return s[-1].isalnum() if kind == 0 else s.isdigit()


def _stretch(text: str, lo: int, hi: int) -> Stretch:
    tokens = [m.span() for m in _TOKEN.finditer(text, lo, hi)]
    segments, values = [], []
    for i, (a, b) in enumerate(tokens):
        first = text[a:b]
        for kind in range(len(KINDS)):
            if not _can_start(kind, first):
                continue
            for j in range(i + 1, min(len(tokens), i + LONGEST) + 1):
                last = text[tokens[j - 1][0]:tokens[j - 1][1]]
                if kind and not (last.isdigit() or len(last) == 1 and last in "+().-/"):
                    break
                if _can_end(kind, last) and (f := _features(text, tokens, i, j, kind)) is not None:
                    segments.append((i, j, kind))
                    values.append(f)
    return Stretch(text, tokens, segments, np.array(values).reshape(-1, len(FEATURES)))


def stretches(text: str) -> Iterator[tuple[int, int]]:
    """Where segments may be: around cues, out to the second white space on either side; stretches don't meet."""
    lo = hi = -1
    for m in _CUE.finditer(text):
        if m.start() < hi:
            continue
        a, b = m.start(), m.end()
        for _ in range(3):
            a = max(text.rfind(" ", max(0, a - 80), a), text.rfind("\n", max(0, a - 80), a), max(0, a - 80))
            x, y = text.find(" ", b + 1, b + 80), text.find("\n", b + 1, b + 80)
            b = min([k for k in (x, y) if k >= 0], default=min(len(text), b + 80))
        if lo < 0:
            lo, hi = a, b
        elif a <= hi:
            hi = max(hi, b)
        else:
            yield lo, hi
            lo, hi = a, b
    if lo >= 0:
        yield lo, hi


# ---------------------------------------------------------------- the field

#: Labels are the kinds, and one for a token outside any segment.
OUT = len(KINDS)


@dataclass
class Field:
    """Weights of each kind's features and of one label after another."""

    weights: np.ndarray
    follow: np.ndarray

    def scores(self, s: Stretch) -> np.ndarray:
        if not s.segments:
            return np.zeros(0)
        return np.einsum("sf,sf->s", s.values, self.weights[[k for _, _, k in s.segments]])

    def best(self, s: Stretch) -> list[tuple[int, int, int]]:
        """Segments of the best cutting, by a dynamic programme over ends and labels."""
        n = len(s.tokens)
        score = self.scores(s)
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (_, j, _) in enumerate(s.segments):
            ending[j].append(k)
        top = np.full((n + 1, OUT + 1), -np.inf)
        top[0, OUT] = 0
        back: list[dict[int, tuple[int, int]]] = [{} for _ in range(n + 1)]
        for j in range(1, n + 1):
            came = top[j - 1] + self.follow[:, OUT]
            top[j, OUT] = came.max()
            back[j][OUT] = (-1, int(came.argmax()))
            for k in ending[j]:
                i, _, kind = s.segments[k]
                came = top[i] + self.follow[:, kind]
                value = came.max() + score[k]
                if value > top[j, kind]:
                    top[j, kind] = value
                    back[j][kind] = (k, int(came.argmax()))
        out, j, label = [], n, int(top[n].argmax()) if n else OUT
        while j > 0:
            k, before = back[j][label]
            if k >= 0:
                out.append(s.segments[k])
            j, label = (j - 1 if k < 0 else s.segments[k][0]), before
        return out[::-1]

    def gradient(self, s: Stretch, gold: set[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Of the log likelihood: features and followings of the gold cutting, less their expectations."""
        n, labels = len(s.tokens), OUT + 1
        score = self.scores(s)
        fore, aft = np.full((n + 1, labels), -np.inf), np.full((n + 1, labels), -np.inf)
        fore[0, OUT] = 0
        aft[n] = 0
        ending: list[list[int]] = [[] for _ in range(n + 1)]
        for k, (_, j, _) in enumerate(s.segments):
            ending[j].append(k)
        for j in range(1, n + 1):
            fore[j, OUT] = np.logaddexp.reduce(fore[j - 1] + self.follow[:, OUT])
            for k in ending[j]:
                i, _, kind = s.segments[k]
                fore[j, kind] = np.logaddexp(fore[j, kind], np.logaddexp.reduce(fore[i] + self.follow[:, kind]) + score[k])
        for j in range(n, 0, -1):
            aft[j - 1] = np.logaddexp(aft[j - 1], self.follow[:, OUT] + aft[j, OUT])
            for k in ending[j]:
                i, _, kind = s.segments[k]
                aft[i] = np.logaddexp(aft[i], self.follow[:, kind] + score[k] + aft[j, kind])
        whole = np.logaddexp.reduce(fore[n])
        dw, df = np.zeros_like(self.weights), np.zeros_like(self.follow)
        for j in range(1, n + 1):
            df[:, OUT] -= np.exp(fore[j - 1] + self.follow[:, OUT] + aft[j, OUT] - whole)
            for k in ending[j]:
                i, _, kind = s.segments[k]
                p = np.exp(fore[i] + self.follow[:, kind] + score[k] + aft[j, kind] - whole)
                df[:, kind] -= p
                dw[kind] -= p.sum() * s.values[k]
        at, label = 0, OUT
        starts = {i: (j, kind) for i, j, kind in gold}
        rows = {seg: k for k, seg in enumerate(s.segments)}
        while at < n:
            j, kind = starts.get(at, (at + 1, OUT))
            df[label, kind] += 1
            if kind != OUT:
                dw[kind] += s.values[rows[at, j, kind]]
            at, label = j, kind
        return dw, df


def fit(examples: list[tuple[Stretch, set[tuple[int, int, int]]]], epochs: int = EPOCHS) -> Field:
    """Adaptive gradient ascent on the log likelihood with a ridge."""
    field = Field(np.zeros((len(KINDS), len(FEATURES))), np.zeros((OUT + 1, OUT + 1)))
    params = [field.weights, field.follow]
    sums = [np.full_like(p, 1e-2) for p in params]
    order = random.Random(5)
    rows = list(examples)
    for _ in range(epochs):
        order.shuffle(rows)
        for s, gold in rows:
            for p, g, total in zip(params, field.gradient(s, gold), sums):
                g -= 1e-3 * p
                total += g * g
                p += 0.3 * g / np.sqrt(total)
    return field


def _rewritten(kind: str, s: str, rng: random.Random) -> tuple[str, bool] | None:
    """A span in another form, and whether it is still one of its kind."""
    digits = re.sub(r"\D", "", s)
    if kind == "email":
        at, dot = rng.choice([(" [at] ", " [dot] "), (" (at) ", " (dot) "), ("(at)", "."), (" at ", " dot "), ("[at]", "[dot]")])
        local, _, domain = s.partition("@")
        return local + at + domain.replace(".", dot), True
    if kind == "ip":
        if rng.random() < 0.6:
            parts = s.split(".")
            parts[rng.randrange(4)] = str(rng.randint(256, 999))
            return ".".join(parts), False
        return s.replace(".", " . "), True
    if kind == "card":
        form = rng.random()
        if form < 0.4:
            return digits[:-1] + str((int(digits[-1]) + rng.randint(1, 9)) % 10), False
        sep = rng.choice([" ", "-", "."])
        return sep.join(digits[k:k + 4] for k in range(0, len(digits), 4)), True
    last = digits[-10:]
    if len(last) < 10:
        return None
    if rng.random() < 0.3:
        return last[3:6] + "-" + last[6:], False
    return rng.choice(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "1-{}-{}-{}", "({}){}-{}"]).format(last[:3], last[3:6], last[6:]), True


def _example(text: str, lo: int, hi: int, spans: list[Span]) -> tuple[Stretch, set[tuple[int, int, int]]] | None:
    s = _stretch(text, lo, hi)
    place = {(s.tokens[i][0], s.tokens[j - 1][1], k): (i, j, k) for i, j, k in s.segments}
    gold: set[tuple[int, int, int]] = set()
    for kind, a, b in spans:
        if a >= lo and b <= hi:
            seg = place.get((a, b, KINDS.index(kind)))
            if seg is None or any(seg[0] < y and x < seg[1] for x, y, _ in gold):
                return None
            gold.add(seg)
    return s, gold


def examples_of(texts: list[str], most: int = STRETCHES) -> list[tuple[Stretch, set[tuple[int, int, int]]]]:
    """Stretches with their base spans, each followed by rewritten ones; a share of every kind and of stretches without spans."""
    rng = random.Random(3)
    out, used = [], dict.fromkeys((*KINDS, "none"), 0)
    for text in texts:
        spans = base_spans(text)
        for lo, hi in stretches(text):
            own = [x for x in spans if x[1] < hi and x[2] > lo]
            kind = min((k for k, _, _ in own), key=used.get, default="none")
            if used[kind] >= most // len(used):
                continue
            used[kind] += 1
            part = text[lo:hi]
            moved = [(k, a - lo, b - lo) for k, a, b in own]
            if (e := _example(part, 0, len(part), moved)) is not None:
                out.append(e)
            if len(own) == 1:
                k, a, b = moved[0]
                for _ in range(2):
                    new = _rewritten(k, part[a:b], rng)
                    if new is not None:
                        made = part[:a] + new[0] + part[b:]
                        if (e := _example(made, 0, len(made), [(k, a, a + len(new[0]))] if new[1] else [])) is not None:
                            out.append(e)
    return out


def train(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """Fits on the stretches of `sample` documents at most; only texts with a cue come to the driver."""
    ids = draw(docs.select("doc_id").where("doc_id is not null"), sample).distinct()
    # bounded by `sample`, and to the stretches' surroundings
    rows = texts_of(docs, ids).where(F.col("text").rlike("[0-9@]"))

    def make():
        def step(batch):
            parts = [t[max(0, lo - 2):hi + 2] for t in batch.column("text").to_pylist() for lo, hi in stretches(t)]
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string())], ["part"])
        return step

    parts = sorted(r["part"] for r in map_batches(rows.select("text"), make, "part string").orderBy(F.xxhash64("part")).limit(20 * STRETCHES).collect())
    random.Random(9).shuffle(parts)
    examples = examples_of(parts)
    return fit(examples) if any(gold for _, gold in examples) else None


def all_spans(text: str, base: list[Span], field: Field | None) -> list[Span]:
    """Base spans and what the field adds to them, by kind, then start."""
    out = list(base)
    if field is not None:
        for lo, hi in stretches(text):
            s = _stretch(text, lo, hi)
            if s.segments:
                for i, j, kind in field.best(s):
                    a, b = s.tokens[i][0], s.tokens[j - 1][1]
                    if all(b <= x or y <= a for _, x, y in base):
                        out.append((KINDS[kind], a, b))
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1], x[2]))


SPANS = "array<struct<kind: string, start: int, end: int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def find(docs: DataFrame, field: Field | None, keep: tuple[str, ...] = ("doc_id",), masked: bool = False) -> DataFrame:
    """Columns `keep`, base and spans (arrays of kind, start, end) of every whole text; with `masked`, also the text with a mark for each span."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def make():
        f = shared.value

        def step(batch):
            base, spans, clean = [], [], []
            for t in batch.column("_text").to_pylist():
                b = base_spans(t)
                a = all_spans(t, b, f)
                base.append([dict(zip(("kind", "start", "end"), x)) for x in b])
                spans.append([dict(zip(("kind", "start", "end"), x)) for x in a])
                if masked:
                    clean.append(mask(t, a))
            cols = [*(batch.column(c) for c in keep), pa.array(base, _SPAN_TYPE), pa.array(spans, _SPAN_TYPE)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(clean, pa.string())] if masked else cols, [*keep, "base", "spans", *["masked"] * masked])
        return step

    rows = docs.select(*keep, text_of().alias("_text"))
    return map_batches(rows, make, extended(docs, keep, f"base {SPANS}, spans {SPANS}{', masked string' * masked}"), AT_ONCE)


def mask(text: str, spans: list[Span]) -> str:
    """The text with <KIND> for each span; of overlapping spans the union gets the first one's mark."""
    out, at, last = [], 0, -1
    for kind, a, b in sorted(spans, key=lambda x: (x[1], -x[2])):
        if a >= last:
            out += [text[at:a], f"<{kind.upper()}>"]
            at = last = b
        elif b > last:
            at = last = b
    return "".join([*out, text[at:]])

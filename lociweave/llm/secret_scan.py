"""Secrets in texts: fixed patterns, and tokens that look drawn at random.

A token is a run of at least SHORTEST letters, digits and + / _ - signs. Its encoding is the smallest alphabet that holds it. Four tests ask whether its
symbols were drawn uniformly and independently: chi-squared over the alphabet, chi-squared over the bit places of the bytes that
they stand for, runs above and below the alphabet's middle, and correlation of neighbouring symbols. Fisher's sum of their p-values is the token's energy; random keys have a low one.

How low is low enough depends on encoding and length: a short identifier often looks random by chance. So every document also makes
decoys, its own words written as programmers write them (joined, with capitals, with numbers, as paths) and encoded (base 16, 32, 64).
They go through the same inference and tests. In each stratum of encoding and length, the share of decoys at most as high is a token's p-value, and
the Benjamini-Hochberg step over all tokens of the collection sets the threshold: at most LEVEL of the spans it adds are expected to be ordinary text.
The tables behind it have a fixed size (encoding x length x energy); their counts cover all documents.

Defined results: a null text is empty. Rows of digits alone aren't tokens. A token inside a span of a pattern adds nothing. Repeated rows count
as often as they occur. Other columns only pass through `keep`. An empty table has no thresholds.
"""

from __future__ import annotations

import base64
import math
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import extended, map_batches, text_of

Span = tuple[str, int, int]

# ---- fixed patterns ---------------------------------------------------------

KINDS = ("assign", "access", "hex", "random")
_ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
#: Runs are maximal, so a least length inside the pattern finds what a check afterwards would.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def base_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that don't overlap; a match that is too short is dropped with what it covers."""
    out = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    out += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return in_order(out)


# ---- tokens and their encodings ---------------------------------------------

SHORTEST = 16
_TOKEN = re.compile(r"(?<![\w+/=-])[A-Za-z0-9+/_-]{16,}+={0,2}(?![\w+/=-])")
_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Alphabets in the order in which they are tried, each by its symbols' order.
ALPHABETS = {
    "hex": _DIGITS + "abcdef", "upper hex": _DIGITS + "ABCDEF", "base32": _UPPER + "234567", "base36": _DIGITS + _LOWER,
    "upper base36": _DIGITS + _UPPER, "base62": _UPPER + _LOWER + _DIGITS, "base64": _UPPER + _LOWER + _DIGITS + "+/",
    "base64url": _UPPER + _LOWER + _DIGITS + "-_",
}
SIZES = np.array([len(a) for a in ALPHABETS.values()])
#: Bits that a symbol stands for; 0 where symbols aren't groups of bits.
BITS = np.array([4, 4, 5, 0, 0, 6, 6, 6])
_MEMBERS = [frozenset(a) for a in ALPHABETS.values()]
_GROUPED = [_MEMBERS[0] | {"-"}, _MEMBERS[1] | {"-"}]
_ONLY_DIGITS = frozenset(_DIGITS)
_PLACES = np.full((len(ALPHABETS), 128), -1, np.int64)
for _k, _a in enumerate(ALPHABETS.values()):
    _PLACES[_k, [ord(c) for c in _a]] = np.arange(len(_a))


def inferred(token: str) -> tuple[int, str] | None:
    """Encoding and symbols to be tested: hyphens within base 16 and padding don't count, nor do short words set before or after a key."""
    core = token.rstrip("=")
    symbols = set(core)
    if "-" in symbols or "_" in symbols:
        if len(joined := core.replace("-", "")) >= SHORTEST and (symbols <= _GROUPED[0] or symbols <= _GROUPED[1]):
            core = joined
        elif len(longest := max(re.split("[_-]", core), key=len)) >= SHORTEST:
            core = longest
        symbols = set(core)
    if len(core) < SHORTEST or symbols <= _ONLY_DIGITS:
        return None
    for k, members in enumerate(_MEMBERS):
        if symbols <= members:
            return k, core
    return None


def tokens(text: str, base: list[Span]) -> Iterator[tuple[int, int, int, str]]:
    """(start, end, encoding, symbols) of the tokens that no base span covers."""
    for m in _TOKEN.finditer(text):
        if any(a <= m.start() and m.end() <= b for _, a, b in base):
            continue
        if (found := inferred(m[0])) is not None:
            yield m.start(), m.end(), *found


# ---- tests ------------------------------------------------------------------

def _upper_tail(z: np.ndarray) -> np.ndarray:
    return np.array([0.5 * math.erfc(x / math.sqrt(2)) for x in z])


def battery(encodings: list[int], cores: list[str]) -> np.ndarray:
    """(tokens x 4) p-values: uniform symbols, uniform bits, runs, serial correlation. Each is low where the symbols don't look random."""
    if not cores:
        return np.ones((0, 4))
    n = np.array([len(c) for c in cores])
    enc = np.array(encodings)
    k = SIZES[enc]
    owner = np.repeat(np.arange(len(cores)), n)
    sym = _PLACES[enc[owner], np.frombuffer("".join(cores).encode("ascii"), np.uint8)]
    first = np.concatenate([[0], np.cumsum(n)])[:-1]

    squares = (np.bincount(owner * 64 + sym, minlength=64 * len(cores)).reshape(-1, 64).astype(np.float64) ** 2).sum(axis=1)
    df = k - 1
    spread = 2 / (9 * df)  # cube root of chi-squared over its degrees of freedom is close to normal
    uniform = _upper_tail((np.cbrt((k * squares / n - n) / df) - (1 - spread)) / np.sqrt(spread))

    width = BITS[enc]
    wide = width[owner]
    bit = ((np.arange(len(sym)) - first[owner]) * wide).astype(np.int32)  # first bit of each symbol
    cells = (owner * 8).astype(np.int32)
    ones = np.zeros(8 * len(cores))
    for b in range(6):
        at = slice(None) if wide.min(initial=0) > b else np.flatnonzero(wide > b)
        set_ = np.flatnonzero((sym[at] >> (wide[at] - 1 - b)) & 1)
        ones += np.bincount((cells[at] + ((bit[at] + b) & 7))[set_], minlength=len(ones))
    all_bits = (n * width)[:, None] + 7 - np.arange(8) >> 3  # bits at each place of a byte
    half = ((ones.reshape(-1, 8) - all_bits / 2) ** 2 / np.maximum(all_bits / 4, 1)).sum(axis=1) / 2
    bits = np.exp(-half) * (1 + half + half ** 2 / 2 + half ** 3 / 6)  # upper tail of chi-squared with 8 degrees of freedom

    high = sym >= k[owner] // 2
    n1 = np.add.reduceat(high, first).astype(np.float64)
    n2 = n - n1
    changes = np.concatenate([[False], (high[1:] != high[:-1]) & (owner[1:] == owner[:-1])])
    runs = 1 + np.add.reduceat(changes, first)
    both = 2 * n1 * n2
    var = np.maximum(both * (both - n) / (n * n * (n - 1.0)), 1e-9)
    turns = np.where(both > 0, 2 * _upper_tail(np.abs(runs - 1 - both / n) / np.sqrt(var)), 2.0 ** (1 - np.minimum(n, 1000)))

    dev = sym - (np.add.reduceat(sym, first) / n)[owner]
    after = np.arange(len(sym)) + 1
    after[first + n - 1] = first  # the last symbol's neighbour is the first
    power = np.add.reduceat(dev * dev, first)
    r = np.add.reduceat(dev * dev[after], first) / np.maximum(power, 1e-9)
    serial = np.where(power > 0, 2 * _upper_tail(np.abs(r + 1 / (n - 1)) * np.sqrt(n)), 0.0)
    return np.column_stack([uniform, bits, turns, serial])


def energies(encodings: list[int], cores: list[str]) -> np.ndarray:
    """Fisher's sum of each token's tests: about 4 for random symbols, higher for others."""
    return -np.log(np.clip(battery(encodings, cores), 1e-300, 1)).sum(axis=1)


# ---- strata, decoys, thresholds ---------------------------------------------

#: Least lengths of the length classes.
LENGTHS = np.array([16, 20, 24, 32, 48, 96])
#: Steps of the energy's grid in a unit, and its last step.
STEPS, LAST = 8, 511
#: Share of ordinary tokens that the added spans of a stratum may hold.
LEVEL = 0.01


def strata(encodings: list[int], cores: list[str]) -> np.ndarray:
    return np.array(encodings, np.int64) * len(LENGTHS) + np.searchsorted(LENGTHS, [len(c) for c in cores], side="right") - 1


def _grid(energy: np.ndarray) -> np.ndarray:
    return np.minimum(np.ceil(energy * STEPS), LAST).astype(np.int64)


_WORD = re.compile("[A-Za-z]+|[0-9]+")


def decoys(text: str, base: list[Span]) -> list[str]:
    """Ordinary names and encoded words for every length class, from the words outside base spans at places that a checksum of the text chooses."""
    words, at = [], 0
    for _, a, b in base:
        words += _WORD.findall(text, at, max(at, a))
        at = max(at, b)
    words += _WORD.findall(text, at)
    if len(words) < 4:
        return []
    upto = list(accumulate(map(len, words)))
    seed, out = zlib.crc32(text.encode("utf-8", "replace")), []
    for c, least in enumerate(LENGTHS.tolist()):
        most = int(LENGTHS[c + 1]) if c + 1 < len(LENGTHS) else 2 * least
        for style in range(9):
            seed = (seed * 1103515245 + 12345) & 0x7FFFFFFF
            n = least + (seed >> 8) % (most - least)
            at = (seed >> 4) % len(words)
            need = (upto[at - 1] if at else 0) + n  # words enough for n symbols, from the front again after the last
            some = words[at:bisect_left(upto, need) + 1] if need <= upto[-1] else [*words[at:], *words[:n]]
            out.append(_STYLES[style](some, n, seed)[:n])
    return out


def _bytes(words: list[str], n: int) -> bytes:
    return " ".join(words)[:n].encode()


#: How ordinary words get into tokens: (words, symbols wanted, a number) -> at least the symbols wanted, where the words suffice.
_STYLES = (
    lambda w, n, k: _bytes(w, n // 2 + 1).hex(),
    lambda w, n, k: _bytes(w, n // 2 + 1).hex().upper(),
    lambda w, n, k: base64.b32encode(_bytes(w, (n // 8 + 1) * 5)).decode(),
    lambda w, n, k: base64.b64encode(_bytes(w, (n // 4 + 1) * 3)).decode(),
    lambda w, n, k: "".join(w).lower(),
    lambda w, n, k: "".join(map(str.capitalize, w)),
    lambda w, n, k: str(10 + (k >> 9) % 90).join(w).upper(),
    lambda w, n, k: "/".join(x.capitalize() if i % 2 else x for i, x in enumerate(w)),
    lambda w, n, k: "".join(x if i % 3 else f"{x.capitalize()}{(k >> i % 16) % 1000}" for i, x in enumerate(w)),
)


def _counted(docs: DataFrame) -> DataFrame:
    """(decoy, stratum, energy, n) over all documents; a task adds up its own first."""
    shape = (2, len(ALPHABETS) * len(LENGTHS), LAST + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape, np.int64)

        def add(which: int, found: list[tuple[int, str]]) -> None:
            if found:
                enc, cores = map(list, zip(*found))
                np.add.at(total[which], (strata(enc, cores), _grid(energies(enc, cores))), 1)

        for batch in batches:
            found, fakes = [], []
            for text in map(str, batch.column("_text")):
                base = base_spans(text)
                found += [x[2:] for x in tokens(text, base)]
                fakes += [x for x in map(inferred, decoys(text, base)) if x is not None]
                if len(found) + len(fakes) > 4000:
                    add(0, found)
                    add(1, fakes)
                    found, fakes = [], []
            add(0, found)
            add(1, fakes)
        at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([*(pa.array(a.astype(np.int32)) for a in at), pa.array(total[at])], ["decoy", "stratum", "energy", "n"])

    rows = docs.select(text_of().alias("_text"))
    return rows.mapInArrow(run, "decoy int, stratum int, energy int, n long").groupBy("decoy", "stratum", "energy").agg(F.sum("n").alias("n"))


def thresholds_of(found: np.ndarray, fakes: np.ndarray, level: float = LEVEL) -> np.ndarray:
    """Highest grid step that passes in each stratum, -1 for none, from the counts (stratum x step) of tokens and decoys.

    A token's p-value is (1 + decoys up to its step) / (1 + decoys). Benjamini and Hochberg: the largest step whose p-value is at most level x tokens up to it / tokens.
    """
    up_to, below = found.cumsum(axis=1), fakes.cumsum(axis=1)
    p = (1 + below) / (1 + below[:, -1:])
    passes = (p * up_to[:, -1:] <= level * up_to) & (found > 0)
    return np.where(passes.any(axis=1), found.shape[1] - 1 - passes[:, ::-1].argmax(axis=1), -1)


def thresholds(docs: DataFrame, level: float = LEVEL) -> np.ndarray:
    """Thresholds of all strata; at most 2 x 48 x 512 counts come to the driver."""
    counts = np.zeros((2, len(ALPHABETS) * len(LENGTHS), LAST + 1), np.int64)
    for r in _counted(docs).collect():
        counts[r["decoy"], r["stratum"], r["energy"]] = r["n"]
    return thresholds_of(counts[0], counts[1], level)


# ---- finding ----------------------------------------------------------------

SPANS = "array<struct<kind: string, start: int, end: int>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def added(text: str, base: list[Span], limits: np.ndarray) -> list[Span]:
    found = list(tokens(text, base))
    if not found:
        return []
    enc, cores = [x[2] for x in found], [x[3] for x in found]
    passed = _grid(energies(enc, cores)) <= limits[strata(enc, cores)]
    return [("random", x[0], x[1]) for x, ok in zip(found, passed) if ok]


def find(docs: DataFrame, limits: np.ndarray, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep`, base and spans (arrays of kind, start, end in code points, by start) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(limits)

    def make():
        def step(batch):
            base, spans = [], []
            for text in map(str, batch.column("_text")):
                b = base_spans(text)
                base.append([dict(zip(("kind", "start", "end"), x)) for x in b])
                spans.append([dict(zip(("kind", "start", "end"), x)) for x in in_order(b + added(text, b, shared.value))])
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(base, _SPAN_TYPE), pa.array(spans, _SPAN_TYPE)], [*keep, "base", "spans"])
        return step

    return map_batches(docs.select(*keep, text_of().alias("_text")), make, extended(docs, keep, f"base {SPANS}, spans {SPANS}"))

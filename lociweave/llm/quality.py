"""Quality scores from a factorisation machine over hashed words, structure statistics and metadata.

Every text is one sparse row: its words hashed into WORDS columns (damped counts, unit length), and a column for
each statistic of its structure and of its make-up (lengths, cases, symbols, repeats, lines). The score is
    w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j
and the pair term is computed in linear time as half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2, factor by factor.

The model is fitted with numpy on the driver, on SAMPLE labelled rows of either class at most; everything is scored on the
executors. Defined results: a null or empty text has no words and zero statistics, and gets the score of that row;
with no label to learn from (no table rows, or all held out) every score is 0.5; with one class only, scores lean to
that class. Labels, lang, source and doc_id are no inputs. Repeated ids are scored row by row.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import extended, held_out, map_batches, text_of
from .samples import Rows, draw, labelled, sigmoid, texts_of

#: Labelled rows of each class that the model is fitted on, at most.
SAMPLE = 4000
#: Columns of hashed words, a power of two.
WORDS = 1 << 13
FACTORS = 8
EPOCHS = 12
#: Words whose columns a task remembers, about 20 MB; most words of a large collection are seen once.
REMEMBERED = 100_000
#: Of the bytes: upper case, lower case, digits, other printable ASCII, space, line end, parts of other characters.
_KIND = np.select(
    [(np.arange(256) >= lo) & (np.arange(256) <= hi) for lo, hi in ((65, 90), (97, 122), (48, 57), (10, 10), (32, 32), (128, 255), (33, 126))],
    [0, 1, 2, 5, 4, 6, 3], 7)
STATISTICS = 22


def statistics(text: str, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Structure of a text as numbers of about unit size; zeros for an empty one."""
    out = np.zeros(STATISTICS, np.float32)
    n = len(words)
    if not n:
        return out
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    upper, lower, digits, marks, space, line_ends, other, _ = np.bincount(_KIND[raw], minlength=8) / len(raw)
    letters = max(upper + lower, 1e-9)
    size = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in text.split("\n") if x]
    ends = sum(x[-1] in ".!?:;\"" for x in lines)
    same = sum(map(str.__eq__, words, words[1:]))
    out[:] = (
        np.log1p(len(text)) / 10, np.log1p(n) / 8, size.mean() / 10, min(size.std() / 10, 3), size.max() / 100 if size.max() < 300 else 3,
        upper / letters, digits * 5, marks * 5, space * 3, line_ends * 10, other, len(counts) / n, counts.max() / n, same / n,
        np.log1p(len(lines)) / 5, min(n / max(len(lines), 1) / 100, 3), len(set(lines)) / max(len(lines), 1), ends / max(len(lines), 1),
        (size <= 3).mean(), (size == 1).mean(), min(text.count("!") / n, 1), min(text.count("|") / n, 1))
    return out


class Reader:
    """Turns texts into sparse rows; words' columns are kept for the next text."""

    def __init__(self):
        self.column: dict[str, int] = {}

    def row(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        words = text.split()
        known = self.column
        if len(known) > REMEMBERED:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = zlib.crc32(w.lower().encode("utf-8", "replace")) & WORDS - 1
        at, counts = np.unique(np.fromiter(map(known.__getitem__, words), np.int32, len(words)), return_counts=True)
        damped = np.log1p(counts).astype(np.float32)
        damped /= np.sqrt((damped * damped).sum()) or 1
        stats = statistics(text, words, counts)
        used = np.flatnonzero(stats).astype(np.int32)
        return np.concatenate([at, used + WORDS]), np.concatenate([damped, stats[used]])


@dataclass
class Machine:
    """A fitted factorisation machine."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def raw(self, rows: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores before the logistic function, and what their gradient needs."""
        vx = self.factors[rows.index] * rows.value[:, None]
        sums = rows.sums(vx)
        pairs = 0.5 * (sums * sums - rows.sums(vx * vx)).sum(axis=1)
        return self.bias + rows.sums(self.linear[rows.index] * rows.value) + pairs, vx, sums

    def score(self, rows: Rows) -> np.ndarray:
        return sigmoid(self.raw(rows)[0])


def fit(rows: Rows, y: np.ndarray, weight: np.ndarray, seed: int = 7, epochs: int = EPOCHS) -> Machine | None:
    """Adam on the weighted logistic loss with a small ridge; None without rows."""
    if not len(y):
        return None
    rng = np.random.default_rng(seed)
    columns = WORDS + STATISTICS
    m = Machine(0.0, np.zeros(columns), rng.normal(0, 0.05, (columns, FACTORS)))
    params = [np.zeros(1), m.linear, m.factors]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    rate, step, batch = 0.02, 0, 128
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(order), batch):
            which = order[k:k + batch]
            part = rows.take(which)
            z, vx, sums = m.raw(part)
            g = (sigmoid(z) - y[which]) * weight[which] / len(which)
            row = part.row_of_entry()
            ge = g[row] * part.value
            grad_v = ge[:, None] * (sums[row] - vx)
            grads = [np.array([g.sum()]), np.bincount(part.index, ge, columns),
                     np.stack([np.bincount(part.index, grad_v[:, f], columns) for f in range(FACTORS)], axis=1)]
            step += 1
            for p, d, a, b in zip(params, grads, first, second):
                d = d + 1e-5 * p
                a += 0.1 * (d - a)
                b += 0.001 * (d * d - b)
                p -= rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
            m.bias = float(params[0][0])
        rate *= 0.8
    return m


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Machine | None:
    """Fits on whole texts of `sample` rows of each class at most, weighted back to the share of the classes."""
    known = labelled(labels, label)
    share = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}  # two rows at most
    picked = draw(known, sample, F.col("y") == 1).unionByName(draw(known, sample, F.col("y") == 0))

    def make():
        reader = Reader()

        def step(batch):
            rows = [reader.row(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), pa.array([i.tobytes() for i, _ in rows], pa.binary()),
                 pa.array([v.astype(np.float32).tobytes() for _, v in rows], pa.binary())], ["y", "idx", "val"])
        return step

    # bounded by `sample`: a few thousand sparse rows; in a fixed order, so that a repeated task fits the same model
    got = map_batches(texts_of(docs, picked), make, "y int, idx binary, val binary").collect()
    got.sort(key=lambda r: (r["y"], bytes(r["idx"]), bytes(r["val"])))
    y = np.array([r["y"] for r in got], float)
    n = {c: max((y == c).sum(), 1) for c in (0, 1)}
    total = sum(share.values()) or 1
    weight = np.where(y == 1, share.get(1, 0) / n[1], share.get(0, 0) / n[0]) * len(y) / total
    return fit(Rows.collected(got), y, weight)


def score(docs: DataFrame, model: Machine | None, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """Columns `keep` and the score (double, 0 to 1) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WORDS * (FACTORS + 1) numbers

    def make():
        reader, m = Reader(), shared.value

        def step(batch):
            if m is None:
                found = np.full(batch.num_rows, 0.5)
            else:
                texts, found = batch.column("text" if "text" in keep else "_text"), np.zeros(batch.num_rows)
                for k in range(0, len(found), 128):  # factors of few rows at a time
                    rows = [reader.row(t or "") for t in texts.slice(k, 128).to_pylist()]
                    found[k:k + 128] = m.score(Rows(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]),
                                                    np.array([len(i) for i, _ in rows], np.int64)))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, pa.float64())], [*keep, name])
        return step

    rows = docs.select(*keep) if "text" in keep else docs.select(*keep, text_of().alias("_text"))
    return map_batches(rows, make, extended(docs, keep, f"{name} double"))


def scored(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, held_out, score and predicted (1 from 0.5) of every document."""
    return (score(docs, train(docs, labels), keep).withColumn("held_out", held_out(F.col("doc_id")))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))

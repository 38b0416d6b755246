"""Toxicity scores by non-negative positive-unlabelled learning.

Learnt from: documents confirmed toxic, and a draw of all documents whose labels, if any, aren't looked at. With the
share of toxic documents `prior`, the risk of a linear model g with the logistic loss l is
    prior * E_toxic[l(g)] + max(0, E_any[l(-g)] - prior * E_toxic[l(-g)])
Where the bracket would fall below zero, the step goes against it instead, so that the model can't win by calling the
confirmed examples' unlabelled twins clean. The prior is the share of toxic rows among the labels that may be learnt from.

A text is the set of its lower-cased words and of their beginnings of 4 to 7 characters, hashed into COLUMNS columns.
Columns seen in fewer than LEAST confirmed texts of the sample, or not clearly commoner there than in unlabelled
texts, have no weight.

Defined results: a null or empty text has no columns and gets the score of the bias; with no confirmed example
every score is 0; labels that are null count as none. Repeated ids are scored row by row; labels, lang, source
and doc_id are no inputs.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import extended, held_out, map_batches, text_of
from .samples import Rows, draw, labelled, sigmoid, texts_of

#: Confirmed toxic rows and unlabelled rows that the model is fitted on, at most.
CONFIRMED, UNLABELLED = 4000, 12000
COLUMNS = 1 << 18
LEAST = 3
#: Standard deviations by which a column is commoner in confirmed texts than in unlabelled ones.
ABOVE = 5
THRESHOLD = 0.7
STEPS = 400
#: Size of a step back while the bracket is below zero, and of the ridge.
BACK, RIDGE = 0.1, 1e-5
_WORD = re.compile(r"\w+")


def columns_of(word: str) -> tuple[int, ...]:
    raw = [word] + [f"{word[:k]}*" for k in (4, 5, 6, 7) if len(word) >= k]
    return tuple(zlib.crc32(x.encode("utf-8", "replace")) & COLUMNS - 1 for x in raw)


class Reader:
    """The set of columns of a text; words' columns are kept for the next text."""

    def __init__(self, weights: np.ndarray | None = None):
        self.known: dict[str, tuple[int, ...]] = {}
        self.weights = weights

    def columns(self, text: str) -> np.ndarray:
        known, out = self.known, set()
        if len(known) > 400_000:
            known.clear()
        for w in set(_WORD.findall(text.lower())):
            c = known.get(w)
            if c is None:
                c = columns_of(w)
                if self.weights is not None:
                    c = tuple(i for i in c if self.weights[i])
                known[w] = c
            if c:
                out.update(c)
        return np.array(sorted(out), np.int32)


@dataclass
class Model:
    bias: float
    weights: np.ndarray


def fit(columns: list[np.ndarray], confirmed: np.ndarray, prior: float, steps: int = STEPS) -> Model | None:
    """Adam on the non-negative risk; `columns` are the rows' column sets, `confirmed` says which rows are confirmed toxic, the others are unlabelled."""
    if not confirmed.any():
        return None
    counts = np.zeros((2, COLUMNS), np.int64)
    for c, yes in zip(columns, confirmed.tolist()):
        counts[int(yes), c] += 1
    around, seen = counts
    expected = (around + 0.5) * confirmed.sum() / max((~confirmed).sum(), 1)
    active = np.flatnonzero((seen >= LEAST) & (seen - expected >= ABOVE * np.sqrt(expected + 0.1)))
    local = np.full(COLUMNS, -1, np.int32)
    local[active] = np.arange(len(active))
    kept = [x[x >= 0] for x in (local[c] for c in columns)]
    size = np.array([len(x) for x in kept], np.int64)
    rows = Rows(np.concatenate([*kept, np.zeros(0, np.int32)]), np.ones(size.sum(), np.float32), size)
    n = len(active)
    p, first, second = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    p[-1] = np.log(prior / (1 - prior))
    toxic, others = np.flatnonzero(confirmed), np.flatnonzero(~confirmed)
    others = others if len(others) else toxic
    rows_p, rows_u = rows.take(toxic), rows.take(others)
    entry_p, entry_u = rows_p.row_of_entry(), rows_u.row_of_entry()

    def slope(part, entry, d):
        d = d / len(d)
        return np.append(np.bincount(part.index, d[entry], n), d.sum())

    for step in range(1, steps + 1):
        zp, zu = rows_p.sums(p[rows_p.index]) + p[-1], rows_u.sums(p[rows_u.index]) + p[-1]
        bracket = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        away = slope(rows_u, entry_u, sigmoid(zu)) - prior * slope(rows_p, entry_p, sigmoid(zp))
        grad = prior * slope(rows_p, entry_p, sigmoid(zp) - 1) + (away if bracket >= 0 else -BACK * away)
        grad[:-1] += RIDGE * p[:-1]
        first += 0.1 * (grad - first)
        second += 0.001 * (grad * grad - second)
        p -= 0.05 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(COLUMNS, np.float32)
    weights[active] = p[:-1]
    return Model(float(p[-1]), weights)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", confirmed: int = CONFIRMED, unlabelled: int = UNLABELLED) -> Model | None:
    known = labelled(labels, label)
    prior = known.agg(F.avg("y")).head()[0]
    if not prior:
        return None
    toxic = draw(known, confirmed, F.col("y") == 1).select("doc_id", F.lit(True).alias("confirmed"))
    ids = docs.select("doc_id").distinct()  # else an id of many rows could be all that is drawn
    other = draw(ids, unlabelled, F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.lit(False).alias("confirmed"))
    # one text of each drawn id, the first in order
    texts = texts_of(docs, toxic.unionByName(other)).groupBy("doc_id", "confirmed").agg(F.min("text").alias("text"))

    def make():
        reader = Reader()

        def step(batch):
            idx = [reader.columns(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("confirmed"), pa.array([i.tobytes() for i in idx], pa.binary())], ["confirmed", "idx"])
        return step

    # bounded by the two limits; in a fixed order, so that a repeated task fits the same model
    got = map_batches(texts, make, "confirmed boolean, idx binary").collect()
    got.sort(key=lambda r: (r["confirmed"], bytes(r["idx"])))
    columns = [np.frombuffer(r["idx"], np.int32) for r in got]
    return fit(columns, np.array([r["confirmed"] for r in got], bool), min(max(prior, 1e-4), 1 - 1e-4))


def score(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` and score (double, 0 to 1) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # COLUMNS numbers

    def make():
        m = shared.value
        reader = Reader(m.weights if m else None)

        def step(batch):
            if m is None:
                found = np.zeros(batch.num_rows)
            else:
                found = sigmoid(np.array([m.bias + float(m.weights[reader.columns(t)].sum()) for t in batch.column("_text").to_pylist()]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found, pa.float64())], [*keep, "score"])
        return step

    rows = docs.select(*keep, text_of().alias("_text"))
    return map_batches(rows, make, extended(docs, keep, "score double"))


def scored(docs: DataFrame, labels: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, held_out, score and predicted (1 from THRESHOLD) of every document."""
    return (score(docs, train(docs, labels), keep).withColumn("held_out", held_out(F.col("doc_id")))
            .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))

"""Bounded samples of labelled rows, drawn alike at every size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import held_out, text_of


def labelled(labels: DataFrame, label: str) -> DataFrame:
    """One row (doc_id, y) for each id whose label is 0 or 1 and may be learnt from; of repeated rows the smallest label counts."""
    return (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min(label).cast("int").alias("y")))


def draw(rows: DataFrame, n: int, where: Column | None = None) -> DataFrame:
    """n rows at most, the first in the order of a hash of doc_id: a top-n, which never brings all rows together."""
    rows = rows if where is None else rows.where(where)
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)


def texts_of(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """Whole texts of a drawn sample; its size is bounded by the limits it was drawn with, so it is broadcast."""
    return docs.select("doc_id", text_of().alias("text")).join(F.broadcast(sample), "doc_id")


class Rows:
    """Sparse rows: column numbers and values of all rows in turn, and where each row starts."""

    def __init__(self, index: np.ndarray, value: np.ndarray, size: np.ndarray):
        self.index, self.value, self.size = index, value, size
        self.start = np.concatenate([[0], np.cumsum(size)])[:-1]

    @staticmethod
    def collected(rows: list) -> Rows:
        """From collected rows with binary columns idx (int32) and val (float32)."""
        idx = [np.frombuffer(r["idx"], np.int32) for r in rows]
        val = [np.frombuffer(r["val"], np.float32) for r in rows]
        return Rows(np.concatenate([*idx, np.zeros(0, np.int32)]), np.concatenate([*val, np.zeros(0, np.float32)]),
                    np.array([len(i) for i in idx], np.int64))

    def take(self, which: np.ndarray) -> Rows:
        size = self.size[which]
        at = np.repeat(self.start[which] - np.concatenate([[0], np.cumsum(size)])[:-1], size) + np.arange(size.sum())
        return Rows(self.index[at], self.value[at], size)

    def sums(self, per_entry: np.ndarray) -> np.ndarray:
        """Sums of the entries of each row; rows without entries have 0."""
        total = np.concatenate([np.zeros((1, *per_entry.shape[1:]), np.float64), np.cumsum(per_entry, axis=0, dtype=np.float64)])
        end = self.start + self.size
        return total[end] - total[self.start]

    def row_of_entry(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.size)), self.size)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

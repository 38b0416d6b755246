"""Passages of test items in documents, exact, edited or paraphrased.

1. The word n-grams of all items set bits in a map of fixed size (BITS). Every document is read once against it; its
   n-grams with a set bit are its hits, kept with their places.
2. Hits and items are joined on their n-grams. The hits of one item in one document that follow each other within 3 - 2 * THRESHOLD
   times the item's length make a chain: an alignment of THRESHOLD can't cover more, with all words matched and gaps for the rest. A chain of at least two different n-grams (one, if
   the item has no more), however common they are, is a candidate; its window is the words of the chain and as many on either side.
3. Smith-Waterman alignment of the words scores candidates (match 2, mismatch and gap -1); the score is divided by that of
   the whole item against itself. Pairs from THRESHOLD count as contaminated.

Words are lower-cased runs of letters, digits and underscores. Defined results: items with fewer than N words
hold no n-gram and are never found; null and empty texts hold nothing; rows with a null doc_id are found under the null
id; repeated ids of documents or items count once, with their best score; empty tables give no rows.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import BITS, bit_map, cut, map_batches, text_of

N = 3
THRESHOLD = 0.6
_WORDS = re.compile(r"\w+").findall
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[str]:
    return _WORDS(text.lower())


def grams(words: list[str]) -> np.ndarray:
    """64-bit numbers of the word n-grams, in order."""
    if len(words) < N:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    h = np.zeros(len(words) - N + 1, np.uint64)
    for i in range(N):
        h = (h ^ w[i:len(w) - N + 1 + i]) * _MIX
        h ^= h >> np.uint64(29)
    return h


def item_grams(items: DataFrame) -> DataFrame:
    """(item_id, gram, length, need): distinct n-grams of each item, with its words and the n-grams that a chain needs."""
    def make():
        def step(batch):
            ids, found, sizes, needs = [], [], [], []
            for i, t in zip(batch.column("item_id").to_pylist(), batch.column("_text").to_pylist()):
                words = words_of(t)
                g = np.unique(grams(words))
                ids += [i] * len(g)
                sizes += [len(words)] * len(g)
                needs += [min(2, len(g))] * len(g)
                found.append(g.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(np.concatenate([*found, np.zeros(0, np.int64)]), pa.int64()),
                                              pa.array(sizes, pa.int32()), pa.array(needs, pa.int32())], ["item_id", "gram", "length", "need"])
        return step
    rows = map_batches(items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("_text")), make, "item_id long, gram long, length int, need int")
    own = cut(rows.distinct())
    whole = own.groupBy("item_id").agg(F.max("length").alias("length"), F.min("need").alias("need"))  # an id can repeat
    return own.select("item_id", "gram").distinct().join(whole.withColumnRenamed("item_id", "_id"), F.expr("item_id <=> _id")).drop("_id")


def hits_of(docs: DataFrame, bits: np.ndarray, least: int) -> DataFrame:
    """doc_id, text_key and the hits (gram, at) of each document with `least` distinct ones."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def make():
        table = shared.value

        def step(batch):
            ids, keys, found, places = [], [], [], []
            for doc, key, text in zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), batch.column("_text").to_pylist()):
                g = grams(words_of(text))
                place = (g >> np.uint64(64 - BITS)).astype(np.int64)
                at = np.flatnonzero(table[place >> 3] >> (place & 7).astype(np.uint8) & 1)
                if len(at) < least or len(np.unique(g[at])) < least:
                    continue
                ids.append(doc)
                keys.append(key)
                found.append(g[at].view(np.int64))
                places.append(at.astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                ["doc_id", "text_key", "grams", "places"])
        return step
    found = map_batches(keyed(docs), make, "doc_id long, text_key long, grams array<long>, places array<int>").dropDuplicates(["doc_id", "text_key"])
    return found.select("doc_id", "text_key", F.explode(F.arrays_zip("grams", "places")).alias("hit")).select("doc_id", "text_key", F.col("hit.grams").alias("gram"), F.col("hit.places").alias("at"))


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_of()).alias("text_key"), text_of().alias("_text"))


def windows(docs: DataFrame, chains: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, item_id, words) of every chain that can hold its item; `chains` has the hits of each item of a document in `found`."""
    def make():
        def step(batch):
            out: list[tuple] = []
            for doc, text, found in zip(batch.column("doc_id").to_pylist(), batch.column("_text").to_pylist(), batch.column("found").to_pylist()):
                words = words_of(text)
                g = grams(words)
                for x in found:
                    at, reach = np.unique(np.array(x["places"])), math.ceil((3 - 2 * threshold) * x["length"])
                    for run in np.split(at, np.flatnonzero(np.diff(at) > reach) + 1):
                        if len(run) >= x["need"] and len(np.unique(g[run])) >= x["need"]:
                            out.append((doc, x["item_id"], " ".join(words[max(0, run[0] - reach):run[-1] + N + reach])))
            yield pa.RecordBatch.from_arrays([
                pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.string())], ["doc_id", "item_id", "words"])
        return step
    held = (keyed(docs).alias("d").join(chains.alias("c"), F.expr("d.doc_id <=> c.doc_id and d.text_key = c.text_key"))
            .select("d.doc_id", "d._text", "c.found"))
    return map_batches(held, make, "doc_id long, item_id long, words string")


def align(a: np.ndarray, b: np.ndarray) -> float:
    """Best local alignment score of two number sequences: match 2, mismatch -1, gap -1."""
    if not len(a) or not len(b):
        return 0.0
    step = np.arange(len(b), dtype=np.float64)
    last = np.zeros(len(b) + 1)
    best = 0.0
    for x in a:
        row = np.maximum(np.maximum(last[:-1] + np.where(b == x, 2.0, -1.0), last[1:] - 1), 0)
        row = np.maximum.accumulate(row + step) - step  # gaps along the row
        best = max(best, row.max())
        last[1:] = row
    return best


def similarity(item: str, words: str, least: float = 0.0) -> float:
    """Score of the alignment; 0 where the words in common, whatever their order, can't reach `least`."""
    numbers: dict[str, int] = {}
    a, b = (np.array([numbers.setdefault(w, len(numbers)) for w in x], np.int64) for x in (words_of(item), words.split()))
    if not len(a):
        return 0.0
    common = np.minimum(np.bincount(a, minlength=len(numbers)), np.bincount(b, minlength=len(numbers))).sum()
    return align(a, b) / (2 * len(a)) if common / len(a) >= least else 0.0


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, score): items found in documents, with their best score."""
    of_items = cut(item_grams(items))
    least = of_items.agg(F.min("need")).head()[0] or 2
    hits = hits_of(docs, bit_map(of_items, "gram"), least)
    chains = (hits.join(of_items, "gram").groupBy("doc_id", "text_key", "item_id")
              .agg(F.collect_list("at").alias("places"), F.first("length").alias("length"), F.first("need").alias("need"))
              .where(F.size("places") >= F.col("need"))
              .groupBy("doc_id", "text_key").agg(F.collect_list(F.struct("item_id", "length", "need", "places")).alias("found")))
    item_texts = items.select(F.col("item_id").cast("long").alias("item_id"), text_of().alias("item"))
    both = windows(docs, cut(chains), threshold).join(item_texts, "item_id")

    def make():
        def step(batch):
            score = [similarity(i, w, threshold) for i, w in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("item_id"), pa.array(score, pa.float64())], ["doc_id", "item_id", "score"])
        return step

    scored = map_batches(both.select("doc_id", "item_id", "item", "words"), make, "doc_id long, item_id long, score double")
    return scored.where(F.col("score") >= threshold).groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))

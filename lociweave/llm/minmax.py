"""Near-duplicate documents by min-max hashing.

A document is the set of its distinct word shingles. Under each of PERMUTATIONS permutations of 64-bit numbers both the
least and the greatest shingle are kept, so half as many hashes give the same number of signature values. BANDS
bands of three permutations (six values) are bucketed. With similarity s a pair shares a bucket with the chance
1 - (1 - s^6)^32: 0.99994 at 0.8, over 0.9999999 from 0.87.

Candidates are confirmed on the full sets. Exact copies (equal sets) are one node. Pairs of a bucket are never listed
as a whole:
  1. each bucket names a leader (first by a hash of the id); every node is held against the leader that it shares
     most buckets with;
  2. pairs of node and leader that this leaves in different groups are held against each other, and components are formed;
  3. in buckets that still hold several components, the nodes outside the bucket's largest one are held against all of its
     nodes, unless the shingles that a node has alone rule any link out. A bucket's full sets meet in tiles of a bounded number of
     shingles, each with an index of its shingles; a tile returns one link for two components at most, so no pair is a row.
     After that every candidate pair is linked, checked, ruled out, or inside one component.

Defined results: a null, empty or blank text has no shingles, links with nothing and is kept; a text with fewer words than
a shingle is one shingle; equal texts form a group; a null id has a null component and is kept, and never speaks for a
group; rows that repeat an id are placed by their own text; other columns are ignored; the group's smallest id is kept.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import AT_ONCE, BITS, bit_map, cut, map_batches, text_of
from .components import components

BANDS = 32
PER_BAND = 3
PERMUTATIONS = BANDS * PER_BAND
#: Shingles on either side of a tile, about; a bucket with more is held against itself in several tiles.
TILE = 1 << 20
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _numbers(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1) | np.uint64(1)


_FACTORS = _numbers(PERMUTATIONS, 20)
_BAND_FACTORS = _numbers(2 * PER_BAND, 21)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit shingles of a text's words, with A-Z lower-cased."""
    words = text.encode("utf-8", "replace").translate(_LOWER).split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    k = min(width, n)
    h = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        h = h * _MIX + w[i:n - k + 1 + i]
        h ^= h >> np.uint64(29)
    return np.unique(_mixed(h))


def band_keys(s: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band from the minima and maxima of its permutations."""
    low, high = np.full(PERMUTATIONS, ~np.uint64(0)), np.zeros(PERMUTATIONS, np.uint64)
    for k in range(0, len(s), 2048):
        h = s[k:k + 2048, None] * _FACTORS
        np.minimum(low, h.min(axis=0), out=low)
        np.maximum(high, h.max(axis=0), out=high)
    values = np.concatenate([low.reshape(BANDS, PER_BAND), high.reshape(BANDS, PER_BAND)], axis=1)
    return _mixed((_mixed(values) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def _signed(a: np.ndarray) -> np.ndarray:
    return a.view(np.int64)


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_key (digest of the whole set, null for an empty one) and band keys of every document."""
    def make():
        def step(batch):
            sets = [shingles(t, width) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array([_signed(band_keys(s)) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                ["doc_id", "n_shingles", "set_key", "bands"])
        return step
    return map_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text")), make,
                       "doc_id long, n_shingles long, set_key binary, bands array<long>", AT_ONCE)


def _sets(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, n, s): the full shingle sets of the given nodes, once for each text."""
    def make():
        def step(batch):
            sets = [shingles(t, width) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "s"])
        return step
    bits = docs.sparkSession.sparkContext.broadcast(bit_map(nodes.select(F.xxhash64("node").alias("h")), "h"))

    def near():
        def step(batch):
            place = batch.column("h").to_numpy().view(np.uint64) >> np.uint64(64 - BITS)
            yield batch.filter(pa.array((bits.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)))
        return step

    # only texts that may be needed are exchanged; where the map is full, all are
    rows = docs.select(F.col("doc_id").cast("long").alias("node"), text_of().alias("_text"), F.xxhash64(F.col("doc_id").cast("long")).alias("h"))
    texts = map_batches(rows, near, "node long, _text string, h long").join(nodes, "node", "left_semi")
    return map_batches(texts, make, "node long, s binary", AT_ONCE).where("octet_length(s) > 0")


def _unshared(sets: DataFrame) -> DataFrame:
    """(node, unshared): how many of a node's shingles no other of the given nodes has."""
    def make():
        def step(batch):
            sets_ = [np.frombuffer(s, np.int64) for s in batch.column("s").to_pylist()]
            nodes = np.repeat(batch.column("node").to_numpy(), [len(s) for s in sets_])
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(np.concatenate(sets_), pa.int64())], ["node", "h"])
        return step
    once = map_batches(sets.select("node", "s"), make, "node long, h long").groupBy("h").agg(F.count("*").alias("k"), F.min("node").alias("node")).where("k = 1")
    return once.groupBy("node").agg(F.count("*").alias("unshared"))


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    def make():
        def step(batch):
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])
        return step
    joined = (pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("s").alias("x")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("s").alias("y")), "b"))
    return map_batches(joined, make, "a long, b long", AT_ONCE)


def _sizes_agree(x: str, y: str, percent: int) -> str:
    return f"100 * least({x}, {y}) >= {percent} * greatest({x}, {y})"


def _across(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    of = lambda end: groups.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}"))
    return (pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
            .where("coalesce(c_a, a) != coalesce(c_b, b)").select("a", "b"))


def _links_across(table: pa.Table, percent: int) -> pa.Table:
    """Links (a, b) that join the components of a tile: each row of its right side is counted against the index of its left side."""
    node, c = (table.column(k).to_numpy() for k in ("node", "c"))
    sets = [np.frombuffer(s, np.uint64) for s in table.column("s").to_pylist()]
    n = np.array([len(s) for s in sets], np.int64)
    left, right = (np.flatnonzero(table.column(side).to_numpy()) for side in ("is_left", "is_right"))
    shingle = np.concatenate([np.zeros(0, np.uint64), *(sets[i] for i in left)])
    order = np.argsort(shingle, kind="stable")
    owner, shingle = np.repeat(left, n[left])[order], shingle[order]
    top: dict[int, int] = {}

    def root(x):
        while x in top:
            x = top[x]
        return x

    links = []
    for p in right:
        first, last = np.searchsorted(shingle, sets[p], "left"), np.searchsorted(shingle, sets[p], "right")
        size = last - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        both = np.bincount(owner[at], minlength=len(node))
        met = np.flatnonzero((c != c[p]) & (both > 0) & (100 * both >= percent * (n + n[p] - both)))
        for x in met[np.unique(c[met], return_index=True)[1]]:
            one, other = root(int(c[p])), root(int(c[x]))
            if one != other:
                top[max(one, other)] = min(one, other)
                links.append((node[p], node[x]))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _confirmed_in_tiles(inside: DataFrame, sets: DataFrame, percent: int, tile: int) -> DataFrame:
    """Links (a, b) between the components of each bucket: inside has key, node, n, component c and the bucket's largest."""
    outside = F.col("c") != F.col("largest")
    parts = lambda n: F.greatest(F.ceil(F.sum(n) / tile), F.lit(1)).cast("int")
    sizes = inside.groupBy("key").agg(parts(F.col("n")).alias("lefts"), parts(F.when(outside, F.col("n")).otherwise(0)).alias("rights"))
    place = F.xxhash64("node")
    dealt = (inside.join(sizes, "key").withColumns({"own_left": F.pmod(place, "lefts").cast("int"), "own_right": F.pmod(place, "rights").cast("int")})
             .withColumn("row", F.transform(F.sequence(F.lit(0), F.col("rights") - 1), lambda r: F.struct(F.col("own_left").alias("l"), r.alias("r"))))
             .withColumn("column", F.transform(F.sequence(F.lit(0), F.col("lefts") - 1), lambda l: F.struct(l.alias("l"), F.col("own_right").alias("r"))))
             .withColumn("t", F.explode(F.when(outside, F.array_union("row", "column")).otherwise(F.col("row")))))
    rows = (dealt.select("key", F.col("t.l").alias("l"), F.col("t.r").alias("r"), "node", "c", "n", (F.col("t.l") == F.col("own_left")).alias("is_left"),
                         (outside & (F.col("t.r") == F.col("own_right"))).alias("is_right")).join(sets, "node"))
    return rows.groupBy("key", "l", "r").applyInArrow(lambda table: _links_across(table, percent), "a long, b long")


def _joined_up(groups: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after more links: the components of components."""
    if links.isEmpty():
        return groups
    of = lambda end: groups.select(F.col("node").alias(end), F.col("component").alias(f"c_{end}"))
    between = links.join(of("a"), "a", "left").join(of("b"), "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    larger = components(between).select(F.col("node").alias("component"), F.col("component").alias("whole"))
    moved = groups.join(larger, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
    new = larger.select(F.col("component").alias("node"), F.col("whole").alias("component")).join(groups.select("node"), "node", "left_anti")
    return cut(moved.unionByName(new))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    signed = cut(signatures(docs, width))
    own = signed.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("node"), F.min("n_shingles").alias("n"))
    heads = cut(signed.select(F.col("doc_id").alias("node"), "set_key", "bands").join(own, ["set_key", "node"])
                .dropDuplicates(["set_key", "node"]).select("node", "n", "bands"))
    buckets = heads.select("node", "n", F.explode("bands").alias("key"))
    leaders = (buckets.groupBy("key").agg(F.min_by(F.struct("node", "n"), F.struct(F.xxhash64("node"), "node")).alias("lead"), F.count("*").alias("m"))
               .where("m > 1").select("key", F.col("lead.node").alias("b"), F.col("lead.n").alias("nb")))
    crowded = cut(buckets.join(leaders, "key"))
    led = cut(crowded.where(f"node != b and {_sizes_agree('n', 'nb', percent)}")
              .groupBy(F.col("node").alias("a"), "b").agg(F.count("*").alias("shared")))
    sets = cut(_sets(docs, crowded.select("node").distinct(), width))

    best = led.groupBy("a").agg(F.max_by("b", F.struct("shared", F.xxhash64("b"), "b")).alias("b"))
    first = cut(_confirmed(best, sets, percent))
    stars = first.select(F.col("a").alias("node"), F.col("b").alias("component"))
    links = first.unionByName(_confirmed(_across(led.join(best, ["a", "b"], "left_anti"), stars), sets, percent))
    groups = cut(components(links))

    placed = cut(crowded.join(groups, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("c")))
    several = lambda rows: (rows.groupBy("key", "c").agg(F.count("*").alias("k")).groupBy("key")
                            .agg(F.count("*").alias("groups"), F.max_by("c", F.struct("k", "c")).alias("largest")).where("groups > 1").select("key", "largest"))
    mixed = placed.join(several(placed).select("key"), "key")
    own_share = _unshared(sets.join(mixed.select("node").distinct(), "node"))
    open_ = cut(mixed.join(own_share, "node", "left").where(f"100 * (n - coalesce(unshared, 0)) >= {percent} * n").drop("unshared"))
    links = cut(_confirmed_in_tiles(open_.join(several(open_), "key"), sets, percent, tile))
    groups = _joined_up(groups, links)

    node_of = own.join(groups, "node", "left").select("set_key", F.coalesce("component", "node").alias("component"))
    return (signed.select("doc_id", "n_shingles", "set_key").join(node_of, "set_key", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))

"""Prefix trie of conversations: which openings they share, how often, and what sharing them saves.

A conversation is the sequence of its turns (role and text); every distinct opening is a node. Texts stay where they are:
a turn travels as 16 bytes of its SHA-256 and its length, a conversation as one row of 20 bytes a turn.

Conversations are sorted by (path, id) and cut at splitters into as many shards as a shuffle has partitions. The prefixes of
the splitters' paths form the skeleton; it alone can reach over a cut, since what lies on both sides of a splitter shares its
prefix. So a shard, read in order, finishes every other node by itself, and hands on partial sums for the skeleton's nodes, which are
added up afterwards. Copies of one conversation are cut by id, so no opening and no group of copies gathers in one task.

What is bounded: splitters have at most LONGEST turns (more than that in common can't be cut, only read in order), so the
skeleton has at most LONGEST nodes a shard, whatever the data. A shard holds the open nodes of one path, and the children of
those until their parent closes.

Defined results: null roles and texts are empty ones. Turns of one number are put in the order of their digests; rows that repeat are turns
that repeat. Rows without conv_id belong to no conversation. An empty table has no nodes, not even a root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import cut, map_batches, shuffle_width

#: Bytes of a turn's digest in a path.
WIDTH = 16
#: Turns of a splitter.
LONGEST = 128
#: Conversations drawn for each shard, to choose splitters from.
DRAWN = 16
#: Bytes of an id list that leave a shard at a time.
IDS = 1 << 16
LEAST_ID = -(1 << 63)


# ---- sequences --------------------------------------------------------------

def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, each as (turn, key, size); key is 32 hex digits, size counts code points."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    key = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * WIDTH)
    return (conversations.where("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", key.alias("key"), F.length(text).alias("size")).alias("t"))
            .groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns")))


def forked(seqs: DataFrame, every: int = 100, below: int = 6) -> DataFrame:
    """Every conversation with its first h turns taken from the one that starts its hundred (`every`): h is crc32(id) modulo `below`."""
    start = F.col("conv_id") - F.col("conv_id") % every
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(below)).cast("int")
    heads = seqs.where(f"conv_id % {every} = 0").select(F.col("conv_id").alias("start"), F.slice("turns", 1, below - 1).alias("head"))
    head = F.when(F.col("head").isNull(), F.slice("turns", 1, 0)).otherwise(F.slice("head", F.lit(1), h))
    own = F.slice("turns", h + 1, F.size("turns"))
    return seqs.withColumn("start", start).join(heads, "start", "left").select("conv_id", F.concat(head, own).alias("turns"))


def _path() -> Column:
    return F.unhex(F.array_join(F.transform("turns", lambda t: t["key"]), ""))


# ---- splitters and skeleton -------------------------------------------------

def shared(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with alike."""
    n = min(len(a), len(b)) // WIDTH
    if a[:n * WIDTH] == b[:n * WIDTH]:
        return n
    lo, hi = 0, n  # alike up to lo, not up to hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo * WIDTH:mid * WIDTH] == b[lo * WIDTH:mid * WIDTH] else (lo, mid)
    return lo


class Skeleton:
    """Splitters (path, id) in order, and the numbered nodes that are prefixes of their paths, parents before children."""

    def __init__(self, splitters: list[tuple[bytes, int]]):
        self.splitters = splitters
        self.chains: list[list[int]] = []
        self.ancestors: list[list[int]] = []  # of each node, itself last
        last, chain = b"", []
        for path, _ in splitters:
            chain = chain[:shared(last, path) + 1]
            while len(chain) <= len(path) // WIDTH:
                chain = [*chain, len(self.ancestors)]
                self.ancestors.append(chain)
            self.chains.append(chain)
            last = path

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def nodes(self, shard: int, path: bytes) -> list[int]:
        """The path's nodes of the skeleton, from the root on; only the two splitters beside a shard can share them."""
        best: list[int] = []
        for k in (shard - 1, shard):
            if 0 <= k < len(self.splitters):
                chain = self.chains[k][:shared(path, self.splitters[k][0]) + 1]
                best = max(best, chain, key=len)
        return best


def splitters(seqs: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """At most shards - 1 splitters, from DRAWN conversations a shard, drawn by a hash of the id."""
    drawn = (seqs.orderBy(F.xxhash64("conv_id"), "conv_id").limit(DRAWN * shards)
             .select(F.substring("path", 1, LONGEST * WIDTH).alias("path"), F.length("path").alias("bytes"), "conv_id").collect())
    keys = sorted((bytes(r["path"]), r["conv_id"] if r["bytes"] <= LONGEST * WIDTH else LEAST_ID) for r in drawn)
    return sorted({keys[k * len(keys) // shards] for k in range(1, shards)}) if keys else []


# ---- shards -----------------------------------------------------------------

class _Open:
    """A node whose members are being read."""

    __slots__ = ("depth", "size", "node", "n", "least", "children", "leaves", "saved", "digest", "ids", "bytes", "seq", "held")

    def __init__(self, depth: int, size: int, node: int):
        self.depth, self.size, self.node = depth, size, node
        self.n = self.children = self.leaves = self.saved = self.bytes = self.seq = 0
        self.least = None
        self.digest = None
        self.ids: list[str] = []
        self.held: list[list] = []


#: kind: DONE is a node (node: its parent in the skeleton, -1 if that is none), PART a shard's sums for node, ENDS a piece of its id list.
DONE, PART, ENDS = 0, 1, 2
FIELDS = "kind int, node int, conv_id long, depth int, parent_conv_id long, n long, children long, leaves long, saved long, size int, ends string, shard int, seq int"
_NAMES = [f.split()[0] for f in FIELDS.split(", ")]
_TYPES = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}


class Walk:
    """One shard after another, each read in the order of (path, id)."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.shard, self.path = skeleton, None, b""
        self.stack: list[_Open] = []
        self.out: list[tuple] = []

    def add(self, shard: int, path: bytes, conv_id: int, sizes: list[int]) -> None:
        if shard != self.shard:
            self.end()
            self.shard = shard
        keep = shared(self.path, path) + 1 if self.stack else 0
        self._close(keep)
        depth = len(path) // WIDTH
        if keep <= depth:
            chain = self.skeleton.nodes(shard, path)
            for d in range(keep, depth + 1):
                self.stack.append(_Open(d, sizes[d - 1] if d else 0, chain[d] if d < len(chain) else -1))
        self.path = path
        top = self.stack[-1]
        top.n += 1
        top.least = conv_id if top.least is None else min(top.least, conv_id)
        self._ends_with(top, str(conv_id))

    def end(self) -> None:
        self._close(0)
        self.path = b""

    def _ends_with(self, v: _Open, conv_id: str) -> None:
        if v.node < 0:
            if v.digest is None:
                v.digest = hashlib.sha256(conv_id.encode())
            else:
                v.digest.update(f",{conv_id}".encode())
            return
        v.ids.append(conv_id)
        v.bytes += len(conv_id) + 1
        if v.bytes >= IDS:
            self._hand_on(v)

    def _hand_on(self, v: _Open) -> None:
        if v.ids:
            self.out.append((ENDS, v.node, None, None, None, None, None, None, None, None, ",".join(v.ids), self.shard, v.seq))
            v.ids, v.bytes, v.seq = [], 0, v.seq + 1

    def _close(self, keep: int) -> None:
        while len(self.stack) > keep:
            v = self.stack.pop()
            parent = self.stack[-1] if self.stack else None
            if v.node >= 0:
                self._hand_on(v)
                self.out.append((PART, v.node, v.least, v.depth, None, v.n, v.children, v.leaves, v.saved, v.size, None, self.shard, None))
            else:
                self._finish(v, parent)
            if parent is not None:
                parent.n += v.n
                parent.least = v.least if parent.least is None else min(parent.least, v.least)

    def _finish(self, v: _Open, parent: _Open | None) -> None:
        for row in v.held:
            row[4] = v.least
            self.out.append(tuple(row))
        leaves, saved = max(v.leaves, 1), v.saved + (v.n - 1) * v.size
        digest = v.digest or hashlib.sha256()
        row = [DONE, -1 if parent is None else parent.node, v.least, v.depth, None, v.n, v.children, leaves, saved, v.size, digest.hexdigest(), self.shard, None]
        if parent is None:
            self.out.append(tuple(row))
            return
        (self.out if parent.node >= 0 else parent.held).append(row)
        parent.children += 1
        parent.leaves += leaves
        parent.saved += saved

    def taken(self) -> pa.RecordBatch:
        columns = list(zip(*self.out)) if self.out else [()] * len(_NAMES)
        self.out = []
        return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[f.split()[1]]) for c, f in zip(columns, FIELDS.split(", "))], _NAMES)


def _walked(placed: DataFrame, shared_skeleton) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk(shared_skeleton.value)
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("shard", "path", "conv_id", "sizes"))):
                walk.add(*row)
                if len(walk.out) >= 4096:
                    yield walk.taken()
        walk.end()
        yield walk.taken()
    return placed.mapInArrow(run, FIELDS)


def _digests(pieces: DataFrame) -> DataFrame:
    """(node, ends): the digest of each node's id list, from its pieces in order; a piece at a time is in memory."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, out = None, None, []
        for batch in batches:
            for n, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if n != node:
                    if node is not None:
                        out.append((node, digest.hexdigest()))
                    node, digest = n, hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
        if node is not None:
            out.append((node, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int32(), pa.string()))], ["node", "ends"])
    return pieces.repartition("node").sortWithinPartitions("node", "shard", "seq").select("node", "ends").mapInArrow(run, "node int, ends string")


# ---- the trie ---------------------------------------------------------------

def trie(seqs: DataFrame, shards: int | None = None) -> DataFrame:
    """One row a node of the sequences (conv_id, turns).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves (childless nodes below, itself
    included), saved_tokens (code points of the last turns below, once for every member but one), ends_sha256 (digest of the ids that end here).
    """
    spark = seqs.sparkSession
    shards = shards or shuffle_width(spark)
    paths = cut(seqs.select("conv_id", _path().alias("path"), F.transform("turns", lambda t: t["size"]).alias("sizes")))
    skeleton = Skeleton(splitters(paths, shards))
    known = spark.sparkContext.broadcast(skeleton)  # at most LONGEST nodes a shard

    def make():
        def step(batch):
            shard = [known.value.shard(p, c) for p, c in zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int32()), *(batch.column(c) for c in ("path", "conv_id", "sizes"))], ["shard", "path", "conv_id", "sizes"])
        return step

    placed = map_batches(paths, make, "shard int, path binary, conv_id long, sizes array<int>")
    walked = cut(_walked(placed.repartition(len(skeleton.splitters) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id"), known))
    done = walked.where(F.col("kind") == DONE)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    named = lambda df: df.select(*(F.col(c).cast("long") for c in columns[:-1]), columns[-1])
    renamed = {"n": "n_convs", "children": "n_children", "leaves": "n_leaves", "saved": "saved_tokens", "ends": "ends_sha256"}
    if not skeleton.splitters:
        return named(done.withColumnsRenamed(renamed))

    kids = [0] * len(skeleton.ancestors)
    for chain in skeleton.ancestors:
        if len(chain) > 1:
            kids[chain[-2]] += 1
    frame = spark.createDataFrame([(c[-1], c[-2] if len(c) > 1 else None, kids[c[-1]], c) for c in skeleton.ancestors], "node int, parent int, kids long, above array<int>")
    sums = (walked.where(F.col("kind") == PART).groupBy("node")
            .agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.sum("n").alias("n_convs"), F.sum("children").alias("children"),
                 F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"), F.max("size").alias("size"))
            .join(frame, "node")
            .withColumn("n_children", F.col("children") + F.col("kids"))
            .withColumn("leaves", F.col("leaves") + F.when(F.col("n_children") == 0, 1).otherwise(0))
            .withColumn("saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("size")))
    sums = cut(sums)  # a row for each node of the skeleton
    below = (sums.select(F.explode("above").alias("node"), "leaves", "saved")
             .groupBy("node").agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    ends = _digests(walked.where(F.col("kind") == ENDS))
    parents = sums.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_id"))
    own = (sums.join(below, "node").join(ends, "node", "left").join(parents, "parent", "left")
           .withColumn("ends_sha256", F.coalesce("ends", F.sha2(F.lit("").cast("binary"), 256)))
           .withColumn("parent_conv_id", F.col("parent_id")))
    # the skeleton's size is bounded, so its ids go to where the finished nodes lie
    rest = (done.join(F.broadcast(parents), F.col("node") == F.col("parent"), "left")
            .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "parent_id")).withColumnsRenamed(renamed))
    return named(rest).unionByName(named(own))

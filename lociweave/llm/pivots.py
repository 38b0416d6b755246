"""Near-duplicate vectors by a pivot-permutation index.

PIVOTS reference points are drawn from the vectors, no two of them with a cosine of APART or more: else a dense group would
supply many, and its members would name different ones of them as nearest. A vector is described by the FIRST of them in order of distance,
and inverted lists are kept for these: vectors of one label whose first points have one in common are candidates. All vectors are indexed.

A list is read by one task, or by one task for each pair of its chunks where it has more than CHUNK members; cosines are taken in tiles, and no pair
is ever a row. A tile's result is, for each vector with links, their number and one vector that it hangs together with, so what is stored grows with
the vectors, however many links they have. A pair that meets in several lists counts in that of the lowest point that both have.

Links are counted, not sampled. Equal vectors of one label are one node, so that exact copies make no pairs. Tiles are multiplied in single
precision; what comes near the limit is multiplied again in double precision.

Defined results: a null label, a null, empty or zero vector, and one with null or non-finite components link with nothing;
vectors of other lengths than their partner don't link; a null vec_id has no component, counts no links and is kept; rows that
repeat an id are counted by their own vector; other columns are ignored; the smallest id of a component is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ..operators.membership import split_by
from .common import cut, map_batches
from .components import components

PIVOTS = 128
#: Vectors drawn for each reference point that is wanted, and the cosine from which a drawn one is passed over.
DRAWN, APART = 32, 0.9
#: Nearest points whose lists a vector is in.
FIRST = 3
#: Members of a list that a task takes for either side.
CHUNK = 1 << 16
#: Rows and columns of a tile, and how far single precision may be off.
TILE, OFF = (512, 4096), 1e-5
#: A place among the first points that is empty: there are fewer points of that length.
_NONE = (1 << 16) - 1


def _unit(vector) -> np.ndarray | None:
    """A vector at length one in double precision; None where it links with nothing."""
    if not vector or any(x is None for x in vector):
        return None
    units, fine = _units(np.asarray(vector, np.float64)[None])
    return units[0] if fine[0] else None


def _units(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows at length one in double precision, and which of them have one."""
    v = rows.astype(np.float64)
    fine = np.isfinite(v).all(axis=1)
    v[~fine] = 0
    top = np.abs(v).max(axis=1, initial=0)
    v /= np.where(top > 0, top, 1)[:, None]  # large and tiny components keep their square
    size = np.sqrt(np.einsum("ij,ij->i", v, v))
    return v / np.where(size > 0, size, 1)[:, None], fine & (size > 0)


def reference_points(vectors: DataFrame, n: int = PIVOTS) -> dict[int, np.ndarray]:
    """At most n unit vectors of each length, the first by a hash of their components that aren't close to an earlier one; n * DRAWN are looked at."""
    hashed = vectors.where("embedding is not null and label is not null and vec_id is not null").select(
        "embedding", F.xxhash64("embedding").alias("_x"), F.hash("embedding").alias("_y"))
    # hashes alone are told apart and ordered; of the vectors only those drawn move, whose hashes are a table of fixed size
    first = cut(hashed.select("_x", "_y").distinct().orderBy("_x", "_y").limit(DRAWN * n))
    drawn = hashed.join(F.broadcast(first), ["_x", "_y"]).dropDuplicates(["_x", "_y"]).orderBy("_x", "_y").select("embedding").toArrow()
    by_size: dict[int, list[np.ndarray]] = {}
    for r in drawn.column("embedding"):
        if (u := _unit(r.as_py())) is not None:
            kept = by_size.setdefault(len(u), [])
            if len(kept) < n and all(u @ v < APART for v in kept):
                kept.append(u)
    return {k: np.array(v) for k, v in by_size.items()}


def _by_size(column: pa.Array, usable: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their vectors) for each length of vector among rows that are usable and hold no null."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets, values = column.offsets.to_numpy(), column.values
    ends = np.concatenate(([0], np.cumsum(values.is_null().to_numpy(zero_copy_only=False))))
    sizes = np.diff(offsets)
    fits = usable & column.is_valid().to_numpy(zero_copy_only=False) & (sizes > 0) & (ends[offsets[1:]] == ends[offsets[:-1]])
    flat = values.to_numpy(zero_copy_only=False)
    for size in np.unique(sizes[fits]):
        rows = np.flatnonzero(fits & (sizes == size))
        yield rows, flat[offsets[rows][:, None] + np.arange(size)]


def described(vectors: DataFrame, points: dict[int, np.ndarray]) -> DataFrame:
    """vec_id, label, key of the vector (null: links with nothing), its length, its first points (16 bits each, in order) and its components as bytes."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    shared = vectors.sparkSession.sparkContext.broadcast(points)

    def make():
        pivots = shared.value

        def step(batch):
            n = batch.num_rows
            keys, packed, size, firsts = [None] * n, [None] * n, np.zeros(n, np.int32), np.zeros(n, np.int64)
            for rows, vectors in _by_size(batch.column("embedding"), batch.column("label").is_valid().to_numpy(zero_copy_only=False)):
                units, fine = _units(vectors)
                rows, units, vectors = rows[fine], units[fine], vectors[fine]
                double = vectors.astype(np.float64)
                for at, k in enumerate(rows.tolist()):
                    keys[k], packed[k] = hashlib.blake2b(double[at].tobytes(), digest_size=16).digest(), vectors[at].tobytes()
                size[rows] = vectors.shape[1]
                near = np.full((len(rows), FIRST), _NONE)
                p = pivots.get(vectors.shape[1])
                if p is not None:
                    m = min(FIRST, len(p))
                    near[:, :m] = np.argpartition(-(units @ p.T), m - 1, axis=1)[:, :m]
                near.sort(axis=1)
                for place in range(FIRST):
                    firsts[rows] |= near[:, place] << 16 * place
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(keys, pa.binary()), pa.array(size), pa.array(firsts), pa.array(packed, pa.binary())],
                ["vec_id", "label", "key", "size", "firsts", "packed"])
        return step
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                          F.col("embedding").cast("array<float>" if single else "array<double>").alias("embedding"))
    return map_batches(rows, make, "vec_id long, label string, key binary, size int, firsts long, packed binary")


def _points_of(firsts: np.ndarray) -> np.ndarray:
    return np.stack([firsts >> 16 * k & _NONE for k in range(FIRST)], axis=1)


def _lists():
    """Distinct first points in a column of firsts; a vector without any is in the list of that name."""
    return F.array_distinct(F.filter(
        F.array(*[F.shiftright("firsts", 16 * k).bitwiseAND(_NONE).cast("int") for k in range(FIRST)]),
        lambda p, i: (p != _NONE) | (i == 0)))


def _hung(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Puts what a and b hang on together, the larger on the smaller."""
    while len(a):
        while (parent[a] != a).any():
            a = parent[a]
        while (parent[b] != b).any():
            b = parent[b]
        apart = a != b
        a, b = np.maximum(a, b)[apart], np.minimum(a, b)[apart]
        np.minimum.at(parent, a, b)


def links_of(units: np.ndarray, firsts: np.ndarray, copies: np.ndarray, point: int, least: float, cross: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links of each member of a list, weighted by copies, and the smallest member that it hangs together with. With `cross`, members before
    that place are met with those behind it only."""
    n = len(units)
    narrow, points = units.astype(np.float32), _points_of(firsts)
    counts, parent = np.zeros(n, np.int64), np.arange(n)
    for lo in range(0, n if cross is None else cross, TILE[0]):
        hi = min(lo + TILE[0], n if cross is None else cross)
        for left in range(lo if cross is None else cross, n, TILE[1]):
            right = min(left + TILE[1], n)
            cosines = narrow[lo:hi] @ narrow[left:right].T
            i, j = np.nonzero(cosines >= least - OFF)
            unsure = cosines[i, j] < least + OFF
            i, j = i + lo, j + left
            keep = i < j
            keep[unsure] &= np.einsum("ij,ij->i", units[i[unsure]], units[j[unsure]]) >= least
            i, j = i[keep], j[keep]
            lowest = np.full(len(i), _NONE + 1)
            for k in range(FIRST):
                own = points[i, k]
                lowest = np.minimum(lowest, np.where((points[j] == own[:, None]).any(axis=1), own, _NONE + 1))
            _hung(parent, i, j)
            here = lowest == point
            i, j = i[here], j[here]
            counts[lo:hi] += np.bincount(i - lo, copies[j], hi - lo).astype(np.int64)
            counts[left:right] += np.bincount(j - left, copies[i], right - left).astype(np.int64)
    while (parent[parent] != parent).any():
        parent = parent[parent]
    return counts, parent


def linked(members: DataFrame, long: DataFrame, least: float, single: bool) -> DataFrame:
    """label, node, mark, n and root: the links of the members (label, size, firsts, node, mark, copies, packed) in each list where they have any,
    and a node that they hang together with; n is 0 where all links count in other lists. long: label, size, point and chunks of long lists."""
    # of long lists there is one for each CHUNK rows at most
    at = members.withColumn("point", F.explode(_lists())).join(F.broadcast(long), ["label", "size", "point"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
    at = at.withColumn("own", F.pmod("mark", "chunks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    dealt = at.select("label", "size", "point", F.least("own", "other").alias("first"), F.greatest("own", "other").alias("last"), "own", "firsts", "node", "mark", "copies", "packed")

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("own", "ascending"), ("node", "ascending")])
        first, last, point, size = (table.column(c)[0].as_py() for c in ("first", "last", "point", "size"))
        raw = np.frombuffer(b"".join(table.column("packed").to_pylist()), np.float32 if single else np.float64).reshape(-1, size)
        firsts, copies, node, own = (table.column(c).to_numpy() for c in ("firsts", "copies", "node", "own"))
        counts, parent = links_of(_units(raw)[0], firsts, copies, point, least, None if first == last else int((own == first).sum()))
        held = np.flatnonzero((counts > 0) | (parent != np.arange(len(parent))))
        rows = table.take(pa.array(held))
        return pa.table([rows.column("label"), rows.column("node"), rows.column("mark"), pa.array(counts[held]), pa.array(node[parent[held]])],
                        names=["label", "node", "mark", "n", "root"])

    return dealt.groupBy("label", "size", "point", "first", "last").applyInArrow(run, "label string, node long, mark long, n long, root long")


def long_lists(own: DataFrame, chunk: int) -> DataFrame:
    """label, size, point and chunks of the lists with more than `chunk` members."""
    sizes = own.select("label", "size", F.explode(_lists()).alias("point")).groupBy("label", "size", "point").agg(F.count("*").alias("n"))
    return cut(sizes.where(F.col("n") > chunk).select("label", "size", "point", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")))


def near_duplicates(vectors: DataFrame, least: float = 0.98, chunk: int = CHUNK) -> DataFrame:
    """vec_id, n_links, component_id and kept of every vector."""
    single = isinstance(vectors.schema["embedding"].dataType.elementType, T.FloatType)
    every = described(vectors, reference_points(vectors))
    rows = cut(every.drop("packed"))
    own = cut(rows.where("key is not null and vec_id is not null").groupBy("label", "key").agg(
        F.min("vec_id").alias("node"), F.count("*").alias("copies"), F.first("size").alias("size"), F.first("firsts").alias("firsts")))
    # a vector's components are moved once for each of its lists; only those that may have copies are met with their table before
    near, far = split_by(every.where("key is not null and vec_id is not null"), own.where("copies > 1"), "key")
    mark = F.xxhash64("label", "key").alias("mark")
    member = lambda df, node, copies: df.select("label", "key", "size", "firsts", node.alias("node"), mark, copies.alias("copies"), "packed")
    # joins of tables that grow with the input are merges: by their sizes before a run, Spark might send one of them to the driver
    repeated = own.where("copies > 1").select("label", "key", "node", "copies").hint("merge")
    met = near.join(repeated, ["label", "key"], "left").where("copies is null or vec_id = node")
    once = member(met, F.col("vec_id"), F.coalesce("copies", F.lit(1).cast("bigint"))).dropDuplicates(["label", "key"])
    members = member(far, F.col("vec_id"), F.lit(1).cast("bigint")).unionByName(once).drop("key")
    parts = cut(linked(members, long_lists(own, chunk), least, single))
    groups = components(parts.select(F.col("node").alias("a"), F.col("root").alias("b")))
    others = parts.groupBy("node", "mark").agg(F.sum("n").alias("others"))
    placed = (own.select("label", "key", "node", "copies", mark).join(others.hint("merge"), ["node", "mark"], "left").join(groups.hint("merge"), "node", "left")
              .select("label", "key", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n"), F.coalesce("component", "node").alias("component")))
    known = F.col("vec_id").isNotNull()
    return (rows.select("vec_id", "label", "key").join(placed.hint("merge"), ["label", "key"], "left")
            .select("vec_id", F.when(known, F.coalesce("n", F.lit(0))).otherwise(0).cast("long").alias("n_links"),
                    F.when(known, F.coalesce("component", "vec_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))

"""Repeated windows of a collection: the distributed part that the two substring operators share.

A text is a row of symbols (bytes or words); a window is LENGTH symbols of one text. Every window names an anchor: the
place, inside it, of its SEED-symbol piece with the least hash, the leftmost of equal ones. The anchor depends on the window's
content alone, so equal windows anywhere have equal seeds. Consecutive windows with one anchor form a segment.

  1. Seeds of all texts are dealt by their value; those that occur once are out. This is exact: a repeated window's seed repeats.
  2. Segments of the other seeds are dealt by seed, each distinct one once for each group of documents, with its count
     and smallest document. So all equal windows meet in one task, and copies don't add to it. The segments of a seed that occurs more
     than HOT times are cut into single windows, which are dealt by their whole content: no seed's neighbourhood is a hot spot.
  3. There an index over the segments (the operator's own) tells equal windows apart; what holds of them goes back to the documents.

Rows of the exchanges are packed arrays, a few for each task, so that their number doesn't grow with the symbols. Documents
are grouped by a hash of doc_id into groups whose number follows the session's shuffle partitions; the text is exchanged
once. Nothing is collected, and lost tasks are computed again from the tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .common import map_batches, shuffle_width, text_of

#: Occurrences of a seed from which its segments are cut into windows.
HOT = 20_000
LAST = (1 << 63) - 1
_PLACES = 1 << 24
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Method:
    """How a text becomes symbols, and the index that tells equal windows apart."""

    length: int
    seed: int
    #: hashes of the symbols, and what `content` cuts
    symbols: Callable[[str], tuple[np.ndarray, object]]
    #: symbols from one place to another, as bytes
    content: Callable[[object, int, int], bytes]
    #: for distinct contents: a number for every window of each in turn, equal for equal windows
    classes: Callable[[list[bytes]], np.ndarray]
    #: symbols of a content
    size: Callable[[bytes], int]
    #: whether other occurrences must be in another document
    across: bool


def rolled(w: np.ndarray, k: int) -> np.ndarray:
    """64-bit hashes of all runs of k symbols, by doubling."""
    n = len(w) - k + 1
    powers = {1: w * _MIX ^ (w >> np.uint64(7))}
    factor, size = {1: np.uint64(0xD6E8FEB86659FD93)}, 1
    with np.errstate(over="ignore"):
        while size * 2 <= k:
            h = powers[size]
            powers[size * 2] = h[:-size] * factor[size] + h[size:]
            factor[size * 2] = factor[size] * factor[size]
            size *= 2
        out, done = None, 0
        while size:
            if k & size:
                part = powers[size][done:done + n]
                out = part if out is None else out * factor[size] + part
                done += size
            size //= 2
    out = out ^ (out >> np.uint64(29))
    out = out * np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def anchors(h: np.ndarray, width: int) -> np.ndarray:
    """For every run of `width` hashes, the place of its least one, the leftmost of equal ones."""
    if len(h) > _PLACES:  # the places of a very long text don't fit beside the hash
        return np.concatenate([k + anchors(h[k:k + _PLACES // 2 + width - 1], width) for k in range(0, len(h) - width + 1, _PLACES // 2)])
    # the hash's high bits with the place below them: one minimum finds both, and the leftmost of equal ones
    value = h & ~np.uint64(_PLACES - 1) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size < width:
        step = min(size, width - size)
        value = np.minimum(value[:len(value) - step], value[step:])
        size += step
    return (value & np.uint64(_PLACES - 1)).astype(np.int64)


def segments(m: Method, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Seeds, first windows and end windows of a text's segments."""
    if len(w) < m.length:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    h = rolled(w, m.seed)
    place = anchors(h, m.length - m.seed + 1)
    first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
    return h[place[first]], first, np.append(first[1:], len(place))


def _pack(a: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a.tobytes())


def _unpack(b: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(b), kind)


def _short(seeds: np.ndarray) -> bytes:
    """The low 40 bits: with the bucket they tell seeds apart well enough for a filter, which may let too much pass."""
    return seeds.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5].tobytes()


def _long(b: bytes) -> np.ndarray:
    out = np.zeros((len(b) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(b, np.uint8).reshape(-1, 5)
    return out.reshape(-1).view("<u8")


_LOW = np.uint64((1 << 40) - 1)


def _cuts(sorted_keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Runs of equal keys."""
    if len(sorted_keys):
        at = np.concatenate([[0], np.flatnonzero(np.diff(sorted_keys)) + 1, [len(sorted_keys)]])
        for a, b in zip(at[:-1], at[1:]):
            yield int(sorted_keys[a]), slice(int(a), int(b))


def _seed_rows(docs: DataFrame, m: Method, buckets: int) -> DataFrame:
    """(bucket, groups, sizes, seeds, counts): for each bucket the seeds of each document group, once, with their occurrences."""
    def make():
        def step(batch):
            of_group: dict[int, list[np.ndarray]] = {}
            for g, t in zip(batch.column("g").to_pylist(), batch.column("_text").to_pylist()):
                s = segments(m, m.symbols(t)[0])[0]
                if len(s):
                    of_group.setdefault(g, []).append(np.unique(s) if m.across else s)
            seeds, groups, counts = [], [], []
            for g, parts in of_group.items():
                s, n = np.unique(np.concatenate(parts), return_counts=True)
                seeds.append(s)
                counts.append(np.minimum(n, 255).astype(np.uint8))
                groups.append(np.full(len(s), g, np.int32))
            if not seeds:
                return
            s, n, g = np.concatenate(seeds), np.concatenate(counts), np.concatenate(groups)
            b = (s >> np.uint64(40)).astype(np.int64) % buckets
            order = np.lexsort((g, b))
            s, n, g, b = s[order], n[order], g[order], b[order]
            rows = []
            for bucket, part in _cuts(b):
                there = list(_cuts(g[part]))
                rows.append((bucket, np.array([x for x, _ in there], np.int32).tobytes(), np.array([y.stop - y.start for _, y in there], np.int32).tobytes(),
                             _short(s[part]), n[part].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5))],
                                             ["bucket", "groups", "sizes", "seeds", "counts"])
        return step
    return map_batches(docs.select("g", "_text"), make, "bucket int, groups binary, sizes binary, seeds binary, counts binary")


def _repeated(rows: DataFrame) -> DataFrame:
    """(g, seeds, hot): for each document group its seeds that occur elsewhere too."""
    def of_bucket(table: pa.Table) -> pa.Table:
        seeds, counts, groups = [], [], []
        for gs, sizes, s, n in zip(*(table.column(c).to_pylist() for c in ("groups", "sizes", "seeds", "counts"))):
            seeds.append(_long(s))
            counts.append(np.frombuffer(n, np.uint8))
            groups.append(np.repeat(np.frombuffer(gs, np.int32), np.frombuffer(sizes, np.int32)))
        s, n, g = np.concatenate(seeds), np.concatenate(counts), np.concatenate(groups)
        order = np.argsort(s, kind="stable")
        s, n, g = s[order], n[order].astype(np.int64), g[order]
        first = np.concatenate([[True], s[1:] != s[:-1]])
        number = np.cumsum(first) - 1
        total = np.bincount(number, n)[number]
        keep = total > 1
        s, g, hot = s[keep], g[keep], total[keep] > HOT
        order = np.lexsort((s, g))
        s, g, hot = s[order], g[order], hot[order]
        out = []
        for group, part in _cuts(g):
            x, y = s[part], hot[part]
            new = np.concatenate([[True], x[1:] != x[:-1]])
            out.append((group, _short(x[new]), np.packbits(y[new]).tobytes()))
        bucket = table.column("bucket")[0].as_py()
        return pa.table({"g": pa.array([r[0] for r in out], pa.int32()), "bucket": pa.array([bucket] * len(out), pa.int32()),
                         "seeds": pa.array([r[1] for r in out], pa.binary()), "hot": pa.array([r[2] for r in out], pa.binary())})
    return rows.groupBy("bucket").applyInArrow(of_bucket, "g int, bucket int, seeds binary, hot binary")


def _with_bucket(seeds: np.ndarray, buckets: int) -> np.ndarray:
    """What a seed is known by: its bucket and its low bits."""
    return ((seeds >> np.uint64(40)) % np.uint64(buckets)) << np.uint64(40) | seeds & _LOW


def _known(table: pa.Table, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The repeated seeds of a document group, sorted, and which are hot."""
    keys, hot = [np.zeros(0, np.uint64)], [np.zeros(0, bool)]
    for b, s, h in zip(*(table.column(c).to_pylist() for c in ("bucket", "seeds", "hot"))):
        x = _long(s)
        keys.append(np.uint64(b) << np.uint64(40) | x)
        hot.append(np.unpackbits(np.frombuffer(h, np.uint8))[:len(x)].astype(bool))
    k, h = np.concatenate(keys), np.concatenate(hot)
    order = np.argsort(k)
    return k[order], h[order]


def _pieces(m: Method, w: np.ndarray, data: object, known: np.ndarray, hot: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Seed keys, first windows, whether hot, and contents of a text's segments whose seed is known."""
    seeds, first, end = segments(m, w)
    if not len(seeds) or not len(known):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, bool), []
    key = _with_bucket(seeds, buckets)
    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
    hit = np.flatnonzero(known[at] == key)
    key, first, end, is_hot = key[hit], first[hit], end[hit], hot[at[hit]]
    if is_hot.any():
        number = np.where(is_hot, end - first, 1)
        of, turn = _expanded(number)
        key, is_hot, first = key[of], is_hot[of], first[of] + turn
        end = np.where(is_hot, first + 1, end[of])
    return key, first, is_hot, [m.content(data, a, b) for a, b in zip(first.tolist(), (end + (m.length - 1)).tolist())]


def _expanded(number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For `number` rows of each place in turn: the place, and the row's turn among those of its place."""
    of = np.repeat(np.arange(len(number)), number)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(number) - number, number)


def _distinct(keys: np.ndarray, digests: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of (key, digest), and where in it each distinct one begins."""
    order = np.lexsort((digests, keys))
    k, d = keys[order], digests[order]
    return order, np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])])[:len(k)])


def _segment_rows(docs: DataFrame, seeds: DataFrame, m: Method, buckets: int) -> DataFrame:
    """(part, g, keys, hot, counts, least, sizes, contents): distinct segments of each document group, dealt by seed, or by content where hot."""
    def of_group(texts: pa.Table, known_rows: pa.Table) -> pa.Table:
        known, hot = _known(known_rows, buckets)
        keys, hots, docs_, contents = [np.zeros(0, np.uint64)], [np.zeros(0, bool)], [np.zeros(0, np.int64)], []
        if len(known):
            for d, t in zip(texts.column("doc_id").to_pylist(), texts.column("_text").to_pylist()):
                key, _, is_hot, own = _pieces(m, *m.symbols(t), known, hot, buckets)
                keys.append(key)
                hots.append(is_hot)
                docs_.append(np.full(len(key), LAST if d is None else d, np.int64))
                contents += own
        key, is_hot, digest = np.concatenate(keys), np.concatenate(hots), _digests(contents)
        order, begin = _distinct(key, digest)
        n = np.diff(np.append(begin, len(order)))
        least = np.minimum.reduceat(np.concatenate(docs_)[order], begin) if len(begin) else np.zeros(0, np.int64)
        one = order[begin]
        key, is_hot, digest = key[one], is_hot[one], digest[one]
        with np.errstate(over="ignore"):
            mixed = key * _MIX >> np.uint64(20)
        place = (np.where(is_hot, digest, mixed) % np.uint64(buckets)).astype(np.int32)
        by_place = np.argsort(place, kind="stable")
        parts = {where: by_place[rows] for where, rows in _cuts(place[by_place])}
        g = known_rows.column("g")[0].as_py() if known_rows.num_rows else 0
        cols: list[list] = [[] for _ in range(8)]
        for where, rows in parts.items():
            texts_ = [contents[i] for i in one[rows].tolist()]
            for c, v in zip(cols, (
                    where, g, key[rows].tobytes(), is_hot[rows].astype(np.uint8).tobytes(), _pack(n[rows]), _pack(least[rows]),
                    _pack(np.fromiter(map(len, texts_), np.int32, len(texts_))), zstandard.ZstdCompressor(level=1).compress(b"".join(texts_)))):
                c.append(v)
        names = ("part", "g", "keys", "hot", "counts", "least", "sizes", "contents")
        return pa.table({n: pa.array(c, pa.int32() if k < 2 else pa.binary()) for k, (n, c) in enumerate(zip(names, cols))})
    return (docs.select("g", "doc_id", "_text").groupBy("g").cogroup(seeds.groupBy("g"))
            .applyInArrow(of_group, "part int, g int, keys binary, hot binary, counts binary, least binary, sizes binary, contents binary"))


def _digests(contents: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, contents), np.uint64, len(contents))


#: Bytes of distinct contents that are indexed at a time; a seed's contents stay together.
INDEXED = 1 << 18


def _found_rows(rows: DataFrame, m: Method) -> DataFrame:
    """(g, keys, digests, hot, first, number, owner): runs of windows of a segment that are repeated, with the smallest document that has them (0: any)."""
    def of_part(table: pa.Table) -> pa.Table:
        rows_, contents = [], []
        for keys, hot, counts, least, sizes, joined in zip(*(table.column(c).to_pylist() for c in ("keys", "hot", "counts", "least", "sizes", "contents"))):
            raw, ends = zstandard.ZstdDecompressor().decompress(joined), np.cumsum(_unpack(sizes, np.int32), dtype=np.int64)
            rows_.append((np.frombuffer(keys, np.uint64), np.frombuffer(hot, np.uint8), _unpack(counts, np.int64), _unpack(least, np.int64)))
            contents += [raw[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
        key, hot, n, least = (np.concatenate(c) for c in zip(*rows_))
        digest = _digests(contents)
        order, begin = _distinct(key, digest)
        entry = np.empty(len(order), np.int64)  # each row's number among the distinct contents
        entry[order] = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(order))))
        texts = [contents[i] for i in order[begin].tolist()]
        total, owner_of, seed = np.add.reduceat(n[order], begin), np.minimum.reduceat(least[order], begin), key[order[begin]]
        heads = np.append(np.flatnonzero(np.concatenate([[True], seed[1:] != seed[:-1]])), len(seed)).tolist()
        found, start, held = [], 0, 0
        for a, b in zip(heads[:-1], heads[1:]):
            held += sum(map(len, texts[a:b]))
            if held >= INDEXED or b == len(seed):
                of, *rest = _runs(m, texts[start:b], total[start:b], owner_of[start:b])
                found.append((of + start, *rest))
                start, held = b, 0
        of, first, number, owner = (np.concatenate(c) for c in zip(*found))
        runs = np.bincount(of, minlength=len(seed))
        row, turn = _expanded(runs[entry])
        run = (np.cumsum(runs) - runs)[entry[row]] + turn
        if m.across:  # a group whose only holder is the owner itself has nothing to remove
            some = (owner[run] < least[row]) | (n[row] > 1)
            row, run = row[some], run[some]
        out: list[tuple] = []
        ends = np.searchsorted(row, np.cumsum([len(r[0]) for r in rows_]))
        for g, a, b in zip(table.column("g").to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
            if b > a:
                r, x = row[a:b], run[a:b]
                out.append((g, key[r].tobytes(), digest[r].tobytes(), _pack(hot[r]), _pack(first[x].astype(np.int32)), _pack(number[x].astype(np.int32)), _pack(owner[x])))
        names = ("g", "keys", "digests", "hot", "first", "number", "owner")
        return pa.table({n: pa.array([r[k] for r in out], pa.int32() if k == 0 else pa.binary()) for k, n in enumerate(names)})
    return rows.groupBy("part").applyInArrow(of_part, "g int, keys binary, digests binary, hot binary, first binary, number binary, owner binary")


def _runs(m: Method, contents: list[bytes], counts: np.ndarray, leasts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(content, first, number, owner), in the contents' order: the runs of windows of each content that are repeated."""
    windows = np.fromiter(map(m.size, contents), np.int64, len(contents)) - (m.length - 1)
    number = m.classes(contents)
    of_content = np.repeat(np.arange(len(contents)), windows)
    n_classes = int(number.max()) + 1 if len(number) else 0
    if m.across:
        owner = np.full(n_classes, LAST, np.int64)
        np.minimum.at(owner, number, leasts[of_content])
        value = owner[number]
    else:
        count = np.bincount(number, counts.astype(np.float64)[of_content], n_classes)
        value = np.where(count[number] > 1, 0, -1).astype(np.int64)
    begin = np.cumsum(windows) - windows
    new = np.ones(len(value), bool)
    new[1:] = value[1:] != value[:-1]
    new[begin[windows > 0]] = True
    at = np.flatnonzero(new)
    stop = np.append(at[1:], len(value))
    some = value[at] >= 0
    at, stop = at[some], stop[some]
    return of_content[at], at - begin[of_content[at]], stop - at, value[at]


def _code(keys: np.ndarray, digests: np.ndarray) -> np.ndarray:
    """One number that stands for both while they are looked up."""
    with np.errstate(over="ignore"):
        return keys * _MIX ^ digests


def repeated_spans(docs: DataFrame, m: Method, finish: Callable[[object, np.ndarray], tuple], schema: str) -> DataFrame:
    """For every document: doc_id and what `finish` makes of its symbols and of the mask of symbols that repeated windows cover."""
    width = 2 * shuffle_width(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("_text")) \
        .select(F.pmod(F.hash("doc_id"), F.lit(width)).alias("g"), "doc_id", "_text")
    seeds = _repeated(_seed_rows(rows, m, width))
    found = _found_rows(_segment_rows(rows, seeds, m, width), m)

    arrow = to_arrow_schema(StructType.fromDDL(f"doc_id long, {schema}"))

    def of_group(texts: pa.Table, runs: pa.Table) -> pa.Table:
        kinds = (np.uint64, np.uint64, np.uint8, np.int32, np.int32, np.int64)
        rows_ = [[np.zeros(0, k) for k in kinds]]
        for r in zip(*(runs.column(c).to_pylist() for c in ("keys", "digests", "hot", "first", "number", "owner"))):
            rows_.append([*(np.frombuffer(b, k) for b, k in zip(r[:2], kinds)), *(_unpack(b, k) for b, k in zip(r[2:], kinds[2:]))])
        of, digest, hot, first, number, owner = (np.concatenate(c) for c in zip(*rows_))
        keys, one = np.unique(of, return_index=True)
        is_hot = hot[one].astype(bool)
        code = _code(of, digest)
        order = np.argsort(code)
        code, of, digest, first, number, owner = (c[order] for c in (code, of, digest, first, number, owner))
        out = []
        for d, t in zip(texts.column("doc_id").to_pylist(), texts.column("_text").to_pylist()):
            w, data = m.symbols(t)
            least = LAST if d is None else d
            key, start, _, contents = _pieces(m, w, data, keys, is_hot, width)
            mine = _digests(contents)
            asked = _code(key, mine)
            low = np.searchsorted(code, asked, "left")
            piece, turn = _expanded(np.searchsorted(code, asked, "right") - low)
            run = low[piece] + turn
            met = (of[run] == key[piece]) & (digest[run] == mine[piece])
            if m.across:
                met &= owner[run] < least
            piece, run = piece[met], run[met]
            a = start[piece] + first[run]
            cover = np.bincount(a, minlength=len(w) + 1) - np.bincount(a + number[run] + (m.length - 1), minlength=len(w) + 1)
            out.append((d, *finish(data, np.cumsum(cover)[:-1] > 0)))
        return pa.table([pa.array([r[k] for r in out], f.type) for k, f in enumerate(arrow)], schema=arrow)

    return (rows.select("g", "doc_id", "_text").groupBy("g").cogroup(found.groupBy("g")).applyInArrow(of_group, f"doc_id long, {schema}"))

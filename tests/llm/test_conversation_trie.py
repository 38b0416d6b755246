"""The trie against one built in a dictionary, however the sequences are cut into shards."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lociweave.llm import conversation_trie as ct

SCHEMA = "conv_id long, turn long, role string, text string"


def key(role, text):
    role, text = role or "", text or ""
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def plain(rows):
    """Nodes as the rules say, with every opening spelt out."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), key(role, text), (role or "", text or "")))
    own = {c: [x[2] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        start = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        built[c] = own.get(start, [])[:h] + turns[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1]) if p else 0
    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), kids.get(p, 0), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def made(rng, n, turns, hot=0):
    """Conversations over few turns, with one opening and one whole conversation that many share, nulls, ties and repeated rows."""
    rows = []
    for c in rng.sample(range(-150, 3 * n), n):
        if rng.random() < hot:
            rows += [(c, t, "user", f"the same {t}") for t in range(4)]
            continue
        for t in range(rng.randint(1, turns)):
            first = t == 0 and rng.random() < 0.5
            rows.append((c, None if rng.random() < 0.05 else t // 2 if rng.random() < 0.1 else t, "system" if first else rng.choice(["user", "bot", None]),
                         "shared opening" if first else rng.choice(["é" * 3, "b", "", None, "two words"])))
        if rng.random() < 0.1:
            rows.append(rows[-1])
    rows += [(None, 0, "user", "nobody's"), (None, None, None, None)]
    return rows


@pytest.mark.parametrize("seed,n,turns,hot,shards", [(1, 60, 7, 0.0, 1), (2, 120, 7, 0.4, 5), (3, 200, 4, 0.3, 61), (4, 30, 12, 0.9, 9), (5, 3, 2, 0, 8)])
def test_against_dictionary(spark, seed, n, turns, hot, shards):
    rows = made(random.Random(seed), n, turns, hot)
    df = spark.createDataFrame(rows, SCHEMA)
    for name in ("node", "kind", "key", "path", "turns", "start", "head", "n"):
        df = df.withColumn(name, F.lit("x"))
    got = ct.trie(ct.forked(ct.sequences(df)), shards).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[1], r[7])) == sorted(plain(rows), key=lambda r: (r[0], r[1], r[7]))


def test_long_conversations(spark):
    """Copies of a conversation longer than a splitter, and one that goes on where they end."""
    long = [("user", f"turn {k % 7}") for k in range(ct.LONGEST + 60)]
    rows = [(c, t, *x) for c in range(100, 900, 100) for t, x in enumerate(long)]
    rows += [(c, t, *x) for c in (1000, 1100) for t, x in enumerate([*long, ("bot", f"end {c}")])]
    rows += [(c, t, *x) for c in range(2000, 2600, 100) for t, x in enumerate([*long[:c // 20], ("bot", "other")])]
    got = ct.trie(ct.forked(ct.sequences(spark.createDataFrame(rows, SCHEMA))), 6).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], r[1], r[7])) == sorted(plain(rows), key=lambda r: (r[0], r[1], r[7]))


def test_turnless_and_empty(spark):
    """A conversation may lose all its turns; it still counts at the root."""
    lone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 2)
    got = ct.trie(ct.forked(ct.sequences(spark.createDataFrame([(lone, 0, "user", "a"), (lone, 1, "bot", "b")], SCHEMA)))).collect()
    assert [tuple(r) for r in got] == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]
    none = spark.createDataFrame([(None, 0, "user", "x")], SCHEMA)
    assert ct.trie(ct.forked(ct.sequences(none))).count() == 0
    assert ct.trie(ct.forked(ct.sequences(none.where("false")))).count() == 0


def test_copies_are_cut_by_id():
    """A third of all conversations alike: their path is several splitters', and no shard holds them all."""
    paths = sorted((b"m" * 32, c) for c in range(300)) + sorted((bytes([c % 256]) * 16, c) for c in range(300, 900))
    keys = sorted(paths)
    skeleton = ct.Skeleton([keys[k * 900 // 12] for k in range(1, 12)])
    shards = [skeleton.shard(*p) for p in paths[:300]]
    assert max(shards.count(s) for s in set(shards)) <= 80
    assert len({skeleton.nodes(s, b"m" * 32)[-1] for s in set(shards)}) == 1  # one node of the skeleton for all its shards


def test_shared():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (b"".join(rng.choice([b"x" * 16, b"y" * 16]) for _ in range(rng.randint(0, 9))) for _ in "ab")
        n = next((k for k in range(10) if a[16 * k:16 * k + 16] != b[16 * k:16 * k + 16] or len(a) <= 16 * k), 9)
        assert ct.shared(a, b) == n

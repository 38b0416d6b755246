"""Each operator on small tables: edge rows, and a plain version of what it promises."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lociweave.llm import bpe, bwt_merge, decontaminate, html_text, minmax, pii, pivots, quality, suffix_trees, toxicity
from lociweave.llm.components import components

WORDS = [a + b for a in ("ba", "re", "mo", "ti", "lu", "ka") for b in ("n", "ster", "l", "rio", "s")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_rows():
    rng = random.Random(4)
    base = [prose(rng, 120) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, " \t\n "), (3, "one"), (4, "Zwölf ß 日本 \x00 word"), (5, base[0]), (6, base[0]), (6, base[0]), (7, base[0] + " tail"),
            (8, base[1]), (None, base[1]), (9, " ".join(["the"] * 400)), (10, "x" * 30000), (11, base[2] + " " + base[3]), (12, base[3] + " " + base[2]), (13, "a b c")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    """Edge rows with further columns whose names the operators use themselves."""
    df = spark.createDataFrame(edge_rows(), "doc_id long, text string")
    for name in ("node", "g", "key", "score", "spans", "n", "_row", "component", "start", "base"):
        df = df.withColumn(name, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def no_docs(docs):
    return docs.where("false")


def found(df, *keys):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r[:2]))


# ---------------------------------------------------------------- components

def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randint(0, 200), rng.randint(0, 200)) for _ in range(120)] + [(1000 + k, 1001 + k) for k in range(60)] + [(5, 5)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in pairs:
        if a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- html

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var x="</p>";</script></head><body>
<nav><ul><li>Home</li></ul></nav><div class="ad">Buy</div><!-- <p>no</p> --><article><header><h1>Big &amp; small</h1></header>
<p>First <b>bold</b>&nbsp;text<br>goes   on</p><div class="comments"><p>nice!</p></div><p>{0}</p></article><aside>x</aside><footer>&copy; y</footer></body></html>"""
PLAIN = "<html><body><p>Welcome to the site</p><p>{0}</p><p>Another {0}</p><p>All about us</p></body></html>"


def test_html(spark):
    rows = [(1, "http://a.org/x/1", PAGE.format("same")), (2, "http://a.org/x/2", PAGE.format("same")), (3, "http://b.org/n/1", PLAIN.format("cats")),
            (4, "http://b.org/n/2", PLAIN.format("dogs")), (5, "http://b.org/n/2", PLAIN.format("dogs")), (6, None, None), (7, "no url", ""), (8, "http://c.org/", PLAIN.format("owls")),
            (9, "http://d.org/", "plain & simple &lt;text"), (10, "http://d.org/a", "<p>" * 3000 + "deep" + "<nav>never closed <p>gone</p>"), (None, None, "<p>q</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("x")).coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", 1)  # one range, so that every host is whole
    try:
        got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
    article = "Big & small\nFirst bold text goes on\nsame"
    assert got[1] == got[2] == article  # a named article keeps lines that its neighbour has too
    assert got[3] == "cats\nAnother cats" and got[4] == got[5] == "dogs\nAnother dogs"
    assert got[6] == got[7] == "" and got[None] == "q"
    assert got[8] == "Welcome to the site\nowls\nAnother owls\nAll about us"
    assert got[9] == "plain & simple <text" and got[10] == "deep"
    assert html_text.extract(df.where("false")).count() == 0


def test_transforms_are_merged_several_symbols_a_round(monkeypatch):
    """A round of the merge deals by as many symbols as fit beside an entry's place; the classes are those of equal windows."""
    rounds = []
    turn = bwt_merge._in_turn
    monkeypatch.setattr(bwt_merge, "_in_turn", lambda *a: rounds.append(1) or turn(*a))
    rng = random.Random(7)
    for symbols in ("ab", "abcdefgh \xff"):
        base = "".join(rng.choice(symbols) for _ in range(4000)).encode("latin-1")
        contents = [base[a:a + rng.randrange(50, 400)] for a in (rng.randrange(3600) for _ in range(60))] + [b"a" * 300]
        windows = [c[i:i + 50] for c in contents for i in range(len(c) - 49)]
        rounds.clear()
        got = bwt_merge.classes(contents).tolist()
        assert len(got) == len(windows) and len(set(zip(got, windows))) == len(set(got)) == len(set(windows))
        assert len(rounds) <= 10  # 22 when two symbols were dealt a round
    places, key = bwt_merge._in_order(np.array([5, 1, 5, 0], np.uint64), 64)
    assert places.tolist() == [3, 1, 0, 2] and key.tolist() == [0, 1, 5, 5]


def test_a_round_of_the_merge_deals_by_a_run(monkeypatch):
    """16 symbols a round, as the rank of their run: three rounds from 16 to 50 bytes, and the blocks are read once."""
    rounds, turn, rng = [], bwt_merge._in_turn, random.Random(8)
    monkeypatch.setattr(bwt_merge, "_in_turn", lambda *a: rounds.append(1) or turn(*a))
    base = bytes(rng.choice(b"ab\0") for _ in range(3000))
    contents = list(dict.fromkeys(base[a:a + rng.randrange(50, 300)] for a in (rng.randrange(2700) for _ in range(60))))
    windows = [c[i:i + 50] for c in contents for i in range(len(c) - 49)]
    got = bwt_merge.classes(contents).tolist()
    assert len(set(zip(got, windows))) == len(set(got)) == len(set(windows))
    assert len(rounds) <= 4
    text, left = np.frombuffer(b"abcdefghij", np.uint8), np.array([7, 6, 5, 4, 3, 2, 1, 3, 2, 1])
    assert [int(x).to_bytes(8, "big") for x in bwt_merge._eight(text, left)] == [bytes(text[k:k + n]).ljust(8, b"\0") for k, n in enumerate(left)]


def test_differencing_decides_among_named_articles(spark):
    """An article element that the neighbour has too is template; a passage that two articles share stays."""
    page = lambda own: (f"<body><nav>Menu</nav><p>Site</p><article><h1>{own}</h1><p>A shared passage</p><p>{own} ends</p></article>"  # noqa: E731
                        "<article><h2>Read next</h2><p>The same teaser</p></article></body>")
    rows = [(1, "http://h/a/1", page("One")), (2, "http://h/a/2", page("Two")),
            (3, "http://k/a/1", page("Alone")),
            # all that is named is shared: the elements stay whole
            (4, "http://m/a/1", "<p>x</p><article><p>Same text</p></article>"), (5, "http://m/a/2", "<p>y</p><article><p>Same text</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got[1] == "One\nA shared passage\nOne ends" and got[2] == "Two\nA shared passage\nTwo ends"
    assert got[3] == "Alone\nA shared passage\nAlone ends\nRead next\nThe same teaser"
    assert got[4] == got[5] == "Same text"


def test_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        for most in (1 << 20, 4):
            c = html_text.common(a, b, most)
            rest = iter(b)
            assert len(c) == table[-1][-1] and c == sorted(set(c)) and all(any(a[k] == y for y in rest) for k in c)


# ---------------------------------------------------------------- classifiers

def learnable(spark, bad):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(400):
        y = k % 4 == 0
        rows.append((k, bad(rng) if y else prose(rng, rng.randint(20, 80))))
        labels.append((k, int(not y), int(y)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def on_held_out(df, labels, label):
    rows = df.join(labels, "doc_id").where("held_out").select("predicted", label).collect()
    assert len(rows) > 50
    return sum(r.predicted == r[label] for r in rows) / len(rows)


def test_quality(spark, docs, no_docs):
    texts, labels = learnable(spark, lambda rng: " ".join(w.upper() + "!!" for w in prose(rng, 40).split()))
    assert on_held_out(quality.scored(texts, labels), labels, "quality") > 0.95
    got = quality.scored(docs, labels.withColumn("score", F.lit(1))).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert {r.score for r in quality.scored(docs, labels.where("false")).collect()} == {0.5}
    assert quality.scored(no_docs, labels).count() == 0


def test_pairs_in_linear_time():
    rng = np.random.default_rng(2)
    m = quality.Machine(0.3, rng.normal(size=30), rng.normal(size=(30, 4)))
    x = np.zeros(30)
    x[[2, 5, 11]] = rng.normal(size=3)
    rows = quality.Rows(np.array([2, 5, 11], np.int32), x[[2, 5, 11]], np.array([3]))
    slow = 0.3 + m.linear @ x + sum(m.factors[i] @ m.factors[j] * x[i] * x[j] for i in range(30) for j in range(i))
    assert abs(m.raw(rows)[0][0] - slow) < 1e-9


def test_toxicity(spark, docs, no_docs):
    texts, labels = learnable(spark, lambda rng: prose(rng, 30) + " " + rng.choice(["vilegus", "vilegorn", "grubbish"]))
    assert on_held_out(toxicity.scored(texts, labels), labels, "toxic") > 0.95
    got = toxicity.scored(docs, labels).collect()
    assert len(got) == len(edge_rows()) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert {r.score for r in toxicity.scored(docs, labels.where("toxic = 0")).collect()} == {0.0}
    assert toxicity.scored(no_docs, labels).count() == 0


def test_toxicity_sample_with_one_id_on_most_rows(spark, monkeypatch):
    """1,500 of 2,000 rows have one id: it supplies one text, whatever its rows."""
    free = [i for i in range(3000) if zlib.crc32(str(i).encode()) % 3 != 1]
    rows = [(free[0], f"copy {k}") for k in range(1500)] + [(i, f"text {i}") for i in free[1:501]]
    labels = spark.createDataFrame([(i, int(k % 2 == 0)) for k, i in enumerate(free[:200])], "doc_id long, toxic long")
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda columns, confirmed, prior: seen.append((len(columns), int(confirmed.sum()))))
    toxicity.train(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert seen == [(100 + 501, 100)]


def test_held_out(docs):
    for r in quality.score(docs, None).withColumn("h", quality.held_out(F.col("doc_id"))).collect():
        assert r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


# ---------------------------------------------------------------- personal data

PATTERNS = (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"))


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text):
            d = re.sub(r"[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 13 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0
                    or kind == "phone" and 9 <= len(d) <= 15):
                out.append((kind, *m.span()))
    return out


def test_base_spans():
    rng = random.Random(6)
    assert pii.base_spans("") == [] and pii.base_spans("é a.b@c.de+f@g.h") == plain_spans("é a.b@c.de+f@g.h")
    for _ in range(4000):
        t = "".join(rng.choice("a1.@+- ()0é9_4") for _ in range(rng.randint(0, 60)))
        assert pii.base_spans(t) == plain_spans(t), t
        t = "".join(rng.choice(["4041894974608795", "10.2.3.4", ".", " ", "+1 (988) 555-2485", "x@y.z", "-", "7", "300"]) for _ in range(rng.randint(1, 8)))
        assert pii.base_spans(t) == plain_spans(t), t


def test_semi_markov_field(spark):
    rng = random.Random(5)
    rows = [(k, prose(rng, 12) + rng.choice([" bo.tel@mail.example.com ", " 10.20.30.40 ", " 4041894974608795 ", " +1 (988) 555-2485 ", " "]) + prose(rng, 12)) for k in range(300)]
    field = pii.train(spark.createDataFrame(rows, "doc_id long, text string"))
    text = "write jo.ann [at] mail [dot] example [dot] org or (319) 555-5132 or to ka@mail.org now"
    base = pii.base_spans(text)
    spans = pii.all_spans(text, base, field)
    assert [text[a:b] for _, a, b in spans] == ["jo.ann [at] mail [dot] example [dot] org", "ka@mail.org", "(319) 555-5132"]
    assert set(base) <= set(spans)
    assert pii.mask(text, spans) == "write <EMAIL> or <PHONE> or to <EMAIL> now"
    # the chosen cutting is the best of all cuttings
    s = pii._stretch("at 10.2.3.4 b", 0, 13)
    scores = dict(zip(s.segments, field.scores(s)))

    def best(at, label):
        if at == len(s.tokens):
            return 0.0
        options = [field.follow[label, pii.OUT] + best(at + 1, pii.OUT)]
        options += [field.follow[label, k] + v + best(j, k) for (i, j, k), v in scores.items() if i == at]
        return max(options)
    value, label, at = 0.0, pii.OUT, 0
    for i, j, k in field.best(s):
        for _ in range(at, i):
            value, label = value + field.follow[label, pii.OUT], pii.OUT
        value, label, at = value + field.follow[label, k] + scores[i, j, k], k, j
    for _ in range(at, len(s.tokens)):
        value, label = value + field.follow[label, pii.OUT], pii.OUT
    assert abs(value - best(0, pii.OUT)) < 1e-9


def test_pii_edges(docs, no_docs):
    got = pii.find(docs, pii.train(docs)).collect()
    assert len(got) == len(edge_rows()) and all(r.base == [] for r in got)
    assert pii.train(no_docs) is None and pii.find(no_docs, None).count() == 0


# ---------------------------------------------------------------- decontamination

def test_decontamination(spark, docs, no_docs):
    rng = random.Random(9)
    items = [(k, prose(rng, 30)) for k in range(5)] + [(5, None), (6, ""), (7, "two words"), (8, "ranster mol tirio"), (None, prose(rng, 20))]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("words", F.lit("x"))
    edited = items[1][1].split()
    edited[5:6], edited[12:13], edited[20:21] = ["NEW"], [], ["more", "words"]
    texts = [(100, prose(rng, 300) + " " + items[0][1].upper() + ". " + prose(rng, 5000)), (101, prose(rng, 40) + " " + " ".join(edited) + " " + prose(rng, 40)),
             (102, items[0][1] + " and " + items[2][1]), (103, prose(rng, 500)), (104, "say ranster mol tirio"), (None, items[3][1]), (105, None), (105, "")]
    df = docs.select("doc_id", "text", "start").unionByName(spark.createDataFrame(texts, "doc_id long, text string").withColumn("start", F.lit(1).cast("string")))
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(df, bench).collect()}
    assert {(100, 0), (101, 1), (102, 0), (102, 2), (None, 3), (104, 8)} == set(got)
    assert got[100, 0] == 1.0 and 0.6 <= got[101, 1] < 1
    assert decontaminate.contaminated(no_docs, bench).count() == 0
    assert decontaminate.contaminated(docs, bench.where("false")).count() == 0


def test_copies_with_one_long_edit(spark):
    """Words inserted or rewritten near the middle of a copy, which as a whole still passes the threshold."""
    rng = random.Random(13)
    new = lambda n, tag: [f"{tag}{k}" for k in range(n)]
    items, docs = [], []
    for i, (size, cut_out, put_in) in enumerate([(59, 0, 25), (100, 0, 40), (100, 25, 25), (200, 35, 35), (40, 0, 30)]):
        words, at = new(size, f"i{i}x"), (size - cut_out) // 2
        items.append((i, " ".join(words)))
        docs.append((i, " ".join([prose(rng, 200), *words[:at], *new(put_in, f"d{i}x"), *words[at + cut_out:], prose(rng, 200)])))
    docs.append((5, " ".join([*items[0][1].split()[:30], *new(400, "far"), *items[0][1].split()[30:]])))  # too far apart
    got = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id): round(r.score, 2) for r in got} == {(0, 0): 0.79, (1, 1): 0.8, (2, 2): 0.62, (3, 3): 0.74, (4, 4): 0.62}


def test_common_edited_copies(spark):
    """A third of the documents hold one item with every fifth word replaced."""
    rng = random.Random(12)
    words = [f"w{k}" for k in range(60)]
    edited = " ".join("new" + w if k % 5 == 2 else w for k, w in enumerate(words))
    df = spark.createDataFrame([(k, prose(rng, 20) + " " + (edited if k % 3 == 0 else prose(rng, 40))) for k in range(1200)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    assert {r.doc_id for r in decontaminate.contaminated(df, bench).collect()} == set(range(0, 1200, 3))


def test_alignment():
    rng = random.Random(2)
    for _ in range(100):
        a, b = (np.array([rng.randint(0, 3) for _ in range(rng.randint(1, 9))]) for _ in range(2))
        h = np.zeros((len(a) + 1, len(b) + 1))
        for i in range(len(a)):
            for j in range(len(b)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if a[i] == b[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        assert decontaminate.align(a, b) == h.max()


# ---------------------------------------------------------------- tokens

def test_tokens(docs, no_docs):
    import public_tokenizers
    import tiktoken
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(path))}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.encode(docs, path, public_tokenizers.PATTERN, keep=("doc_id", "text")).collect()
    assert len(got) == len(edge_rows())
    for r in got:
        assert np.frombuffer(r.ids, "<u4").tolist() == plain.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
    codec = bpe.Codec(bpe.read_ranks(path), public_tokenizers.PATTERN)
    rng = random.Random(7)
    for _ in range(5000):
        t = "".join(rng.choice(["th", "in", "er", "at", "ion", " ", "é", "日", "x", "<|endoftext|>", "\n", "12", "'s"]) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(codec.encode(t), "<u4").tolist() == plain.encode_ordinary(t), t
    assert bpe.encode(no_docs, path, public_tokenizers.PATTERN).count() == 0


# ---------------------------------------------------------------- repeats

def plain_bytes(rows, length):
    rows = [(float("inf") if d is None else d, (t or "").encode()) for d, t in rows]
    least = {}
    for d, b in rows:
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            least[w] = min(least.get(w, d), d)
    out = []
    for d, b in rows:
        gone = set()
        for k in range(len(b) - length + 1):
            if least[b[k:k + length]] < d:
                gone.update(range(k, k + length))
        out.append((None if d == float("inf") else d, len(b), len(gone), sum(k - 1 not in gone for k in gone), bytes(x for k, x in enumerate(b) if k not in gone)))
    return out


def plain_words(rows, length):
    rows = [(d, (t or "").encode().split()) for d, t in rows]
    n = {}
    for _, w in rows:
        for k in range(len(w) - length + 1):
            n[tuple(w[k:k + length])] = n.get(tuple(w[k:k + length]), 0) + 1
    out = []
    for d, w in rows:
        gone = set()
        for k in range(len(w) - length + 1):
            if n[tuple(w[k:k + length])] > 1:
                gone.update(range(k, k + length))
        out.append((d, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def repeat_rows():
    rng = random.Random(12)
    base = [prose(rng, 90) for _ in range(6)]
    rows = edge_rows()
    for k in range(20, 80):
        parts = [rng.choice(base) if rng.random() < 0.5 else prose(rng, rng.randint(1, 60)) for _ in range(rng.randint(1, 4))]
        text = " ".join(parts).split()
        if rng.random() < 0.4:
            text[rng.randrange(len(text))] = "édit"
        rows.append((k, " ".join(text)))
    return rows


@pytest.mark.parametrize("hot", [20_000, 3])
def test_repeated_bytes(spark, monkeypatch, hot):
    from lociweave.llm import repeats
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = repeat_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("g", F.lit("x")).repartition(3)
    got = [(r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.spans), len(r.spans), bytes(r.kept)) for r in bwt_merge.remove_repeats(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(plain_bytes(rows, 50), key=key)
    assert bwt_merge.remove_repeats(df.where("false")).count() == 0


@pytest.mark.parametrize("hot", [20_000, 3])
def test_repeated_words(spark, monkeypatch, hot):
    from lociweave.llm import repeats
    monkeypatch.setattr(repeats, "HOT", hot)
    rows = repeat_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("x")).repartition(3)
    got = [(r.doc_id, r.n_words, sum(x.end - x.start for x in r.spans), bytes(r.kept)) for r in suffix_trees.remove_repeats(df).collect()]
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(got, key=key) == sorted(plain_words(rows, 35), key=key)
    assert suffix_trees.remove_repeats(df.where("false")).count() == 0


@pytest.mark.parametrize("method,length", [(bwt_merge, 50), (suffix_trees, 35)])
def test_equal_windows(method, length):
    rng = random.Random(2)
    for _ in range(20):
        base = [[rng.choice([b"a", b"bb", b"c"]) for _ in range(200)] for _ in range(3)]
        cut = [b[i:i + length + rng.randint(0, 60)] for b in (rng.choice(base) for _ in range(20)) for i in [rng.randint(0, 100)]] + [[b"the"] * 90]
        contents = list(dict.fromkeys(c for c in (b"".join(x) if length == 50 else b" ".join(x) for x in cut)))
        rows = [c if length == 50 else c.split(b" ") for c in contents]
        want = [tuple(r[k:k + length]) for r in rows for k in range(len(r) - length + 1)]
        got = method.classes(contents).tolist()
        assert len(got) == len(want) and len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_prefix_groups():
    words = np.array([1, 1, 1, 2, 1, 1, 3, 1, 2, 2, 0, 0, 0, 0])
    groups = suffix_trees.prefix_groups(words, np.arange(9), length=4, most=2)
    for at, depth in groups:
        assert len({tuple(words[a:a + depth]) for a in at}) == 1 and (len(at) <= 2 or depth == 4)


# ---------------------------------------------------------------- near duplicates

def plain_near(rows, width, percent):
    sets = []
    for _, t in rows:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
        sets.append({tuple(w)} if 0 < len(w) < width else {tuple(w[k:k + width]) for k in range(len(w) - width + 1)})
    comp = [d for d, _ in rows]
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and rows[i][0] is not None and rows[j][0] is not None and comp[i] > comp[j] and 100 * len(a & b) >= percent * len(a | b):
                    comp[i], changed = comp[j], True
    return [len(s) for s in sets], comp


def test_near_duplicates(spark, no_docs):
    rng = random.Random(21)
    rows = [r for r in edge_rows() if r[0] is not None]
    for k in range(30):
        text = prose(rng, 100).split()
        for c in range(rng.randint(1, 5)):
            rows.append((100 + 10 * k + c, " ".join(text)))
            text[rng.randrange(100)] = rng.choice(WORDS).upper()
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("bands", F.lit(1))
    size, comp = plain_near(rows, 4, 80)
    want = sorted((d, n, c, d == c) for (d, _), n, c in zip(rows, size, comp))
    assert sorted(tuple(r) for r in minmax.near_duplicates(df, 4, 80).collect()) == want
    with_null = minmax.near_duplicates(spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.component_id, r.kept) for r in with_null if r.doc_id is not None) == [(False, 1, True)]
    assert [(r.component_id, r.kept) for r in with_null if r.doc_id is None] == [(None, True)]
    assert minmax.near_duplicates(no_docs).count() == 0


def test_near_duplicates_of_a_large_group(spark, monkeypatch):
    """Copies of one text with up to a third of its shingles changed: exact links, while pairs that are listed grow with the rows."""
    rng = random.Random(8)
    base = prose(rng, 120).split()
    rows = []
    for k in range(300):
        text = list(base)
        for at in rng.sample(range(120), rng.randint(1, 14)):
            text[at] = f"{rng.choice(WORDS)}{k % 40}"
        rows.append((k, " ".join(text)))
    listed, confirmed = [], minmax._confirmed
    monkeypatch.setattr(minmax, "_confirmed", lambda pairs, *rest: listed.append(pairs.count()) or confirmed(pairs, *rest))
    size, comp = plain_near(rows, 4, 80)
    want = sorted((d, n, c, d == c) for (d, _), n, c in zip(rows, size, comp))
    assert 5 < len(set(comp)) < 295
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minmax.near_duplicates(df, 4, 80).collect()) == want
    assert sum(listed) <= 32 * len(rows)


def test_tiles_of_a_large_bucket(spark):
    """A bucket held against itself in many tiles gives the components of all its pairs, by one link for two components at most."""
    rng = np.random.default_rng(5)
    sets = {i: np.unique(rng.choice(80, 60, replace=False)).astype(np.uint64) for i in range(60)}
    inside = spark.createDataFrame([(1, i, 60, i, 0) for i in sets], "key long, node long, n long, c long, largest long")
    stored = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "node long, s binary")
    links = {(a, b) for a in sets for b in sets if a < b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 64 * len(np.union1d(sets[a], sets[b]))}

    def whole(pairs):
        comp = {i: i for i in sets}
        for _ in sets:
            for a, b in pairs:
                comp[a] = comp[b] = min(comp[a], comp[b])
        return comp

    for tile in (1 << 20, 700):
        got = {(min(r), max(r)) for r in minmax._confirmed_in_tiles(inside, stored, 64, tile).collect()}
        assert got <= links and whole(got) == whole(links)
        assert tile == 700 or len(got) == len(sets) - len(set(whole(links).values()))


def test_near_vectors(spark):
    rng = np.random.default_rng(4)
    rows, k = [], 0
    for _ in range(40):
        centre = rng.normal(size=32)
        for _ in range(int(rng.integers(1, 6))):
            rows.append((k, (centre + rng.normal(size=32) * 0.1).tolist(), int(rng.integers(0, 2))))
            k += 1
    rows += [(900, rows[0][1], rows[0][2]), (901, rows[0][1], None), (902, None, 1), (903, [0.0] * 32, 1), (904, [float("nan")] * 32, 1), (905, [None] * 32, 1),
             (906, [], 1), (907, [1.0, 2.0], 1), (908, [2.0, 4.0], 1), (909, rows[0][1], rows[0][2]), (None, rows[0][1], rows[0][2]), (910, [1e200, 0.0, 0.0], 1), (911, [1e-200, 0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit(1)).withColumn("key", F.lit(1))
    units = {i: pivots._unit(v) if lab is not None else None for i, v, lab in rows if i is not None}
    label = {i: lab for i, _, lab in rows}
    links = {i: [j for j, y in units.items() if j != i and x is not None and y is not None and label[i] == label[j] and len(x) == len(y) and x @ y >= 0.98] for i, x in units.items()}
    comp = {i: i for i in units}
    for _ in units:
        comp = {i: min([c, *(comp[j] for j in links[i])]) for i, c in comp.items()}
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pivots.near_duplicates(df).collect()}
    assert got.pop(None) == (0, None, True)
    assert got == {i: (len(links[i]), comp[i], comp[i] == i) for i in units}
    assert pivots.near_duplicates(df.where("false")).count() == 0


def test_index_recall(spark):
    """At least 0.9 of the links that brute force finds among many noisy groups."""
    rng = np.random.default_rng(11)
    rows = [(8 * k + c, (centre + rng.normal(size=64) * 0.11).tolist(), 0) for k, centre in enumerate(rng.normal(size=(150, 64))) for c in range(8)]
    x = np.array([pivots._unit(v) for _, v, _ in rows])
    true = (x @ x.T >= 0.98).sum(axis=1) - 1
    got = {r.vec_id: r.n_links for r in pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    found = np.array([got[i] for i, _, _ in rows])
    assert (found <= true + 1).all() and found.sum() >= 0.9 * true.sum() > 100


def test_dense_group_recall(spark):
    """Nearly all links of distinct near copies that hold a third of the rows."""
    rng = np.random.default_rng(12)
    centre = rng.normal(size=16)
    x = np.vstack([centre + rng.normal(size=(400, 16)) * 0.13, rng.normal(size=(800, 16))])
    units = np.array([pivots._unit(v) for v in x.tolist()])
    true = (units @ units.T >= 0.98).sum() - len(x)
    df = spark.createDataFrame([(k, v, 0) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    found = sum(r.n_links for r in pivots.near_duplicates(df).collect())
    assert true > 50_000 and 0.99 * true <= found <= true + 2


def test_long_lists_in_chunks(spark):
    """Lists dealt over many tasks give each link once, and no more rows than lists that a vector is in, however many links."""
    rng = np.random.default_rng(13)
    centre = rng.normal(size=16)
    x = np.vstack([centre + rng.normal(size=(300, 16)) * 0.05, rng.normal(size=(300, 16))]).astype(np.float32)
    x[310:330] = x[5]
    units = np.array([pivots._unit(v) for v in x.tolist()])
    true = (units @ units.T >= 0.98).sum(axis=1) - 1
    df = spark.createDataFrame([(k, v, 0) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<float>, label int")
    for chunk in (1 << 16, 70):
        got = {r.vec_id: (r.n_links, r.component_id) for r in pivots.near_duplicates(df, chunk=chunk).collect()}
        assert [got[k][0] for k in range(len(x))] == true.tolist() and {got[k][1] for k in range(300)} == {0}
    counts, parent = pivots.links_of(units, np.zeros(len(x), np.int64), np.ones(len(x), np.int64), 0, 0.98)
    assert counts.tolist() == true.tolist() and (parent[:300] == 0).all()


def test_recall_where_all_lie_close(spark):
    """Vectors of mean cosine 0.9, a third of them in one dense group: few points lie apart."""
    rng = np.random.default_rng(1)
    mean = rng.normal(size=64)
    x = rng.normal(size=(1500, 64)) / 3 * np.linalg.norm(mean) / 8 + mean
    x[:500] = x[0] + rng.normal(size=(500, 64)) / 8 * 0.12 * np.linalg.norm(x[0])
    units = np.array([pivots._unit(v) for v in x.tolist()])
    true = (units @ units.T >= 0.98).sum() - len(x)
    df = spark.createDataFrame([(k, v, 0) for k, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    found = sum(r.n_links for r in pivots.near_duplicates(df).collect())
    assert true > 100_000 and 0.99 * true <= found <= true


# ---------------------------------------------------------------- pipeline

def test_stages_decide_by_row(spark, folder):
    """Repeated and null ids: a row goes for its own text only, and one of equal rows stays."""
    rng = random.Random(14)
    a, b, c, d, item = (prose(rng, 60) for _ in range(5))
    near = b + " tail"
    df = spark.createDataFrame([(3, b), (5, a), (5, near), (6, c), (6, c), (7, ""), (7, None), (None, d), (None, b)], "doc_id long, text string")
    got = corpus_pipeline.near_duplicates(spark, df, folder)
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(3, b), (5, a), (6, c), (7, ""), (7, None), (None, d)], key=str)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    df = spark.createDataFrame([(None, item), (1, a), (1, a + " " + item), (None, b)], "doc_id long, text string")
    assert sorted(map(tuple, corpus_pipeline.decontamination(spark, df, folder).collect()), key=str) == sorted([(1, a), (None, b)], key=str)

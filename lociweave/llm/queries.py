"""Queries of the text operators over the whole tables, with production parameters, and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if check is not None:
            CHECKS[name] = check
        return fn
    return add


@query("op6_byte_bpe")
def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from . import bpe

    coded = bpe.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op2_factorisation_quality")
def factorisation_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality

    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query("op4_nnpu_toxicity")
def nnpu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


#: Pages whose article is marked up by p, h1, b, br and a alone, as those of the tables are.
ARTICLE_SQL = r"""with a as (select page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') as x from pages),
  b as (select page_id, url, list_filter(list_transform(regexp_split_to_array(x, '</?(?:p|h1)>'), lambda t: trim(regexp_replace(replace(replace(
    regexp_replace(replace(t, '<br>', ' '), '<[^>]*>', '', 'g'), '&quot;', '"'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda t: t <> '') as l from a)
  select page_id, url, array_to_string(l, chr(10)) as text, length(array_to_string(l, chr(10))) as n_chars from b"""


@query("op1_nearest_url_difference", ARTICLE_SQL)
def nearest_url_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html_text

    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: For tables whose doc_id are different and not null.
NEAR_SQL = rf"""with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') as ws from documents),
  s as materialized (select distinct doc_id, array_to_string(ws[i:i + 3], ' ') as g from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) as i from w where len(ws) > 0)),
  n as materialized (select doc_id, count(*) as n from s group by 1),
  e as materialized (select a.doc_id as a, b.doc_id as b from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2
    having 100 * count(*) >= 80 * ((select n from n where doc_id = a.doc_id) + (select n from n where doc_id = b.doc_id) - count(*))),
  reach as (select doc_id as a, doc_id as b from documents union select r.a, e.b from reach r join e on e.a = r.b),
  c as (select a, min(b) as component_id from reach group by 1)
  select c.a as doc_id, coalesce(n.n, 0) as n_shingles, c.component_id, c.a = c.component_id as kept from c left join n on n.doc_id = c.a"""


@query("op9_min_max_hashing", NEAR_SQL)
def min_max_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import minmax

    return minmax.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


@query("op5_seeded_alignment")
def seeded_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate

    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _joined(spans: str) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


@query("op3_semi_markov_pii")
def semi_markov_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


@query("op10_pivot_permutations")
def pivot_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pivots

    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


def _removed() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])


BYTES_SQL = """with d as (select row_number() over () as r, doc_id, coalesce(doc_id, 9223372036854775807) as d, hex(coalesce(text, '')) as h from documents),
  w as (select r, d, i, substr(h, 2 * i - 1, 100) as k from (select r, d, h, unnest(range(1, length(h) // 2 - 48)) as i from d)),
  rep as (select r, i from (select r, i, d, min(d) over (partition by k) as m from w) where m < d),
  isl as (select r, i, sum(f) over (partition by r order by i) as g from (select r, i, case when i > lag(i) over (partition by r order by i) + 50 then 1 else 0 end as f from rep)),
  runs as materialized (select r, min(i) as a, max(i) + 50 as b from isl group by r, g),
  n as (select r, cast(sum(b - a) as bigint) as n_removed, count(*) as n_spans from runs group by 1),
  pieces as (select r, coalesce(lag(b) over (partition by r order by a), 1) as s, a as e from runs union all select r, max(b), 1000000000 from runs group by 1),
  kept as (select r, string_agg(substr(h, 2 * s - 1, 2 * (e - s)), '' order by s) as k from pieces join d using (r) group by 1)
  select doc_id, length(h) // 2 as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(k, h))) as kept_sha256
  from d left join n using (r) left join kept using (r)"""


@query("op7_bwt_merge", BYTES_SQL)
def bwt_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bwt_merge as method

    return method.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", _removed().alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


WORDS_SQL = r"""with d as (select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
  w as (select r, i, array_to_string(ws[i:i + 34], ' ') as k from (select r, ws, unnest(range(1, len(ws) - 33)) as i from d)),
  rep as (select r, i from (select r, i, count(*) over (partition by k) as n from w) where n > 1),
  gone as materialized (select distinct r, i + j as p from rep, range(0, 35) t(j)),
  n as (select r, count(*) as n_removed from gone group by 1),
  kept as (select t.r, string_agg(word, ' ' order by t.p) as k from (select r, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as p from d) t anti join gone g on g.r = t.r and g.p = t.p group by 1)
  select doc_id, len(ws) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(k, '')) as kept_sha256 from d left join n using (r) left join kept using (r)"""


@query("op8_prefix_suffix_trees", WORDS_SQL)
def prefix_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffix_trees

    return suffix_trees.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", _removed().alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))


def _draw(k: int) -> str:
    """Number k of an id's digest, in SQL."""
    return f"cast('0x' || substr(sha256('1:' || coalesce(cast(doc_id as varchar), '')), {8 * k - 7}, 8) as bigint)"


MIDDLE_SQL = f"""with d as (select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n, {', '.join(f'{_draw(k)} as h{k}' for k in (1, 2, 3, 4))} from documents),
  c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end as form from d),
  p as (select *, substr(t, 1, a) as p, substr(t, a + 1, b - a) as m, substr(t, b + 1, n - b) as s from c)
  select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars, case when form <> 'plain' then b - a end as middle_chars,
    sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
    sha256(t) as restored_sha256 from p"""


@query("op12_indexable_skip_list", MIDDLE_SQL)
def indexable_skip_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import fill_middle

    return fill_middle.transform(table(spark, sf_dir, "documents")).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


#: crc32 of the id's digits, a bit at a time.
_CRC_SQL = """xor(4294967295, list_reduce(list_concat([4294967295::bigint], list_transform(string_split(cast(c as varchar), ''), lambda x: ascii(x)::bigint)),
  lambda e, b: list_reduce(list_concat([xor(e, b)], range(8)), lambda x, i: xor(x >> 1, (x & 1) * 3988292384::bigint))))"""
TRIE_SQL = f"""with t as (select conv_id as c, turn, sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) as k, length(coalesce(text, '')) as n
    from conversations where conv_id is not null),
  own as materialized (select c, list({{'k': k, 'n': n}} order by turn nulls first, k) as o, {_CRC_SQL} % 6 as h from t group by c),
  paths as materialized (select o.c, list_concat(coalesce(b.o[1:o.h], []), o.o[o.h + 1:]) as p from own o left join own b on b.c = o.c - o.c % 100),
  pre as (select c, d, len(p) = d as last, coalesce(array_to_string(list_transform(p[1:d], lambda x: x.k), ''), '') as key, case when d > 0 then p[d].n else 0 end as size
    from (select c, p, unnest(range(0, len(p) + 1)) as d from paths)),
  node as materialized (select d, key, min(c) as conv_id, count(*) as n_convs, max(size) as size, coalesce(string_agg(case when last then cast(c as varchar) end, ',' order by c), '') as ends from pre group by d, key),
  kids as (select d - 1 as d, left(key, 64 * (d - 1)) as key, count(*) as n from node where d > 0 group by 1, 2),
  full_node as materialized (select node.*, coalesce(kids.n, 0) as n_children from node left join kids on node.d = kids.d and node.key = kids.key),
  below as (select a as d, left(key, 64 * a) as key, count(*) filter (n_children = 0) as n_leaves, sum((n_convs - 1) * size)::bigint as saved_tokens
    from (select *, unnest(range(0, d + 1)) as a from full_node) group by 1, 2)
  select f.conv_id, f.d as depth, p.conv_id as parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, sha256(f.ends) as ends_sha256
  from full_node f join below b on b.d = f.d and b.key = f.key left join node p on p.d = f.d - 1 and p.key = left(f.key, 64 * (f.d - 1))"""


@query("op11_splitter_skeleton", TRIE_SQL)
def splitter_skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import conversation_trie as method

    return method.trie(method.forked(method.sequences(table(spark, sf_dir, "conversations"))))


@query("op13_randomness_battery")
def randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import secret_scan

    docs = table(spark, sf_dir, "documents")
    found = secret_scan.find(docs, secret_scan.thresholds(docs))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, secret_scan.KINDS[:3]), F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))

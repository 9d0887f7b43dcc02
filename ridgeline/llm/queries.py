"""The registered queries of the operators and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ridgeline.llm import embeddings, exact_dedup, language, licenses, manifest, minhash, mixing, packing, prefixes, secrets, substrings, suffixes, toxicity
from ridgeline.llm.common import read_table, ship

JOBS: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(job):
        def shipped(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return job(spark, sf_dir)

        JOBS[name] = shipped
        if sql is not None:
            SQL[name] = sql
        return shipped

    return add


@query(
    "op9_exact_dedup",
    """
    with t as (
      select doc_id, length(coalesce(text, '')) as n,
             sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g')) as sha
      from documents),
    r as (
      select *, count(*) over (partition by sha) as group_size,
             first_value(doc_id) over (partition by sha order by n desc, doc_id) as keep_id
      from t)
    select doc_id, keep_id, cast(group_size as bigint) as group_size, doc_id = keep_id as kept, sha as text_sha256 from r
    """,
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decide(read_table(spark, sf_dir, "documents")).drop("text_key")


#: The tokenizer of the packed sequences.
TOKENIZER = "byte_bpe_50k.json"


def _tokenizers():
    """The public tokenizer files of this installation; another one passes its own paths to the operators."""
    import public_tokenizers

    return public_tokenizers


def tokenizer_path(name: str) -> str:
    return _tokenizers().path(name)


@query("op3_license_scan")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.digest(licenses.scan(read_table(spark, sf_dir, "documents")))


@query("op4_secret_scan")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _tokenizers()
    return secrets.digest(secrets.scan(read_table(spark, sf_dir, "documents"), files.path("byte_bpe_50k.tiktoken"), files.PATTERN))


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))


#: Target shares of the sources in the training mix.
WEIGHTS = {"src0": 0.20} | {f"src{i}": 0.05 for i in range(1, 10)} | {f"src{i}": 0.035 for i in range(10, 20)}


@query("op10_source_mix")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"), WEIGHTS).drop("order")


@query("op6_minhash_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents")).drop("text_key")


@query(
    "op1_embedding_near_dedup",
    """
    with recursive v as (
      select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
      where embedding is not null and len(embedding) > 0
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0),
    l as (
      select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
      where list_cosine_similarity(a.e, b.e) >= 0.95),
    r as (
      select vec_id as id, vec_id as c from embeddings
      union
      select l.b, r.c from r join l on r.id = l.a),
    n as (select a, count(*) as n from l group by a),
    m as (select id, min(c) as c from r group by id)
    select e.vec_id, coalesce(n.n, 0) as n_links, m.c as component_id, e.vec_id = m.c as kept
    from embeddings e join m on m.id = e.vec_id left join n on n.a = e.vec_id
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(read_table(spark, sf_dir, "embeddings"))


@query(
    "op5_substring_dedup",
    """
    with t as (
      select doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
    p as (
      select doc_id, i, array_to_string(list_slice(w, i, i + 12), ' ') as g
      from (select doc_id, w, unnest(range(1, len(w) - 11)) as i from t where len(w) >= 13)),
    m as (select g, min(doc_id) as d from p group by g),
    r as (select distinct p.doc_id, p.i + k.range as i from p join m using (g), range(13) k where m.d < p.doc_id),
    x as (select doc_id, list(i) as gone from r group by doc_id)
    select t.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(gone), 0) as bigint) as n_removed,
           sha256(coalesce(array_to_string(list_filter(w, lambda v, i: not coalesce(list_contains(gone, i), false)), ' '), '')) as kept_sha256
    from t left join x using (doc_id)
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.dedup(read_table(spark, sf_dir, "documents")))


@query("op7_suffix_dedup")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.dedup(read_table(spark, sf_dir, "documents")))


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read_table(spark, sf_dir, "labels")))


#: The unsigned CRC-32 of a decimal number in DuckDB, which has no function for it: bit by bit over the digits.
CRC32 = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(cast({} as varchar), ''), lambda ch: cast(ascii(ch) as bigint))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::bigint)"""


def _sql_field(name: str) -> str:
    return f"coalesce(strlen(cast({name} as varchar)) || ':' || cast({name} as varchar), '-')"


_SQL_LEAF = "sha256(" + " || ".join(_sql_field(c) for c in ("doc_id", "source", "lang", "n_chars")) + " || coalesce(strlen({0}) || ':' || {0}, '-'))"


@query(
    "op11_merkle_manifest",
    f"""
    with recursive held as (
      select *, case when {CRC32.format('doc_id')} % 3 = 0 then translate(text, '{manifest.UPPER}', '{manifest.LOWER}') else text end as claim from documents),
    leaf as (
      select doc_id, {_SQL_LEAF.format('text')} as leaf, {_SQL_LEAF.format('claim')} as held,
             dense_rank() over (order by lang nulls first) - 1 as g, count(*) over (partition by lang) as n,
             row_number() over (partition by lang order by doc_id) - 1 as pos from held),
    tree(g, lvl, idx, n, h) as (
      select g, 0, pos, n, leaf from leaf
      union all
      select g, lvl + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' order by idx)) from tree where n > 1 group by g, lvl, idx // 8),
    runs as (select g, lvl, idx // 8 as run, max(n) as n, list(h order by idx) as hs from tree where n > 1 group by g, lvl, idx // 8),
    subs as (select g, h as subroot, count(*) over () as n from tree where n = 1),
    top(lvl, idx, n, h) as (
      select 0, g, n, subroot from subs
      union all
      select lvl + 1, idx // 8, (max(n) + 7) // 8, sha256(string_agg(h, '' order by idx)) from top where n > 1 group by lvl, idx // 8),
    top_runs as (select lvl, idx // 8 as run, list(h order by idx) as hs from top where n > 1 group by lvl, idx // 8),
    climb(doc_id, leaf, g, n, lvl, idx, f, proof) as (
      select doc_id, leaf, g, n, 0, pos, held, '' from leaf
      union all
      select c.doc_id, c.leaf, c.g, (c.n + 7) // 8, c.lvl + 1, c.idx // 8,
             sha256(array_to_string(list_transform(r.hs, lambda x, i: case when i = c.idx % 8 + 1 then c.f else x end), '')),
             c.proof || array_to_string(list_filter(r.hs, lambda x, i: i <> c.idx % 8 + 1), '')
      from climb c join runs r on r.g = c.g and r.lvl = c.lvl and r.run = c.idx // 8 where c.n > 1),
    over(doc_id, leaf, g, n, lvl, idx, f, proof) as (
      select c.doc_id, c.leaf, c.g, (select count(*) from subs), 0, c.g, c.f, c.proof from climb c where c.n = 1
      union all
      select c.doc_id, c.leaf, c.g, (c.n + 7) // 8, c.lvl + 1, c.idx // 8,
             sha256(array_to_string(list_transform(r.hs, lambda x, i: case when i = c.idx % 8 + 1 then c.f else x end), '')),
             c.proof || array_to_string(list_filter(r.hs, lambda x, i: i <> c.idx % 8 + 1), '')
      from over c join top_runs r on r.lvl = c.lvl and r.run = c.idx // 8 where c.n > 1)
    select o.doc_id, o.leaf, s.subroot, t.h as root, sha256(o.proof) as proof_sha256, o.f as folded_root, o.f = t.h as verified
    from over o join subs s on s.g = o.g, top t where o.n = 1 and t.n = 1
    """,
)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return manifest.verify(manifest.build(docs, {"text": manifest.tampered_text()}), docs)


#: The pieces of language identification.
VOCABULARY = "byte_bpe_multi_50k.tiktoken"


@query("op12_language_id")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs, tokenizer_path(VOCABULARY)))


@query(
    "op13_prefix_trie",
    f"""
    with t as (
      select conv_id, coalesce(role, '') as r, coalesce(text, '') as x,
             row_number() over (partition by conv_id order by turn nulls first) - 1 as pos, count(*) over (partition by conv_id) as n
      from conversations where conv_id is not null),
    c as (select distinct conv_id, n from t),
    k as (
      select c.conv_id, c.conv_id - c.conv_id % 100 as base, {CRC32.format('c.conv_id')} % 6 as h, least({CRC32.format('c.conv_id')} % 6, coalesce(b.n, 0)) as kept
      from c left join c b on b.conv_id = c.conv_id - c.conv_id % 100),
    s as (
      select k.conv_id, t.pos as pos, r, x from k join t on t.conv_id = k.base and t.pos < k.kept
      union all
      select k.conv_id, k.kept + t.pos - k.h, r, x from k join t on t.conv_id = k.conv_id and t.pos >= k.h),
    p as (
      select conv_id, pos + 1 as d, length(x) as points,
             string_agg(length(r) || ':' || r || length(x) || ':' || x, '' order by pos) over (partition by conv_id order by pos) as seq from s
      union all
      select conv_id, 0, 0, '' from c),
    n as (select d, seq, min(conv_id) as m, count(*) as n_convs, max(points) as points from p group by d, seq),
    w as (select p.conv_id, p.d, n.m, p.d = max(p.d) over (partition by p.conv_id) as last from p join n on n.d = p.d and n.seq = p.seq),
    e as (select m, d, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as sha from w where last group by m, d),
    u as (select n.*, w.m as up from n left join w on w.conv_id = n.m and w.d = n.d - 1),
    ch as (select up as m, d - 1 as d, count(*) as n_children from u where d > 0 group by up, d),
    v as (select u.*, coalesce(ch.n_children, 0) as n_children from u left join ch on ch.m = u.m and ch.d = u.d),
    roll as (
      select w.m, w.d, count(*) filter (v.n_children = 0) as n_leaves, sum((v.n_convs - 1) * v.points) as saved
      from v join w on w.conv_id = v.m and w.d <= v.d group by w.m, w.d)
    select v.m as conv_id, cast(v.d as bigint) as depth, v.up as parent_conv_id, v.n_convs, v.n_children, roll.n_leaves,
           cast(roll.saved as bigint) as saved_tokens, coalesce(e.sha, sha256('')) as ends_sha256
    from v join roll on roll.m = v.m and roll.d = v.d left join e on e.m = v.m and e.d = v.d
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.trie(read_table(spark, sf_dir, "conversations"))


# op6 in SQL: sets as lists of distinct shingles, links by counting shared ones.
SQL["op6_minhash_near_dedup"] = """
    with recursive t as (
      select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents),
    s as (
      select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as g
      from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as i from t where len(w) > 0)),
    n as (select doc_id, count(*) as n from s group by doc_id),
    p as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
    l as (select a, b from p join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
    r as (select doc_id as id, doc_id as c from documents union select l.b, r.c from r join l on r.id = l.a),
    m as (select id, min(c) as c from r group by id)
    select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, m.c as component_id, d.doc_id = m.c as kept
    from documents d join m on m.id = d.doc_id left join n on n.doc_id = d.doc_id
"""

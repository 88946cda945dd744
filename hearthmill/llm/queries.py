"""The numbered operators over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthmill.llm import chat, contamination, language, licenses, line_dedup, masked_lm, merkle, mixing, near_dedup, simhash, top_k, urls, whitening
from hearthmill.llm.common import shared_read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


@query()
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared_read(spark, sf_dir, "documents")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    field = language.fit(language.training_rows(docs, keep=~held_out))
    labelled = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), language.language_column(docs, field).alias("p"))
    return labelled.select("doc_id", "held_out", "p.lang_pred", "p.score", "p.n_words")


@query()
def op2_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared_read(spark, sf_dir, "documents")
    counts = masked_lm.word_counts(docs)
    return masked_lm.word_likelihoods(docs, masked_lm.train(docs, counts=counts), counts)


@query(
    """
with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id as vec_id, list_inner_product(q.v, c.v)::bigint as score
      from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""
)
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = top_k.integer_vectors(shared_read(spark, sf_dir, "embeddings"))
    return top_k.top_k(vectors, F.col("vec_id") % 100 == 0, 10)


WORDS_SQL = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    f"""
with d as (select doc_id, coalesce({WORDS_SQL.format("text")}, []) as w from documents),
b as (select cast(item_id as varchar) as item, {WORDS_SQL.format("text")} as w from benchmark),
win as (select distinct item, w[s:s + 12] as v, len(w[s:s + 12]) as n
        from (select item, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) as s from b where len(w) > 0)),
firsts as (select distinct v[1] as f, n from win),
pos as (select doc_id, unnest(generate_series(1, len(w))) as p, unnest(w) as f from d),
hit as (select pos.doc_id, pos.p, firsts.n, d.w[pos.p:pos.p + firsts.n - 1] as v
        from pos join firsts using (f) join d using (doc_id)),
occ as (select hit.doc_id, hit.p, hit.n, win.item from hit join win on hit.v = win.v),
covered as (select doc_id, count(distinct q) as n_hit
            from (select doc_id, unnest(generate_series(p, p + n - 1)) as q from occ) group by doc_id),
items as (select doc_id, count(distinct item) as n_items, sha256(string_agg(distinct item, ',' order by item)) as h
          from occ group by doc_id)
select d.doc_id, len(d.w) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(i.n_items, 0) as n_items,
       coalesce(i.h, sha256('')) as items_sha256,
       coalesce(c.n_hit, 0) > 0 and 20 * coalesce(c.n_hit, 0) >= len(d.w) as contaminated
from d left join covered c using (doc_id) left join items i using (doc_id)
"""
)
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.contaminated_words(shared_read(spark, sf_dir, "documents"), shared_read(spark, sf_dir, "benchmark"))
    ids = F.coalesce(F.array_join("item_ids", ","), F.lit(""))
    return found.select(
        "doc_id", "n_words", "n_hit", F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"), contamination.is_contaminated().alias("contaminated"),
    )


@query()
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = shared_read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mixed_rows(docs).select("doc_id", "source", "mix_copy", "mix_position")


@query(
    r"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                  unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) as i from documents),
k as (select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from l),
f as (select key, max(doc_id) as keeper from k where length(key) >= 40 group by key having count(distinct doc_id) >= 5),
m as (select k.doc_id, k.i, k.line, f.key is not null and k.doc_id <> f.keeper as gone from k left join f using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) as kept_sha256
from m group by doc_id
"""
)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = line_dedup.with_lines_dropped(shared_read(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "__kept.n_lines", "__kept.n_dropped", F.sha2("__kept.text", 256).alias("kept_sha256"))


@query(
    r"""
with recursive d as (select doc_id, regexp_extract_all(
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select distinct doc_id, hash(w[i:i + 3]) as g
      from (select doc_id, w, unnest(generate_series(1, greatest(len(w) - 3, 1))) as i from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
x as (select a.doc_id as p, b.doc_id as q, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
link as (select p, q from x join n a on a.doc_id = p join n b on b.doc_id = q where 100 * c >= 80 * (a.n + b.n - c)),
reach(a, b) as (select doc_id, doc_id from d union select reach.a, link.q from reach join link on link.p = reach.b)
select d.doc_id, coalesce(n.n, 0) as n_shingles, r.c as component_id, r.c = d.doc_id as kept
from d left join n using (doc_id) join (select a, min(b) as c from reach group by a) r on r.a = d.doc_id
"""
)
def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(shared_read(spark, sf_dir, "documents"), gram=4)
    return found.select("doc_id", "n_shingles", "component_id", F.expr("doc_id <=> component_id").alias("kept"))


LICENSE_VALUES = ", ".join(f"('{name}', '{notice}')" for name, notice in licenses.TEMPLATES.items())
LICENSE_GRAMS = "list_distinct(case when len(w) = 1 then w else list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]) end)"


@query(
    f"""
with t as (select license, {LICENSE_GRAMS} as g from (select col0 as license, {WORDS_SQL.format("col1")} as w from (values {LICENSE_VALUES}))),
l as (select doc_id, unnest(string_split(text, chr(10))) as body, unnest(generate_series(0, len(string_split(text, chr(10))) - 1)) as line from documents),
c as (select doc_id, line, {LICENSE_GRAMS} as g from (select doc_id, line, {WORDS_SQL.format("body")} as w from l) where len(w) > 0),
x as (select doc_id, line, license, 2.0::double * len(list_intersect(c.g, t.g)) / (len(c.g) + len(t.g)) as dice
      from c join t on len(c.g) between 0.6 * len(t.g) and 1.7 * len(t.g)),
m as (select * from x where dice >= 0.8),
b as (select *, row_number() over (partition by doc_id order by dice desc, line, license) as r, count(*) over (partition by doc_id) as n from m),
n as (select doc_id, count(distinct line) as n_lines from m group by doc_id)
select d.doc_id, b.license, b.dice, b.line, coalesce(n.n_lines, 0) as n_lines
from documents d left join b on b.doc_id = d.doc_id and b.r = 1 left join n on n.doc_id = d.doc_id
"""
)
def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.document_licenses(shared_read(spark, sf_dir, "documents"))


@query(
    r"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, length(regexp_replace(role, '([<\[\\])', '\1\\', 'g')) + length(regexp_replace(text, '([<\[\\])', '\1\\', 'g')) as n from c)
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(n + 20)::bigint as formatted_chars
from e group by conv_id
"""
)
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    rows = shared_read(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(chat.linear_messages(rows.union(extra)))
    read = formatted.withColumns({"turns": chat.read_back(), "loss": chat.loss_text()})
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.select(
        F.col("tree").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(digest, 256).alias("turns_sha256"),
        F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = urls.train(urls.labelled_urls(spark))
    pages = shared_read(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judged(pages, weights).select("page_id", "host", "path", "rule", "verdict", F.round("chance", 6).alias("chance"))


@query()
def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(shared_read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


def _merkle_sql(levels: int) -> str:
    """SQL of the manifest: leaf, then level by level the parent runs of every source, and of the sources."""
    field = "case when {0} is null then '-' else strlen({0}::varchar)::varchar || ':' || {0}::varchar end"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    fields = [field.format(name) for name in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf, shown = " || ".join(fields), " || ".join([*fields[:4], field.format(low)])
    crc = "xor(list_reduce(string_split(doc_id::varchar, ''), lambda a, c: xor(a >> 8, t.t[(xor(a, ascii(c)) & 255) + 1]), 4294967295::bigint), 4294967295)"
    parts = [
        f"""t as (select list(v order by i) as t from (select i, list_reduce(range(8),
               lambda a, k: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, i::bigint) as v from range(256) r(i))),
leaves as (select doc_id, sha256({leaf}) as leaf, case when {crc} % 5 = 0 then sha256({shown}) else sha256({leaf}) end as shown,
                  coalesce('s' || source, 'n') as tree from documents, t),
placed as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos from leaves),
a0 as (select tree, pos, leaf as digest from placed)"""
    ]

    def reduced(name: str) -> None:
        for k in range(levels):
            parts.append(
                f"""{name}{k + 1} as (select tree, pos // 16 as pos, case when any_value(n) = 1 then any_value(digest) else sha256(string_agg(digest, '' order by pos)) end as digest
             from (select *, count(*) over (partition by tree) as n from {name}{k}) group by tree, pos // 16)"""
            )

    def steps(name: str) -> str:
        found = [
            f"""select {k} as level, tree, pos, coalesce(string_agg(digest, '' order by pos) over (partition by tree, pos // 16 order by pos rows between unbounded preceding and 1 preceding), '') as l,
                coalesce(string_agg(digest, '' order by pos) over (partition by tree, pos // 16 order by pos rows between 1 following and unbounded following), '') as r
                from (select *, count(*) over (partition by tree) as n from {name}{k}) where n > 1"""
            for k in range(levels)
        ]
        return " union all ".join(found)

    reduced("a")
    parts.append(f"b0 as (select 'all' as tree, row_number() over (order by encode(tree)) - 1 as pos, digest, tree as own from a{levels})")
    reduced("b")
    parts.append(f"sa as ({steps('a')})")
    parts.append(f"sb as ({steps('b')})")
    parts.append(
        f"""path as (select doc_id, leaf, shown, p.tree, p.pos, s.digest as subroot, r.digest as root, list_concat(
               coalesce((select list({{'l': l, 'r': r}} order by level) from sa where sa.tree = p.tree and sa.pos = p.pos // (16 ** level)::bigint), []),
               coalesce((select list({{'l': l, 'r': r}} order by level) from sb where sb.pos = s.pos // (16 ** level)::bigint), [])) as path
               from placed p join b0 s on s.own = p.tree, b{levels} r)"""
    )
    return f"""with {", ".join(parts)}
select doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(path, lambda x: x.l || x.r), ''), '')) as proof_sha256,
       folded_root, folded_root = root as verified
from (select *, list_reduce(list_concat([{{'l': shown, 'r': ''}}], path), lambda a, x: {{'l': sha256(x.l || a.l || x.r), 'r': ''}}).l as folded_root from path)"""


@query(_merkle_sql(5))
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(shared_read(spark, sf_dir, "documents"))


@query()
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shared_read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whitened(rows).withColumn("deviation", F.col("deviation").cast("long"))

"""Registered queries of the training-data operators; SQL where DuckDB can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm import (
    alignment,
    exact_dedup,
    language,
    mixing,
    near_dedup,
    nearest,
    packing,
    partenum,
    prefix_trie,
    quality,
    tokens,
    url_filter,
    warc,
)
from tiffin.llm.common import table
from tiffin.llm.encoding import tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_near_dedup(spark, sf_dir):
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85).drop("text_hash")


SQL["op1_near_dedup"] = r"""
with recursive w as materialized (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^ 	-
]+') as words
    from documents
), s as materialized (
    select distinct doc_id, unnest(case when len(words) < 3 then [array_to_string(words, ' ')] else
        list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' ')) end) as shingle
    from w where len(words) > 0
), n as materialized (select doc_id, count(*) as n_shingles from s group by doc_id),
i as (
    select a.doc_id as a, b.doc_id as b, count(*) as shared
    from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
), l as materialized (
    select a, b from i join n na on na.doc_id = a join n nb on nb.doc_id = b
    where 100 * shared >= 85 * (na.n_shingles + nb.n_shingles - shared)
), e as materialized (select a, b from l union all select b, a from l),
reach(doc_id, other) as (
    select doc_id, doc_id from n
    union
    select doc_id, b from reach join e on a = other
), c as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, coalesce(n_shingles, 0) as n_shingles, coalesce(component_id, doc_id) as component_id,
       coalesce(component_id, doc_id) = doc_id as kept
from documents left join n using (doc_id) left join c using (doc_id)
"""


@query
def op2_language_id(spark, sf_dir):
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


SQL["op3_exact_dedup"] = r"""
with d as (
    select doc_id, length(coalesce(text, '')) as n_points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) as text_sha256
    from documents
), g as (
    select text_sha256, count(*) as group_size, max(n_points) as most from d group by text_sha256
), k as (
    select text_sha256, group_size, most, min(doc_id) as keep_id
    from d join g using (text_sha256) where n_points = most group by all
)
select doc_id, keep_id, group_size, n_points = most and doc_id = keep_id as kept, text_sha256, n_points
from d join k using (text_sha256)
"""


@query
def op4_url_filter(spark, sf_dir):
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), url_filter.rule_table(spark, url_filter.RULES))


SQL["op4_url_filter"] = r"""
with u as (
    select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
    from pages
), p as (
    select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from u
), r(verdict, rule_host, rule_path) as (
    values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'),
           ('allow', 'org', '/fr/')
)
select page_id, host, path,
       arg_max(rule_host || rule_path, length(rule_host) + length(rule_path)) as rule,
       coalesce(arg_max(verdict, length(rule_host) + length(rule_path)), 'allow') as verdict
from p left join r
  on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
group by all
"""


@query
def op5_warc(spark, sf_dir):
    return warc.archive_pages(table(spark, sf_dir, "pages")).drop("url")


# Five hex digits are four of base 32.
SQL["op5_warc"] = r"""
with p as (
    select page_id, encode(coalesce(html, '')) as payload, sha1(coalesce(html, '')) as sha from pages
), d as (
    select page_id, octet_length(payload) as payload_bytes, sha,
           list_aggregate(flatten(list_transform(range(8), lambda g: list_transform(range(4), lambda j:
               substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                      ((('0x' || substr(sha, g * 5 + 1, 5))::int >> (15 - 5 * j)) & 31)::int + 1, 1)))),
               'string_agg', '') as payload_digest
    from p
), h as (select sha, max(page_id) as holder from d group by sha)
select page_id, payload_bytes, payload_digest, case when page_id = holder then 'response' else 'revisit' end as record_type,
       case when page_id <> holder then holder end as refers_to
from d join h using (sha)
"""


@query
def op6_token_counts(spark, sf_dir):
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(tokens.TOKENIZER))


@query
def op7_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(packing.TOKENIZER))


@query
def op8_mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


SQL["op8_mixing"] = r"""
with recursive d as (
    select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
           md5('mix-1|' || doc_id) as draw
    from documents
), s as (
    select source, sum(size)::bigint as source_size,
           [1, 2, 3][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as weight
    from d group by source
), o as (
    select *, row_number() over (order by source_size / weight, source nulls last) as place from s
), fill(capped, level) as (
    select 0::bigint, (select sum(source_size) from o) / (select sum(weight) from o)
    union all
    select capped + 1,
           ((select sum(source_size) from o) - 3 * (select sum(source_size) from o where place <= capped + 1))
           / (select sum(weight) from o where place > capped + 1)
    from fill, o
    where place = capped + 1 and level * weight > 3 * source_size
), t as (
    select source, source_size,
           case when place <= (select max(capped) from fill) then (3 * source_size)::double
                else (select arg_max(level, capped) from fill) * weight end as target
    from o
), b as (
    select *, least(round(target)::bigint, 3 * source_size) as budget from t
), c as (
    select doc_id, size, source_size, target, budget,
           coalesce(sum(size) over (partition by d.source order by draw, doc_id, size
                                    rows between unbounded preceding and 1 preceding), 0) as before
    from d join b on d.source is not distinct from b.source
)
select doc_id, size, source_size, target,
       case when source_size = 0 then 0
            else (budget // source_size) * size
                 + greatest(0, least(size, budget % source_size - before)) end::bigint as taken
from c
"""


@query
def op9_quality(spark, sf_dir):
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_nearest(spark, sf_dir):
    return nearest.nearest_vectors(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 20 == 0)


@query
def op11_prefix_trie(spark, sf_dir):
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("last_conv_place")


# The checksum of the decimal id is spelled out: eight steps for each of its characters.
SQL["op11_prefix_trie"] = r"""
with own as materialized (
    select conv_id, length(coalesce(text, '')) as chars,
           sha256(octet_length(encode(coalesce(role, '')))::varchar || ':' || coalesce(role, '') || coalesce(text, '')) as digest,
           row_number() over (partition by conv_id order by turn nulls first, digest) as place
    from conversations where conv_id is not null
), ids as materialized (
    select conv_id, conv_id - conv_id % 100 as family,
           xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(conv_id::varchar) + 1),
               lambda p: ascii(substr(conv_id::varchar, p, 1))::bigint)),
               lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                   lambda x, k: case when x % 2 = 1 then xor(x // 2, 3988292384::bigint) else x // 2 end)),
               4294967295::bigint) % 6 as taken
    from (select distinct conv_id from own)
), whole as materialized (
    select conv_id, list(digest order by part, place) as turns, list(chars order by part, place) as sizes
    from (
        select i.conv_id, 1 as part, place, digest, chars from ids i join own o on o.conv_id = i.family and place <= taken
        union all
        select conv_id, 2, place, digest, chars from own join ids using (conv_id) where place > taken
    ) group by conv_id
), rebuilt as materialized (
    select conv_id, coalesce(turns, []) as turns, coalesce(sizes, []) as sizes from ids left join whole using (conv_id)
), prefix as materialized (
    select conv_id, d as depth, turns[1:d] as key, turns[1:d - 1] as above, sizes[d] as chars, d = len(turns) as ends
    from (select *, unnest(range(0, len(turns) + 1)) as d from rebuilt)
), node as materialized (
    select key, any_value(above) as above, depth, min(conv_id) as conv_id, count(*) as n_convs,
           coalesce(any_value(chars), 0) as chars,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where ends), '')) as ends_sha256
    from prefix group by key, depth
), child as materialized (select above as key, count(*) as n_children from node where depth > 0 group by above),
subtree as (
    select key[1:d] as key, sum((n_convs - 1) * chars) as saved_tokens, count(*) filter (where n_children is null) as n_leaves
    from (select *, unnest(range(0, depth + 1)) as d from node left join child using (key)) group by 1
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children,
       n_leaves, saved_tokens::bigint as saved_tokens, n.ends_sha256
from node n join subtree using (key) left join child using (key)
left join node p on n.depth > 0 and p.key = n.above and p.depth = n.depth - 1
"""


@query
def op12_token_alignment(spark, sf_dir):
    first, second = tokenizer_path(alignment.FIRST), tokenizer_path(alignment.SECOND)
    return alignment.align(table(spark, sf_dir, "documents"), first, second)


@query
def op13_ngram_join(spark, sf_dir):
    return partenum.jaccard_join(table(spark, sf_dir, "documents"))


SQL["op13_ngram_join"] = r"""
with recursive w as materialized (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words
    from documents
), s as materialized (
    select distinct doc_id, unnest(case when len(words) < 5 then [array_to_string(words, ' ')] else
        list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingle
    from w where len(words) > 0
), n as materialized (select doc_id, count(*) as n_shingles from s group by doc_id),
i as (
    select a.doc_id as a, b.doc_id as b, count(*) as shared
    from s a join s b on a.shingle = b.shingle and a.doc_id < b.doc_id group by all
), l as materialized (
    select a, b from i join n na on na.doc_id = a join n nb on nb.doc_id = b
    where 100 * shared >= 80 * (na.n_shingles + nb.n_shingles - shared)
), e as materialized (select a, b from l union all select b, a from l),
reach(doc_id, other) as (
    select doc_id, doc_id from n
    union
    select doc_id, b from reach join e on a = other
), c as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, coalesce(n_shingles, 0) as n_shingles, coalesce(component_id, doc_id) as component_id
from documents left join n using (doc_id) left join c using (doc_id)
"""

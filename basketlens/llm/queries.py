"""The queries of the subpackage: every operator over its whole table."""

import public_tokenizers

from basketlens.llm import ann, bpe, decontam, embdedup, infill, linededup, minhash, mixing, packed, quality, runs, suffix, warc
from basketlens.llm.common import table


def op1_line_dedup(spark, sf_dir):
    return linededup.line_report(table(spark, sf_dir, "documents"))


def op2_warc_normaliser(spark, sf_dir):
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_line_field(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_bpe_transducer(spark, sf_dir):
    return bpe.token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_multiprobe_search(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return ann.nearest(rows, rows.where("vec_id % 20 = 0"), 20)


def op6_packed_ids(spark, sf_dir):
    return packed.packed_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_minhash_components(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=4)


def op8_repeated_bytes(spark, sf_dir):
    return suffix.repeat_report(table(spark, sf_dir, "documents"))


def op9_source_mix(spark, sf_dir):
    return mixing.mixed_words(table(spark, sf_dir, "documents"))


def op10_embedding_groups(spark, sf_dir):
    return embdedup.near_groups(table(spark, sf_dir, "embeddings"))


def op11_word_runs(spark, sf_dir):
    return runs.run_report(runs.with_cycles(table(spark, sf_dir, "documents")))


def op12_infill(spark, sf_dir):
    return infill.infill_report(table(spark, sf_dir, "documents"))


def op13_decontamination(spark, sf_dir):
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def queries():
    return {k: v for k, v in globals().items() if k.startswith("op")}


OP12_SQL = """
with d as (select doc_id, coalesce(text, '') as text, length(coalesce(text, '')) as n, sha256('1:' || cast(doc_id as varchar)) as h from documents),
draws as (
  select doc_id, text, n,
    cast('0x' || substr(h, 1, 8) as bigint) as h1, cast('0x' || substr(h, 9, 8) as bigint) as h2,
    cast('0x' || substr(h, 17, 8) as bigint) as h3, cast('0x' || substr(h, 25, 8) as bigint) as h4
  from d),
cuts as (
  select doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
    case when n = 0 or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
      when h4 % 100 < 20 then 'spm' else 'psm' end as form
  from draws),
parts as (
  select *, substring(text, 1, a) as prefix, substring(text, a + 1, b - a) as middle, substring(text, b + 1, n - b) as suffix
  from cuts)
select doc_id, cast(n as bigint) as n, form,
  case when form <> 'plain' then cast(a as bigint) end as prefix_chars,
  case when form <> 'plain' then cast(b - a as bigint) end as middle_chars,
  sha256(case form when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    when 'spm' then '<S>' || suffix || '<P>' || prefix || '<M>' || middle else text end) as output_sha256,
  sha256(text) as restored_sha256
from parts
"""

# Every place of every document against every window, by the words themselves; rows are told apart by their place.
OP13_SQL = r"""
with d as (
  select row_number() over () as k, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w
  from documents),
i as (
  select cast(item_id as varchar) as item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') as w
  from benchmark),
placed as (select item_id, w, least(len(w), 10) as n, unnest(range(1, len(w) - least(len(w), 10) + 2)) as p from i where len(w) > 0),
windows as (select distinct item_id, n, array_to_string(w[p:p + n - 1], ' ') as words from placed),
sizes as (select distinct n from windows),
places as (select k, w, n, unnest(range(1, len(w) - n + 2)) as p from d cross join sizes where len(w) >= n),
hits as (
  select distinct places.k, places.p, places.n, windows.item_id
  from places join windows on windows.n = places.n and windows.words = array_to_string(places.w[places.p:places.p + places.n - 1], ' ')),
covered as (select k, count(distinct x) as n_hit from (select k, unnest(range(p, p + n)) as x from hits) group by k),
found as (select k, list_sort(list(distinct item_id)) as ids from hits where item_id is not null group by k)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
  cast(coalesce(len(ids), 0) as bigint) as n_items, sha256(coalesce(array_to_string(ids, ','), '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from d left join covered using (k) left join found using (k)
"""

# A SHA-1 in base32: every five hexadecimal digits make four letters.
OP2_SQL = """
with p as (select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as h from pages),
r as (select *, min(page_id) over (partition by payload) as first from p)
select page_id, cast(strlen(payload) as bigint) as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((cast('0x' || substr(h, 1 + 5 * (i // 4), 5) as bigint) >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from r
"""

# All pairs that share a shingle.
OP7_SQL = r"""
with recursive d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents),
places as (select doc_id, w, least(len(w), 4) as n, unnest(range(1, len(w) - least(len(w), 4) + 2)) as p from d where len(w) > 0),
sets as (select distinct doc_id, array_to_string(w[p:p + n - 1], ' ') as shingle from places),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as c from sets a join sets b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by 1, 2),
links as (
  select a, b from pairs join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c >= 80 * (x.n + y.n - c)),
reach as (select doc_id, doc_id as r from documents union select reach.doc_id, links.b from reach join links on links.a = reach.r),
named as (select doc_id, min(r) as component_id from reach group by doc_id)
select documents.doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id, documents.doc_id = component_id as kept
from documents left join sizes using (doc_id) left join named using (doc_id)
"""

# Every string of 100 bytes by its digest; texts are cut into overlapping pieces first, which DuckDB takes faster.
OP8_SQL = """
with d as (select doc_id, strlen(coalesce(text, '')) as n, hex(coalesce(text, '')) as x from documents),
chunks as (select doc_id, n, x, unnest(range(0, n - 99, 500)) as c from d where n >= 100),
parts as (select doc_id, c, least(n - 99 - c, 500) as m, substr(x, 2 * c + 1, 1200) as x from chunks),
places as (select doc_id, c, x, unnest(range(1, m + 1)) as q from parts),
ranked as (select doc_id, c + q as p, row_number() over (partition by md5(substr(x, 2 * q - 1, 200)) order by doc_id, c + q) as k from places),
again as (select doc_id, p, coalesce(p - lag(p) over (partition by doc_id order by p) > 100, true) as new from ranked where k > 1),
runs as (select doc_id, p, sum(cast(new as int)) over (partition by doc_id order by p) as run from again),
spans as (select doc_id, min(p) as a, max(p) + 99 as b from runs group by doc_id, run),
pieces as (select doc_id, a, b, coalesce(lag(b) over (partition by doc_id order by a), 0) as before from spans),
cut as (
  select doc_id, sum(b - a + 1) as removed, count(*) as n_spans, max(b) as last,
    string_agg(substr(x, 2 * before + 1, 2 * (a - before - 1)), '' order by a) as kept
  from pieces join d using (doc_id) group by doc_id)
select doc_id, cast(n as bigint) as n_bytes, cast(coalesce(removed, 0) as bigint) as n_removed,
  cast(coalesce(n_spans, 0) as bigint) as n_spans,
  sha256(unhex(coalesce(kept || substr(x, 2 * last + 1), x))) as kept_sha256
from d left join cut using (doc_id)
"""

OP10_SQL = """
with recursive e as (
  select vec_id, cast(embedding as double[]) as x from embeddings
  where len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0 and len(list_filter(embedding, lambda v: v <> 0)) > 0),
u as (select vec_id, list_transform(x, lambda v: v / sqrt(list_dot_product(x, x))) as x from e),
links as (select a.vec_id as a, b.vec_id as b from u a join u b on a.vec_id <> b.vec_id and list_dot_product(a.x, b.x) >= 0.9),
counts as (select a as vec_id, count(*) as n from links group by a),
reach as (select vec_id, vec_id as r from embeddings union select reach.vec_id, links.b from reach join links on links.a = reach.r),
named as (select vec_id, min(r) as component_id from reach group by vec_id)
select embeddings.vec_id, cast(coalesce(n, 0) as bigint) as n_links, component_id, embeddings.vec_id = component_id as kept
from embeddings left join counts using (vec_id) left join named using (vec_id)
"""


def oracle_sql():
    return {
        "op2_warc_normaliser": OP2_SQL, "op7_minhash_components": OP7_SQL, "op8_repeated_bytes": OP8_SQL, "op10_embedding_groups": OP10_SQL,
        "op12_infill": OP12_SQL, "op13_decontamination": OP13_SQL,
    }

"""SQL twins of the operators' queries, for DuckDB."""

from __future__ import annotations

from tradewind.llm import mixing, quality_rules

#: The words of ``text`` as a list.
WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
#: The 256 remainders of the usual 32-bit cyclic redundancy check.
CRC_TABLE = "(select list_transform(range(256), lambda i: list_reduce(list_prepend(i::bigint, list_transform(range(8), lambda k: k::bigint)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)))"


def crc32(text: str, crc_table: str = "t.crc") -> str:
    octets = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: ('0x' || substr(hex(encode({text})), (2 * i - 1)::int, 2))::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), lambda c, b: xor(c >> 8, {crc_table}[(xor(c, b) & 255) + 1])), 4294967295)"


OP1 = rf"""
with t as (select {CRC_TABLE} as crc),
docs as (select doc_id, text, {WORDS} as w from documents),
trusted as (select distinct doc_id from labels where quality = 1),
spots as (select doc_id, unnest(range(1, len(w) + 1)) as i, w from docs),
pairs as (
  select doc_id, right(coalesce(w[i - 1], ''), {quality_rules.TAIL}) || ' ' || right(w[i], {quality_rules.TAIL}) as pair from spots
),
kinds as (select pair, {crc32("pair")} % {quality_rules.CELLS} as cell from (select distinct pair from pairs), t),
cells as (select p.doc_id, k.cell from pairs p join kinds k using (pair)),
counts as (
  select cell, count(*) as r, count(tr.doc_id) as tr_n from cells c left join trusted tr on c.doc_id = tr.doc_id group by cell
),
totals as (select sum(r) as r, sum(tr_n) as tr_n from counts),
weights as (
  select cell, case when totals.tr_n > 0 then round((ln((counts.tr_n + 1) / (totals.tr_n + {quality_rules.CELLS})::double)
    - ln((counts.r + 1) / (totals.r + {quality_rules.CELLS})::double)) * {quality_rules.UNIT})::bigint else 0 end as weight
  from counts, totals
),
scores as (select doc_id, sum(weight)::bigint as llr_sum, count(*) as llr_n from cells join weights using (cell) group by doc_id),
windows as (select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as gram from spots where i <= len(w) - 2),
twice as (select doc_id, gram from windows group by doc_id, gram having count(*) > 1),
covered as (
  select doc_id, count(distinct j) as n from (
    select doc_id, unnest([i, i + 1, i + 2]) as j from windows join twice using (doc_id, gram)) group by doc_id
),
lines as (
  select doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as l from docs
),
base as (
  select d.doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, coalesce(c.n, 0)::bigint as n_repeat_words
  from docs d join lines using (doc_id) left join covered c on d.doc_id = c.doc_id
)
select b.*, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words)
    and coalesce(llr_sum, 0) >= {quality_rules.THRESHOLD} * coalesce(llr_n, 0) as kept,
  coalesce(llr_sum, 0)::bigint as llr_sum
from base b left join scores s on b.doc_id = s.doc_id
"""

OP4 = """
with x as (
  select vec_id, list_transform(embedding, lambda v: floor(v::double * 256)::bigint) as q from embeddings
  where embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
),
scored as (
  select a.vec_id as query_id, b.vec_id, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::bigint as score
  from x a join x b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id
)
select query_id, rank::int as rank, vec_id, score from (
  select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5
"""

OP5 = """
with p as (
  select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
),
f as (select *, min(page_id) over (partition by payload_digest) as first_id from p)
select page_id, payload_bytes::bigint as payload_bytes, payload_digest,
  case when payload_bytes >= 100 and page_id > first_id then 'revisit' else 'response' end as record_type,
  case when payload_bytes >= 100 and page_id > first_id then first_id end as refers_to
from f
"""

OP6 = """
with d as (select doc_id, encode(coalesce(text, '')) as b from documents),
h as (select doc_id, hex(b) as x, octet_length(b) as n from d),
starts as (select doc_id, x, n, unnest(range(0, n - 99)) as i from h where n >= 100),
grams as (select doc_id, i, substr(x, (2 * i + 1)::bigint, 200) as g from starts),
again as (select doc_id, i from (select doc_id, i, row_number() over (partition by g order by doc_id, i) as k from grams) where k > 1),
edges as (
  select doc_id, i, max(i + 100) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding) as reach from again
),
runs as (select doc_id, i, sum((reach is null or i > reach)::int) over (partition by doc_id order by i) as run from edges),
spans as (select doc_id, run, min(i) as a, max(i) + 100 as b from runs group by doc_id, run),
totals as (select doc_id, sum(b - a)::bigint as n_removed, count(*) as n_spans from spans group by doc_id),
gaps as (
  select doc_id, a, coalesce(lag(b) over (partition by doc_id order by a), 0) as after from spans
  union all select h.doc_id, h.n, coalesce(max(s.b), 0) from h left join spans s on h.doc_id = s.doc_id group by h.doc_id, h.n
),
kept as (
  select g.doc_id, string_agg(substr(x, (2 * after + 1)::bigint, (2 * (a - after))::bigint), '' order by a, after) as k
  from gaps g join h on g.doc_id = h.doc_id group by g.doc_id
)
select h.doc_id, h.n::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0)::bigint as n_spans,
  sha256(unhex(k)) as kept_sha256
from h join kept on h.doc_id = kept.doc_id left join totals t on h.doc_id = t.doc_id
"""

OP9 = r"""
with recursive d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
),
grams as (
  select distinct doc_id, array_to_string(w[i:i + 4], ' ') as g
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) as i from d)
),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from grams a join grams b using (g) where a.doc_id <> b.doc_id group by all),
links as materialized (
  select a, b from common join sizes x on a = x.doc_id join sizes y on b = y.doc_id where 100 * k >= 80 * (x.n + y.n - k)
),
reach(doc_id, other) as (select doc_id, doc_id from d union select r.doc_id, l.b from reach r join links l on r.other = l.a)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, c.component_id
from d left join sizes using (doc_id) join (select doc_id, min(other) as component_id from reach group by doc_id) c using (doc_id)
"""


OP12 = """
with x as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda v: floor(v::double * 256)::bigint) as q
  from embeddings
  where label is not null and embedding is not null and len(embedding) > 0 and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0
),
scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::bigint as score
  from x a join x b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id
),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from (
    select *, row_number() over (partition by anchor_id order by score desc, vec_id) as k from scored where same) where k <= 5
)
select anchor_id, positive_id, rank::int as rank, negative_id, positive_score, negative_score from (
  select p.*, s.vec_id as negative_id, s.score as negative_score,
    row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as rank
  from positives p join scored s on p.anchor_id = s.anchor_id and not s.same
    and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score
) where rank <= 10
"""


OP13 = rf"""
with t as (select {CRC_TABLE} as crc),
numbered as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first) as i
  from conversations where conv_id is not null
),
convs as (
  select conv_id, conv_id - conv_id % 100 as base, {crc32("conv_id::varchar")} % 6 as h from (select distinct conv_id from conversations where conv_id is not null), t
),
rebuilt as (
  select conv_id, i, role, text from numbered join convs using (conv_id) where i > h
  union all select c.conv_id, n.i, n.role, n.text from convs c join numbered n on n.conv_id = c.base and n.i <= c.h
),
placed as (
  select conv_id, row_number() over (partition by conv_id order by i) as d, md5(length(role) || ':' || role || text) as turn, length(text) as size from rebuilt
),
prefixes as (
  select conv_id, d, size, md5(array_to_string(list(turn) over (partition by conv_id order by d rows unbounded preceding), ' ')) as key from placed
  union all select conv_id, 0, 0, '' from convs
),
reach as (select conv_id, max(d) as depth from prefixes group by conv_id),
nodes as (
  select d, key, min(conv_id) as conv_id, count(*) as n, max(size) as size, max(depth) as deepest,
    coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where depth = d), '') as ends
  from prefixes join reach using (conv_id) group by d, key
),
above as (
  select u.d, u.key, u.conv_id, (u.n - 1) * u.size as saved, (u.d = u.deepest)::bigint as leaf, p.d as up_d, p.key as up_key
  from nodes u join prefixes p on p.conv_id = u.conv_id and p.d <= u.d
),
sums as (
  select up_d as d, up_key as key, sum(saved)::bigint as saved_tokens, sum(leaf)::bigint as n_leaves, count(*) filter (where d = up_d + 1) as n_children
  from above group by up_d, up_key
),
parents as (select a.d, a.key, n.conv_id as parent_conv_id from above a join nodes n on n.d = a.up_d and n.key = a.up_key where a.up_d = a.d - 1)
select n.conv_id, n.d::bigint as depth, parent_conv_id, n.n as n_convs, n_children, n_leaves, saved_tokens, sha256(n.ends) as ends_sha256
from nodes n join sums s on n.d = s.d and n.key = s.key left join parents p on n.d = p.d and n.key = p.key
"""


def mix_sql(docs: str, seed: int = 20) -> str:
    """Copies of the rows of the table ``docs`` with equal weights for its sources."""
    return f"""
with counts as (select source, count(*) as n from {docs} group by source),
totals as (select sum(n) as n, count(*) as k from counts),
means as (select source, (1.0::double / totals.k) * totals.n::double / counts.n as mean from counts, totals),
steps as (
  select source, k, sum(exp(-mean + k * ln(mean) - lgamma(k + 1))) over (partition by source order by k) as below
  from (select source, mean, unnest(range(0, (ceil(mean + 9 * sqrt(mean) + 24))::bigint + 1)) as k from means)
),
drawn as (
  select d.*, ('0x' || left(md5('{seed}:' || coalesce(d.doc_id::varchar, 'null')), 12))::bigint / 281474976710656.0::double as u from {docs} d
),
counted as (
  select d.*, (select count(*) from steps s where s.source is not distinct from d.source and s.below <= d.u) as k from drawn d
)
select c.* exclude (u, k), unnest(range(1, k + 1))::int as copy from counted c
"""


ORACLE: dict[str, str] = {
    "op1_quality_rules": OP1,
    "op4_exact_top_k": OP4,
    "op5_warc": OP5,
    "op6_suffix_dedup": OP6,
    "op9_ngram_jaccard": OP9,
    "op10_mixing": mix_sql("documents"),
    "op12_hard_negatives": OP12,
    "op13_prefix_trie": OP13,
}

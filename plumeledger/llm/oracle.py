"""The SQL that states the results of the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DECONTAMINATION = rf"""
with doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (
  select distinct item_id, least(10, len(w)) as n, array_to_string(w[p : p + least(10, len(w)) - 1], ' ') as g
  from (select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) as p from item where len(w) > 0)),
sizes as (select distinct n from win),
grams as (
  select doc_id, p, n, array_to_string(w[p : p + n - 1], ' ') as g
  from (select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as p from doc, sizes where len(w) >= n)),
hits as (select doc_id, p, n, item_id from grams join win using (n, g)),
covered as (
  select doc_id, count(distinct q) as n_hit
  from (select doc_id, unnest(generate_series(p, p + n - 1)) as q from hits) group by doc_id),
found as (
  select doc_id, count(*) as n_items, string_agg(i, ',' order by i) as ids
  from (select distinct doc_id, item_id::varchar as i from hits) group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 as contaminated
from doc left join covered using (doc_id) left join found using (doc_id)
"""

MINHASH = rf"""
with recursive doc as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '[^\x20\x09-\x0D]+') as w from documents),
sets as materialized (
  select distinct doc_id, hash(array_to_string(w[p : p + 3], ' ')) as s
  from (select doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) as p from doc where len(w) > 0)),
sizes as (select doc_id, count(*) as n from sets group by doc_id),
shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as n
  from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as materialized (
  select shared.a, shared.b from shared join sizes x on x.doc_id = shared.a join sizes y on y.doc_id = shared.b
  where 100 * shared.n >= 80 * (x.n + y.n - shared.n)),
edges as (select a, b from links union select b, a from links),
reach(doc_id, other) as (
  select doc_id, doc_id from doc
  union
  select reach.doc_id, edges.b from reach join edges on edges.a = reach.other)
select doc.doc_id, coalesce(sizes.n, 0)::bigint as n_shingles, r.c as component_id, doc.doc_id = r.c as kept
from doc left join sizes using (doc_id)
join (select doc_id, min(other) as c from reach group by doc_id) r using (doc_id)
"""

COVER_TREE = """
with recursive vec as (
  select vec_id, embedding::double[] as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as materialized (
  select a.vec_id as a, b.vec_id as b from vec a join vec b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.95),
reach(vec_id, other) as (
  select vec_id, vec_id from embeddings
  union
  select reach.vec_id, links.b from reach join links on links.a = reach.other)
select e.vec_id, coalesce(n.n, 0)::bigint as n_links, r.c as component_id, e.vec_id = r.c as kept
from embeddings e
left join (select a, count(*) as n from links group by a) n on n.a = e.vec_id
join (select vec_id, min(other) as c from reach group by vec_id) r on r.vec_id = e.vec_id
"""

TOOL_CALLS = r"""
with t as (
  select *, 'c' || conv_id || '-t' || turn as id, 'c' || conv_id || '-t' || (turn - 1) as before,
    'c' || conv_id || '-t' || (turn - 2) as before2,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words
  from conversations),
calls as (select *, case role when 'user' then 'respond' else 'configure' end as name from t where role in ('user', 'system')),
results as (select conv_id, before as id, turn, text from t where role = 'assistant'),
needs as (
  select conv_id, id, before2 as needs from calls where role = 'user' and turn >= 2
  union all select conv_id, id, before from calls where role = 'user' and turn = 1),
lost as (select id, count(*) as missing from needs where needs not in (select id from calls) group by id),
checked as (
  select c.conv_id, c.id, c.turn, c.name, r.text as result, r.id is not null as answered, coalesce(missing, 0) as missing,
    concat_ws(',', case when length(c.text) < 1 then 'length of text' end,
      case when words < case name when 'respond' then 5 else 1 end then 'minimum of words' end,
      case when name = 'respond' and words > 60 then 'maximum of words' end,
      case when missing > 0 then 'missing dependency' end) as errors,
    '{"arguments":{"text":' || to_json(c.text) || ',"turn":' || c.turn || ',"words":' || words || '},"id":' || to_json(c.id)
      || ',"name":' || to_json(c.name) || coalesce(',"result":' || to_json(r.text), '') || '}' as message
  from calls c left join results r on r.id = c.id left join lost on lost.id = c.id)
select conv_id, id as call_id, turn, name, case when answered then 'linked' else 'unanswered' end as status,
  turn as rank, missing::integer as missing, errors, message::varchar as message
from checked
union all
select conv_id, id, turn, null, 'orphan', turn, 0, 'no call', '{"id":' || to_json(id) || ',"result":' || to_json(text) || '}'
from results where id not in (select id from calls)
union all
select conv_id, null, turn, null, 'no role', turn, 0, 'no role',
  case when text is not null then '{"text":' || to_json(text) || '}' end
from t where role is null or role not in ('user', 'system', 'assistant')
"""

DIVERGENCE = rf"""
with doc as (
  select row_number() over () as d, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
used as materialized (
  select d, lang, source, term, count(*) as n
  from (select d, lang, source, unnest(w) as term from doc) group by all),
kept as materialized (
  select lang, term, sum(n) as n from used group by lang, term having count(*) >= 3),
sizes as (select lang, count(*) as v, sum(n) as total from kept group by lang),
groups as materialized (select distinct lang, source from doc),
grid as (
  select g.lang, g.source, k.term, coalesce(u.n, 0)::hugeint as n, k.n::hugeint as of_lang
  from groups g join kept k using (lang)
  left join (select lang, source, term, sum(n) as n from used group by all) u using (lang, source, term)),
shares as materialized (
  select lang, source, term, n,
    1 + 1000000000::hugeint * (n + 1) // ((sum(n) over (partition by lang, source))::hugeint + v) as p,
    1 + 1000000000::hugeint * (of_lang + 1) // (total::hugeint + v) as q
  from grid join sizes using (lang)),
pairs as (
  select a.lang, a.source, b.source as item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) as value
  from groups a join groups b on a.lang = b.lang and a.source <> b.source
  left join shares x on x.lang = a.lang and x.source = a.source
  left join shares y on y.lang = b.lang and y.source = b.source and y.term = x.term
  group by all),
terms as (
  select lang, source, term as item, (p - q) * (p - q) // q as value from shares where n > 0 and p > q),
ranked as (
  select lang, source, 'pair' as part, item, value,
    row_number() over (partition by lang, source order by value desc, item) as r from pairs
  union all
  select lang, source, 'term', item, value,
    row_number() over (partition by lang, source order by value desc, item) from terms)
select lang, source, part, item, value::bigint as value, r::int as rank
from ranked where part = 'pair' or r <= 200
"""

SUBSTRINGS = r"""
with doc as materialized (
  select row_number() over () as d, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
win as materialized (
  select d, p, array_to_string(w[p : p + 34], ' ') as g
  from (select d, w, unnest(generate_series(1, len(w) - 34)) as p from doc where len(w) >= 35)),
again as (select g from win group by g having count(*) > 1),
covered as materialized (
  select distinct d, unnest(generate_series(p, p + 34)) as q from win join again using (g)),
left_over as (
  select d, string_agg(word, ' ' order by q) as t
  from (select d, unnest(w) as word, generate_subscripts(w, 1) as q from doc) anti join covered using (d, q)
  group by d),
removed as (select d, count(*) as n from covered group by d)
select doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from doc left join removed using (d) left join left_over using (d)
"""

ORACLE: dict[str, str] = {
    "op1_cover_tree": COVER_TREE,
    "op2_decontamination": DECONTAMINATION,
    "op8_minhash_dedup": MINHASH,
    "op10_tool_calls": TOOL_CALLS,
    "op11_source_divergence": DIVERGENCE,
    "op12_substring_dedup": SUBSTRINGS,
}

"""DuckDB SQL for the operators that SQL can express, written from their definitions.

Not here: sharding (crc32 of texts), byte-level BPE, SimHash (XXH64), toxicity (a
trained score), the byte-wise suffix dedup and token counts; tests hold those against brute force.
"""

from __future__ import annotations

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

OP1 = rf"""
with d as (select row_number() over () as k, doc_id, {_WORDS} as w from documents),
win as (select k, i, md5(array_to_string(w[i:i + 34], ' ')) as h from d, unnest(range(1, len(w) - 33)) as u(i)),
again as (select k, i from win where h in (select h from win group by h having count(*) > 1)),
gone as (select distinct k, i + j as p from again, range(0, 35) as r(j)),
lists as (select k, list(p) as ps, count(*) as n from gone group by k)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(l.n, 0)::bigint as n_removed,
       sha256(coalesce(array_to_string(list_filter(d.w, lambda x, p: not list_contains(coalesce(l.ps, []), p)), ' '), '')) as kept_sha256
from d left join lists l using (k)
"""

OP4 = r"""
with d as (select row_number() over (order by doc_id) as k, doc_id, text, string_split(text, chr(10)) as w from documents),
run as (select k, i, w[i] as a, w[i + 1] as b from d, unnest(range(1, len(w))) as u(i)),
later as (select k, i from (select k, i, row_number() over (partition by a, b order by k, i) as nth from run) where nth > 1),
gone as (select distinct k, i + j as p from later, range(0, 2) as r(j)),
isle as (select k, p, p - row_number() over (partition by k order by p) as g from gone),
runs as (select k, g, count(*) as n from isle group by k, g),
stats as (select k, count(*) as n_runs, max(n) as longest, sum(n) as removed from runs group by k),
kept as (select e.k, string_agg(e.line, chr(10) order by e.p) as t
         from (select k, unnest(w) as line, generate_subscripts(w, 1) as p from d) e anti join gone g on e.k = g.k and e.p = g.p group by e.k)
select d.doc_id, coalesce(len(d.w), 0)::bigint as n_lines, coalesce(s.removed, 0)::bigint as n_removed, coalesce(s.n_runs, 0)::bigint as n_runs,
       coalesce(s.longest, 0)::bigint as longest_run, sha256(coalesce(t.t, '')) as kept_sha256
from d left join stats s using (k) left join kept t using (k)
"""

_URN = "concat('<urn:uuid:', substr({0}, 1, 8), '-', substr({0}, 9, 4), '-', substr({0}, 13, 4), '-', substr({0}, 17, 4), '-', substr({0}, 21, 12), '>')"


def _urn(*parts: str) -> str:
    return _URN.format("md5(concat_ws(chr(10), " + ", ".join(parts) + "))")


def _text() -> str:
    t = "regexp_replace(body, '(?s)<!--.*?-->', '', 'g')"
    for tag in ("script", "style"):
        t = rf"regexp_replace({t}, '(?is)<{tag}[^>]*>.*?</{tag}\s*>', '', 'g')"
    t = (rf"regexp_replace({t}, '(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|table|title|article|section|header|footer|nav|blockquote|pre)"
         rf"(\s[^>]*)?/?>', chr(10), 'g')")
    t = f"regexp_replace({t}, '<[^>]*>', '', 'g')"
    for name, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
        t = f"replace({t}, '{name}', '{char}')"
    t = rf"regexp_replace({t}, '[ \t\r\f]+', ' ', 'g')"
    t = rf"regexp_replace({t}, ' ?\n[ \n]*', chr(10), 'g')"
    return rf"regexp_replace({t}, '^[ \n]+|[ \n]+$', '', 'g')"


_NL = "chr(13) || chr(10)"
OP5 = rf"""
with p as (select page_id, coalesce(url, '') as target_uri, coalesce(html, '') as body from pages),
r as (select *, concat('HTTP/1.1 200 OK', {_NL}, 'Content-Type: text/html; charset=utf-8', {_NL}, 'Content-Length: ', strlen(body)) as head from p),
b as (select *, concat('sha256:', sha256(concat(head, {_NL}, {_NL}, body))) as block_digest, concat('sha256:', sha256(body)) as payload_digest,
      {_urn("'response'", "coalesce(page_id::varchar, '')", "target_uri", "body")} as refers_to, {_text()} as text,
      trim(regexp_replace(coalesce(regexp_extract(body, '(?is)<title[^>]*>(.*?)</title\s*>', 1), ''), '\s+', ' ', 'g')) as title,
      coalesce(regexp_extract(body, '(?i)<html[^>]*\slang=["'']?([a-zA-Z-]+)', 1), '') as language,
      len(regexp_extract_all(body, '(?i)<a\s[^>]*href=')) as outlinks from r),
f as (select *, concat('title: ', title, {_NL}, 'language: ', language, {_NL}, 'outlinks: ', outlinks, {_NL}, 'source-block-digest: ', block_digest, {_NL},
      'source-payload-digest: ', payload_digest, {_NL}, 'source-header: ', replace(head, {_NL}, {_NL} || 'source-header: '), {_NL}) as fields from b),
m as (select *, {_urn("'metadata'", "refers_to", "fields")} as mid, {_urn("'conversion'", "refers_to", "text")} as cid from f)
select page_id, 'metadata' as type, mid as record_id, refers_to, null::varchar as linked_to, target_uri, '2026-01-01T00:00:00Z' as date,
       concat('sha256:', sha256(fields)) as block_digest, strlen(fields)::bigint as n_bytes from m
union all
select page_id, 'conversion', cid, refers_to, mid, target_uri, '2026-01-01T00:00:00Z', concat('sha256:', sha256(text)), strlen(text)::bigint from m
"""

_TOKENS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP7 = rf"""
with d as (select row_number() over () as k, doc_id, {_TOKENS} as w from documents),
b as (select item_id::varchar as item, {_TOKENS} as w from benchmark),
iw as (select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as s from b, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as u(i)
       where len(w) > 0),
sizes as (select distinct n from iw),
dw as (select k, i, n, array_to_string(w[i:i + n - 1], ' ') as s from d, sizes, unnest(range(1, len(w) - n + 2)) as u(i)),
hits as (select dw.k, dw.i, dw.n, iw.item from dw join iw on dw.n = iw.n and dw.s = iw.s),
cover as (select k, count(distinct p) as n_hit from (select k, i + unnest(range(0, n)) as p from hits) group by k),
found as (select k, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct k, item from hits) group by k)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(c.n_hit, 0)::bigint as n_hit, coalesce(f.n_items, 0)::bigint as n_items,
       sha256(coalesce(f.items, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
from d left join cover c using (k) left join found f using (k)
"""

OP10 = r"""
with v as (select row_number() over () as k, vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as q from embeddings
           where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select a.k, a.vec_id as query_id, b.vec_id, list_dot_product(a.q, b.q)::bigint as score
      from v a join v b on a.k <> b.k where a.vec_id % 50 = 0)
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by k order by score desc, vec_id) as rank from s) where rank <= 5
"""

OP11 = r"""
with d as materialized (select row_number() over () as k, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents),
occ as (select k, lang, source, unnest(w) as term from d),
kept as materialized (select lang, term, count(*)::hugeint as c from occ group by lang, term having count(distinct k) >= 3),
cnt as materialized (select lang, source, term, count(*)::hugeint as c from occ semi join kept using (lang, term) group by lang, source, term),
size as (select lang, count(*)::hugeint as v, sum(c)::hugeint as n from kept group by lang),
grp as (select lang, source, coalesce(g.n, 0)::hugeint as n, coalesce(size.v, 0)::hugeint as v
        from (select distinct lang, source from d) left join (select lang, source, sum(c)::hugeint as n from cnt group by lang, source) g using (lang, source)
        left join size using (lang)),
p as materialized (select g.lang, g.source, k.term, coalesce(c.c, 0) as c, 1 + (1000000000 * (coalesce(c.c, 0) + 1)) // (g.n + g.v) as p
      from grp g join kept k using (lang) left join cnt c on c.lang = g.lang and c.source = g.source and c.term = k.term),
sums as (select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) as value
         from p a join p b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
pairs as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0)::bigint as value
          from grp a join grp b on a.lang = b.lang and a.source <> b.source
          left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source),
q as (select k.lang, k.term, 1 + (1000000000 * (k.c + 1)) // (s.n + s.v) as q from kept k join size s using (lang)),
terms as (select p.lang, p.source, 'term' as part, p.term as item, (((p.p - q.q) * (p.p - q.q)) // q.q)::bigint as value
          from p join q using (lang, term) where p.c > 0 and p.p > q.q)
select lang, source, part, item, value, rank::int as rank
from (select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank
      from (select * from pairs union all select * from terms))
where part = 'pair' or rank <= 200
"""

_RANK_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
               r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

OP12 = rf"""
with d as materialized (select row_number() over () as k, doc_id, {_RANK_TERMS} as w from documents),
totals as materialized (select count(*) filter (len(w) > 0) as n_docs, coalesce(sum(len(w)), 0)::bigint as n_all from d),
item as materialized (select i, item_id, term, count(*) as times
                      from (select i, item_id, unnest(w) as term from (select row_number() over () as i, item_id, {_RANK_TERMS} as w from benchmark)) group by all),
tf as materialized (select k, term, count(*) as tf from (select k, unnest(w) as term from d) semi join item using (term) group by k, term),
weight as materialized (select term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::bigint as weight from tf, totals group by term, n_docs),
m as (select k, doc_id, 100 - 75 + (75 * len(w) * n_docs) // n_all as m from d, totals where len(w) > 0),
gain as materialized (select k, m.doc_id, term, weight * ((1000000000 * tf) // (1000 * tf + 8 * m)) as gain from tf join weight using (term) join m using (k)),
score as (select i, item_id, k, doc_id, sum(times * gain)::bigint as score from gain join item using (term) group by all)
select item_id, rank::int as rank, doc_id, score
from (select *, row_number() over (partition by i order by score desc, doc_id) as rank from score where score > 0) where rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_substring_dedup": OP1, "op4_line_dedup": OP4, "op5_warc_derivatives": OP5, "op7_decontamination": OP7, "op10_exact_topk": OP10,
            "op11_divergence_audit": OP11, "op12_ranked_search": OP12}

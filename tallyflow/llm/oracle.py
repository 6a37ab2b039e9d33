"""Comparison SQL of the pipeline operators, where SQL can express them."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_WORD = r"[^\x20\x09-\x0D]+"

_LEDGER = rf"""
base as (
  select doc_id, row_number() over () as row_id, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '{_WORD}') as w from documents),
grams as (
  select row_id, i, md5(w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2]) as g
  from (select row_id, w, unnest(range(1, len(w) - 1)) as i from base)),
marked as (select row_id, i from grams qualify count(*) over (partition by row_id, g) > 1),
covered as (
  select row_id, count(distinct i + k) as n
  from marked cross join (values (0), (1), (2)) as o(k) group by 1),
lines as (
  select row_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) as l
  from base),
ledger as (
  select b.doc_id, b.row_id, len(w)::bigint as n_words,
         length(array_to_string(w, ''))::bigint as word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
         (len(l) - len(list_distinct(l)))::bigint as n_dup_lines, len(l)::bigint as n_lines,
         coalesce(c.n, 0)::bigint as n_repeat_words
  from base b join lines using (row_id) left join covered c using (row_id)),
book as (
  select *, (case when n_words < 50 then 1 else 0 end
           + case when 100 * n_repeat_words > 50 * n_words then 2 else 0 end
           + case when 10 * n_symbols > word_chars then 4 else 0 end
           + case when 10 * n_dup_lines > 3 * n_lines then 8 else 0 end
           + case when word_chars > 40 * n_words then 16 else 0 end)::bigint as fail_bits
  from ledger)
"""

ORACLE["op1_quality_rules"] = f"""
with {_LEDGER}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & 3) <> 0 as base_failed, fail_bits = 0 as kept, fail_bits
from book
"""

ORACLE["op3_decontaminate"] = r"""
with base as (
  select doc_id, row_number() over () as row_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from documents),
items as (
  select item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
  from benchmark),
windows as (
  select distinct item_id, size, array_to_string(w[i:i + size - 1], ' ') as g
  from (select item_id, w, least(13, len(w)) as size,
               unnest(range(1, greatest(2, len(w) - 11))) as i
        from items where len(w) > 0)),
sizes as (select distinct size from windows),
found as (
  select row_id, i, size, item_id
  from (select row_id, i, size, array_to_string(w[i:i + size - 1], ' ') as g
        from (select row_id, w, size, unnest(range(1, len(w) - size + 2)) as i
              from base cross join sizes where len(w) >= size)) join windows using (size, g)),
hit as (
  select row_id, count(distinct k) as n
  from (select row_id, unnest(range(i, i + size)) as k from found) group by 1),
named as (
  select row_id, count(*) as n, string_agg(item_id::varchar, ',' order by item_id::varchar) as ids
  from (select distinct row_id, item_id from found) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(h.n, 0)::bigint as n_hit,
       coalesce(m.n, 0)::bigint as n_items, sha256(coalesce(m.ids, '')) as items_sha256,
       coalesce(h.n, 0) > 0 and 20 * coalesce(h.n, 0) >= len(w) as contaminated
from base left join hit h using (row_id) left join named m using (row_id)
"""

ORACLE["op6_systematic_mix"] = rf"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::bigint as size
  from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
weighted as (
  select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::bigint
    as weight from sources),
ahead as (
  select *, source_size::double / weight as ratio, sum(source_size) over () as total from weighted),
filled as (
  select *, coalesce(sum(source_size) over (order by ratio, source nulls last
              rows between unbounded preceding and 1 preceding), 0) as full_before,
         sum(weight) over (order by ratio, source nulls last
              rows between current row and unbounded following) as open_weight from ahead),
marked as (
  select *, total - 3 * full_before as share,
         3 * source_size * open_weight <= (total - 3 * full_before) * weight as closed from filled),
level as (
  select arg_max(share, open_weight)::bigint as share, max(open_weight)::bigint as k
  from marked where not closed),
targets as (
  select m.source, m.source_size, case when closed then (3 * source_size)::double
         else (weight * level.share)::double / level.k::double end as target
  from marked m left join level on true),
rates as (
  select *, case when source_size > 0
         then floor(target * 16777216 / source_size)::bigint else 0 end as rate,
         ('0x' || substr(md5(coalesce(source, 'null source')), 1, 6))::bigint as u from targets),
placed as (
  select s.doc_id, s.size, r.source_size, r.target, r.rate, r.u,
         row_number() over (partition by s.source order by s.size, s.doc_id) as place
  from sized s join rates r on s.source is not distinct from r.source)
select doc_id, size, source_size, target,
       (size * (((place * rate + u) >> 24) - (((place - 1) * rate + u) >> 24)))::bigint as taken
from placed
"""

ORACLE["op10_reply_trees"] = r"""
with turns as (
  select conv_id, turn, role, text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
clean as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from turns),
cut as (
  select *, length(replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</turn>', '<\/turn>'))
            as body,
         length(replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'),
                '</turn>', '<\/turn>'), ': ', ':\ ')) as head from clean),
said as (
  select conv_id, count(*) as n_turns,
         string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as whole,
         coalesce(string_agg(text, '' order by turn, role, text)
                  filter (where role = 'assistant'), '') as learned,
         sum(body + head + 14) as formatted_chars from cut group by conv_id)
select conv_id, n_turns, sha256(whole) as turns_sha256, length(learned)::bigint as loss_chars,
       sha256(learned) as loss_sha256, formatted_chars::bigint as formatted_chars
from said
"""

# CRC-32 by four bits at a time, low half of a byte first; the table follows from the polynomial.
_CRC_HALF = [0] * 16
for _k in range(16):
    _c = _k
    for _ in range(4):
        _c = _c >> 1 ^ (0xEDB88320 if _c & 1 else 0)
    _CRC_HALF[_k] = _c


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 of a non-empty text."""
    halves = (f"list_transform(range(0, len(hex(encode({text})))), lambda i: "
              f"instr('0123456789ABCDEF', substr(hex(encode({text})), (i + 2 - 2 * (i % 2))::int, 1))::bigint - 1)")
    return (f"xor(list_reduce(list_prepend(4294967295::bigint, {halves}), "
            f"lambda c, x: xor(c >> 4, ({_CRC_HALF}::bigint[])[(xor(c, x) & 15) + 1])), 4294967295::bigint)")


ORACLE["op13_spelling_variants"] = f"""
with recursive runs as (
  select doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\u00C0-\u00FF]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents),
few as (
  select doc_id, run, count(*) as n from runs where length(run) >= 6 group by all),
checked as (
  select run, n, {crc32_sql("coalesce(doc_id::varchar, '') || ':' || run")} as h from few),
spelled as (
  select case when h % 199 = 0 then left(run, (h % length(run))::int) ||
                  substr(run, (h % length(run))::int + 2) else run end as word, n from checked),
words as (
  select word, sum(n)::bigint as n from spelled where length(word) >= 6
  group by word having sum(n) >= 5),
cut as (
  select distinct word, n, length(word) as size, left(word, i::int) as a, substr(word, i::int + 2) as b
  from (select word, n, unnest(range(0, length(word))) as i from words)),
near as (
  select distinct x.word, x.n, y.word as other, y.n as other_n
  from cut x join cut y on x.a = y.a and x.b = y.b and x.size = y.size and x.word <> y.word
  union
  select distinct x.word, x.n, y.word, y.n from cut x join words y on x.a || x.b = y.word
  union
  select distinct y.word, y.n, x.word, x.n from cut x join words y on x.a || x.b = y.word),
best as (
  select word, count(*) as n_near, max(other_n) as top_n,
         (list(other order by other_n desc, other))[1] as top from near group by word),
formed as (
  select w.word, w.n, coalesce(b.n_near, 0) as n_near,
         case when b.top_n >= 5 * w.n then b.top end as form,
         case when b.top_n >= 5 * w.n then b.top_n end as form_n
  from words w left join best b on w.word = b.word),
steps as (
  select word, word as root, form as next from formed
  union all
  select s.word, f.word, f.form from steps s join formed f on s.next = f.word)
select f.word, f.n, f.n_near, f.form, f.form_n, s.root
from formed f join steps s on f.word = s.word where s.next is null
"""

ORACLE["op11_prefix_trie"] = rf"""
with turns as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (
           partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as k
  from conversations where conv_id is not null),
convs as (
  select conv_id, conv_id - conv_id % 20 as base, {crc32_sql("conv_id::varchar")} % 4 as h
  from (select distinct conv_id from turns)),
rebuilt as (
  select c.conv_id, t.k, t.role, t.text from convs c join turns t on t.conv_id = c.base and t.k <= c.h
  union all
  select c.conv_id, t.k, t.role, t.text from convs c join turns t on t.conv_id = c.conv_id and t.k > c.h),
steps as (
  select conv_id, row_number() over w as depth, string_agg(sha256(length(role) || ':' || role || text), '') over w
           as path, len(regexp_extract_all(text, '{_WORD}'))::bigint as words
  from rebuilt window w as (partition by conv_id order by k)),
members as (
  select conv_id, 0::bigint as depth, '' as path, 0::bigint as words from convs
  union all select conv_id, depth, sha256(path), words from steps),
linked as (
  select *, lag(path) over w as above, lead(path) over w is null as ends from members
  window w as (partition by conv_id order by depth)),
nodes as (
  select path, any_value(above) as above, any_value(depth) as depth, min(conv_id) as conv_id, count(*) as n_convs,
         any_value(words) as words, bool_and(ends) as leaf, sha256(coalesce(string_agg(conv_id::varchar, ','
           order by conv_id) filter (where ends), '')) as ends_sha256
  from linked group by path),
children as (select above as path, count(*) as n_children from nodes where above is not null group by above),
under as (
  select m.path, sum(n.leaf::bigint)::bigint as n_leaves, sum((n.n_convs - 1) * n.words)::bigint as saved_tokens
  from nodes n join members m on m.conv_id = n.conv_id and m.depth <= n.depth group by m.path)
select n.conv_id, n.depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children,
       u.n_leaves, u.saved_tokens, n.ends_sha256
from nodes n join under u on n.path = u.path left join children c on c.path = n.path
left join nodes p on p.path = n.above
"""

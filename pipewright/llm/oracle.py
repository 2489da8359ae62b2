"""DuckDB texts of the queries that SQL can express."""

from __future__ import annotations

_WS = r"[\x20\x09-\x0D]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

LINE_DEDUP = rf"""
with split as (select doc_id, string_split(coalesce(text, ''), chr(10)) as a from documents),
lines as (select doc_id, generate_subscripts(a, 1) as i, unnest(a) as line from split),
keyed as (select *, {_LOWER.format(rf"regexp_replace(regexp_replace(line, '^{_WS}+', ''), '{_WS}+$', '')")} as k from lines),
many as (select k, max(doc_id) as holder from (select distinct doc_id, k from keyed where length(k) >= 40)
         group by k having count(*) >= 5),
marked as (select l.doc_id, l.i, l.line, coalesce(m.holder <> l.doc_id, false) as gone from keyed l left join many m using (k))
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""


def quality_rules() -> str:
    from pipewright.llm.quality_rules import ALPHA, DELTA, RULES
    tests = ", ".join(f"('{r}', {c}, 100 * {num} > {c} * {den})" for r, (num, den, cuts) in RULES.items() for c in cuts)
    fail = " or ".join(f"exists (select 1 from best b where b.stratum = f.stratum and b.rule = '{r}' "
                       f"and 100 * f.{num} > b.cutoff * f.{den})" for r, (num, den, _) in RULES.items())
    return rf"""
with words as (select doc_id, coalesce(lang, 'und') as stratum, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS}+'), lambda x: x <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
    from documents),
windows as (select doc_id, unnest(range(1, len(w) - 1)) as i, w from words where len(w) > 2),
grams as (select doc_id, i, w[i] || ' ' || w[i+1] || ' ' || w[i+2] as g from windows),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from grams) where c > 1),
covered as (select doc_id, count(distinct p) as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice) group by doc_id),
feats as (select doc_id, stratum, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words,
    len(lines)::bigint as n_lines, length(regexp_replace(text, '[^\p{{Lu}}]+', '', 'g'))::bigint as n_upper
    from words left join covered using (doc_id)),
f as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from feats),
tests as (select f.stratum, l.quality, unnest([{tests}]) as t from f join labels l using (doc_id)
          where not f.base_failed and l.quality in (0, 1)),
g as (select stratum, t[1] as rule, t[2] as cutoff, count(*) filter (quality = 1) as n,
      count(*) filter (quality = 1 and t[3]) as k, count(*) filter (quality = 0 and t[3]) as caught from tests group by all),
p as (select *, case when k > n * {ALPHA} then 1 else
      (select sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({ALPHA}) + (n - i) * ln(1 - {ALPHA})))
       from range(0, k + 1) as r(i)) end as tail from g where n > 0 and caught > 0),
sure as (select * from p where tail <= {DELTA} / (select greatest(1, count(*)) from g)),
best as (select stratum, rule, arg_max(cutoff, (caught, cutoff)) as cutoff from sure group by all)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and not ({fail}) as kept from f
"""


NEAR_DEDUP = rf"""
with recursive w as (select doc_id, list_filter(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '{_WS}+'),
    lambda x: x <> '') as w from documents),
grams as (select distinct doc_id, g from (select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then
    [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i+1] || ' ' || w[i+2]) end) as g
    from w)),
sizes as (select doc_id, count(*) as n from grams group by doc_id),
common as (select x.doc_id as a, y.doc_id as b, count(*) as k from grams x join grams y on x.g = y.g and x.doc_id < y.doc_id
           group by all),
links as (select a, b from common join sizes s on s.doc_id = a join sizes t on t.doc_id = b
          where 100 * k >= 85 * (s.n + t.n - k)),
edges as (select a, b from links union select b, a from links),
reach(node, root) as (select doc_id, doc_id from documents union select r.node, e.b from reach r join edges e on e.a = r.root),
comp as (select node, min(root) as c from reach group by node)
select d.doc_id, coalesce(s.n, 0)::bigint as n_shingles, c.c as component_id, d.doc_id = c.c as kept
from documents d left join sizes s using (doc_id) join comp c on c.node = d.doc_id
"""

DECONTAMINATION = rf"""
with d as (select doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w from documents),
b as (select item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') as w from benchmark),
bm as (select *, least(10, len(w)) as m from b where len(w) > 0),
win as (select distinct item_id, m, array_to_string(w[i:i+m-1], ' ') as g from (select *, unnest(range(1, len(w) - m + 2)) as i from bm)),
lens as (select distinct m from win),
dw as (select doc_id, m, i, array_to_string(w[i:i+m-1], ' ') as g
       from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) as i from d, lens)),
found as (select doc_id, i, m, item_id from dw join win using (m, g)),
hits as (select doc_id, count(distinct p) as n from (select doc_id, unnest(range(i, i + m)) as p from found) group by doc_id),
items as (select doc_id, count(*) as n, string_agg(item, ',' order by item) as ids
          from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(hits.n, 0)::bigint as n_hit, coalesce(items.n, 0)::bigint as n_items,
       sha256(coalesce(items.ids, '')) as items_sha256, coalesce(hits.n, 0) > 0 as contaminated
from d left join hits using (doc_id) left join items using (doc_id)
"""


# crc32 by its defining rule: the table of all bytes, then one step per byte
_CRC_TABLE = """crc_table as (select list(c order by i) as tab from (select i, list_reduce(list_prepend(i, range(8)),
    lambda a, b: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end) as c from range(256) r(i)))"""


def _crc32(byte_list: str) -> str:
    """Needs ``crc_table`` in the FROM clause."""
    return f"xor(list_reduce(list_prepend(4294967295, {byte_list}), lambda a, b: xor(a >> 8, tab[(xor(a, b) & 255) + 1])), 4294967295)"


CONVERSATION_REPAIR = rf"""
with recursive {_CRC_TABLE},
named as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: unicode(c)::bigint) as b
    from conversations),
hashed as (select *, {_crc32("b")} % 20 as h from named, crc_table),
hurt as (select conv_id, turn, if(h = 4, 'user', role) as role,
    case h when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
    from hashed, range(if(h = 3, 2, 1)) where h <> 0),
placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from hurt),
judged as (select *, role[1:1] as initial, not regexp_matches(text, '[^\x20\x09-\x0D]') as blank,
    row_number() over (partition by conv_id, role, text order by i) > 1 as again,
    regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) not in ('.', '!', '?') as cut,
    lag(role[1:1]) over (partition by conv_id order by i) || role[1:1] as pair from placed),
facts as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (blank) as blank, count(*) filter (not blank and again) as duplicate,
    count(*) filter (not blank and not again and cut) as truncated,
    count(*) filter (pair not in ('su', 'ua', 'au')) as illegal from judged group by conv_id),
nxt(place, name, into_) as (values (0, 'user', 2), (1, 'user', 2), (3, 'user', 2), (2, 'assistant', 3)),
ways(conv_id, i, place, best) as (
    select conv_id, 0::bigint, 0, {{'cost': 0::bigint, 'audit': '', 'lines': []::varchar[]}} from facts
    union all
    (with once as (select w.conv_id, w.i, w.place, w.best from ways w union all
        select w.conv_id, w.i, into_, {{'cost': best.cost + 5, 'audit': best.audit || 'I', 'lines': list_append(best.lines, name || ':')}}
        from ways w join nxt using (place)),
     twice as (select * from once union all
        select o.conv_id, o.i, into_, {{'cost': best.cost + 5, 'audit': best.audit || 'I', 'lines': list_append(best.lines, name || ':')}}
        from once o join nxt using (place)),
     edges as (
        select t.conv_id, t.i + 1 as i, place, {{'cost': best.cost + 2, 'audit': best.audit || 'D', 'lines': best.lines}} as best
        from twice t join judged j on j.conv_id is not distinct from t.conv_id and j.i = t.i + 1
        union all
        select t.conv_id, t.i + 1, into_, {{'cost': best.cost + 1 + if(cut, 5, 0), 'audit': best.audit || 'R',
               'lines': list_append(best.lines, name || ':' || text)}}
        from twice t join nxt using (place) join judged j on j.conv_id is not distinct from t.conv_id and j.i = t.i + 1
        where not blank and not again
        union all
        select t.conv_id, t.i + 1, k.into_, {{'cost': best.cost + if(cut, 5, 0), 'audit': best.audit || 'K',
               'lines': list_append(best.lines, role || ':' || text)}}
        from twice t join judged j on j.conv_id is not distinct from t.conv_id and j.i = t.i + 1
        join (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)) k(place, initial, into_)
          on k.place = t.place and k.initial = j.initial
        where not blank and not again)
     select conv_id, i, place, min(best) from edges group by conv_id, i, place)),
done as (select w.conv_id, min(case place when 0 then best when 3 then best
        when 2 then {{'cost': best.cost + 5, 'audit': best.audit || 'I', 'lines': list_append(best.lines, 'assistant:')}}
        else {{'cost': best.cost + 10, 'audit': best.audit || 'II', 'lines': best.lines || ['user:', 'assistant:']}} end) as best
    from ways w join facts f on f.conv_id is not distinct from w.conv_id and f.n = w.i group by w.conv_id)
select c.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
       coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(best.cost, 0) as cost,
       coalesce(best.audit, '') as audit, sha256(coalesce(array_to_string(best.lines, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) c
left join facts f on f.conv_id is not distinct from c.conv_id left join done d on d.conv_id is not distinct from c.conv_id
"""

SPELLING_VARIANTS = rf"""
with recursive {_CRC_TABLE},
runs as (select doc_id, run, count(*) as n from (select doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-zÀ-ÿ]+')) as run
    from documents) group by all),
bytes as (select *, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || run, ''),
    lambda c: if(unicode(c) < 128, [unicode(c)::bigint], [195, unicode(c)::bigint - 64]))) as b from runs where length(run) >= 5),
hashed as (select *, {_crc32("b")} as h from bytes, crc_table),
words as (select if(h % 97 = 0, substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2), run) as word, n from hashed),
v as materialized (select word, sum(n)::bigint as n from words where length(word) >= 5 group by word having sum(n) >= 3),
letters as (select word, unnest(range(1, length(word) + 1)) as i from v),
shorter as (select distinct word, substr(word, 1, i - 1) || substr(word, i + 1) as less from letters),
masked as (select word, substr(word, 1, i - 1) || '*' || substr(word, i + 1) as mask from letters),
near as materialized (select s.word, v.word as other from shorter s join v on v.word = less
    union all select v.word, s.word from shorter s join v on v.word = less
    union all select x.word, y.word from masked x join masked y using (mask) where x.word <> y.word),
best as (select near.word, count(*) as n_near, min({{'minus': -v.n, 'other': other}}) as b from near join v on v.word = other group by near.word),
formed as materialized (select v.word, v.n, coalesce(n_near, 0) as n_near, if(-b.minus >= 2 * v.n, b.other, null) as form,
    if(-b.minus >= 2 * v.n, -b.minus, null) as form_n from v left join best using (word)),
chain(word, last_) as (select word, word from formed union all select chain.word, form from chain join formed on formed.word = last_ where form is not null),
roots as (select chain.word, last_ as root from chain join formed on formed.word = last_ where form is null)
select word, form, root, n, n_near, form_n::bigint as form_n from formed join roots using (word)
"""

SUFFIX_DEDUP = """
with d as (select doc_id, hex(encode(coalesce(text, ''))) as x from documents),
b as (select doc_id, x, (length(x) // 2)::bigint as n from d),
chunks as (select doc_id, c, substr(x, 2 * c + 1, 2 * (1000 + 199)) as y, least(1000, n - 199 - c) as m
    from (select doc_id, x, n, unnest(range(0, n - 199, 1000)) as c from b)),
s as (select doc_id, c + i as i, md5_number(substr(y, 2 * i + 1, 400)) as h from (select doc_id, c, y, unnest(range(0, m)) as i from chunks)),
r as (select doc_id, i from (select doc_id, i, count(*) over (partition by h) as k from s) where k > 1),
runs as (select doc_id, i, coalesce(i > lag(i) over w + 200, true) as fresh from r window w as (partition by doc_id order by i)),
span as (select doc_id, min(i) as a, max(i) + 200 as z from
    (select *, count(*) filter (fresh) over (partition by doc_id order by i) as g from runs) group by doc_id, g),
g as (select doc_id, sum(z - a)::bigint as n_removed, count(*) as n_spans, list(a order by a) as a, list(z order by z) as z from span group by doc_id)
select b.doc_id, b.n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
    sha256(unhex(case when g.a is null then x else array_to_string(list_transform(range(0, len(g.a) + 1),
        lambda k: substr(x, case when k = 0 then 1 else 2 * g.z[k] + 1 end,
            2 * (case when k = len(g.a) then n else g.a[k + 1] end - case when k = 0 then 0 else g.z[k] end))), '') end)) as kept_sha256
from b left join g using (doc_id)
"""

SQL: dict[str, str] = {"op4_line_dedup": LINE_DEDUP, "op6_quality_rules": quality_rules(),
                      "op7_decontamination": DECONTAMINATION, "op10_minhash_near_dedup": NEAR_DEDUP,
                      "op11_conversation_repair": CONVERSATION_REPAIR, "op12_spelling_variants": SPELLING_VARIANTS,
                      "op13_suffix_dedup": SUFFIX_DEDUP}

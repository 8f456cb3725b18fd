"""DuckDB SQL for the results of the operators that SQL can express.

An independent statement of each result over the whole tables (documents
with distinct ids); nothing in the library uses it.
"""
from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from starmart.llm.phrases import DEFAULT as MINING
from starmart.llm.quality_rules import DEFAULT

_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = f"translate({{}}, '{ascii_uppercase}', '{ascii_lowercase}')"


def _chars(words: str) -> str:
    return f"coalesce(list_sum(list_transform({words}, lambda x: length(x))), 0)"


def _covered(n: int) -> str:
    """Words inside n-word windows that occur twice or more in their text."""
    return f"""
g{n} as (select doc_id, i, array_to_string(ws[i:i + {n - 1}], ' ') as g
  from (select doc_id, ws, unnest(range(1, len(ws) - {n - 2})) as i from w) x),
c{n} as (select doc_id, count(*) as n, sum(length(ws[p])) as chars from (
  select distinct doc_id, i + k as p from (
    select doc_id, i, count(*) over (partition by doc_id, g) as times from g{n}) y,
    (select unnest(range(0, {n})) as k) z where times > 1) q join w using (doc_id) group by doc_id)"""


def quality_rules() -> str:
    lengths = sorted({DEFAULT.base_window, *DEFAULT.ngram_shares})
    share = round(100 * DEFAULT.base_share)
    repeat = f"coalesce(c{DEFAULT.base_window}.n, 0)"
    dup = {n: f"coalesce(c{n}.chars, 0)" for n in DEFAULT.ngram_shares}
    lines = "coalesce(l.dup_chars, 0)"
    failed = f"(len(ws) < {DEFAULT.min_words} or 100 * {repeat} > {share} * len(ws))"
    bad = " or ".join([failed, f"{lines} > {DEFAULT.line_share}::double * word_chars",
                       *(f"{dup[n]} > {s}::double * word_chars" for n, s in DEFAULT.ngram_shares.items())])
    return f"""
with w as (select doc_id, coalesce(text, '') as t, {_WORDS.format("coalesce(text, '')")} as ws from documents),
line as (select doc_id, s, k, {_chars(_WORDS.format("s"))} as chars from (
  select doc_id, unnest(string_split(t, chr(10))) as s, generate_subscripts(string_split(t, chr(10)), 1) as k from w) x),
l as (select doc_id, count(*) as n, sum(chars) as dup_chars from (
  select doc_id, chars, row_number() over (partition by doc_id, s order by k) as r from line where chars > 0) y
  where r > 1 group by doc_id),
{",".join(_covered(n) for n in lengths)},
s as (select *, {_chars("ws")} as word_chars from w)
select doc_id, len(ws)::bigint as n_words, word_chars::bigint as word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols,
  coalesce(l.n, 0)::bigint as n_dup_lines, {repeat}::bigint as n_repeat_words,
  {failed} as base_failed, not ({bad}) as kept, {lines}::bigint as dup_line_chars,
  {", ".join(f"{dup[n]}::bigint as dup_chars_{n}" for n in DEFAULT.ngram_shares)}
from s left join l using (doc_id) {" ".join(f"left join c{n} using (doc_id)" for n in lengths)}
"""


_TERMS = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = rf"""
with d as (select doc_id, coalesce({_TERMS}, []) as ws from documents),
b as (select item_id, {_TERMS} as ws from benchmark),
win as (select distinct item_id, least(len(ws), 13) as n, array_to_string(ws[i:i + 12], ' ') as g
  from (select item_id, ws, unnest(range(1, greatest(len(ws) - 12, 1) + 1)) as i from b where len(ws) > 0) x),
size as (select distinct n from win),
dw as (select doc_id, i, n, array_to_string(ws[i:i + n - 1], ' ') as g
  from (select doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) as i from d, size) y),
hit as (select dw.doc_id, dw.i, dw.n, win.item_id from dw join win on dw.g = win.g and dw.n = win.n),
pos as (select doc_id, count(*) as n_hit from (
  select distinct doc_id, unnest(range(i, i + n)) as p from hit) z group by doc_id),
item as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from hit) q group by doc_id)
select doc_id, len(ws)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
  coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(ws) as contaminated
from d left join pos using (doc_id) left join item using (doc_id)
"""

_CONTROL = r"<\|(?:turn|text|end)\|>|</?s>|</?<?/?SYS>>|\[/?INST\]"
_ESCAPED = f"(length({{0}}) + length({{0}}) - length(replace({{0}}, '\\', '')) + len(regexp_extract_all({{0}}, '{_CONTROL}')))"

CHAT = f"""
with t as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn)) as turns_sha256,
  sum(case when role = 'assistant' then length(text) else 0 end)::bigint as loss_chars,
  sha256(string_agg(case when role = 'assistant' then text else '' end, '' order by turn)) as loss_sha256,
  sum(24 + {_ESCAPED.format('role')} + {_ESCAPED.format('text')})::bigint as formatted_chars
from t group by conv_id
"""

JACCARD = f"""
with recursive w as (select doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} as ws from documents),
s as (select distinct doc_id, array_to_string(ws[i:i + 4], ' ') as g
  from (select doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) as i from w where len(ws) > 0) x),
n as (select doc_id, count(*) as n from s group by doc_id),
common as (select a.doc_id as u, b.doc_id as v, count(*) as c from s a join s b on a.g = b.g and a.doc_id <> b.doc_id
  group by 1, 2),
link as (select u, v from common join n x on x.doc_id = u join n y on y.doc_id = v
  where 100 * c >= 75 * (x.n + y.n - c)),
reach(a, b) as (select doc_id, doc_id from w union select r.a, l.v from reach r join link l on r.b = l.u),
least as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
from least left join n using (doc_id)
"""

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_FIVE = " + ".join(f"{16 >> k} * (bits[i * 5 + {k + 1}] = '1')::int" for k in range(5))

WARC = f"""
with p as (select page_id, coalesce(html, '') as payload from pages),
b as (select *, cast(cast(unhex(sha1(payload)) as bit) as varchar) as bits,
  min(page_id) over (partition by payload) as first from p)
select page_id, strlen(payload)::bigint as payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: '{_BASE32}'[1 + {_FIVE}]), '') as payload_digest,
  case when page_id = first then 'response' else 'revisit' end as record_type,
  case when page_id <> first then first end as refers_to
from b
"""

_PHRASES = f"""
with p as (select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(
  {_LOWER.format("coalesce(text, '')")}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from p),
g as (select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase from (
  select lang, ws, k, unnest(range(1, len(ws) - k + 2)) as i from w, (values (1), (2), (3)) s(k) where len(ws) >= k) x),
f as materialized (select lang, phrase, k, count(*) as f from g group by lang, phrase, k),
total as (select lang, sum(f) as n from f where k = 1 group by lang),
c as materialized (select lang, phrase, k, f as a, string_split(phrase, ' ') as ws from f where k > 1 and f >= {MINING.least}),
split as materialized (select lang, phrase, a, spot, array_to_string(ws[:spot], ' ') as p1,
    array_to_string(ws[spot + 1:], ' ') as p2 from (select *, unnest(range(1, k)) as spot from c) x),
lft as materialized (select s.*, f.f as l from split s join f on f.lang = s.lang and f.phrase = s.p1),
cut as (select s.lang, s.phrase, a, spot, l, f.f as r,
    (1000000 * a::hugeint * a::hugeint) // (l::hugeint * f.f::hugeint) as score
  from lft s join f on f.lang = s.lang and f.phrase = s.p2),
low as (select * from cut qualify row_number() over (partition by lang, phrase order by score, spot) = 1),
cover as (select lang, array_to_string(ws[i:i + 1], ' ') as phrase, max(a) as longer
  from (select *, unnest([1, 2]) as i from c where k = 3) x group by all),
kept as (select low.*, n from low left join cover using (lang, phrase) join total using (lang)
  where longer is null or 100 * longer < {MINING.cover} * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase)::bigint as rank, phrase,
  a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from kept qualify rank <= {MINING.top}
"""

ORACLE_SQL = {"op12_phrase_mining": _PHRASES, "op3_decontamination": DECONTAMINATION, "op6_chat_formatting": CHAT,
              "op7_quality_rules": quality_rules(), "op8_jaccard_join": JACCARD, "op9_warc": WARC}

"""The queries as SQL for DuckDB, where SQL can say them.  Each follows its contract, not the operator's way."""

from __future__ import annotations

import re

from . import mixing, pii, quality
from .urlfilter import SITE_RULES, given_globs

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_SPACES = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"


def _context(pattern: str) -> str:
    """The context of match i: up to pii.NEAR code points of the gaps on either side, without cut words."""
    gap, n = f"string_split_regex(t, '{pattern}')", pii.NEAR
    left = f"case when length({gap}[i]) > {n} then regexp_replace(right({gap}[i], {n}), '\\A\\p{{L}}+', '') else {gap}[i] end"
    right = f"case when length({gap}[i + 1]) > {n} then regexp_replace(left({gap}[i + 1], {n}), '\\p{{L}}+\\z', '') else {gap}[i + 1] end"
    return f"concat({left}, '|', {right})"


def _located(kind: str, pattern: str, valid: str, near: bool = False) -> str:
    """A list of the valid matches in t, with code points; ``valid`` is over v, digits over g."""
    context = f", 'c': {_context(pattern)}" if near else ""
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{pattern}')) + 1), lambda i: {{'kind': '{kind}',
      'b': (list_sum(list_transform(string_split_regex(t, '{pattern}')[1:i], lambda x: length(x)))
        + coalesce(list_sum(list_transform(regexp_extract_all(t, '{pattern}')[1:i - 1], lambda x: length(x))), 0))::bigint,
      'v': regexp_extract_all(t, '{pattern}')[i]{context}}}), lambda s: {valid})"""


_DIGITS = "regexp_replace(s.v, '[^0-9]', '', 'g')"
_LUHN = f"""list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda k: case when (length({_DIGITS}) - k) % 2 = 0 then substr({_DIGITS}, k, 1)::int
  else substr({_DIGITS}, k, 1)::int * 2 - case when substr({_DIGITS}, k, 1)::int > 4 then 9 else 0 end end)) % 10 = 0"""
_KINDS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "len(list_filter(string_split(s.v, '.'), lambda p: p::hugeint > 255)) = 0"),
    ("card", r"[0-9]([\x20-]?[0-9])+", f"length({_DIGITS}) between 13 and 19 and {_LUHN}"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) between 9 and 15"),
)
_BASE, _NEAR = ("list_concat(list_concat({}, {}), list_concat({}, {}))".format(*(_located(*k, near=near) for k in _KINDS)) for near in (False, True))
_NAMED = "array_to_string(list_transform({}, lambda s: concat(s.kind, ':', s.b, ':', s.b + length(s.v))), ',')"

PII = f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
based as (select doc_id, {_BASE} as base from d),
held as (select doc_id, s.kind || ':' || s.v as entity, s.c as context from (select doc_id, unnest({_NEAR}) as s from d where regexp_matches(t, '@|[0-9]'))),
term as (select distinct doc_id, entity, context, unnest(regexp_extract_all(lower(context), '{pii.TERM}')) as term from held),
pair as (select entity, term, count(distinct doc_id) as n_both, count(distinct context)::double as c from term group by 1, 2),
n_term as (select term, count(*) as n_term from (select distinct doc_id, unnest(regexp_extract_all(lower(t), '{pii.TERM}')) as term from d) group by 1),
n_entity as (select entity, count(distinct doc_id) as n_entity from held group by 1),
counts as (select entity, term, n::double as n, n_entity, c, least(n_both / n_term, 1.0::double) as p, nullif(log2(n::double / n_entity), 0) as ic
  from pair join n_term using (term) join n_entity using (entity), (select count(distinct doc_id) as n from documents)),
share as (select entity, term, log2(n * p / n_entity) / ic as share from counts where log2(n / n_entity
  * (p + {pii.Z**2}::double / (2 * c) - {pii.Z}::double * sqrt(p * (1 - p) / c + {pii.Z**2}::double / (4 * c * c))) / (1 + {pii.Z**2}::double / c)) / ic >= {pii.GENERALISE}),
mine as (select doc_id, term, max(least(share, 1.0)) as share from (select distinct doc_id, entity from held) join share using (entity) group by 1, 2),
word as (select doc_id, unnest({_located("term", r"\p{L}+", "true")}) as s from d where doc_id in (select doc_id from mine)),
more as (select doc_id, string_agg(concat(case when share >= {pii.REMOVE} then 'term_removed' else 'term' end, ':', s.b, ':', s.b + length(s.v)), ',' order by s.b) as more
  from word join mine using (doc_id) where lower(s.v) = term group by 1)
select doc_id, {", ".join(f"len(list_filter(base, lambda s: s.kind = '{k}'))::bigint as n_{k}" for k in pii.KINDS)},
  sha256({_NAMED.format("base")}) as base_sha256, concat_ws(',', nullif({_NAMED.format("base")}, ''), more) as spans, len(base)::bigint as n_base
from based left join more using (doc_id)
"""

LINE_DEDUP = f"""
with l as (select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos from documents),
k as (select *, {_LOWER.format(f"trim(line, {_SPACES})")} as key from l),
bad as (select key, max(doc_id) as top from k where length(key) >= 20 group by 1 having count(distinct doc_id) >= 3),
judged as (select doc_id, pos, line, coalesce(doc_id <> top, false) as lost from k left join bad using (key))
select doc_id, count(*)::bigint as n_lines, count(*) filter (where lost)::bigint as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by pos) filter (where not lost), '')) as kept_sha256
from judged group by doc_id
"""

JACCARD = f"""
with recursive w as (select doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} as w from documents),
g as (select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
  else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end) as g from w),
s as (select doc_id, unnest(g) as s from g),
n as (select doc_id, len(g)::bigint as n from g),
e as (select a.doc_id as a, b.doc_id as b from s a join s b on a.s = b.s and a.doc_id < b.doc_id join n x on x.doc_id = a.doc_id join n y on y.doc_id = b.doc_id
  group by a.doc_id, b.doc_id, x.n, y.n having 100 * count(*) >= 75 * (x.n + y.n - count(*))),
u as (select a, b from e union all select b, a from e),
r as (select doc_id as node, doc_id as c from documents union select u.b, r.c from r join u on u.a = r.node where r.c < u.b)
select n.doc_id, n as n_shingles, min(c) as component_id from n join r on r.node = n.doc_id group by 1, 2
"""

_BITS = " + ".join(f"case when {rule.fails} then {1 << k} else 0 end" for k, rule in enumerate(quality.RULES))

QUALITY = rf"""
with d as (select doc_id, coalesce(text, '') as t, {_WORDS.format("coalesce(text, '')")} as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 7], ' ') as x from (select doc_id, w, unnest(range(1, len(w) - 6)) as i from d)),
twice as (select doc_id, i from (select *, count(*) over (partition by doc_id, x) as n from win) where n > 1),
rep as (select doc_id, count(distinct i + j)::bigint as n from twice, range(8) r(j) group by 1),
ln as (select doc_id, count(*)::bigint as n_lines, (count(*) - count(distinct x))::bigint as n_dup_lines
  from (select doc_id, unnest(string_split(t, chr(10))) as x from d) where regexp_matches(x, '[^\x20\x09-\x0D]') group by 1),
m as (select doc_id, len(w)::bigint as n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::bigint as word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::bigint as n_symbols, coalesce(n_lines, 0) as n_lines,
  coalesce(n_dup_lines, 0)::bigint as n_dup_lines, coalesce(rep.n, 0)::bigint as n_repeat_words
  from d left join ln using (doc_id) left join rep using (doc_id)),
b as (select *, ({_BITS})::bigint as fail_bits from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & {quality.POLICIES["base"]} <> 0 as base_failed,
  fail_bits & {quality.POLICIES["base"] | quality.POLICIES[quality.DEFAULT_POLICY]} = 0 as kept, fail_bits from b
"""

_FITS = " union all ".join(f"select '{r.host}' as h, '{r.path}' as p, '{r.verdict}' as v" for r in SITE_RULES)

#: The globs as one pattern: ** is any run, * any run without / and ?.
_GLOBS = "|".join(re.sub(r"(?:\\\*){2,}", ".*", re.escape(g)).replace(r"\*", "[^/?]*").replace(r"\-", "-") for g in given_globs())
_URL = f"{_LOWER.format("regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)', 1, 's')")}"

URLS = f"""
with u as (select page_id, coalesce(url, '') like '%://%' as ok, {_URL} as host,
  regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') as path, regexp_extract(coalesce(url, ''), '^.*?://[^?#]*([?][^#]*)', 1, 's') as query from pages),
r as ({_FITS}),
best as (select page_id, arg_max(concat(h, p), length(concat(h, p))) as rule, arg_max(v, length(concat(h, p))) as v
  from u join r on ok and (host = h or ends_with(host, concat('.', h))) and starts_with(path, p) group by 1),
j as (select *, ok and regexp_matches(concat('.', host, {_LOWER.format("case when path = '' then '/' else path end")}, {_LOWER.format("query")}), '^(?:{_GLOBS})', 's') as bad from u left join best using (page_id))
select page_id, host, path, rule, coalesce(v, case when bad then 'block' else 'allow' end) as verdict,
  case when rule is not null then 'rule' when bad then 'glob' else 'default' end as "by" from j
"""

SUBSTRINGS = f"""
with d as (select doc_id, {_WORDS.format("coalesce(text, '')")} as w from documents),
win as (select doc_id, i, array_to_string(w[i:i + 49], ' ') as x from (select doc_id, w, unnest(range(1, len(w) - 48)) as i from d)),
late as (select doc_id, i from (select *, min(doc_id) over (partition by x) as first from win) where first < doc_id),
-- the words in a late window are those with at most 49 words since the last late start
word as (select doc_id, unnest(w) as x, generate_subscripts(w, 1) as k from d),
seen as (select word.doc_id, x, k, max(late.i) over (partition by word.doc_id order by k) as last from word left join late on late.doc_id = word.doc_id and late.i = k),
judged as (select *, coalesce(k - last < 50, false) as gone from seen)
select d.doc_id, len(w)::bigint as n_words, coalesce(n, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from d left join (select doc_id, count(*) filter (where gone) as n, string_agg(x, ' ' order by k) filter (where not gone) as kept from judged group by 1) using (doc_id)
"""

_NORMAL = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(_LOWER.format("coalesce(text, '')"))

DECONTAMINATION = f"""
with b as (select item_id, {_NORMAL} as w from benchmark),
bw as (select distinct item_id, least(len(w), 13) as n, array_to_string(w[i:i + 12], ' ') as x from (select item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) as i from b where len(w) > 0)),
width as (select distinct n from bw),
d as (select doc_id, {_NORMAL} as w from documents),
dw as (select doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') as x from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as i from d, width where len(w) >= n)),
hit as (select doc_id, dw.n, i, item_id from dw join bw on bw.n = dw.n and bw.x = dw.x),
found as (select doc_id, count(distinct item_id)::bigint as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from hit group by 1),
word as (select doc_id, count(distinct k)::bigint as n_hit from (select distinct doc_id, unnest(range(i, i + n)) as k from hit) group by 1)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(items, '')) as items_sha256,
  coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join found using (doc_id) left join word using (doc_id)
"""

_WEIGHT = "case ((row_number() over (order by source nulls last)) - 1) % 3 when 0 then 1.0::double when 1 then 2.0::double else 3.0::double end"

MIX = f"""
with d as (select doc_id, source, len({_WORDS.format("coalesce(text, '')")})::bigint as size,
  (('0x' || substr(md5(concat(coalesce(doc_id::varchar, 'null'), ':{mixing.SEED}')), 1, 12))::bigint + 0.5::double) / {float(1 << 48)}::double as u from documents),
s as (select source, sum(size)::bigint as source_size from d group by 1),
c as (select *, source_size * 3.0::double as cap, {_WEIGHT} as w from s),
l as (select *, (sum(source_size) over ()::double - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0.0::double))
  / sum(w) over (o rows between current row and unbounded following) as level from c window o as (order by cap / w, w, source nulls last)),
t as (select source, source_size, least(cap, (select arg_min(level, cap / w) from l where level * w <= cap) * w) as target from l),
p as (select *, least(floor(case when source_size > 0 then target / source_size else 1.0::double end), 3)::int as whole from t),
q as (select *, greatest(target - whole * source_size, 0.0::double) as want from p),
k as (select d.source, length(bin(size)) - 1 as k, sum(size)::double as cap, pow(2.0::double, {mixing.POWER} * (length(bin(size)) - 1)) * sum(size)::double as w, any_value(want) as want
  from d join q on d.source is not distinct from q.source where size > 0 and want > 0 group by 1, 2),
f as (select *, (want - coalesce(sum(cap) over (o rows between unbounded preceding and 1 preceding), 0.0::double))
  / sum(w) over (o rows between current row and unbounded following) as level from k window o as (partition by source order by k desc)),
h as (select source, arg_min(level, -k) filter (where level * w <= cap) as level from f group by 1),
p2 as (select f.source, k, least(1.0::double, coalesce(h.level * w / cap, 1.0::double)) as p from f join h on f.source is not distinct from h.source),
r as (select doc_id, size, source_size, target, whole, want, d.source, u * (1 - p) / (u * (1 - p) + p * (1 - u)) as rank
  from d join q on d.source is not distinct from q.source left join p2 on d.source is not distinct from p2.source and size > 0 and length(bin(size)) - 1 = p2.k),
z as (select *, sum(size) over (partition by source order by rank, doc_id nulls last, size rows unbounded preceding) as till from r)
select doc_id, size, source_size, target, ((whole + case when rank is not null and till - size / 2.0::double <= want then 1 else 0 end) * size)::bigint as taken from z
"""

ORACLES = {
    "op1_pii": PII,
    "op3_line_dedup": LINE_DEDUP,
    "op4_ngram_jaccard": JACCARD,
    "op6_quality_rules": QUALITY,
    "op7_url_filter": URLS,
    "op8_substring_dedup": SUBSTRINGS,
    "op9_decontamination": DECONTAMINATION,
    "op10_source_mix": MIX,
}

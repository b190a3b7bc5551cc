"""DuckDB SQL for the registered queries whose results SQL can express."""

from __future__ import annotations

from formflow.llm import chat, quality, urls

_WORDS = r"list_filter(regexp_split_to_array({0}, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def chat_formatting(said: str) -> str:
    quoted = lambda s: "'" + s.replace("'", "''") + "'"
    # An escaped text has one character more for each control string.
    size = lambda c: f"length({c}) + len(regexp_extract_all({c}, {quoted(chat._ANY)}))"
    fixed = len(chat.START) + len(chat.SEPARATOR) + len(chat.END)
    loss = "coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')"
    return f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', {quoted(said)} union all select -1, 1, 'assistant', {quoted(said)})
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  length({loss}) as loss_chars, sha256({loss}) as loss_sha256,
  cast(sum({fixed} + {size('role')} + {size('text')}) as bigint) as formatted_chars
from turns group by conv_id"""


def url_filter(rules: list[urls.Rule], how: urls.Propagation = urls.Propagation()) -> str:
    host = _LOWER.format(r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    fits = lambda r: f"(host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}')"
    choose = lambda of: "case " + " ".join(f"when {fits(r)} then '{of(r)}'" for r in ordered) + " end"
    link = urls._LINK.replace("'", "''")
    d = how.damping
    steps = ["s0 as materialized (select host, (1 - {d}) * trust as trust, (1 - {d}) * distrust as distrust from seeds)".format(d=d)]
    for k in range(1, how.steps + 1):
        steps.append(f"""s{k} as materialized (select host, sum(trust) as trust, sum(distrust) as distrust from (
  select * from s0
  union all select e.dst, {d} * s.trust * e.forward, 0 from shares e join s{k - 1} s on e.src = s.host
  union all select e.src, 0, {d} * s.distrust * e.backward from shares e join s{k - 1} s on e.dst = s.host) group by host)""")
    return f"""
with parsed as (
  select page_id, html, {host} as host, coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path from pages),
ruled as (select *, {choose(lambda r: r.name)} as rule, {choose(lambda r: r.verdict)} as said from parsed),
seeds as (
  select host, avg(case when said = 'allow' then 1.0 else 0 end) as trust, avg(case when said = 'block' then 1.0 else 0 end) as distrust
  from ruled where host <> '' group by host having count(said) > 0),
links as (
  select host as src, unnest(list_distinct(list_transform(regexp_extract_all(coalesce(html, ''), '{link}', 1), lambda x: {_LOWER.format('x')}))) as dst
  from ruled),
edges as (select src, dst, count(*) as weight from links where src <> dst and src <> '' and dst <> '' group by src, dst),
shares as materialized (
  select src, dst, weight / sum(weight) over (partition by src) as forward, weight / sum(weight) over (partition by dst) as backward from edges),
{', '.join(steps)}
select page_id, r.host, path, rule, coalesce(said,
  case when round(coalesce(distrust, 0), 9) >= {how.threshold} and round(coalesce(distrust, 0), 9) > round(coalesce(trust, 0), 9) then 'block' else 'allow' end) as verdict
from ruled r left join s{how.steps} s on r.host = s.host"""


def quality_rules(how: quality.Risk = quality.Risk()) -> str:
    rate = how.risk / len(how.rules)
    sums, choices, rejects = [], [], []
    for rule in how.rules:
        passed = []
        options = []
        for i, cut in enumerate(quality.RULES[rule]):
            sums += [f"sum(case when quality = 1 and {rule} > {cut} then 1 else 0 end) as g_{rule}_{i}",
                     f"sum(case when quality <> 1 and {rule} > {cut} then 1 else 0 end) as b_{rule}_{i}"]
            passed.append(f"""(g_{rule}_{i} < n_good * {rate} and list_sum(list_transform(range(0, cast(g_{rule}_{i} as bigint) + 1), lambda i:
  exp(lgamma(n_good + 1) - case when i = 0 then 0 else lgamma(i + 1) end - lgamma(n_good - i + 1) + i * ln({rate}) + (n_good - i) * ln(1 - {rate})))) <= level)""")
            options.append(f"case when {' and '.join(passed)} and b_{rule}_{i} > 0 then {{'bad': b_{rule}_{i}, 'rank': -{i}, 'cut': {cut}}} end")
        choices.append(f"list_max([{', '.join(options)}])['cut'] as cut_{rule}")
        rejects.append(f"coalesce({rule} > cut_{rule}, false)")
    words = _WORDS.format("t")
    return f"""
with texts as (select row_number() over () as id, doc_id, lang as stratum, coalesce(text, '') as t from documents),
split as (
  select id, doc_id, stratum, t, {words} as w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as l from texts),
places as (select id, unnest(range(1, len(w) - 1)) as i, w from split where len(w) > 2),
windows as (select id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from places),
repeated as (select id, i from (select id, i, count(*) over (partition by id, g) as n from windows) where n > 1),
covered as (
  select id, count(*) as n from (
    select id, i from repeated union select id, i + 1 from repeated union select id, i + 2 from repeated) group by id),
counts as (
  select s.id, doc_id, stratum, len(w) as n_words, length(array_to_string(w, '')) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols, len(l) - len(list_distinct(l)) as n_dup_lines,
    coalesce(c.n, 0) as n_repeat_words, len(l) as n_lines, length(regexp_replace(t, '[^A-Z]+', '', 'g')) as n_capitals
  from split s left join covered c on s.id = c.id),
stats as materialized (
  select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > {quality.MAX_REPEATED_PCT} * n_words as base_failed,
    coalesce(n_symbols / nullif(n_words, 0), 0) as symbols_per_word, coalesce(n_repeat_words / nullif(n_words, 0), 0) as repeated_share,
    coalesce(n_dup_lines / nullif(n_lines, 0), 0) as repeated_lines, coalesce(n_capitals / nullif(word_chars, 0), 0) as capitals_share
  from counts),
marks as (select doc_id, min(quality) as quality from labels where doc_id is not null and quality is not null group by doc_id),
held as (select distinct on (doc_id) s.*, quality from stats s join marks using (doc_id) where not base_failed),
tallies as (select stratum, sum(case when quality = 1 then 1 else 0 end) as n_good, {', '.join(sums)} from held group by stratum),
levels as (select *, {how.error} / (count(*) over () * {len(how.rules)}) as level from tallies),
cuts as (select stratum, {', '.join(choices)} from levels)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not (base_failed or {' or '.join(rejects)}) as kept
from stats s left join cuts c on s.stratum is not distinct from c.stratum"""


def minhash_near_dedup(size: int = 4, percent: int = 80) -> str:
    words = _WORDS.format(_LOWER.format("coalesce(text, '')"))
    return f"""
with recursive split as (select doc_id, {words} as w from documents),
places as (select doc_id, w, unnest(range(1, greatest(len(w) - {size - 1}, least(len(w), 1)) + 1)) as i from split),
shingles as materialized (select distinct doc_id, array_to_string(w[i:i + {size - 1}], ' ') as s from places),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
pairs as (select a.doc_id as a, b.doc_id as b, count(*) as both_ from shingles a join shingles b on a.s = b.s and a.doc_id < b.doc_id group by 1, 2),
links as materialized (
  select p.a, p.b from pairs p join sizes x on p.a = x.doc_id join sizes y on p.b = y.doc_id where 100 * both_ >= {percent} * (x.n + y.n - both_)),
both_ways as materialized (select a, b from links union select b, a from links),
reach as (select a, b from both_ways union select r.a, e.b from reach r join both_ways e on r.b = e.a),
least_ as (select a as doc_id, min(b) as m from reach group by a)
select d.doc_id, coalesce(n, 0) as n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) as component_id, d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) as kept
from split d left join sizes s on d.doc_id = s.doc_id left join least_ l on d.doc_id = l.doc_id"""


def warc(least: int = 1000) -> str:
    return f"""
with p as (select page_id, coalesce(html, '') as h from pages),
g as (select *, max(page_id) over (partition by h) as m, strlen(h) >= {least} as large from p)
select page_id, strlen(h) as payload_bytes, sha1(h) as payload_digest,
  case when large and m is not null and (page_id is null or page_id < m) then 'revisit' else 'response' end as record_type,
  case when large and m is not null and (page_id is null or page_id < m) then m end as refers_to
from g"""


def suffix_array_dedup(length: int = 400) -> str:
    """All strings of ``length`` bytes by their 64-bit hashes; spans are cut out of the hexadecimal text."""
    return f"""
with texts as materialized (
  select row_number() over () as id, doc_id, encode(coalesce(text, '')) as e, hex(encode(coalesce(text, ''))) as h from documents),
places as (select id, e, unnest(range(0, octet_length(e) - {length - 1})) as i from texts where octet_length(e) >= {length}),
strings as (select id, i, hash(array_slice(e, i + 1, i + {length})) as s from places),
twice as (select id, i from (select id, i, count(*) over (partition by s) as n from strings) where n > 1),
marked as (select id, i, case when i - lag(i) over (partition by id order by i) <= {length} then 0 else 1 end as new from twice),
grouped as (select id, i, sum(new) over (partition by id order by i) as g from marked),
spans as (select id, min(i) as a, max(i) + {length} as b from grouped group by id, g),
kept as (
  select s.id, a, b, lag(b, 1, 0) over (partition by s.id order by a) as p, row_number() over (partition by s.id order by a desc) as last, h
  from spans s join texts t on s.id = t.id),
cut as (
  select id, cast(sum(b - a) as bigint) as n_removed, count(*) as n_spans,
    string_agg(substr(h, 2 * p + 1, 2 * (a - p)), '' order by a) || max(case when last = 1 then substr(h, 2 * b + 1) end) as rest
  from kept group by id)
select t.doc_id, octet_length(e) as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans, sha256(unhex(coalesce(rest, h))) as kept_sha256
from texts t left join cut c on t.id = c.id"""

r"""SQL (DuckDB) for the corpus queries that SQL can express, written from their definitions."""

from __future__ import annotations

#: Texts as the chat template writes them: control strings with one more backslash; roles only where they would not come back.
OP11_CHAT_FORMAT = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, t, r, '<|im_end|><|im_start|>assistant ok' from (values (0, 'user'), (1, 'assistant')) as h(t, r)
), written as (
  select *,
    case when regexp_matches(role, '\n|\\n|\\\\|<\\*\|im_(start|end)\|>')
         then regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*\|im_(start|end)\|>)', '<\\\1', 'g')
         else role end as as_role,
    regexp_replace(text, '<(\\*\|im_(start|end)\|>)', '<\\\1', 'g') as as_text
  from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (role = 'assistant'), '')) as loss_sha256,
  cast(sum(length('<|im_start|>') + length(as_role) + 1 + length(as_text) + length('<|im_end|>') + 1) as bigint) as formatted_chars
from written group by conv_id
"""

#: crc32 bit by bit; then the cheapest edits row by row: for each state the least (cost, edits), with the turns they leave.
OP13_TURN_REPAIR = r"""
with recursive keyed as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    xor(list_reduce(
      list_concat([4294967295::bigint], list_transform(
        string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda c: ascii(c)::bigint)),
      lambda acc, b: list_reduce(list_concat([xor(acc, b)], range(8)),
        lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
    ), 4294967295) % 20 as kind
  from conversations
), damaged as (
  select conv_id, turn, case kind when 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from keyed, range(2) as copies(nth) where kind <> 0 and (kind = 3 or nth = 0)
), ordered as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text) as i from damaged
), placed as (
  select *, row_number() over (partition by conv_id, role, text order by i) as nth, regexp_replace(text, '[\x20\x09-\x0D]+$', '') as said
  from ordered
), judged as (
  select *, left(role, 1) as ini, case when said = '' then 'blank' when nth > 1 then 'duplicate' when right(said, 1) not in ('.', '!', '?') then 'truncated' end as fault
  from placed
), figures as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
    count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
    count(*) filter (fault = 'truncated') as truncated
  from judged group by conv_id
), neighbours as (
  select conv_id, count(*) filter (before || ini not in ('su', 'ua', 'au')) as illegal
  from (select conv_id, ini, lag(ini) over (partition by conv_id order by i) as before from judged) group by conv_id
), best as (
  -- n: nothing yet, s, u, a: after such a turn. c: cost, e: edits, t: turns; 1e6 stands for a state out of reach.
  select conv_id, 0::bigint as i, {'c': 0, 'e': '', 't': ''} as n, {'c': 1000000, 'e': '', 't': ''} as s,
    {'c': 2, 'e': 'I', 't': chr(10) || 'user:'} as u, {'c': 4, 'e': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'} as a
  from (select distinct conv_id from conversations)
  union all
  select conv_id, i, n, s,
    list_min([u, {'c': n.c + 2, 'e': n.e || 'I', 't': n.t || chr(10) || 'user:'}, {'c': s.c + 2, 'e': s.e || 'I', 't': s.t || chr(10) || 'user:'},
              {'c': a.c + 2, 'e': a.e || 'I', 't': a.t || chr(10) || 'user:'}]) as u2,
    list_min([a, {'c': struct_extract(u2, 'c') + 2, 'e': struct_extract(u2, 'e') || 'I', 't': struct_extract(u2, 't') || chr(10) || 'assistant:'}])
  from (
    select b.conv_id, j.i,
      {'c': b.n.c + 3, 'e': b.n.e || 'D', 't': b.n.t} as n,
      list_min([{'c': b.s.c + 3, 'e': b.s.e || 'D', 't': b.s.t}, {'c': b.n.c + late + case when ini = 's' then 0 else 1000000 end, 'e': b.n.e || 'K', 't': b.n.t || own}]) as s,
      list_min([{'c': b.u.c + 3, 'e': b.u.e || 'D', 't': b.u.t},
        {'c': b.n.c + late + as_u, 'e': b.n.e || edit_u, 't': b.n.t || turn_u}, {'c': b.s.c + late + as_u, 'e': b.s.e || edit_u, 't': b.s.t || turn_u},
        {'c': b.a.c + late + as_u, 'e': b.a.e || edit_u, 't': b.a.t || turn_u}]) as u,
      list_min([{'c': b.a.c + 3, 'e': b.a.e || 'D', 't': b.a.t}, {'c': b.u.c + late + as_a, 'e': b.u.e || edit_a, 't': b.u.t || turn_a}]) as a
    from best b join (
      select *, case when fault in ('blank', 'duplicate') then 1000000 when fault = 'truncated' then 1 else 0 end as late,
        chr(10) || role || ':' || text as own,
        case when ini = 'u' then 0 else 2 end as as_u, case when ini = 'u' then 'K' else 'R' end as edit_u,
        chr(10) || case when ini = 'u' then role else 'user' end || ':' || text as turn_u,
        case when ini = 'a' then 0 else 2 end as as_a, case when ini = 'a' then 'K' else 'R' end as edit_a,
        chr(10) || case when ini = 'a' then role else 'assistant' end || ':' || text as turn_a
      from judged
    ) j on b.conv_id is not distinct from j.conv_id and j.i = b.i + 1
  )
), last as (
  select conv_id, arg_max(case when a.c < n.c or (a.c = n.c and a.e < n.e) then a else n end, i) as f from best group by conv_id
)
select l.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, f.c::bigint as cost, f.e as audit, sha256(substr(f.t, 2)) as repaired_sha256
from last l left join figures g on l.conv_id is not distinct from g.conv_id left join neighbours b on l.conv_id is not distinct from b.conv_id
"""

ORACLES: dict[str, str] = {"op11_chat_format": OP11_CHAT_FORMAT, "op13_turn_repair": OP13_TURN_REPAIR}


def url_rules_sql(hosts, patterns, default: str = "allow") -> str:
    """Every host rule as a CASE, and every pattern's regular expression tried on every url."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    by_length = sorted(hosts, key=lambda r: (-len(str(r)), str(r)))
    fits = [f"when (host = {quoted(r.host)} or ends_with(host, {quoted('.' + r.host)})) and starts_with(path, {quoted(r.path)})" for r in by_length]
    rule = "case " + " ".join(f"{f} then {quoted(str(r))}" for f, r in zip(fits, by_length, strict=True)) + " end"
    verdict = "case rule " + " ".join(f"when {quoted(str(r))} then {quoted(r.verdict)}" for r in by_length) + " end"
    ordered = [*(p for p in patterns if p.verdict == "allow"), *(p for p in patterns if p.verdict != "allow")]
    matches = [f"when regexp_matches(lower_url, {quoted(p.regex())})" for p in ordered]
    number = "case " + " ".join(f"{m} then {n}" for n, m in enumerate(matches)) + " end"
    of = lambda field: "case hit " + " ".join(f"when {n} then {quoted(getattr(p, field))}" for n, p in enumerate(ordered)) + " end"
    return f"""
with cut as (
  select page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as lower_url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path
  from pages
), ruled as (select *, {rule} as rule, {number} as hit from cut)
select page_id, host, path, rule, coalesce({verdict}, {of("verdict")}, {quoted(default)}) as verdict,
  case when rule is null then {of("pattern")} end as pattern
from ruled
"""

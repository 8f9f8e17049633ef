"""DuckDB SQL of the registered queries of this subpackage."""
from __future__ import annotations

SQL = {}

SQL["op1_exact_dedup"] = r"""
with hashed as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256 from documents)
select doc_id, min(doc_id) over (partition by text_sha256) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id = min(doc_id) over (partition by text_sha256) as kept, text_sha256
from hashed
"""

SQL["op8_chat"] = r"""
with given as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked as (
  select *, lag(role) over w is not distinct from role as merged, lead(role) over w is not distinct from role as goes_on,
         regexp_extract_all(replace(text, '\', '\\'), '<\||</?s>|<</?SYS>>|\[/?INST\]') as controls,
         regexp_extract_all(replace(role, '\', '\\'), '<\||</?s>|<</?SYS>>|\[/?INST\]') as role_controls
  from given window w as (partition by conv_id order by turn, role, text))
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       cast(sum(case when role = 'assistant' then length(text) else 0 end) as bigint) as loss_chars,
       sha256(coalesce(string_agg(case when role = 'assistant' then text else '' end, '' order by turn, role, text), '')) as loss_sha256,
       cast(7 + sum(length(replace(text, '\', '\\')) + len(controls)
           + case when merged then 8 else 4 + length(replace(role, '\', '\\')) + len(role_controls)
                  + (length(role) - length(replace(role, '|>', ''))) // 2 end
           + case when goes_on then 0 else 7 end) as bigint) as formatted_chars
from marked group by conv_id
"""

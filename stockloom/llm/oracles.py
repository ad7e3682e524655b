"""SQL of the queries that SQL can express."""

_LOWER = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _shingles(table: str, key: str, word: str, size: int) -> str:
    """Distinct runs of ``size`` words; a shorter text is one run."""
    runs = f"[array_to_string(ws[i : i + {size - 1}], ' ') for i in range(1, len(ws) - {size - 2})]"
    return f"""
      (select distinct {key}, unnest(case when len(ws) >= {size} then {runs}
              when len(ws) > 0 then [array_to_string(ws, ' ')] else [] end) as g
       from (select {key}, regexp_extract_all({_LOWER.format(text="coalesce(text, '')")}, '{word}') as ws
             from {table}))"""


_PLAIN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_SPACED = r"[^\x20\x09-\x0D]+"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLES: dict[str, str] = {
    "op8_warc": f"""
      with hashed as (select page_id, coalesce(html, '') as body, sha1(coalesce(html, '')) as h from pages),
      marked as (select *, min(page_id) over (partition by body) as first from hashed)
      select page_id, octet_length(encode(body))::bigint as payload_bytes,
             array_to_string([substr('{_BASE32}',
               ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::bigint >> (15 - 5 * (i % 4))) & 31)::int + 1, 1)
               for i in range(0, 32)], '') as payload_digest,
             case when page_id = first then 'response' else 'revisit' end as record_type,
             case when page_id <> first then first end as refers_to
      from marked""",
    "op9_jaccard_join": f"""
      with recursive sets as materialized {_shingles("documents", "doc_id", _SPACED, 3)},
      sizes as materialized (select doc_id, count(*) as n from sets group by doc_id),
      common as (select a.doc_id as a, b.doc_id as b, count(*) as c
                 from sets a join sets b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
      links as materialized (
        select a, b from common join sizes x on x.doc_id = a join sizes y on y.doc_id = b
        where 100 * c >= 90 * (x.n + y.n - c)),
      reach as (select doc_id as a, doc_id as b from documents
                union select reach.a, links.b from reach join links on links.a = reach.b)
      select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id
      from (select a as doc_id, min(b) as component_id from reach group by a)
      left join sizes using (doc_id)""",
    "op10_decontamination": f"""
      with sets as {_shingles("documents", "doc_id", _PLAIN, 5)},
      items as materialized {_shingles("benchmark", "item_id", _PLAIN, 5)},
      sizes as (select item_id, count(*) as n from items group by item_id)
      select doc_id, item_id, any_value(n)::bigint as n_item_shingles, count(*)::bigint as n_shared
      from sets join items using (g) join sizes using (item_id)
      group by doc_id, item_id having 100 * count(*) >= 80 * any_value(n)""",
}

ORACLES["op5_quality_rules"] = rf"""
  with words as (
    select row_number() over () as rid, doc_id, coalesce(source, '') as host, coalesce(text, '') as t,
           regexp_extract_all(coalesce(text, ''), '{_SPACED}') as ws from documents),
  spots as (
    select rid, unnest(range(1, len(ws) - 1)) as i, ws from words where len(ws) >= 3),
  windows as (select rid, i, array_to_string(ws[i : i + 2], ' ') as g from spots),
  again as (
    select rid, i from windows qualify count(*) over (partition by rid, g) > 1),
  covered as (
    select rid, count(distinct p)::bigint as n_repeat_words
    from (select rid, unnest([i, i + 1, i + 2]) as p from again) group by rid),
  lines as (
    select rid, document, t, host, line, lower(trim(line, ' ')) as plain
    from (select rid, coalesce(doc_id::varchar, 'row ' || rid) as document, t, host, unnest(string_split(t, chr(10))) as line from words)
    where regexp_matches(line, '{_SPACED}')),
  often as (
    select host, plain from (select host, plain, count(distinct document) as n, count(distinct t) as texts
                             from lines group by 1, 2)
    join (select host, count(distinct coalesce(doc_id::varchar, 'row ' || rid)) as docs
          from words group by 1) using (host)
    where n > 20 and n > 0.1 * docs or texts > 100),
  totals as (
    select rid, (count(*) - count(distinct line))::bigint as n_dup_lines,
           sum(length(line))::bigint as line_chars,
           coalesce(sum(length(line)) filter (often.plain is not null), 0)::bigint as lost_chars
    from lines left join often using (host, plain) group by rid),
  stats as (
    select doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars,
           length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols,
           coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
           coalesce(line_chars, 0) as line_chars, coalesce(lost_chars, 0) as lost_chars
    from words left join covered using (rid) left join totals using (rid)),
  judged as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from stats)
  select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
         line_chars, lost_chars,
         not base_failed and line_chars - lost_chars >= 0.3 * line_chars as kept
  from judged"""

# Marks around a turn, and strings that get a backslash after their first character.
_MARKS = "case role when 'system' then 15 when 'user' then 13 when 'assistant' then 7 else 19 + length(role) end"
_CONTROL = r"<\\*(<SYS>>|</SYS>>|s>|/s>)|\[\\*(/?INST|/?ROLE|TEXT)\]"

ORACLES["op11_chat_format"] = rf"""
  with turns as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all
    select -1, i, case when i = 0 then 'user' else 'assistant' end, '</s>[INST] ok [/INST]' from range(2) t(i))
  select conv_id, count(*)::bigint as n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
         coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
         sha256(coalesce(string_agg(text, '' order by turn nulls first, text) filter (role = 'assistant'), '')) as loss_sha256,
         sum(length(text) + {_MARKS}
             + len(regexp_extract_all(text, '{_CONTROL}'))
             + case when role in ('system', 'user', 'assistant') then 0
               else len(regexp_extract_all(role, '{_CONTROL}')) end)::bigint as formatted_chars
  from turns group by conv_id"""

# Bytes are folded into the checksum by the table of its polynomial, as usual for crc32;
# near words share a string with one place starred, or one is the other less one place.
ORACLES["op12_spelling_variants"] = rf"""
  with recursive steps as (
    select i, 0 as k, i::bigint as c from range(256) t(i)
    union all
    select i, k + 1, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where k < 8),
  crc as materialized (select list(c order by i) as t from steps where k = 8),
  runs as (
    select doc_id, {_LOWER.format(text="unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{C0}-\\x{FF}]+'))")} as run
    from documents),
  long_runs as (
    select run, coalesce(doc_id::varchar, '') || ':' || run as key, count(*) as times
    from runs where length(run) >= 7 group by all),
  bytes as (
    select run, times, list_prepend(4294967295, list_transform(range(length(hex(encode(key))) // 2),
             lambda i: ('0x' || substr(hex(encode(key)), 2 * i + 1, 2))::bigint)) as bs
    from long_runs),
  hashed as (
    select run, times,
           xor(list_reduce(bs, lambda a, b: xor(a >> 8, t[xor(a, b) % 256 + 1])), 4294967295) as h
    from bytes, crc),
  spelled as (
    select case when h % 31 = 0 then substr(run, 1, (h % length(run))::int) || substr(run, (h % length(run))::int + 2)
           else run end as word, times from hashed),
  words as materialized (
    select word, sum(times)::bigint as n from spelled where length(word) >= 7
    group by word having sum(times) >= 2),
  cut as materialized (
    select word, n, substr(word, 1, i - 1) as l, substr(word, i + 1) as r
    from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
  starred as materialized (select word, n, l || '*' || r as s from cut),
  shorter as materialized (select distinct word, n, l || r as s from cut),
  pairs as materialized (
    select a.word, b.word as near, b.n as near_n from starred a join starred b on a.s = b.s and a.word <> b.word
    union all select a.word, b.word, b.n from shorter a join words b on a.s = b.word
    union all select b.word, a.word, a.n from shorter a join words b on a.s = b.word),
  best as (
    select word, count(*) as n_near, max(near_n) as near_n from pairs group by word),
  judged as materialized (
    select words.word, words.n, coalesce(n_near, 0)::bigint as n_near,
           case when near_n >= 10 * words.n then
             (select min(near) from pairs p where p.word = words.word and p.near_n = best.near_n) end as form,
           case when near_n >= 10 * words.n then near_n end as form_n
    from words left join best using (word)),
  chain as (
    select word, form as tip from judged where form is not null
    union all select chain.word, judged.form from chain join judged on judged.word = chain.tip where judged.form is not null),
  roots as (
    select chain.word, tip as root from chain join judged on judged.word = chain.tip where judged.form is null)
  select word, form, coalesce(root, word) as root, n, n_near, form_n from judged left join roots using (word)"""

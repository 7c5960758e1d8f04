"""SQL for DuckDB that gives the rows of the queries that SQL can state, each from its definition."""

from __future__ import annotations

from . import line_dedup, quality, warc

# White space of ASCII, a word, and the capital letters that are folded, as the contracts state them.
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
WORD = r"[^\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LINE_DEDUP = f"""
    with pieces as (select doc_id, source, unnest(string_split(text, chr(10))) as line,
                           unnest(range(1, len(string_split(text, chr(10))) + 1)) as place from documents),
    lines as (select *, trim(line, {SPACES}) as bare from pieces),
    held as (select source, bare, count(distinct doc_id) as n from lines where bare <> '' group by all),
    sites as (select source, count(*) as pages from documents group by all),
    boilerplate as (select held.source, bare from held join sites on held.source is not distinct from sites.source
                     where n >= {line_dedup.LEAST_PAGES} and n > cast({line_dedup.RATIO} as double) * pages),
    judged as (select l.*, exists (select 1 from boilerplate b where b.source is not distinct from l.source and b.bare = l.bare) as gone
                 from lines l),
    joined as (select doc_id, coalesce(string_agg(line, chr(10) order by place) filter (not gone), '') as cleaned,
                      count(*) as n_lines, count(*) filter (gone) as n_dropped from judged group by doc_id)
    select d.doc_id, d.source, cleaned as text, coalesce(n_lines, 0) as n_lines, coalesce(n_dropped, 0) as n_dropped
      from documents d left join joined j on d.doc_id = j.doc_id"""

TOPK = """
    with fine as (select vec_id, list_transform(embedding, lambda x: floor(cast(x as double) * 256)) as v from embeddings
                   where vec_id is not null and len(embedding) > 0
                     and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    scored as (select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) as score
                 from fine q join fine c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
    ranked as (select query_id, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank, vec_id, score
                 from scored)
    select * from ranked where rank <= 5"""

JACCARD = f"""
    with recursive words as materialized (
      select doc_id, regexp_extract_all(translate(coalesce(text, ''), '{CAPITALS}', '{CAPITALS.lower()}'), '{WORD}') as w from documents),
    placed as (select doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) as i from words),
    sets as materialized (select distinct doc_id, array_to_string(w[i:i + 3], ' ') as shingle from placed),
    sizes as materialized (select doc_id, count(*) as n from sets group by doc_id),
    common as (select a.doc_id as a, b.doc_id as b, count(*) as n from sets a join sets b on a.shingle = b.shingle and a.doc_id < b.doc_id
                group by all),
    links as materialized (
      select a, b from common c join sizes x on x.doc_id = a join sizes y on y.doc_id = b where 100 * c.n >= 85 * (x.n + y.n - c.n)),
    steps as materialized (select a, b from links union all select b, a from links),
    reached(doc_id, other) as (select a, b from steps union select r.doc_id, s.b from reached r join steps s on r.other = s.a)
    select d.doc_id, coalesce(s.n, 0) as n_shingles, least(d.doc_id, coalesce(r.smallest, d.doc_id)) as component_id
      from documents d left join sizes s on s.doc_id = d.doc_id
      left join (select doc_id, min(other) as smallest from reached group by doc_id) r on r.doc_id = d.doc_id"""


def _any_of(marks: str) -> str:
    return "[" + "".join("\\" + m if m in "[]|.*$\\^-" else m for m in marks).replace("'", "''") + "]"


QUALITY = f"""
    with words as (select doc_id, unnest(list) as word, unnest(range(1, len(list) + 1)) as place
                     from (select doc_id, regexp_extract_all(text, '{WORD}') as list from documents)),
    windows as (select *, lead(word, 1) over o as second, lead(word, 2) over o as third from words window o as (partition by doc_id order by place)),
    found as (select *, third is not null and count(*) over (partition by doc_id, word, second, third) > 1 as again from windows),
    covered as (select doc_id, word, again or coalesce(lag(again, 1) over o, false) or coalesce(lag(again, 2) over o, false) as again
                  from found window o as (partition by doc_id order by place)),
    by_word as (select doc_id, count(*) as n_words, cast(sum(len(word)) as bigint) as word_chars, count(*) filter (again) as n_repeat_words
                  from covered group by doc_id),
    pieces as (select doc_id, unnest(string_split(text, chr(10))) as line, unnest(range(1, len(string_split(text, chr(10))) + 1)) as place
                 from documents),
    lines as (select *, len(regexp_extract_all(line, '{WORD}')) as n, len(regexp_extract_all(line, '{_any_of(quality.SYMBOLS)}')) as symbols,
                     len(regexp_extract_all(line, '{_any_of(quality.SEPARATORS)}')) as separators, len(line) - len(replace(line, '!', '')) as shouts,
                     regexp_matches(line, '{_any_of(quality.ENDS)}{_any_of(quality.CLOSERS)}*([\\x20\\x09-\\x0D]|$)') as ends,
                     row_number() over (partition by doc_id, line order by place) > 1 as same from pieces),
    judged as (select *, case when 3 * symbols >= n and symbols > 0 and 5 * separators < n then 'punctuation'
                              when 5 * separators >= n then 'navigation'
                              when n > {quality.SHORT} and (3 * shouts >= n or not ends) then 'punctuation'
                              when regexp_matches(lower(line), '{"|".join([*quality.BOILERPLATE, quality.SIGNS])}') then 'boilerplate' end as rule
                 from lines where n > 0),
    by_line as (select doc_id, cast(sum(n) filter (rule is not null) as bigint) as lost, count(*) filter (same) as n_dup_lines,
                       count(*) filter (rule = 'punctuation') as n_punctuation, count(*) filter (rule = 'navigation') as n_navigation,
                       count(*) filter (rule = 'boilerplate') as n_boilerplate from judged group by doc_id),
    told as (select d.doc_id, coalesce(n_words, 0) as n_words, coalesce(word_chars, 0) as word_chars,
                    cast(len(regexp_extract_all(coalesce(text, ''), '{_any_of(quality.SYMBOLS)}')) as bigint) as n_symbols,
                    coalesce(n_dup_lines, 0) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, coalesce(lost, 0) as n_lost_words,
                    coalesce(n_punctuation, 0) as n_punctuation, coalesce(n_navigation, 0) as n_navigation,
                    coalesce(n_boilerplate, 0) as n_boilerplate
               from documents d left join by_word w on w.doc_id = d.doc_id left join by_line l on l.doc_id = d.doc_id)
    select * exclude (base_failed_), base_failed_ as base_failed, not base_failed_ and 100 * n_lost_words <= {quality.MOST_LOST} * n_words as kept
      from (select *, n_words < {quality.FEWEST_WORDS} or 100 * n_repeat_words > {quality.MOST_REPEATED} * n_words as base_failed_ from told)"""


WARC = f"""
    with firsts as (select *, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
    told as (select *, min(page_id) over (partition by payload_digest) as first from firsts),
    judged as (select *, payload_bytes >= {warc.LEAST_BYTES} and coalesce(first < page_id, false) as again from told)
    select page_id, payload_bytes, payload_digest, case when again then 'revisit' else 'response' end as record_type,
           case when again then first end as refers_to from judged"""

def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit (3988292384 is the fixed polynomial)."""
    bits = "[0, 0, 0, 0, 0, 0, 0, 0]::bigint[]"
    by_byte = f"list_reduce(list_prepend(xor(c, b), {bits}), lambda x, _: xor(x >> 1, (x & 1) * 3988292384))"
    letters = f"list_transform(string_split({text}, ''), lambda l: ascii(l)::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {letters}), lambda c, b: {by_byte}), 4294967295)"


def _leaf(text: str) -> str:
    values = ["doc_id::varchar", "source", "lang", "n_chars::varchar", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


MERKLE = f"""
    with recursive leaves as materialized (
      select doc_id, lang, row_number() over (partition by lang order by doc_id nulls first) - 1 as pos, count(*) over (partition by lang) as n,
             {_leaf("text")} as leaf,
             case when {crc32("doc_id::varchar")} % 3 = 0 then {_leaf(f"translate(text, '{CAPITALS}', '{CAPITALS.lower()}')")} end as found from documents),
    nodes(lang, level, idx, n, digest) as (
      select lang, 0, pos, n, leaf from leaves
      union all
      select lang, level + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(digest, '' order by idx)) from nodes where n > 1 group by lang, level, idx // 8),
    tree as materialized (select * from nodes),
    subroots as materialized (select lang, level as height, digest as subroot, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n
                                from tree where n = 1),
    tops(level, idx, n, digest) as (
      select 0, pos, n, subroot from subroots
      union all
      select level + 1, idx // 8, any_value((n + 7) // 8), sha256(string_agg(digest, '' order by idx)) from tops where n > 1 group by level, idx // 8),
    top as materialized (select * from tops),
    runs as (select a.lang, a.level, a.idx, coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx < a.idx), '') as before,
                    coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx > a.idx), '') as behind
               from tree a join tree b on a.lang is not distinct from b.lang and a.level = b.level and a.idx // 8 = b.idx // 8 where a.n > 1 group by all),
    top_runs as (select a.level, a.idx, coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx < a.idx), '') as before,
                        coalesce(string_agg(b.digest, '' order by b.idx) filter (b.idx > a.idx), '') as behind
                   from top a join top b on a.level = b.level and a.idx // 8 = b.idx // 8 where a.n > 1 group by all),
    steps as materialized (
      select l.lang, l.pos, r.level as step, before, behind from leaves l
        join runs r on l.lang is not distinct from r.lang and r.idx = l.pos // cast(pow(8, r.level) as bigint)
      union all
      select l.lang, l.pos, s.height + r.level, before, behind from leaves l join subroots s on l.lang is not distinct from s.lang
        join top_runs r on r.idx = s.pos // cast(pow(8, r.level) as bigint)),
    folded(lang, pos, step, digest) as (
      select lang, pos, 0, coalesce(found, leaf) from leaves
      union all
      select f.lang, f.pos, f.step + 1, sha256(before || digest || behind) from folded f
        join steps s on f.lang is not distinct from s.lang and f.pos = s.pos and f.step = s.step),
    ends as (select lang, pos, arg_max(digest, step) as folded_root from folded group by all),
    proofs as (select lang, pos, sha256(string_agg(before || behind, '' order by step)) as proof_sha256 from steps group by all)
    select doc_id, leaf, subroot, root, coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root, folded_root = root as verified
      from leaves l join subroots s on l.lang is not distinct from s.lang join ends e on l.lang is not distinct from e.lang and l.pos = e.pos
      left join proofs p on l.lang is not distinct from p.lang and l.pos = p.pos
      cross join (select digest as root from top where n = 1)"""

REPAIR = f"""
    with recursive spaced as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
                                     coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
    drawn as (select *, {crc32("key")} % 20 as fault from spaced),
    damaged as (select conv_id, turn, case when fault = 4 then 'user' else role end as role,
                       case fault when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
                       unnest(case when fault = 3 then [1, 2] else [1] end) as copy from drawn where fault <> 0),
    placed as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text), copy) as place, rtrim(text, {SPACES}) as said
                 from damaged),
    told as (select *, row_number() over (partition by conv_id, role, text order by place) > 1 as again,
                    lag(left(role, 1)) over (partition by conv_id order by place) || left(role, 1) as pair from placed),
    turns as materialized (
      select *, said = '' as blank, said <> '' and again as duplicate, said <> '' and not again and right(said, 1) not in ('.', '!', '?') as truncated from told),
    counts as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
                      count(*) filter (duplicate) as duplicate, count(*) filter (truncated) as truncated,
                      count(*) filter (pair not in ('su', 'ua', 'au')) as illegal, count(*) as n from turns group by conv_id),
    -- States: 0 nothing yet, 1 behind s, 2 behind u, 3 behind a. Inserts lead from state to state.
    inserts(p, q, cost, edits) as (values (0, 0, 0, ''), (0, 2, 3, 'I'), (0, 3, 6, 'IJ'), (1, 1, 0, ''), (1, 2, 3, 'I'), (1, 3, 6, 'IJ'),
                                          (2, 2, 0, ''), (2, 3, 3, 'J'), (3, 3, 0, ''), (3, 2, 3, 'I')),
    -- A row's edits: those of any role with an empty initial.
    moves(initial, p, q, cost, edit) as (values ('', 0, 0, 4, 'D'), ('', 1, 1, 4, 'D'), ('', 2, 2, 4, 'D'), ('', 3, 3, 4, 'D'), ('', 0, 2, 3, 'R'), ('', 1, 2, 3, 'R'),
                                                ('', 3, 2, 3, 'R'), ('', 2, 3, 3, 'S'), ('s', 0, 1, 0, 'K'), ('u', 0, 2, 0, 'K'), ('u', 1, 2, 0, 'K'),
                                                ('u', 3, 2, 0, 'K'), ('a', 2, 3, 0, 'K')),
    ways(conv_id, place, state, best) as (
      select conv_id, 0::bigint, q, lpad(cost::varchar, 12, '0') || edits from counts cross join (select * from inserts where p = 0)
      union all
      select w.conv_id, w.place + 1, i.q,
             min(lpad((left(w.best, 12)::bigint + m.cost + i.cost + case when t.truncated and m.edit <> 'D' then 3 else 0 end)::varchar, 12, '0')
                 || substr(w.best, 13) || m.edit || i.edits)
        from ways w join turns t on w.conv_id is not distinct from t.conv_id and t.place = w.place + 1
        join moves m on m.p = w.state and m.initial in ('', left(t.role, 1)) and (m.edit = 'D' or not (t.blank or t.duplicate))
        join inserts i on i.p = m.q group by w.conv_id, w.place, i.q),
    ends as (select w.conv_id, min(best) as best from ways w join counts c on w.conv_id is not distinct from c.conv_id and w.place = c.n
              where state in (0, 3) group by w.conv_id),
    pieces as (select conv_id, unnest(regexp_extract_all(substr(best, 13), '[IJ]*[DKRS](?:[IJ]*$)?')) as edits,
                      unnest(range(1, len(regexp_extract_all(substr(best, 13), '[IJ]*[DKRS](?:[IJ]*$)?')) + 1)) as place from ends),
    edits as (select conv_id, place, unnest(string_split(edits, '')) as edit, unnest(range(1, len(edits) + 1)) as part from pieces),
    lines as (select t.conv_id, t.place, part,
                     case edit when 'K' then role || ':' || text when 'R' then 'user:' || text when 'S' then 'assistant:' || text
                               when 'I' then 'user:' when 'J' then 'assistant:' end as line
                from edits e join turns t on e.conv_id is not distinct from t.conv_id and e.place = t.place where edit <> 'D'),
    texts as (select conv_id, sha256(string_agg(line, chr(10) order by place, part)) as repaired_sha256 from lines group by conv_id)
    select e.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
           coalesce(illegal, 0) as illegal, coalesce(left(best, 12)::bigint, 0) as cost, coalesce(translate(substr(best, 13), 'JS', 'IR'), '') as audit,
           coalesce(repaired_sha256, sha256('')) as repaired_sha256
      from (select distinct conv_id from conversations) e left join counts c on e.conv_id is not distinct from c.conv_id
      left join ends b on e.conv_id is not distinct from b.conv_id left join texts x on e.conv_id is not distinct from x.conv_id"""

ORACLES = {
    "op12_conversation_repair": REPAIR,
    "op11_merkle": MERKLE,
    "op2_line_dedup": LINE_DEDUP, "op5_topk": TOPK, "op7_jaccard_join": JACCARD, "op8_quality": QUALITY, "op9_warc": WARC,
}

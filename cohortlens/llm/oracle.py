"""SQL twins (DuckDB) of the registered queries that SQL can express."""

from __future__ import annotations

_BLANK = r"[\x20\x09-\x0D]"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 of the sixteen half bytes (reflected polynomial 0xEDB88320).
_CRC = [0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
        0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C]


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string: one half byte of the text after the other."""
    halves = (f"flatten(list_transform(string_split({text}, ''), lambda c: [ascii(c)::bigint & 15, ascii(c)::bigint >> 4]))")
    step = f"xor({[int(x) for x in _CRC]}[((xor(a, x)) & 15) + 1], a >> 4)"
    return f"xor(list_reduce(list_concat([4294967295::bigint], {halves}), lambda a, x: {step}), 4294967295)"


ORACLE: dict[str, str] = {
    "op1_line_dedup": rf"""
        with lines as (
            select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as pos
            from documents),
        keyed as (
            select *, {_LOWER.format(f"regexp_replace(line, '^{_BLANK}+|{_BLANK}+$', '', 'g')")} as key from lines),
        repeated as (
            select key, max(doc_id) as keeper from keyed where length(key) >= 20
            group by key having count(distinct doc_id) >= 3),
        judged as (
            select k.*, coalesce(r.keeper <> k.doc_id, false) as gone
            from keyed k left join repeated r on k.key = r.key)
        select doc_id, count(*)::bigint as n_lines, count(*) filter (gone)::bigint as n_dropped,
               sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) as kept_sha256
        from judged group by doc_id""",
    "op3_chat": """
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
            union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
        escaped as (
            select *, replace(replace(role, '\\', '\\\\'), '<|', '<\\|') as safe_role,
                   replace(replace(text, '\\', '\\\\'), '<|', '<\\|') as safe_text from turns)
        select conv_id, count(*)::bigint as n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
               coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
               sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
               sum(12 + length(replace(safe_role, chr(10), '\\n')) + 1 + length(safe_text) + 11)::bigint as formatted_chars
        from escaped group by conv_id""",
    "op8_embeddings": """
        with recursive vectors as (
            select distinct vec_id, embedding, label from embeddings),
        usable as (
            select vec_id, embedding::double[] as v, label from vectors
            where label is not null and embedding is not null and len(embedding) > 0
              and list_bool_and([x is not null and isfinite(x) for x in embedding])
              and list_bool_or([x <> 0 for x in embedding])),
        links as (
            select a.vec_id as a, b.vec_id as b from usable a join usable b
              on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
            where list_cosine_similarity(a.v, b.v) >= 0.98),
        reach(a, b) as (
            select vec_id, vec_id from vectors
            union select r.a, l.b from reach r join links l on r.b = l.a),
        named as (select a, min(b) as component_id from reach group by a),
        counted as (select a, count(*) as n from links group by a)
        select v.vec_id, coalesce(c.n, 0)::bigint as n_links, m.component_id, m.component_id = v.vec_id as kept
        from vectors v join named m on m.a = v.vec_id left join counted c on c.a = v.vec_id""",
    "op11_trie": rf"""
        with src as (
            select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
                   row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), md5(coalesce(text, ''))) as pos
            from conversations where conv_id is not null),
        turns as (
            select conv_id, pos, md5(length(role) || ':' || role || text) as turn,
                   len(list_filter(regexp_split_to_array(text, '{_BLANK}+'), lambda w: w <> '')) as words from src),
        family as (
            select conv_id, conv_id - conv_id % 20 as head, {_crc32("conv_id::varchar")} % 4 as h
            from (select distinct conv_id from src)),
        built as (
            select f.conv_id, 0 as part, t.pos, t.turn, t.words from family f join turns t on t.conv_id = f.head and t.pos <= f.h
            union all
            select f.conv_id, 1, t.pos, t.turn, t.words from family f join turns t on t.conv_id = f.conv_id and t.pos > f.h),
        paths as (
            select f.conv_id, coalesce(list(b.turn order by part, pos) filter (b.turn is not null), []) as path,
                   coalesce(list(b.words order by part, pos) filter (b.turn is not null), []) as words
            from family f left join built b on f.conv_id = b.conv_id group by f.conv_id),
        prefixes as (
            select conv_id, d, path[1:d] as p, coalesce(words[d], 0) as words, d = len(path) as ended
            from (select *, unnest(range(0, len(path) + 1)) as d from paths)),
        nodes as (
            select p, d, min(conv_id) as conv_id, count(*) as n_convs, max(words) as words,
                   sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ended), '')) as ends_sha256
            from prefixes group by p, d),
        kids as (select p[1:d - 1] as p, d - 1 as d, count(*) as n from nodes where d > 0 group by 1, 2),
        below as (
            select v.p[1:e] as p, e as d, sum(case when k.n is null then 1 else 0 end) as n_leaves,
                   sum((v.n_convs - 1) * v.words) as saved
            from (select *, unnest(range(0, d + 1)) as e from nodes) v left join kids k on k.p = v.p and k.d = v.d group by 1, 2)
        select v.conv_id, v.d::bigint as depth, u.conv_id as parent_conv_id, v.n_convs::bigint as n_convs,
               coalesce(k.n, 0)::bigint as n_children, b.n_leaves::bigint as n_leaves, b.saved::bigint as saved_tokens, v.ends_sha256
        from nodes v join below b on b.p = v.p and b.d = v.d left join kids k on k.p = v.p and k.d = v.d
        left join nodes u on v.d > 0 and u.p = v.p[1:v.d - 1] and u.d = v.d - 1""",
    "op12_warc": """
        with payloads as (
            select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
        firsts as (
            select *, case when payload_bytes >= 100 then min(page_id) over (partition by payload_digest) end as first from payloads)
        select page_id, payload_bytes, payload_digest,
               case when first is not null and first is distinct from page_id then 'revisit' else 'response' end as record_type,
               case when first is distinct from page_id then first end as refers_to
        from firsts""",
}

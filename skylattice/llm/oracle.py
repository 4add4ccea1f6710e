"""DuckDB SQL for the queries here that SQL can express."""

from __future__ import annotations

_BLANK = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]+"

OP8 = rf"""
    with d as (
        select doc_id, regexp_replace(coalesce(text, ''), '{_BLANK}', ' ', 'g') as norm from documents),
    g as (
        select doc_id, norm, min(doc_id) over w as keep_id, count(*) over w as group_size,
            row_number() over (partition by norm order by doc_id) as i
        from d window w as (partition by norm))
    select doc_id, keep_id, group_size, i = 1 as kept, sha256(norm) as text_sha256 from g"""

#: Schedules of the three kinds of source as (from, to, weight at from, weight at to, demand before).
_PIECES = """(values
    (0, 0.0, 0.5, 4.0, 3.0, 0.0), (0, 0.5, 1.0, 3.0, 2.0, 1.75),
    (1, 0.0, 1.0, 0.5, 1.5, 0.0), (2, 0.0, 1.0, 2.0, 2.0, 0.0)) p(kind, a, b, u, v, q)"""

OP7 = rf"""
    with d as (
        select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) as bigint) as size,
            md5('mix:' || coalesce(cast(doc_id as varchar), '-') || ':' || coalesce(text, '')) as digest
        from documents),
    p as (
        select *, case when size > 0 then cast(ceil(log2(size)) as int) else 0 end as power from d),
    s0 as (
        select source, cast(sum(size) as bigint) as words, max(size) as largest,
            (row_number() over (order by source nulls last) - 1) % 3 as kind
        from d group by source),
    s1 as (
        select *, case kind when 0 then 3.0::double when 1 then 1.0 else 2.0 end as weight from s0),
    s2 as (
        select *, 2 * words / weight as stop from s1),
    s3 as (
        select *, row_number() over o as pos,
            (1.5::double * sum(words) over () - 2 * coalesce(sum(words) over b, 0))
            / (sum(weight) over () - coalesce(sum(weight) over b, 0)) as level
        from s2
        window o as (order by stop, source nulls last),
            b as (order by stop, source nulls last rows between unbounded preceding and 1 preceding)),
    s4 as (
        select *, min(case when level < stop then pos end) over () as first_pos from s3),
    s5 as (
        select *, case when first_pos is null or pos < first_pos then cast(2 * words as double)
            else max(case when pos = first_pos then level end) over () * weight end as target from s4),
    small as (
        select source, min(case when upto >= largest then power end) as power from (
            select source, power, sum(words) over (partition by source order by power) as upto,
                max(largest) over (partition by source) as largest
            from (select source, power, sum(size) as words, max(size) as largest from p group by 1, 2))
        group by source),
    s6 as (
        select s5.*, small.power as small,
            case when words > 0 then cast(floor(target / words) as int) else 0 end as passes
        from s5 join small on s5.source is not distinct from small.source),
    r as (
        select p.doc_id, p.digest, p.source, p.size, p.power > s6.small as big, s6.words, s6.target, s6.passes, s6.kind,
            s6.weight, s6.target - s6.passes * s6.words as rest,
            coalesce(sum(case when p.power > s6.small then size else 0 end) over w, 0) as l0,
            coalesce(sum(case when p.power > s6.small then 0 else size end) over w, 0) as s0,
            sum(case when p.power > s6.small then size else 0 end) over (partition by p.source) as large
        from p join s6 on p.source is not distinct from s6.source
        window w as (partition by p.source order by digest, doc_id
            rows between unbounded preceding and 1 preceding)),
    f as (
        select *, big and l0 + size / 2 < rest * large / words as first_part from r),
    g as (
        select *, sum(case when first_part then size else 0 end) over (partition by source) as given from f),
    c as (
        select *, case when size = 0 then 0 else passes + cast(
            case when big then first_part else s0 + size / 2 < rest - given end as int) end as copies,
            l0 + s0 as start
        from g),
    x as (
        select c.*, i, (case when i <= passes then (i - 1) * words + start
            else passes * words + rest * start / words end) / target * weight as demand
        from c, range(1, 4) t(i) where i <= copies),
    t as (
        select doc_id, digest, i, (
            select max_by(least(b, a + case when u + sqrt(greatest(u * u + 2 * (v - u) / (b - a) * (demand - q), 0)) > 0
                then 2 * (demand - q) / (u + sqrt(greatest(u * u + 2 * (v - u) / (b - a) * (demand - q), 0)))
                else 0 end), q)
            from {_PIECES} where p.kind = x.kind and (q <= demand or q = 0)) as spot
        from x),
    o as (
        select *, row_number() over (order by round(spot, 9), doc_id nulls first, i) - 1 as place from t),
    n as (
        select doc_id, digest, string_agg(place, ',' order by i) as places, round(min_by(spot, i), 6) as starts
        from o group by all)
    select c.doc_id, size, words as source_size, target, size * copies as taken, starts, coalesce(places, '') as places
    from c left join n on c.doc_id = n.doc_id and c.digest = n.digest"""

def _op3() -> str:
    from skylattice.llm.site_lines import BLOCK, ENTITIES, HIDDEN, HOST, PAGES, RATIO

    text = f"regexp_replace(coalesce(html, ''), '{HIDDEN}', '', 'g')"
    text = f"regexp_replace({text}, '{BLOCK}', chr(10), 'g')"
    text = f"regexp_replace({text}, '<[^>]*>', '', 'g')"
    for entity, character in ENTITIES:
        quoted = character.replace("'", "''")
        text = f"replace({text}, '{entity}', '{quoted}')"
    split = rf"[\x20\x09-\x0D]*[\x0A\x0D][\x20\x09-\x0D]*"
    return f"""
        with p as (
            select row_number() over () as page, page_id, nullif(lower(regexp_extract(url, '{HOST}', 1)), '') as host,
                list_filter(list_transform(regexp_split_to_array({text}, '{split}'), lambda x: trim(x)),
                    lambda x: x <> '') as lines
            from pages),
        h as (select host, count(*) as host_pages from p where host is not null group by host),
        e as (select distinct page, host, unnest(lines) as line from p where host is not null),
        b as (
            select host, list(line) as gone from (
                select e.host, line, count(*) as shown, any_value(host_pages) as host_pages
                from e join h on e.host = h.host group by e.host, line)
            where shown >= {PAGES} and shown > {RATIO}::double * host_pages group by host),
        k as (
            select page_id, p.host, lines,
                case when gone is null then lines
                    else list_filter(lines, lambda x: not list_contains(gone, x)) end as kept
            from p left join b on p.host = b.host)
        select page_id, host, array_to_string(kept, chr(10)) as text, cast(len(lines) as bigint) as n_lines,
            cast(len(lines) - len(kept) as bigint) as n_dropped
        from k"""


OP3 = _op3()


def _op5() -> str:
    from skylattice.llm.chat import BEGIN, CLOSE, END, HEAD, LEARNED, MARKED

    frame, turn = len(BEGIN + END), len(f"{HEAD}\n{CLOSE}\n")
    tricky = "'</s>[INST] ok [/INST]'"
    return f"""
        with c as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
            union all select -7, 0, 'user', {tricky} union all select -7, 1, 'assistant', {tricky}),
        t as (
            select *, len(role) + len(text) + {turn} + len(regexp_extract_all(text, '{MARKED}')) as chars,
                case when role = '{LEARNED}' then text else '' end as learned
            from c)
        select conv_id, count(*) as n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
            len(string_agg(learned, '' order by turn, role, text)) as loss_chars,
            sha256(string_agg(learned, '' order by turn, role, text)) as loss_sha256,
            cast(sum(chars) + {frame} as bigint) as formatted_chars
        from t group by conv_id"""


OP5 = _op5()

OP12 = r"""
    with items as (
        select item_id, term, count(*) as times from (
            select item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
            from (select distinct item_id, text from benchmark))
        group by 1, 2),
    d as (
        select row_number() over () as row, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
        from documents),
    t as (
        select cast(count(*) as bigint) as docs, cast(sum(len(terms)) as bigint) as words from d where len(terms) > 0),
    tf as (
        select row, term, count(*) as tf from (select row, unnest(terms) as term from d)
        where term in (select term from items) group by 1, 2),
    w as (
        select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1))) as bigint) as w
        from (select term, count(*) as df from tf group by 1), t),
    m as (
        select row, doc_id, 100 - 75 + (75 * len(terms) * docs) // words as m from d, t),
    s as (
        select i.item_id, m.row, any_value(m.doc_id) as doc_id,
            cast(sum(i.times * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * m.m))) as bigint) as score
        from items i join w using (term) join tf using (term) join m on m.row = tf.row
        group by i.item_id, m.row),
    r as (
        select item_id, doc_id, score,
            cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as int) as rank
        from s where score > 0)
    select item_id, rank, doc_id, score from r where rank <= 10"""

_PARTS, _ENTRIES, _WIDTH = 16, 64, 4  # embeddings have 64 components


def _assigned(entries: str) -> str:
    """Each part's nearest entry and squared distance."""
    return f"""
        select row, part, v, key % {_ENTRIES} as entry, key // {_ENTRIES} as apart from (
            select p.row, p.part, any_value(p.v) as v, min({_ENTRIES} * cast(
                list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, e.v) + list_inner_product(e.v, e.v) as bigint)
                + e.entry) as key
            from p join {entries} e on p.part = e.part group by 1, 2)"""


def _moved(assigned: str, entries: str) -> str:
    """Entries at the whole means of their parts; those without parts stay."""
    return f"""
        select e.part, e.entry, coalesce(n.v, e.v) as v from {entries} e left join (
            select part, entry, list(floor(total / number) order by j) as v from (
                select part, entry, j, sum(v[j]) as total, count(*) as number
                from {assigned}, range(1, {_WIDTH + 1}) x(j) group by 1, 2, 3)
            group by 1, 2) n on n.part = e.part and n.entry = e.entry"""


OP13 = f"""
    with kept as (
        select row_number() over (order by vec_id) - 1 as row, vec_id, label,
            list_transform(embedding, lambda x: floor(256 * x::double)) as v
        from embeddings
        where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
    p as (
        select row, part, v[{_WIDTH} * part + 1:{_WIDTH} * part + {_WIDTH}] as v from kept, range({_PARTS}) y(part)),
    e0 as (select part, row as entry, v from p where row < {_ENTRIES}),
    a0 as ({_assigned('e0')}),
    e1 as ({_moved('a0', 'e0')}),
    a1 as ({_assigned('e1')}),
    e2 as ({_moved('a1', 'e1')}),
    a2 as ({_assigned('e2')}),
    c as (
        select row, string_agg(printf('%02x', entry), '' order by part) as code, cast(sum(apart) as bigint) as error
        from a2 group by 1),
    h as (
        select sha256(string_agg(array_to_string(list_transform(v, lambda x: cast(x as bigint)), ','), ',' order by part, entry))
            as codebooks_sha256
        from e2)
    select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
    from kept join c using (row), h"""

ORACLES = {
    "op3_site_lines": OP3,
    "op5_chat": OP5,
    "op7_curriculum": OP7,
    "op8_exact_dedup": OP8,
    "op12_nra_search": OP12,
    "op13_anchor_codes": OP13,
}

"""Check SQL of the text queries, for DuckDB, where SQL can express them."""

from __future__ import annotations

DIMS, CLUSTERS, ROUNDS = 64, 16, 3

_FINITE = "len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0"


def _clustering() -> str:
    steps = [
        f"""v as (select row_number() over () as r, vec_id,
            list_transform(embedding, lambda x: floor(x::double * 64)::bigint) as v
            from embeddings where len(embedding) = {DIMS} and {_FINITE})""",
        """x as (select r, unnest(range(len(v))) as p, unnest(v) as x from v)""",
        f"""c0 as (select row_number() over (order by h, v) - 1 as k, v as c
            from (select sha256('1:' || vec_id::varchar) as h, v from v where vec_id is not null order by h, v
                  limit {CLUSTERS}))""",
    ]
    for n in range(ROUNDS + 1):
        steps.append(f"""a{n} as (select r, k, d from (
            select r, k, d, row_number() over (partition by r order by d, k) as place from (
                select r, k, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::bigint as d
                from v cross join c{n})) where place = 1)""")
        if n < ROUNDS:
            steps.append(f"""m{n} as (select k, list(((s - (((s % n) + n) % n)) // n)::bigint order by p) as c from (
                select k, p, sum(x)::hugeint as s, count(*)::hugeint as n from a{n} join x using (r) group by k, p) group by k)""")
            steps.append(f"c{n + 1} as (select k, coalesce(m{n}.c, c{n}.c) as c from c{n} left join m{n} using (k))")
    return f"""with {", ".join(steps)}
        select vec_id, k::integer as cluster, d as distance,
               (sum(d) over (partition by k))::bigint as cluster_inertia, (sum(d) over ())::bigint as inertia,
               sha256(array_to_string(c, ',')) as centroid_sha256
        from a{ROUNDS} join v using (r) join c{ROUNDS} using (k)"""


_TOP_K = f"""
    with v as (select row_number() over () as r, vec_id,
            list_transform(embedding, lambda x: floor(x::double * 256)::bigint) as v
            from embeddings where embedding is not null and {_FINITE}),
    s as (select q.r, q.vec_id as query_id, c.vec_id,
            coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0)::bigint as score
            from v q join v c on q.r <> c.r and len(q.v) = len(c.v) where q.vec_id % 50 = 0)
    select query_id, place::integer as rank, vec_id, score from (
        select *, row_number() over (partition by r order by score desc, vec_id nulls last) as place from s)
    where place <= 5"""


def _least(*ways: str) -> str:
    """The best of several (cost, audit, lines), as a list's first."""
    return f"list_sort([{', '.join(ways)}])[1]"


def _way(cost: str, letter: str, line: str | None, then: str) -> str:
    lines = f"{then}.t" if line is None else f"list_prepend({line}, {then}.t)"
    return f"{{'c': {then}.c + {cost}, 'a': '{letter}' || {then}.a, 't': {lines}}}"


def _repair() -> str:
    # from the last row to the first, the best rest from each state: nothing yet (n), after s, u and a
    none = "{'c': 1000000000::bigint, 'a': '~', 't': []::varchar[]}"
    own, user, assistant = "role || ':' || text", "'user:' || text", "'assistant:' || text"

    def step(state: str, kept: dict[str, str], put: str) -> str:
        keep = " ".join(f"when initial = '{i}' then {_way('cut', 'K', own, to)}" for i, to in kept.items())
        keep = f"case when gone then {none} {keep} else {none} end"
        line = user if put == "u" else assistant
        rerole = f"case when gone then {none} else {_way('cut + 3', 'R', line, put)} end"
        return _least(_way("4", "D", None, state), keep, rerole)

    new_u, new_a = "'user:'", "'assistant:'"
    base = f"""select b.conv, b.k - 1 as k, {step("n", {"s": "s", "u": "u"}, "u")} as n0, {step("s", {"u": "u"}, "u")} as s0,
        {step("u", {"a": "a"}, "a")} as u0, {step("a", {"u": "u"}, "u")} as a0 from best b join row_ r on r.conv is not distinct from b.conv and r.k = b.k"""
    closed = f"""select conv, k, n0, s0, {_least("u0", _way("3", "I", new_a, "a0"))} as u, {_least("a0", _way("3", "I", new_u, "u0"))} as a
        from ({base})"""
    end = """select conv, count(*) as k, {'c': 0::bigint, 'a': '', 't': []::varchar[]} as n,
        {'c': 6::bigint, 'a': 'II', 't': ['user:', 'assistant:']} as s, {'c': 3::bigint, 'a': 'I', 't': ['assistant:']} as u,
        {'c': 0::bigint, 'a': '', 't': []::varchar[]} as a from row_ group by conv"""
    return rf"""
    with recursive bits as (select list_transform(range(256), lambda n: list_reduce(range(8),
            lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, n)) as t),
    given as (select conv_id as conv, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        xor(list_reduce(list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''),
                lambda ch: unicode(ch)::bigint),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 as kind
        from conversations, bits),
    hurt as (select conv, turn, case when kind = 4 then 'user' else role end as role,
        case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text,
        unnest(case when kind = 3 then [1, 2] else [1] end) as copy from given where kind <> 0),
    placed as (select *, row_number() over (partition by conv order by turn nulls first, role, text, copy) as k,
        rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as shown, left(role, 1) as initial from hurt),
    told as (select *, row_number() over (partition by conv, role, text order by k) > 1 as again,
        lag(initial) over (partition by conv order by k) as was from placed),
    row_ as (select *, shown = '' or again as gone,
        case when right(shown, 1) in ('.', '!', '?') then 0 else 3 end as cut from told),
    best as ({end} union all
        select conv, k, {_least("n0", _way("3", "I", new_u, "u"))} as n, {_least("s0", _way("3", "I", new_u, "u"))} as s, u, a
        from ({closed})),
    done as (select conv, n from best where k = 0),
    counts as (select conv, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps,
        count_if(shown = '')::bigint as blank, count_if(shown <> '' and again)::bigint as duplicate,
        count_if(shown <> '' and not again and cut = 3)::bigint as truncated,
        count_if(was is not null and was || initial not in ('su', 'ua', 'au'))::bigint as illegal from row_ group by conv)
    select i.conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
        coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(n.c, 0) as cost,
        coalesce(n.a, '') as audit, sha256(coalesce(array_to_string(n.t, chr(10)), '')) as repaired_sha256
    from (select distinct conv_id from conversations) i
    left join counts on counts.conv is not distinct from i.conv_id
    left join done on done.conv is not distinct from i.conv_id"""


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}')"
_BLANK_WORD = r"[^\x20\x09-\x0D]+"


def _placed(source: str, text: str, word: str, row: str) -> str:
    """Rows of ``source`` numbered r, their words w, one per row with its place p from 1 on."""
    return f"""{row}_words as (select *, regexp_extract_all({text}, '{word}') as w from {source}),
        {row} as (select r, unnest(range(1, len(w) + 1)) as p, unnest(w) as word from {row}_words)"""


def _runs(width: int) -> str:
    """The list of up to ``width`` words from a place on."""
    return f"list(word) over (partition by r order by p rows between current row and {width - 1} following)"


def _similarity(width: int = 5, percent: int = 75) -> str:
    return rf"""
    with recursive given as (select doc_id as r, text from documents where doc_id is not null),
    {_placed("given", _LOWERED, _BLANK_WORD, "doc")},
    starts as (select r, p, {_runs(width)} as run from doc),
    shingle as (select distinct r, array_to_string(run, ' ') as g from starts where len(run) = {width} or p = 1),
    own as (select r, count(*) as n, md5(string_agg(g, chr(10) order by g)) as mark from shingle group by r),
    rep as (select mark, any_value(n) as n, min(r) as rep from own group by mark),
    kept as (select r, g, n from shingle join rep on r = rep),
    link as (select a.r as x, b.r as y from kept a join kept b on a.g = b.g and a.r <> b.r
        group by a.r, b.r having 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))),
    reach as (select rep as x, rep as y from rep union select reach.x, link.y from reach join link on reach.y = link.x),
    least as (select x, min(y) as label from reach group by x)
    select given.r as doc_id, coalesce(own.n, 0) as n_shingles, coalesce(label, given.r) as component_id
    from given left join own on own.r = given.r left join rep using (mark) left join least on x = rep"""


def _repeats(width: int = 13) -> str:
    return rf"""
    with given as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents where doc_id is not null),
    {_placed("given", "text", _BLANK_WORD, "doc")},
    starts as (select r, p, word, {_runs(width)} as run from doc),
    named as (select r, p, word, doc_id, case when len(run) = {width} then array_to_string(run, ' ') end as g
        from starts join given using (r)),
    seen as (select *, g is not null and min(doc_id) over (partition by g) < doc_id as again from named),
    cut as (select r, p, word, bool_or(again) over (partition by r order by p rows between {width - 1} preceding and current row)
        as gone from seen),
    left_ as (select r, count(*) as n, count_if(gone) as n_gone, string_agg(word, ' ' order by p) filter (where not gone) as kept
        from cut group by r)
    select doc_id, coalesce(n, 0)::bigint as n_words, coalesce(n_gone, 0)::bigint as n_removed,
           sha256(coalesce(kept, '')) as kept_sha256
    from given left join left_ using (r)"""


def _leaks(width: int = 10) -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
    with given as (select row_number() over () as r, doc_id, {_LOWERED} as text from documents where doc_id is not null),
    {_placed("given", "text", word, "doc")},
    items as (select row_number() over () as r, item_id, {_LOWERED} as text from benchmark where item_id is not null),
    {_placed("items", "text", word, "item")},
    asked as (select r, p, {_runs(width)} as run, least({width}, count(*) over (partition by r)) as k from item),
    windows as (select r as t, item_id, p as q, k, array_to_string(run, ' ') as g from asked join items using (r) where len(run) = k),
    starts as (select r, p, {_runs(width)} as run from doc),
    probes as (select r, p, k, array_to_string(run[1:k], ' ') as g from starts, (select distinct k from windows) where len(run) >= k),
    found as (select r, p, k, t, item_id, q from probes join windows using (k, g)),
    hit as (select r, count(*) as n from (select distinct r, unnest(range(p, p + k)) as p from found) group by r),
    named as (select r, count(*) as n, string_agg(item, ',' order by item) as ids
        from (select distinct r, item_id::varchar as item from found) group by r),
    island as (select r, k, t, p - q as lag_, p - row_number() over (partition by r, t, p - q order by p) as start from found),
    longest as (select r, max(n) as n from (select r, count(*) + k - 1 as n from island group by r, k, t, lag_, start) group by r)
    select doc_id, coalesce(total.n, 0)::bigint as n_words, coalesce(hit.n, 0)::bigint as n_hit,
           coalesce(named.n, 0)::bigint as n_items, sha256(coalesce(ids, '')) as items_sha256,
           coalesce(hit.n, 0) > 0 as contaminated, coalesce(longest.n, 0)::integer as longest_match
    from given left join (select r, count(*) as n from doc group by r) total using (r)
    left join hit using (r) left join named using (r) left join longest using (r)"""


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _secrets() -> str:
    names = "|".join(map(_either_case, ("password", "passwd", "secret", "token", "api_?key")))
    quote = "[\"'']?"
    value = "[A-Za-z0-9+/_.=-]+"
    patterns = {
        "assign": rf"(?:{names}){quote}\x20*[:=]\x20*{quote}{value}",
        "access": "AKIA[A-Z0-9]+",
        "hex": "[0-9a-f]+",
        "string": "[A-Za-z0-9+/_=-]+",
    }
    long_enough = {
        "assign": rf"len(regexp_extract(m, '^(?:{names}){quote}\x20*[:=]\x20*{quote}({value})$', 1)) >= 8",
        "access": "len(m) >= 16",
        "hex": "len(m) >= 32",
        "string": "len(m) >= 20",
    }
    allow = "|".join((
        "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}",
        "[0-9]+",
        "[A-Z]?[a-z]+(?:[-_/][A-Z]?[a-z]+)*",
        "(?i:.*(?:example|placeholder|xxxx|abcdefgh|01234567).*)",
    ))
    kinds = ["assign", "access", "hex", "entropy_hex", "entropy_alpha", "entropy_mixed"]
    # matches stand between two control characters; the pieces' lengths give their places
    parts = [
        rf"""select r, '{kind}' as kind, unnest(string_split(regexp_replace(replace(replace(text, chr(1), ' '), chr(2), ' '),
            '({pattern})', chr(1) || '\1' || chr(1), 'g'), chr(1))) as m,
            unnest(range(len(string_split(regexp_replace(replace(replace(text, chr(1), ' '), chr(2), ' '),
            '({pattern})', chr(1) || '\1' || chr(1), 'g'), chr(1))))) as k from given"""
        for kind, pattern in patterns.items()
    ]
    fits = " or ".join(f"(kind = '{kind}' and {test})" for kind, test in long_enough.items())
    order = f"start, list_position({kinds}, kind), stop"
    listed = "kind || ':' || start::varchar || ':' || stop::varchar"
    return rf"""
    with given as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
    pieces as ({" union all ".join(parts)}),
    matches as (select r, kind, m, k, (sum(len(m)) over (partition by r, kind order by k))::bigint as stop from pieces),
    spans as (select r, kind, m, stop - len(m) as start, stop from matches where k % 2 = 1 and ({fits})),
    base as (select r, kind, start, stop from spans where kind <> 'string'),
    strings as (select *, row_number() over () as s, case when regexp_full_match(m, '[0-9a-fA-F]+') then 'entropy_hex'
            when regexp_full_match(m, '[A-Za-z]+') then 'entropy_alpha' else 'entropy_mixed' end as class
        from spans where kind = 'string' and not regexp_full_match(m, '{allow}')),
    placed as (select s, unnest(range(len(m) - 19)) as i, m from strings),
    letters as (select s, i, unnest(string_split(substr(m, i + 1, 20), '')) as c from placed),
    bits as (select s, i, log2(20) - sum(n * log2(n)) / 20 as bits
        from (select s, i, c, count(*) as n from letters group by s, i, c) group by s, i),
    high as (select s, i, class, r, start from bits join strings using (s)
        where bits >= case class when 'entropy_hex' then 3.0 when 'entropy_alpha' then 3.9 else 3.7 end - 1e-9),
    parted as (select *, i - coalesce(lag(i) over (partition by s order by i), -100) > 20 as opens from high),
    numbered as (select *, count_if(opens) over (partition by s order by i) as stretch from parted),
    stretches as (select r, class as kind, start + min(i) as start, start + max(i) + 20 as stop
        from numbered group by s, stretch, r, class, start),
    every as (select * from base union all select * from stretches t where not exists (
        select 1 from base b where b.r = t.r and b.start <= t.start and t.stop <= b.stop)),
    told as (select r, count_if(kind = 'assign') as a, count_if(kind = 'access') as c, count_if(kind = 'hex') as h,
        string_agg({listed}, ',' order by {order}) filter (where kind in ('assign', 'access', 'hex')) as base,
        string_agg({listed}, ',' order by {order}) as spans from every group by r)
    select doc_id, coalesce(a, 0)::bigint as n_assign, coalesce(c, 0)::bigint as n_access, coalesce(h, 0)::bigint as n_hex,
           sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
    from given left join told using (r)"""


ORACLE_SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": _similarity(),
    "op2_substring_dedup": _repeats(),
    "op6_decontamination": _leaks(),
    "op8_secret_scans": _secrets(),
    "op11_conversation_repair": _repair(),
    "op12_centroid_clustering": _clustering(),
    "op13_exact_topk_search": _TOP_K,
}

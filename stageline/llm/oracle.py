"""SQL twins, for DuckDB, of the operators that have one."""

from __future__ import annotations

from stageline.llm.quality_rules import MAX_REPEATED_PERCENT, MIN_WORDS, RATIOS, RULES, STOP_WORDS, WINDOW, Rule
from stageline.llm.search import BEST

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _terms(table: str, key: str) -> str:
    return f"""
        select {key}, translate(w, '{UPPER}', '{LOWER}') as w
        from (select {key}, unnest(regexp_extract_all(text, '{TERM}')) as w from {table})"""


def search_sql(k: int = BEST) -> str:
    return f"""
        with term as ({_terms("documents", "doc_id")}),
        asked as (select distinct * from ({_terms("benchmark", "item_id")})),
        posting as (select doc_id, w, count(*) as tf from term group by all),
        lengths as (select doc_id, sum(tf)::bigint as n from posting group by all),
        total as (select count(*) as n_docs, sum(n)::bigint as n_terms from lengths),
        weights as (
            select w, floor(1000 * ln((2 * any_value(n_docs) + 2)::double / (2 * count(*) + 1)::double))::bigint as weight
            from posting, total where w in (select w from asked) group by w),
        norms as (select doc_id, 100 - 90 + (90 * n * n_docs) // n_terms as m from lengths, total),
        scored as (
            select item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::bigint as score
            from asked join posting using (w) join weights using (w) join norms using (doc_id) group by all)
        select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
        from scored where score > 0 qualify rank <= {k}
    """


def _fails(rule: Rule) -> str:
    ratio = f"({RATIOS[rule.ratio]})"
    bounds = [f"{ratio} < {rule.low}"] * (rule.low is not None) + [f"{ratio} > {rule.high}"] * (rule.high is not None)
    return f"case when {' or '.join(bounds)} then '{rule.name}' end"


def quality_rules_sql() -> str:
    stop_words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
        with source as (select doc_id, coalesce(text, '') as t from documents),
        split as (
            select doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words,
                   list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as lines
            from source),
        started as (select doc_id, words, unnest(generate_series(1, len(words) - {WINDOW - 1})) as i from split),
        windowed as (select doc_id, i, words[i:i + {WINDOW - 1}] as w from started),
        marked as (select doc_id, i from windowed qualify count(*) over (partition by doc_id, w) > 1),
        followed as (select doc_id, lead(i) over (partition by doc_id order by i) - i as step from marked),
        covered as (select doc_id, sum(least(coalesce(step, {WINDOW}), {WINDOW}))::bigint as n from followed group by doc_id),
        counts as (
            select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
                   len(regexp_extract_all(t, '[#*$%&|<>]')) as n_symbols,
                   len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(covered.n, 0) as n_repeat_words,
                   len(lines) as n_lines, len(list_filter(words, lambda w: w in ({stop_words}))) as n_stop_words,
                   len(list_filter(words, lambda w: suffix(w, '!'))) as n_shouts,
                   len(list_filter(words, lambda w: regexp_matches(w, '\p{{L}}'))) as n_letter_words,
                   len(list_filter(lines, lambda l: regexp_matches(l, '^[ \t]*[-*•●◦]'))) as n_bullet_lines,
                   len(list_filter(lines, lambda l: regexp_matches(l, '(\.\.\.|…)[ \t\r]*$'))) as n_ellipsis_lines
            from split left join covered using (doc_id)),
        judged as (
            select *, n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEATED_PERCENT} * n_words as base_failed,
                   list_filter([{", ".join(_fails(r) for r in RULES)}], lambda r: r is not null) as failed
            from counts)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               array_to_string(failed, '; ') as failed, not base_failed and len(failed) = 0 as kept
        from judged
    """


def trie_sql() -> str:
    # crc32, bit by bit: each digit is folded in, then seven steps without one
    step = "xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))"
    bits = "flatten(list_transform(string_split(conv_id::varchar, ''), lambda d: [ord(d)::bigint, 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce(list_concat([4294967295::bigint], {bits}), lambda c, x: {step}), 4294967295::bigint)"
    return f"""
        with turns as (
            select conv_id, row_number() over (partition by conv_id order by turn nulls first) - 1 as pos,
                   coalesce(role, '') as role, coalesce(text, '') as text
            from conversations where conv_id is not null),
        convs as (
            select conv_id, count(*) as n, conv_id - conv_id % 100 as base, {crc} % 6 as h
            from turns group by conv_id),
        headed as (
            select c.*, least(c.h, coalesce(b.n, 0)) as head, least(c.h, coalesce(b.n, 0)) + greatest(c.n - c.h, 0) as total
            from convs c left join convs b on b.conv_id = c.base),
        places as (
            select c.conv_id, t.pos + 1 as depth, t.role, t.text from headed c join turns t on t.conv_id = c.base and t.pos < c.h
            union all
            select c.conv_id, t.pos - c.h + c.head + 1, t.role, t.text
            from headed c join turns t on t.conv_id = c.conv_id and t.pos >= c.h),
        prefixes as (
            select conv_id, depth, length(text) as points,
                   sha256(string_agg(sha256(length(role)::varchar || ':' || role || text), '')
                          over (partition by conv_id order by depth)) as key
            from places
            union all
            select conv_id, 0, 0, '' from headed),
        nodes as (
            select key, min(conv_id) as conv_id, any_value(depth)::bigint as depth, count(*) as n_convs,
                   any_value(points) as points
            from prefixes group by key),
        parents as (
            select n.key, p.key as above
            from nodes n join prefixes p on p.conv_id = n.conv_id and p.depth = n.depth - 1),
        children as (select above as key, count(*) as n from parents group by above),
        valued as (
            select n.conv_id, n.depth, (n.n_convs - 1) * n.points as value, (c.n is null)::bigint as leaf
            from nodes n left join children c using (key)),
        sums as (
            select a.key, sum(v.value)::bigint as saved, sum(v.leaf)::bigint as leaves
            from valued v join prefixes a on a.conv_id = v.conv_id and a.depth <= v.depth group by a.key),
        ends as (
            select p.key, sha256(string_agg(p.conv_id::varchar, ',' order by p.conv_id)) as ends
            from prefixes p join headed c on c.conv_id = p.conv_id and c.total = p.depth group by p.key)
        select n.conv_id, n.depth, m.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children,
               s.leaves as n_leaves, s.saved as saved_tokens, coalesce(e.ends, sha256('')) as ends_sha256
        from nodes n join sums s using (key) left join children c using (key) left join ends e using (key)
        left join parents p using (key) left join nodes m on m.key = p.above
    """

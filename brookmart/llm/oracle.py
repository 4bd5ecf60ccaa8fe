"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

from brookmart.llm.licenses import PHRASES, TEMPLATES, THRESHOLD

# Lower-casing A-Z only, as the operators do.
NORM = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
        "'abcdefghijklmnopqrstuvwxyz')")

# Words after lower-casing.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _places(phrase: str) -> str:
    same = " and ".join(f"ws[i + {k}] = '{w}'" for k, w in enumerate(phrase.split()))
    return f"list_filter(range(1, len(ws) + 1), lambda i: {same})"


def _licenses() -> str:
    """Every line against every template, without any of the join's filters."""
    found = ", ".join(f"{_places(p)} as p{k}" for k, (p, _) in enumerate(PHRASES))
    labels = ", ".join(f"case when len(p{k}) > 0 then '{x}' end"
                       for k, (_, x) in enumerate(PHRASES))
    every = " || ".join(f"p{k}" for k in range(len(PHRASES)))
    templates = ", ".join(
        f"('{label}', [{', '.join(repr(w) for w in sorted(set(text.split())))}])"
        for label, text in TEMPLATES)

    def joined(labels: str) -> str:
        return (f"array_to_string(list_sort(list_distinct(list_filter({labels}, "
                "lambda x: x is not null))), ',')")

    return f"""
        with d as (select row_number() over () as r, doc_id, {NORM} as norm from documents),
        w as (select r, doc_id, regexp_extract_all(norm, '{WORDS}') as ws from d),
        p as (select r, doc_id, len(ws) as n_words, {found} from w),
        b as (select r, doc_id, n_words, {every} as places, [{labels}] as base from p),
        l as (select r, list_distinct(regexp_extract_all(line, '{WORDS}')) as line_words
              from (select r, unnest(string_split(norm, chr(10))) as line from d)),
        t(label, words) as (values {templates}),
        m as (select r, label, len(list_intersect(words, line_words)) / len(words)::double as score
              from l, t
              where len(list_intersect(words, line_words)) >= ceil({THRESHOLD} * len(words) - 1e-9)),
        g as (select r, list(label) as more, max(score) as score from m group by r)
        select doc_id, n_words, len(places) as n_base, list_min(places) - 1 as first_word,
               list_max(places) - 1 as last_word, {joined("base")} as base_labels,
               {joined("base || coalesce(more, [])")} as labels,
               case when len(places) > 0 then 1.0 else coalesce(score, 0.0) end::double as score
        from b left join g using (r)"""


def _resampling() -> str:
    """CRC-32 by its table, once for each distinct word; the rest is plain arithmetic."""
    gumbel = "floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))"
    return f"""
        with table_steps as (
            select n, list_reduce(list_prepend(n, range(8)),
                                  lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384)
                                               else c >> 1 end) as c
            from (select unnest(range(256)) as n)),
        crc_table as (select list(c order by n) as entries from table_steps),
        d as (select row_number() over () as r, doc_id,
                     regexp_extract_all({NORM}, '{WORDS}') as ws from documents),
        b as (select unnest(regexp_extract_all({NORM}, '{WORDS}')) as w from benchmark),
        dw as (select r, unnest(ws) as w from d),
        dc as (select r, w, count(*) as n from dw group by r, w),
        bytes as (select w, list_transform(range(length(hex(encode(w))) // 2),
                         lambda i: ('0x' || substr(hex(encode(w)), 2 * i + 1, 2))::bigint) as bs
                  from (select w from dw union select w from b)),
        hashed as (select w, xor(4294967295, list_reduce(list_prepend(4294967295, bs),
                          lambda c, x: xor(c >> 8, entries[(xor(c, x) & 255) + 1])))
                          % 10000 as bucket
                   from bytes, crc_table),
        s as (select bucket, sum(n) as s from dc join hashed using (w) group by bucket),
        t as (select bucket, count(*) as t from b join hashed using (w) group by bucket),
        totals as (select (select coalesce(sum(s), 0) from s) as big,
                          (select coalesce(sum(t), 0) from t) as small),
        g as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * (big + 10000)::double
                     / ((s + 1)::double * (small + 10000)::double)))::bigint as gain
              from s left join t using (bucket), totals),
        weights as (select r, sum(n * gain) as weight
                    from dc join hashed using (w) join g using (bucket) group by r),
        scored as (
            select r, doc_id, len(ws) as n_features, coalesce(weight, 0)::bigint as weight,
                   ('0x' || substr(sha256('2024:' || coalesce(doc_id::varchar, '')), 1, 8)
                    )::bigint as h
            from d left join weights using (r)),
        places as (
            select *, weight + {gumbel}::bigint as score,
                   row_number() over (partition by n_features >= 20
                       order by weight + {gumbel}::bigint desc, doc_id) as place,
                   count(*) over (partition by n_features >= 20) as n
            from scored)
        select doc_id, n_features, weight, score,
               case when n_features >= 20 and place <= 10 * n // 100 then place end as rank
        from places"""


ORACLES: dict[str, str] = {
    "op8_license_scan": _licenses(),
    "op11_importance_resampling": _resampling(),
    "op2_exact_dedup": f"""
        with d as (select doc_id, {NORM} as norm from documents),
        g as (select norm, max(doc_id) as keep_id, count(*) as group_size from d group by norm)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept,
               sha256(norm) as text_sha256
        from d join g using (norm)""",
}

"""DuckDB SQL for the queries that SQL can express."""

OP9 = r"""
with docs as (select doc_id, source, coalesce(text, '') as text from documents),
words as (
    select doc_id, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') as w,
        list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) as l, text, source
    from docs
),
windows as (
    select doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g
    from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from words where len(w) >= 3)
),
repeated as (select doc_id, i, count(*) over (partition by doc_id, g) as n from windows),
covered as (
    select doc_id, count(distinct i + k) as n_repeat_words
    from repeated, (select unnest([0, 1, 2]) as k) where n > 1 group by doc_id
),
base as (
    select d.doc_id, d.source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
        (len(l) - len(list_distinct(l)))::bigint as n_dup_lines,
        coalesce(n_repeat_words, 0)::bigint as n_repeat_words
    from words d left join covered c on d.doc_id = c.doc_id
),
judged as (
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base
),
hosts as (
    select source, count(*) as n, sum(base_failed::int) as failed from judged where source is not null group by source
),
fit as (
    select least(greatest(coalesce(avg(failed / n), 0), 1e-6), 1 - 1e-6) as m, var_pop(failed / n) as spread,
        avg(1 / n) as per_doc from hosts
),
prior as (
    select m, least(greatest(m * (1 - m) / greatest(coalesce(spread, 0) - m * (1 - m) * coalesce(per_doc, 0),
        m * (1 - m) / 1000001) - 1, 1), 1e6) as s from fit
),
condemned as (select source from hosts, prior where (failed + m * s) / (n + s) > 0.5)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not base_failed and coalesce(source not in (select source from condemned), true) as kept
from judged
"""

OP4 = """
with recursive good as (
    select vec_id, label, list_transform(embedding, lambda x: x::double) as e from embeddings
    where label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as (
    select a.vec_id as one, b.vec_id as other from good a
    join good b on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
    where list_cosine_similarity(a.e, b.e) >= 0.98
),
reach as (
    select vec_id, vec_id as found from good
    union
    select vec_id, other from reach join links on found = one
),
least as (select vec_id, min(found) as component_id from reach group by vec_id),
counts as (select one as vec_id, count(*) as n from links group by one)
select vec_id, coalesce(n, 0)::bigint as n_links, coalesce(component_id, vec_id) as component_id,
    coalesce(component_id, vec_id) = vec_id as kept
from embeddings left join least using (vec_id) left join counts using (vec_id)
"""

OP11 = r"""
with terms as (
    select doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from documents
),
tf as (select doc_id, term, count(*) as tf from terms group by all),
sizes as (select doc_id, sum(tf)::bigint as n from tf group by all),
totals as (select count(*)::bigint as docs, sum(n)::bigint as total from sizes),
df as (select term, count(*)::bigint as df from tf group by all),
asked as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
),
weights as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w from df, totals
),
scores as (
    select item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // total))))::bigint as score
    from asked join tf using (term) join weights using (term) join sizes using (doc_id), totals group by all
),
ranked as (
    select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score
    from scores where score > 0
)
select * from ranked where rank <= 50
"""

ORACLE = {"op4_embedding_dedup": OP4, "op9_quality_rules": OP9, "op11_lexical_search": OP11}

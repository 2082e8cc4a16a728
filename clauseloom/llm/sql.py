"""Check SQL of the queries that SQL can express, over the whole tables."""

from __future__ import annotations

ORACLES = {
    "op1_hamming_top_k": """
        with bits as (
            select vec_id, list_transform(embedding, lambda x: (x > 0)::int) as code from embeddings),
        pairs as (
            select q.vec_id as query_id, v.vec_id,
                   list_sum(list_transform(list_zip(q.code, v.code), lambda x: xor(x[1], x[2])))::bigint
                       as distance
            from bits q join bits v on q.vec_id % 20 = 0 and v.vec_id <> q.vec_id),
        ranked as (
            select query_id, row_number() over (partition by query_id order by distance, vec_id)
                       as rank, vec_id, distance
            from pairs)
        select * from ranked where rank <= 10
    """,
    "op2_exact_dedup": """
        select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
               row_number() over (partition by coalesce(text, '') order by doc_id desc) = 1 as kept,
               sha256(coalesce(text, '')) as text_sha256
        from documents window same as (partition by coalesce(text, ''))
    """,
    # The exponent solves (largest / smallest) ^ (1 - exponent) = 1.5 in closed form.
    "op7_source_mixing": r"""
        with counted as (
            select doc_id, source,
                   length(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20\x09-\x0D]+',
                       'x', 'g'), '[\x20\x09-\x0D]', '', 'g')) as n_tokens,
                   md5(coalesce(doc_id::varchar, '') || '/1') as drawn,
                   greatest(1, ceil(count(*) over () / 1000.0))::bigint as n_blocks
            from documents),
        dealt as (
            select *, ('0x' || substr(drawn, 1, 7))::bigint % n_blocks as block from counted),
        sized as (
            select source, sum(n_tokens) as tokens from dealt group by source),
        ends as (
            select max(tokens) as t1, min(tokens) as t0 from sized where tokens > 0),
        solved as (
            select t1, case when t1 = t0 then 0.0
                else greatest(0.0, 1.0 - ln(1.5) / ln(t1 / t0)) end as exponent from ends),
        powered as (
            select sum(pow(tokens / t1, exponent)) as powers from sized, solved where tokens > 0),
        weighted as (
            select source, tokens, exponent,
                   case when tokens > 0 then pow(tokens / t1, exponent) / powers else 0 end as weight,
                   case when tokens > 0
                       then round(pow(tokens / t1, exponent) / powers * t1 * powers)::bigint
                       else 0 end as target
            from sized, solved, powered),
        ordered as (
            select d.*, w.weight, w.exponent,
                   case when w.tokens > 0 then w.target // w.tokens else 1 end as passes,
                   case when w.tokens > 0 then w.target % w.tokens else 0 end as rest,
                   coalesce(sum(n_tokens) over (
                       partition by d.source order by md5(block::varchar || '#1'), drawn
                       range between unbounded preceding and current row exclude group), 0) as before
            from dealt d join weighted w on d.source is not distinct from w.source)
        select doc_id, source, n_tokens::bigint as n_tokens, round(weight, 9) as weight,
               round(exponent, 6) as exponent, block,
               (passes + case when rest > 0 and before < rest then 1 else 0 end)::bigint as copies
        from ordered
    """,
    "op13_fill_in_middle": """
        with drawn as (
            select doc_id, coalesce(text, '') as t, length(coalesce(text, '')) as n,
                   sha256('1:' || coalesce(doc_id::varchar, '')) as d
            from documents),
        hashed as (
            select *, ('0x' || substr(d, 1, 8))::bigint % (n + 1) as c1,
                   ('0x' || substr(d, 9, 8))::bigint % (n + 1) as c2,
                   ('0x' || substr(d, 17, 8))::bigint % 100 as h3,
                   ('0x' || substr(d, 25, 8))::bigint % 100 as h4
            from drawn),
        formed as (
            select doc_id, t, n, least(c1, c2) as a, greatest(c1, c2) as b,
                   case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                             or h3 >= 90 then 'plain'
                        when h4 < 20 then 'spm' else 'psm' end as form
            from hashed),
        cut as (
            select *, substr(t, 1, a) as prefix, substr(t, a + 1, b - a) as middle, substr(t, b + 1) as suffix
            from formed)
        select doc_id, n, form,
               case when form <> 'plain' then a end as prefix_chars,
               case when form <> 'plain' then b - a end as middle_chars,
               sha256(case form when 'plain' then t
                   when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                   else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
               sha256(t) as restored_sha256
        from cut
    """,
}

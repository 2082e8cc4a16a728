"""The check SQL: each registered query again, written for DuckDB apart from the Spark plan.

Derived inputs come from the shared SQL in `corpus`; the operators are formulated anew here, with
lists and lambdas for days, RE2 patterns (which have no look-around) for text, and windows over
tokens for rule text.
"""

from __future__ import annotations

from clauseloom.functions import text as tx
from clauseloom.functions.language import DATE_METHODS, EXPRESSION_FUNCTIONS, FEEL_FUNCTIONS
from clauseloom.model import (
    GENERAL_PARAGRAPH,
    GENERAL_RULE,
    LOAN_VOCABULARY,
    RECEIPT_RULE,
    TIMESHARE_PARAGRAPH,
    TIMESHARE_RULE,
)
from clauseloom.plans.corpus import SQL, TABLES, holiday_dates


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_HOLIDAYS = "[" + ", ".join(f"date '{d}'" for d in holiday_dates()) + "]"
_MARK = "chr(57344)"
_ABBREVIATED = "(" + "|".join(a.replace(".", "[.]") for a in tx.ABBREVIATIONS) + ")"
_TRIM = _quoted(f"^{tx.SPACE}+|{tx.SPACE}+$")


def _canonical(number: str) -> str:
    plain = f"regexp_replace(replace({number}, ',', ''), '^0+([0-9])', '\\1')"
    return f"case when contains({plain}, '.') then rtrim(rtrim({plain}, '0'), '.') else {plain} end"


def _values(words: dict[str, int]) -> str:
    return ", ".join(f"('{w}', {v})" for w, v in words.items())


def _stated(name: str, source: str, key: str, text: str) -> str:
    """A relation (key, value) of the numbers each text states."""
    return f"""
      select distinct {key}, value from (
        select {key}, {_canonical('d')} as value from (
          select {key}, unnest(regexp_extract_all({text}, {_quoted(tx.DIGITS)})) as d from {source})
        union all
        select {key}, cast(t.v + u.v as varchar) from (
          select {key}, unnest(regexp_extract_all(lower({text}), {_quoted(tx.HYPHENATED)})) as c
          from {source})
          join (values {_values(tx.TENS)}) t(w, v) on t.w = split_part(c, '-', 1)
          join (values {_values(tx.BELOW_TEN)}) u(w, v) on u.w = split_part(c, '-', 2)
        union all
        select {key}, cast(unnest([n.v, n.v * s.v]) as varchar) from (
          select {key}, words[p] as w, words[p + 1] as after from (
            select {key}, words, unnest(generate_series(1, len(words))) as p from (
              select {key}, regexp_extract_all(lower({text}), '[a-z]+') as words from {source})))
          as positions
          join (values {_values(tx.WORD_VALUES)}) n(w, v) on n.w = positions.w
          left join (values {_values(tx.SCALES)}) s(w, v) on s.w = after
      ) as {name} where value is not null"""


# Relations that only the check side builds.
BUILT = {
    "raw_lines": f"""
        select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as line_no from (
          select doc_id, string_split_regex(text, {_quoted(tx.LINE_BREAK)}) as lines from documents)""",
    "doc_sentences": f"""
        select doc_id, label, case when n = 1 then label else label || '.s' || n end as sentence_id,
          n, text, case when n = 1 then h end as heading
        from (
          select doc_id, label, h, unnest(parts) as text, generate_subscripts(parts, 1) as n from (
            select doc_id, label, h, list_filter(list_transform(string_split(regexp_replace(
                regexp_replace(body, {_quoted(f'({tx.SENTENCE_END})({tx.SENTENCE_START})')},
                  '\\1' || {_MARK} || '\\2', 'g'),
                {_quoted(_ABBREVIATED)} || {_MARK}, '\\1', 'g'), {_MARK}),
                lambda s: regexp_replace(s, {_TRIM}, '', 'g')), lambda s: s <> '') as parts
            from (
              select doc_id, cast(doc_id as varchar) as label,
                nullif(regexp_extract(text, {_quoted(tx.HEADING)}, 1), '') as h,
                regexp_replace(regexp_replace(text, {_quoted(tx.HEADING)}, ''),
                  {_quoted(tx.ITALIC)}, '\\1', 'g') as body
              from documents)))""",
    "days": f"""
        select *, case when lo <= hi then list_filter(
              list_transform(range(0, hi - lo + 1), lambda i: lo + cast(i as int)),
              lambda d: isodow(d) <> 7 and not list_contains({_HOLIDAYS}, d))
            when lo > hi then [] end as days
        from (select *, issue_date - 10 as lo, closing_date + 10 as hi from {{flat_loans}})""",
    "received": """
        select *, case when delivery_method = 'in_person' then received_date
          else list_filter(days, lambda d: d > mailed_date)[3] end as receipt
        from {days}""",
    "decided": """
        select *, len(list_filter(days, lambda d: d >= receipt and d < closing_date)) as n_days
        from {received}""",
    "cells": f"""
        select loan_id, delivery_method, '{GENERAL_RULE}' as rule_id,
          '{GENERAL_PARAGRAPH}' as subsection, not timeshare as applies, n_days >= 3 as met
        from {{decided}}
        union all
        select loan_id, delivery_method, '{TIMESHARE_RULE}', '{TIMESHARE_PARAGRAPH}', timeshare,
          receipt <= closing_date from {{decided}}""",
    "verdicts": """
        select loan_id, delivery_method, rule_id, subsection, case when met then 'pass' else 'fail' end as result
        from {cells} where applies and met is not null""",
    "folded": """
        select c.loan_id, c.subsection, count(v.result) as n_hits,
          coalesce(string_agg(v.result, ','), '') as results,
          case when count(v.result) = 0 then 'not_applicable'
            when count(*) filter (where v.result = 'fail') > 0 then 'fail' else 'pass' end as verdict
        from {cells} c left join {verdicts} v using (loan_id, rule_id) group by all""",
    "stated_quotes": _stated("s", "{receipts}", "rule_id", "quote"),
}


def _tokens(text: str, pattern: str) -> str:
    return f"""
      select *, lag(t, 1) over w as b1, lag(t, 2) over w as b2, lag(t, 3) over w as b3,
        lead(t, 1) over w as a1, lead(t, 2) over w as a2
      from (select rule_id, quote, {text} as rule_text, unnest(ts) as t, generate_subscripts(ts, 1) - 1 as pos
        from (select *, regexp_extract_all({text}, {_quoted(pattern)}) as ts from {{receipts}}))
      window w as (partition by rule_id order by pos)"""


_STRING = r'"(?:[^"\\]|\\.)*"'
_NUMBER = r"\d+(?:\.\d+)?(?:e[+-]?\d+)?"
_NAME = r"\.?[A-Za-z_]\w*(?:\.[A-Za-z_]\w*)*"
_OPERATOR = r"\.\.|\?\?|\*\*|==|!=|<=|>=|[-+*/%^<>?:,.()\[\]{}#$=;]"
# The corpus uses two names of more than one word.
_SPACED = "day of week|list contains"
_ENDS_VALUE = r"^(\)|\]|\"|''|\.?[A-Za-z_])"
_WORDS_OF = "('and','or','not','in','as','true','false','null','then','else','return')"


def _ends(tok: str) -> str:
    return f"(regexp_matches({tok}, '{_ENDS_VALUE}') and {tok} not in {_WORDS_OF})"


_SIGNED = (
    f"(b1 = '-' and (b2 is null or not ({_ends('b2')} or regexp_matches(b2, '^[0-9]'))))"
)
_INDEXED = (
    f"coalesce(a1 = ']' and ((b1 = '[' and {_ends('b2')})"
    f" or (b1 = '-' and b2 = '[' and {_ends('b3')})), false)"
)
_VALUE = f"case when {_SIGNED} then '-' || t else t end"

BUILT["tokens_1"] = _tokens(
    "requirement", rf"{_STRING}|'(?:[^'\\]|\\.)*'|`[^`]*`|{_NUMBER}|{_NAME}|{_OPERATOR}"
)
BUILT["tokens_2"] = _tokens("feel", rf"{_STRING}|{_SPACED}|{_NUMBER}|{_NAME}|{_OPERATOR}")
BUILT["uses_1"] = f"""
    select rule_id, quote, pos, 'number' as kind, {_VALUE} as name,
      case when {_INDEXED} then 'index'
        when ends_with(rtrim(split_part(rule_text, '!=', 1)), '.weekday()') and b1 = '!='
          or ends_with(rtrim(split_part(rule_text, '==', 2)), '.weekday()') and a1 = '==' then 'weekday'
        else 'plain' end as role
    from {{tokens_1}} where regexp_matches(t, '^[0-9]')
    union all select rule_id, quote, pos, 'day', t, '' from {{tokens_1}} where t = '#'
    union all select rule_id, quote, pos, 'unsupported',
      case t when '=' then 'assignment' else 'object literal' end, '' from {{tokens_1}} where t in ('=', '{{')
    union all select rule_id, quote, pos, 'method', regexp_extract(t, '[^.]*$'), '' from {{tokens_1}}
      where a1 = '(' and contains(t, '.') and regexp_matches(t, '^[.A-Za-z_]')
    union all select rule_id, quote, pos, 'function', t, '' from {{tokens_1}}
      where a1 = '(' and not contains(t, '.') and regexp_matches(t, '^[A-Za-z_]') and t <> 'not'
    union all select rule_id, quote, pos, 'field',
      case when a1 = '(' then regexp_replace(t, '[.][A-Za-z]+$', '') else t end, '' from {{tokens_1}}
      where regexp_matches(t, '^[A-Za-z_]') and (coalesce(a1, '') <> '(' or contains(t, '.'))
        and t not in ('and','or','not','in','as','true','false','null')
        and not (t = 'day' and contains(rule_text, ' as day'))"""
_DURATION_TEXT = "b1 = '(' and b2 = 'duration' and a1 = ')'"
BUILT["uses_2"] = f"""
    select rule_id, quote, pos, 'number' as kind, {_VALUE} as name,
      case when {_INDEXED} then 'index' else 'plain' end as role
    from {{tokens_2}} where regexp_matches(t, '^[0-9]')
    union all select rule_id, quote, pos, 'number', regexp_extract(t, '[0-9]+'), 'duration' from {{tokens_2}}
      where {_DURATION_TEXT} and regexp_matches(t, '^"P[0-9]+[DWMY]"$')
    union all select rule_id, quote, pos, 'unsupported', 'duration literal ' || trim(t, '"'), ''
      from {{tokens_2}} where {_DURATION_TEXT} and not regexp_matches(t, '^"P[0-9]+[DWMY]"$')
    union all select rule_id, quote, pos, 'weekday', trim(t, '"'), '' from {{tokens_2}}
      where starts_with(t, '"') and b1 in ('=', '!=') and b2 = ')'
    union all select rule_id, quote, pos, 'unsupported', 'context literal', '' from {{tokens_2}} where t = '{{'
    union all select rule_id, quote, pos, 'day', 'item', '' from {{tokens_2}}
      where t = 'item' or starts_with(t, 'item.')
    union all select rule_id, quote, pos, 'function', t, '' from {{tokens_2}}
      where a1 = '(' and regexp_matches(t, '^[A-Za-z_]') and t not in ('for','in','return','if','then','else','and','or')
    union all select rule_id, quote, pos, 'field', t, '' from {{tokens_2}}
      where regexp_matches(t, '^[A-Za-z_]') and coalesce(a1, '') <> '(' and t <> 'item'
        and t not in ('if','then','else','for','in','return','and','or','true','false','null')
        and not (t = 'i' and contains(rule_text, 'for i in'))"""


def _number_gate(uses: str, shift: int) -> str:
    plain = _canonical("regexp_replace(name, '^-', '')")
    below = "negative" if shift else "(negative or v = '0')"
    return f"""
      select 'number' as "check", rule_id as subject, detail, '{'expression' if shift else 'feel'}' as notation
      from (
        select rule_id, case
            when role = 'index' and {below} then 'index [' || name || '] is not allowed'
            when role = 'index' and not stated then 'index [' || name || '] (element ' || e || ') is not stated'
            when role = 'duration' and not stated then 'duration of ' || v || ' is not stated'
            when role = 'plain' and (negative or not stated) then 'number ' || name || ' is not stated'
          end as detail
        from (
          select u.*, exists(select 1 from {{stated_quotes}} s where s.rule_id = u.rule_id
              and s.value = case when u.role = 'index' then u.e else u.v end) as stated
          from (
            select *, starts_with(name, '-') as negative, {plain} as v,
              case when regexp_matches({plain}, '^[0-9]+$')
                then cast(cast({plain} as bigint) + {shift} as varchar) else {plain} end as e
            from {{{uses}}} where kind = 'number' and role <> 'weekday') u))
      where detail is not null"""


def _names(names) -> str:
    return "(" + ", ".join(_quoted(n) for n in names) + ")"


def _listed(names) -> str:
    return "[" + ", ".join(_quoted(n) for n in names) + "]"


_FIELDS = [*LOAN_VOCABULARY.fields, *LOAN_VOCABULARY.derived]
_FEEL_FIELDS = [*LOAN_VOCABULARY.fields, *[d.replace(".", "_") for d in LOAN_VOCABULARY.derived]]

_CASE_EXPECTED = "case loan_id % 3 when 0 then 'pass' when 1 then 'fail' else 'not_applicable' end"
BUILT["cases"] = f"""
    select *, loan_id % 4 as kind,
      case when loan_id % 4 = 0 and loan_id % 5 = 0 then '{TIMESHARE_RULE}'
           when loan_id % 4 = 0 and loan_id % 7 = 3 then '9.9/r9'
           when loan_id % 4 = 0 then '{GENERAL_RULE}'
           when loan_id % 4 = 2 then '{RECEIPT_RULE}' end as rule_id,
      case when loan_id % 4 = 0 then {_CASE_EXPECTED} when loan_id % 4 = 1 then 'not_applicable' end as wanted
    from {{decided}}"""
BUILT["failures"] = f"""
    select c.loan_id as test_id,
      case when kind = 0 and c.rule_id = '9.9/r9' then 'no such rule: 9.9/r9'
        when kind = 0 and coalesce(v.result, 'not_applicable') <> wanted
          then 'expected ' || wanted || ', got ' || coalesce(v.result, 'not_applicable')
        when kind = 1 and t.result is not null
          then 'expected no rule of {TIMESHARE_PARAGRAPH} to apply, got ' || t.result
        when kind = 2 and closing_date is distinct from receipt
          then 'derived.cd_receipt_date: expected ' || coalesce(cast(closing_date as varchar), 'nothing')
            || ', got ' || coalesce(cast(receipt as varchar), 'nothing')
        when kind = 3 and (not list_contains(days, closing_date) or list_contains(days, issue_date))
          then 'derived.business_days: missing ' || cast(not list_contains(days, closing_date) as int)
            || ', not to contain ' || cast(list_contains(days, issue_date) as int)
      end as problem
    from {{cases}} c
    left join {{verdicts}} v on v.loan_id = c.loan_id and v.rule_id = c.rule_id
    left join {{verdicts}} t on t.loan_id = c.loan_id and t.rule_id = '{TIMESHARE_RULE}'"""
BUILT["case_gaps"] = """
    select r.rule_id, e.has_pass, e.has_fail from (values ('%s'), ('%s')) r(rule_id)
    left join (select rule_id, bool_or(wanted = 'pass') as has_pass, bool_or(wanted = 'fail') as has_fail
      from {cases} where rule_id is not null group by rule_id) e using (rule_id)""" % (
    GENERAL_RULE, TIMESHARE_RULE)
BUILT["exercised"] = f"""
    select c.loan_id as test_id, x.rule_id, x.applies, x.met from {{cases}} c join {{cells}} x
      on x.loan_id = c.loan_id and ((c.kind = 0 and x.rule_id = c.rule_id)
        or (c.kind = 1 and x.subsection = '{TIMESHARE_PARAGRAPH}'))"""
# The verdicts once more, by joins with a numbered calendar in place of lists.
BUILT["numbered"] = f"""
    select day, isodow(day) <> 7 and not list_contains({_HOLIDAYS}, day) as open,
      coalesce(sum(cast(isodow(day) <> 7 and not list_contains({_HOLIDAYS}, day) as int)) over (
        order by day rows between unbounded preceding and 1 preceding), 0) as before
    from (select unnest(list_transform(range(0, hi - lo + 1), lambda i: lo + cast(i as int))) as day
      from (select min(least(issue_date, closing_date)) - 60 as lo,
        max(greatest(issue_date, closing_date)) + 60 as hi from {{flat_loans}}))"""
BUILT["ordinal_receipts"] = """
    select l.*, issue_date - 10 as lo, closing_date + 10 as hi,
      case when delivery_method = 'in_person' then received_date
        when greatest(mailed_date + 1, issue_date - 10) <= closing_date + 10 and third.day <= closing_date + 10
          then third.day end as receipt
    from {flat_loans} l
    left join {numbered} first on first.day = greatest(l.mailed_date + 1, l.issue_date - 10)
    left join {numbered} third on third.open and third.before = first.before + 2 and l.mailed_date is not null"""
BUILT["by_ordinal"] = f"""
    select loan_id, rule_id, case when met then 'pass' else 'fail' end as result from (
      select r.loan_id, '{GENERAL_RULE}' as rule_id, not timeshare as applies,
        case when lo > hi or receipt is null or greatest(receipt, lo) >= least(closing_date, hi + 1) then 0
          else b.before - a.before end >= 3 as met
      from {{ordinal_receipts}} r left join {{numbered}} a on a.day = greatest(receipt, lo)
        left join {{numbered}} b on b.day = least(closing_date, hi + 1)
      union all
      select loan_id, '{TIMESHARE_RULE}', timeshare, receipt <= closing_date from {{ordinal_receipts}})
    where applies and met is not null"""
BUILT["table_best"] = """
    select fact_id, count(*) as n, min(row_no) as first_row, arg_min(price, row_no) as price
    from {facts} join {table_rows}
      on total >= coalesce(total_lo, -1e300) and total <= coalesce(total_hi, 1e300)
    where (tier_eq is null or tier_eq = tier) and not (total_lo_open and total = coalesce(total_lo, -1e300))
      and not (total_hi_open and total = coalesce(total_hi, 1e300))
    group by fact_id"""
BUILT["readback_states"] = """
    select *, case when (doc_id + n) % 11 = 0 then 'QUESTION' when n % 3 = 0 then 'NOT_A_RULE'
      else 'RULE' end as state from {doc_sentences}"""


def _parsed(name: str) -> str:
    digits = "'[0-9][0-9][0-9][0-9]-[0-9][0-9]-[0-9][0-9]'"
    return f"case when regexp_full_match({name}, {digits}) then try_cast({name} as date) end"


def _labelled(cell: str) -> str:
    """Field paths by label. No path of the corpus is part of another name in it."""
    for path in sorted(LOAN_VOCABULARY.labels, key=len, reverse=True):
        label = LOAN_VOCABULARY.labels[path]
        phrase = label if label.startswith(("the ", "how ")) else "the " + label
        mark = f"(^|[^A-Za-z0-9_.]){path.replace('.', '[.]')}($|[^A-Za-z0-9_.])"
        cell = f"regexp_replace({cell}, {_quoted(mark)}, {_quoted(chr(92) + '1' + phrase + chr(92) + '2')}, 'g')"
    return cell


_DISCOUNT = """case
    when tier = 'AUTOMOBILE' and total >= 300000 then {0} when tier = 'AUTOMOBILE' and total >= 100000 then {1}
    when tier = 'BUILDING' and total > 250000 then {2} when total >= 400000 then {3} else {4} end"""

CHECKS: dict[str, str] = {
    "loan_files": f"""
        select loan_id, {_parsed('issue_date')} as issue_date, delivery_method,
          {_parsed('received_date')} as received_date, {_parsed('mailed_date')} as mailed_date,
          {_parsed('closing_date')} as closing_date, timeshare,
          case when loan_id % 61 <> 0 then {len(holiday_dates())} end as n_holidays
        from {{raw_loans}}""",
    "unreadable_files": """
        select 'unreadable' as "check", cast(loan_id as string) as subject,
          case when trim(body) = '' then 'empty file' else 'not a JSON object' end as detail
        from {arrived_bodies}
        where not json_valid(body) or json_type(case when json_valid(body) then body end) <> 'OBJECT'
        union all
        select 'unreadable', name, case when trim(body) = '' then 'empty file' else 'not an XML document' end
        from {arrived_models} where not ends_with(body, '</definitions>')
        union all
        select 'unreadable', name, case when body = '' then 'empty file' else 'not a file of questions and answers' end
        from {arrived_questions} where body = '' or contains(body, '"')""",
    "conformance_report": f"""
        select loan_id, 'cd.issue_date' as field, 'not a date' as problem from {{raw_loans}}
          where issue_date is not null and {_parsed('issue_date')} is null
        union all select loan_id, 'cd.received_date', 'not a date' from {{raw_loans}}
          where received_date is not null and {_parsed('received_date')} is null
        union all select loan_id, 'cd.mailed_date', 'not a date' from {{raw_loans}}
          where mailed_date is not null and {_parsed('mailed_date')} is null
        union all select loan_id, 'closing_date', 'not a date' from {{raw_loans}}
          where closing_date is not null and {_parsed('closing_date')} is null
        union all select loan_id, 'cd.delivery_method', 'not a listed value' from {{raw_loans}}
          where delivery_method not in ('in_person', 'mail', 'electronic')
        union all select loan_id, 'calendar.holidays', 'no list' from {{raw_loans}} where loan_id % 61 = 0""",
    "paragraphs": f"""
        select doc_id, line_no, kind,
          case when kind = 'paragraph' then regexp_extract(line, {_quoted(tx.PARAGRAPH)}, 1) end as label,
          case when kind = 'paragraph' then regexp_extract(line, {_quoted(tx.PARAGRAPH)}, 2) end as text
        from (select *, case when regexp_full_match(line, {_quoted(tx.SPACE + '*')}) then 'blank'
            when starts_with(line, '#') then 'note'
            when regexp_matches(line, {_quoted(tx.PARAGRAPH)}) then 'paragraph' else 'bad' end as kind
          from {{doc_lines}})""",
    "duplicate_sentence_ids": """
        select id, count(*) as n_uses from {file_sentences} group by id having count(*) > 1""",
    "source_fingerprint": "select doc_id, sha256(text) as sha256 from {documents}",
    "nfc_violations": "select doc_id from {accent_docs} where text <> nfc_normalize(text)",
    "sentences": "select sentence_id, n, text, label, heading from {doc_sentences}",
    "paragraph_keys": """
        select p_partkey, 's' || slug as subsection_key, slug,
          'rule_' || regexp_replace(slug, '_$', '') || '_r1_pass' as rule_xml_id,
          replace(path, '.', '_') as feel_name,
          'input_' || trim(regexp_replace(path, '[^A-Za-z0-9]+', '_', 'g'), '_') as input_xml_id
        from (select *, trim(regexp_replace(label, '[^A-Za-z0-9]+', '_', 'g'), '_') as slug
          from {labels_of_parts})""",
    "pack_tables": """
        select cast(k as varchar) as pack, 'receipt' as relation, rule_id as item, requirement as text from {receipts}
        union all select cast(k as varchar), 'link', pack, 'paragraph' from {receipts}
        union all select cast(k as varchar), 'sentence_state', 's' || k, 'RULE' from {receipts}
        union all select cast(k as varchar), 'source', pack, sha256(quote) from {receipts}""",
    "jdm_rows": """
        select cast(k as varchar) as pack, 'table' as node_id, 'collect' as hit_policy,
          rule_id || '/' || result as row_id, applies_when as i1,
          case result when 'pass' then requirement else 'not (' || requirement || ')' end as i2,
          rule_id, result
        from {receipts}, (values ('pass'), ('fail')) r(result) where kind = 'rule'""",
    "dmn_rules": """
        select cast(k as varchar) as pack, 'so' || k || '_r1' as decision,
          'rule_o' || k || '_r1_' || result as xml_id, rule_id || '/' || result as description,
          case applies_when when '' then '-' else applies_when end as applies_when,
          case result when 'pass' then feel else '(not(' || feel || '))' end as requirement,
          rule_id, result
        from {receipts}, (values ('pass'), ('fail')) r(result) where kind = 'rule'""",
    "write_verdicts": "select loan_id, rule_id, result from {verdicts}",
    "questions_answers": """
        select 'q' || c_custkey as question_id, 's' || c_custkey as sentence_id, c_mktsegment as issue,
          case when c_custkey % 4 = 0 then null when c_custkey % 2 = 0 then 'a' else 'b' end as reading_id,
          c_custkey % 4 = 0 as open
        from {customer}""",
    "open_questions": """
        select * from {questions} q where not exists (select 1 from {answers} a where a.question_id = q.question_id)""",
    "day_window": """
        select loan_id, greatest(hi - lo + 1, 0) as n_days, case when lo <= hi then lo end as first_day,
          case when lo <= hi then hi end as last_day
        from (select loan_id, issue_date - 10 as lo, closing_date + 10 as hi from {flat_loans})""",
    "business_days": """
        select loan_id, len(days) as n_days, array_to_string(days, ',') as days from {days}""",
    "nth_business_day_after": """
        select loan_id, list_filter(days, lambda d: d > issue_date)[1] as day_1,
          list_filter(days, lambda d: d > issue_date)[3] as day_3,
          list_filter(days, lambda d: d > issue_date)[25] as day_25 from {days}""",
    "receipt_date": "select loan_id, receipt as cd_receipt_date from {received}",
    "business_days_between": "select loan_id, receipt as cd_receipt_date, n_days from {decided}",
    "calendar_dim": f"""
        select c.first as calendar, day, is_business,
          cast(coalesce(sum(cast(is_business as int)) over (partition by c.first order by day
            rows between unbounded preceding and 1 preceding), 0) as int) as n_before
        from (select *, isodow(day) <> 7 and not list_contains({_HOLIDAYS}, day) as is_business from (
            select parity, unnest(list_transform(range(0, hi - lo + 1), lambda i: lo + cast(i as int))) as day
            from (select loan_id % 2 as parity, min(least(issue_date, closing_date)) - 10 as lo,
              max(greatest(issue_date, closing_date)) + 10 as hi from {{flat_loans}} group by all))) d
        join (values (0, {_HOLIDAYS}[1]), (1, {_HOLIDAYS}[-1])) c(parity, first) on c.parity = d.parity""",
    "calendar_verdicts": "select loan_id, rule_id, result from {verdicts}",
    "derived_struct": """
        select loan_id, len(days) as n_business_days, receipt as cd_receipt_date, issue_date from {received}""",
    "evaluation_order": """
        select loan_id, receipt as cd_receipt_date, closing_date - receipt as slack from {received}""",
    "rule_verdicts": "select loan_id, rule_id, result from {verdicts}",
    "timing_rule_general": f"select loan_id, rule_id, result from {{verdicts}} where rule_id = '{GENERAL_RULE}'",
    "timing_rule_timeshare": f"select loan_id, rule_id, result from {{verdicts}} where rule_id = '{TIMESHARE_RULE}'",
    "collect_hits": "select loan_id, subsection, n_hits, results from {folded}",
    "subsection_verdict": "select loan_id, subsection, verdict from {folded}",
    "subsection_verdict_rows": "select loan_id, subsection, verdict from {folded}",
    "missing_flag_semantics": """
        select l.loan_id, count(v.rule_id) as n_rows from {flat_loans} l left join {verdicts} v using (loan_id)
        where l.timeshare is null group by l.loan_id""",
    "undecided_cells": """
        select loan_id, rule_id, 'applies_when' as cell from {cells} where applies is null
        union all select loan_id, rule_id, 'requirement' from {cells} where met is null""",
    "missing_receipt": """
        select loan_id, 'derived.cd_receipt_date' as field from {received} where receipt is null""",
    "result_document": f"""
        select d.loan_id, '{{"results":{{"s1026_19_f_1_ii_A":[' || coalesce(a.hit, '') ||
          '],"s1026_19_f_1_ii_B":[' || coalesce(b.hit, '') || ']}},"derived":{{"business_days":[' ||
          array_to_string(list_transform(days, lambda x: '"' || cast(x as varchar) || '"'), ',') || ']' ||
          coalesce(',"cd_receipt_date":"' || cast(receipt as varchar) || '"', '') || '}}}}' as document
        from {{received}} d
        left join (select loan_id, '{{"rule_id":"' || rule_id || '","result":"' || result || '"}}' as hit
          from {{verdicts}} where rule_id = '{GENERAL_RULE}') a using (loan_id)
        left join (select loan_id, '{{"rule_id":"' || rule_id || '","result":"' || result || '"}}' as hit
          from {{verdicts}} where rule_id = '{TIMESHARE_RULE}') b using (loan_id)""",
    "verdict_summary": """
        select rule_id, delivery_method, result, count(*) as n_verdicts from {verdicts}
        group by rollup (rule_id, delivery_method, result)""",
    "first_hit": f"select fact_id, {_DISCOUNT.format('0.15', '0.1', '0.12', '0.05', '0.0')}::double as discount from {{facts}}",
    "unique_hit": """
        select fact_id, 1 + cast(total >= 450000 as int) as n_hits, total >= 450000 as violation,
          case when total < 100000 then 'STANDARD' when total < 450000 then 'PREMIUM' end as price
        from {facts}""",
    "field_cells": """
        select fact_id, array_to_string(list_filter([
            case when tier = 'AUTOMOBILE' and total >= 300000 then '1' end,
            case when tier = 'AUTOMOBILE' and total >= 100000 then '2' end,
            case when tier = 'BUILDING' and total > 250000 then '3' end,
            case when total >= 400000 then '4' end, '5'], lambda x: x is not null), ',') as rows
        from {facts}""",
    "decision_tables_as_data": """
        select fact_id, coalesce(n, 0) as n_hits, coalesce(n, 0) > 1 as violation, first_row, price as first,
          case when n = 1 then price end as only
        from {facts} left join {table_best} using (fact_id)""",
    "rule_functions": """
        select o_orderkey, isodow(d) as weekday, d + 3 as added, d - 3 as subtracted, e - d as diff,
          strftime(d, '%Y-%m-%d') as formatted, d < e as before, d > e as after, d = e as same,
          d <= e as same_or_before, d >= e as same_or_after, d as parsed,
          len(list_filter(xs, lambda x: x >= 3)) as counted, len(list_filter(xs, lambda x: x > 3)) as filtered,
          list_contains(xs, o_orderkey % 4) as contained, dayname(d) as day_name
        from (select o_orderkey, cast(o_orderdate as date) as d,
          cast(o_orderdate as date) + cast(o_orderkey % 9 - 4 as int) as e,
          [o_orderkey % 7, o_orderkey % 5, 3] as xs from {orders})""",
    "quote_missing": """
        select 'quote' as "check", rule_id as subject,
          case when s.sentence_id is null then 'unknown sentence ' else 'quote not in ' end || q.sentence_id as detail
        from {quotes} q left join {doc_sentences} s using (sentence_id)
        where s.sentence_id is null or not contains(s.text, q.quote)""",
    "source_drift": """
        select 'source' as "check", rule_id as subject,
          case when doc_id is null then 'no source ' else 'hash differs for ' end || c.source as detail
        from {citations} c left join {documents} on c.source = 'doc-' || doc_id
        where doc_id is null
          or sha256(case when version = 'current' then text else text || ' (older)' end) <> sha256(text)""",
    "stated_numbers": _stated("s", "{documents}", "doc_id", "text"),
    "stated_quote_numbers": "select rule_id, value from {stated_quotes}",
    "number_gate": _number_gate("uses_1", 1) + " union all " + _number_gate("uses_2", 0),
    "vocabulary_gate": f"""
        select distinct 'vocabulary' as "check", rule_id as subject, kind || ' ' || name as detail,
          'expression' as notation from {{uses_1}}
        where (kind = 'field' and name not in {_names(_FIELDS)})
          or (kind = 'function' and name not in {_names(LOAN_VOCABULARY.functions)})
          or (kind = 'method' and name not in {_names(LOAN_VOCABULARY.methods)})
        union all
        select distinct 'vocabulary', rule_id, kind || ' ' || name, 'feel' from {{uses_2}}
        where (kind = 'field' and name not in {_names(_FEEL_FIELDS)})
          or (kind = 'function' and name not in {_names(FEEL_FUNCTIONS)})""",
    "encoding_gate": """
        select distinct 'encoding' as "check", rule_id as subject, 'weekday ' || name as detail,
          'expression' as notation from {uses_1}
        where role = 'weekday' and not (name = '7' and regexp_matches(quote, '(?i)\\bSundays?\\b'))
        union all
        select distinct 'encoding', rule_id, 'weekday ' || name, 'feel' from {uses_2}
        where kind = 'weekday' and not (name = 'Sunday' and regexp_matches(quote, '(?i)\\bSundays?\\b'))""",
    "day_test_gate": """
        select 'day test' as "check", rule_id as subject, 'the test does not use #' as detail,
          'expression' as notation
        from {receipts} where kind = 'derived_field' and not contains(requirement, '#')
        union all
        select 'day test', rule_id, 'the test does not use item', 'feel'
        from {receipts} where kind = 'derived_field' and not regexp_matches(feel, '\\bitem\\b')""",
    "forbidden_constructs": """
        select distinct 'construct' as "check", rule_id as subject, name as detail, 'expression' as notation
        from {uses_1} where kind = 'unsupported'
        union all
        select distinct 'construct', rule_id, case kind when 'weekday' then 'day name ' || name else name end, 'feel'
        from {uses_2} where kind = 'unsupported' or (kind = 'weekday' and name not in
          ('Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday'))""",
    "expression_uses": """
        select rule_id, pos, kind, name, role, 'expression' as notation from {uses_1}
        union all select rule_id, pos, kind, name, role, 'feel' from {uses_2}""",
    "allowlist_gate": f"""
        select distinct 'allow list' as "check", name as subject, 'function is not documented' as detail
        from {{uses_2}} where kind = 'function' and name not in {_names(FEEL_FUNCTIONS)}
        union all
        select distinct 'allow list', name, kind || ' is not documented' from (
            select kind, name from {{uses_1}}
            union all select 'function', unnest({_listed(LOAN_VOCABULARY.functions)})
            union all select 'method', unnest({_listed(LOAN_VOCABULARY.methods)}))
        where kind = 'function' and name not in {_names(EXPRESSION_FUNCTIONS)}
          or kind = 'method' and name not in {_names(DATE_METHODS)}""",
    "row_receipt_mismatch": """
        select w.pack, 'row' as "check", w.row_id as subject,
          case when m.row_id is null then 'missing row' else 'row differs' end as detail
        from (select pack, rule_id || '/' || result as row_id, rule_id, applies_when as i1, result,
            case result when 'pass' then requirement else 'not (' || requirement || ')' end as i2
          from {receipts}, (values ('pass'), ('fail')) r(result) where kind = 'rule') w
        left join {model_rows} m on m.row_id = w.row_id and m.pack = w.pack
        where m.row_id is null or (m.rule_id, m.i1, m.i2, m.result) <> (w.rule_id, w.i1, w.i2, w.result)""",
    "dmn_row_receipt_mismatch": """
        select r.pack, 'dmn rule' as "check", 'rule_o' || k || '_r1_' || w.result as subject,
          case when m.xml_id is null then 'missing dmn rule' else 'dmn rule differs' end as detail
        from {receipts} r cross join (values ('pass'), ('fail')) w(result)
          left join {dmn_model_rows} m on m.xml_id = 'rule_o' || k || '_r1_' || w.result and m.pack = r.pack
        where kind = 'rule' and (m.xml_id is null or (k % 19 = 0 and k % 5 in (3, 4))
          or (w.result = 'fail' and k % 17 = 0))""",
    "rule_sentences": f"""
        select row_id, case i1 when '' then 'For every loan file' else 'When ' || {_labelled('i1')} end
          || ', and ' || {_labelled('i2')} || ', the result is **' || result || '**.' as line
        from {{model_rows}}""",
    "orphan_rows": """
        select distinct pack, 'orphan' as "check", rule_id as subject, 'no receipt' as detail from (
            select pack, rule_id from {model_rows} union all select pack, rule_id from {dmn_model_rows})
          where (pack, rule_id) not in (select (pack, rule_id) from {receipts})
        union all
        select pack, 'orphan', rule_id, 'no row' from {receipts}
          where kind = 'rule' and ((pack, rule_id) not in (select (pack, rule_id) from {model_rows})
            or (pack, rule_id) not in (select (pack, rule_id) from {dmn_model_rows}))""",
    "graph_integrity": """
        select 'graph' as "check", pack || '/' || node_id as subject, 'id is used twice' as detail
          from {nodes} group by pack, node_id having count(*) > 1
        union all
        select 'graph', e.pack || '/' || e.edge_id, 'names no node: ' || e.pack || '/' || e.node_id
          from (select pack, edge_id, unnest([source_id, target_id]) as node_id from {edges}) e
          where not exists (select 1 from {nodes} n where n.pack = e.pack and n.node_id = e.node_id)
        union all
        select distinct 'graph', pack || '/' || node_id, 'needs two inputs and two outputs'
          from {nodes} where n_inputs <> 2 or n_outputs <> 2""",
    "pack_diff": """
        select coalesce(o.rule_id, n.rule_id) as rule_id,
          case when o.rule_id is null then 'added' when n.rule_id is null then 'retired' else 'changed' end as change,
          sha256(o.content) as previous
        from {old_rules} o full join {new_rules} n on o.rule_id = n.rule_id
        where o.content is distinct from n.content""",
    "pack_status": """
        select pack, n_errors, n_open, n_blocked,
          case when n_errors > 0 then 'fail' when n_open + n_blocked > 0 then 'not final' else 'pass' end as status,
          case when n_errors > 0 then 1 when n_open + n_blocked > 0 then 2 else 0 end as code
        from (select coalesce(c_custkey, o_custkey) as pack,
            count(*) filter (where o_orderstatus = 'F' and o_orderkey % 7 = 0) as n_errors,
            count(*) filter (where o_orderstatus = 'O' and o_orderkey % 5 = 0) as n_open,
            count(*) filter (where o_orderstatus = 'P' and o_orderkey % 3 = 0) as n_blocked
          from {customer} left join {orders} on c_custkey = o_custkey group by all)""",
    "fixture_skip": """
        select fixture_id, subsection from {fixtures}
        where subsection in (select cast(c_custkey as varchar) from {customer} where c_nationkey % 3 = 0)""",
    "quote_search": """
        select item_id, doc_id from {benchmark} b, {documents} d where contains(d.text, b.text)""",
    "test_failures": "select test_id, problem from {failures} where problem is not null",
    "rules_under_test": f"""
        select loan_id as test_id, rule_id from {{cases}} where kind = 0
        union all select loan_id, '{TIMESHARE_RULE}' from {{cases}} where kind = 1""",
    "coverage_gaps": """
        select r.rule_id, case when kind = 'rule' then 'needs a passing and a failing case'
          else 'needs two cases with different values' end as gap
        from {test_rules} r left join (select rule_id, bool_or(expectation = 'pass') as has_pass,
          bool_or(expectation = 'fail') as has_fail, count(distinct expectation) as n
          from {test_cases} group by rule_id) t using (rule_id)
        where (kind = 'rule' and not (coalesce(has_pass, false) and coalesce(has_fail, false)))
          or (kind = 'derived_field' and coalesce(n, 0) < 2)""",
    "target_disagreements": """
        select *, 'one' as side, 1 as times from (
          select loan_id, rule_id, result from {verdicts} except select * from {by_ordinal})
        union all
        select *, 'other', 1 from (
          select * from {by_ordinal} except select loan_id, rule_id, result from {verdicts})""",
    "edition_disagreements": """
        select rule_id, content, 'one' as side, 1 as times from (select * from {old_rules} except select * from {new_rules})
        union all
        select rule_id, content, 'other', 1 from (select * from {new_rules} except select * from {old_rules})""",
    "test_run": """
        select 'test' as "check", cast(test_id as varchar) as subject, problem as detail from {failures} where problem is not null
        union all select 'cell', cast(test_id as varchar), rule_id || ' applies_when does not decide'
          from {exercised} where applies is null
        union all select 'cell', cast(test_id as varchar), rule_id || ' requirement does not decide'
          from {exercised} where met is null
        union all select 'coverage', rule_id, 'needs a passing and a failing case' from {case_gaps}
          where not (coalesce(has_pass, false) and coalesce(has_fail, false))""",
    "readback": """
        select doc_id as source, n as seq, sentence_id, 1 as part, '' as item,
          sentence_id || coalesce(' ' || rtrim(heading, '.'), '') as line from {readback_states}
        union all select doc_id, n, sentence_id, 2, '', '> ' || text from {readback_states}
        union all select doc_id, n, sentence_id, 3, '', 'State: ' || state || '.' from {readback_states}
        union all select doc_id, n, sentence_id, 6, '', 'Open question.' from {readback_states} where state = 'QUESTION'
        union all select s.doc_id, s.n, s.sentence_id, 4, q.rule_id,
          'Rule ' || q.rule_id || ', quote: "' || q.quote || '"' from {doc_sentences} s join {quotes} q using (sentence_id)
        union all select doc_id, n, sentence_id, 5, cast(doc_id as varchar),
          'Link (reference) to ' || doc_id || ', cited as "paragraph"' from {doc_sentences} where n % 5 = 0""",
    "label_phrases": """
        select p_partkey, case when starts_with(phrase, 'the ') or starts_with(phrase, 'how ') then phrase
          else 'the ' || phrase end as phrase from {labels_of_parts}""",
    "readback_stale": """
        select doc_id as source, n as seq, unnest([replace(text, 'e', 'E'), text]) as line,
          unnest(['committed', 'fresh']) as side, 1 as times
        from {doc_sentences} where (doc_id + n) % 50 = 0 and contains(text, 'e')""",
    "loan_explanations": """
        select loan_id, rule_id, result, subsection as sentence_id, q as quote,
          'The consumer receives the disclosures ' || q || '.' as sentence
        from (select *, case when rule_id like '%(A)/r1' then 'no later than three business days before consummation'
          else 'no later than consummation' end as q from {verdicts})""",
    "stream_verdicts": "select loan_id, rule_id, result from {verdicts}",
}

# A rule's field is that of one other rule, so blocking is a walk down a forest.
_BLOCKED = """
    , blocked(rule_id, field) as (
      select u.rule_id, u.field from use_edges u join definitions d on d.field = u.field
        join definitions own on own.rule_id = u.rule_id where d.open and not own.open
      union
      select u.rule_id, u.field from blocked b join definitions d on d.rule_id = b.rule_id
        join use_edges u on u.field = d.field join definitions own on own.rule_id = u.rule_id
        where not own.open)
    select rule_id, field from blocked"""


def _needs(text: str) -> list[str]:
    """The derived relations a text reads, each after those it reads itself."""
    out: list[str] = []
    for name in (*SQL, *BUILT):
        if "{" + name + "}" in text:
            body = BUILT.get(name) or SQL[name]
            out += [n for n in (*_needs(body), name) if n not in out]
    return out


def _rendered(name: str | None, text: str = "") -> str:
    """A text with the relations it reads by name. Shared SQL doubles its other braces."""
    body = text if name is None else BUILT.get(name) or SQL[name]
    for relation in (*TABLES, *SQL, *BUILT):
        body = body.replace("{" + relation + "}", relation)
    return body.replace("{{", "{").replace("}}", "}") if name in SQL else body


def _with(text: str) -> str:
    """The statement with each derived relation it reads as a common table expression."""
    names = _needs(text)
    ctes = ", ".join(f"{n} as ({_rendered(n)})" for n in names)
    return (f"with {ctes} " if names else "") + _rendered(None, text)


def oracle_sql() -> dict[str, str]:
    out = {name: _with(text) for name, text in CHECKS.items()}
    out["blocked_rules"] = (
        f"with recursive definitions as ({_rendered('definitions')}),"
        f" use_edges as ({_rendered('uses')})" + _BLOCKED
    )
    return out

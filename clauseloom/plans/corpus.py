"""Inputs derived from the given tables.

The tables hold no loan files, receipts or rule packs, so each is derived here from rows that
are there: one loan per order, one receipt per order, one paragraph per line of a document. The
SQL is the common part of Spark SQL and the check engine's dialect, so both sides see the same
input; the operators and their checks are written apart.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clauseloom.session import shared_path

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def holiday_dates(first: int = 1994, last: int = 2002) -> list[date]:
    """Holidays for derived loans, by month, weekday (Monday 0) and day. Input data only: the
    engine takes every list from the loan."""
    out = []
    day = date(first, 1, 1)
    while day.year <= last:
        m, d, w = day.month, day.day, day.weekday()
        fixed = (m, d) in ((1, 1), (7, 4), (11, 11), (12, 25))
        third_monday = m in (1, 2) and w == 0 and 15 <= d <= 21
        memorial = m == 5 and w == 0 and d >= 25
        labor = m == 9 and w == 0 and d <= 7
        columbus = m == 10 and w == 0 and 8 <= d <= 14
        thanksgiving = m == 11 and w == 3 and 22 <= d <= 28
        if fixed or third_monday or memorial or labor or columbus or thanksgiving:
            out.append(day)
        day += timedelta(days=1)
    return out


# name -> SQL over the tables and over earlier names, as {name}; a brace of the text is doubled.
SQL: dict[str, str] = {
    "flat_loans": """
        select o_orderkey as loan_id,
          cast(o_orderdate as date) as issue_date,
          case o_orderkey % 3 when 0 then 'in_person' when 1 then 'mail' else 'electronic' end
            as delivery_method,
          case when o_orderkey % 3 = 0
            then cast(o_orderdate as date) + cast(o_orderkey % 4 as int) end as received_date,
          case when o_orderkey % 3 <> 0 then cast(o_orderdate as date) + cast(
            case when o_orderkey % 31 = 0 then -14 else o_orderkey % 15 - 2 end as int) end
            as mailed_date,
          cast(o_orderdate as date) + cast(
            (o_orderkey * 7) % 25 - 2 - case when o_orderkey % 50 = 0 then 40 else 0 end as int)
            as closing_date,
          case when o_orderkey % 97 = 0 then null else o_orderkey % 11 = 0 end as timeshare,
          o_totalprice as amount
        from {orders}""",
    # Loan files as they arrive: dates are text, some are no dates, some methods are unknown.
    # chr(123) and chr(125) are the braces.
    "arrived_bodies": """
        select o_orderkey as loan_id,
          case when o_orderkey % 41 = 0 then concat(chr(123), '"note": ', chr(123), '"amount": ', cast(o_orderkey as string))
            when o_orderkey % 43 = 0 then ' '
            when o_orderkey % 47 = 0 then concat('[', cast(o_orderkey as string), ']')
            else concat(chr(123), '"note": ', cast(o_orderkey as string), ', "status": "', o_orderstatus, '"', chr(125))
          end as body
        from {orders}""",
    "raw_loans": """
        select loan_id,
          case when loan_id % 41 = 0 then 'not a date' when loan_id % 53 = 0 then '1997-02-30'
            else cast(issue_date as string) end as issue_date,
          case when loan_id % 43 = 0 then 'fax' when loan_id % 59 = 0 then null
            else delivery_method end as delivery_method,
          cast(received_date as string) as received_date,
          cast(mailed_date as string) as mailed_date,
          case when loan_id % 47 = 0 then '97-1-1' else cast(closing_date as string) end
            as closing_date,
          timeshare, amount
        from {flat_loans}""",
    # Texts of which some have their accents taken apart.
    "accent_docs": """
        select doc_id, case when doc_id % 5 = 0 then replace(text, 'é', 'e\u0301') else text end as text
        from {documents}""",
    # Sentence ids that several files may use.
    "file_sentences": """
        select doc_id as source, 's' || cast(doc_id % 300 as string) || '.' || cast(n as string) as id
        from {doc_sentences}""",
    "labels_of_parts": """
        select p_partkey, '1026.' || cast(p_size as string) || '(' || p_brand || ')(' || p_type || ')' as label,
          'derived.' || replace(p_name, ' ', '.') as path,
          case p_partkey % 3 when 0 then 'how ' when 1 then 'the ' else '' end || p_name as phrase
        from {part}""",
    # Receipts that cite a document as their source, with the hash they recorded.
    "citations": """
        select l_orderkey as k, 'o' || cast(l_orderkey as string) || '/' || cast(l_linenumber as string) as rule_id,
          'doc-' || cast(l_partkey as string) as source,
          case when l_suppkey % 10 = 3 then 'stale' else 'current' end as version
        from {lineitem}""",
    # Tests: per order one case, its expectation taken from the order, so some cases fail.
    "test_cases": """
        select o_orderkey as test_id,
          'c' || cast(o_custkey as string) || '/' ||
            case when o_orderkey % 4 < 3 then 'r1' else 'd1' end as rule_id,
          case when o_orderkey % 4 < 3 then 'rule' else 'derived_field' end as kind,
          case when o_orderkey % 4 = 3 then o_orderpriority
               when o_orderstatus = 'F' then 'fail' when o_orderstatus = 'O' then 'pass'
               else 'not_applicable' end as expectation
        from {orders}""",
    "test_rules": """
        select 'c' || cast(c_custkey as string) || '/r1' as rule_id, 'rule' as kind from {customer}
        union all
        select 'c' || cast(c_custkey as string) || '/d1' as rule_id, 'derived_field' as kind from {customer}""",
    # A source file per document: its lines, most of them labelled paragraphs, some notes, some
    # lines left as they are.
    "doc_lines": """
        select doc_id, line_no,
          case when line_no % 13 = 5 then '# ' || line
               when line_no % 17 = 7 then line
               else '[' || cast(doc_id as string) || '(' || cast(line_no as string) || ')] ' || line
          end as line
        from {raw_lines}""",
    # One receipt per order: rule text in two notations and the quote it rests on.
    "receipts": """
        select k, 'p' || cast(pack as string) as pack,
          'o' || cast(k as string) || case when k % 12 in (1, 2) then '/d1' else '/r1' end as rule_id,
          case when k % 12 in (1, 2) then 'derived_field' else 'rule' end as kind,
          case k % 6
            when 0 then 'no later than ' || word || ' business days before consummation'
            when 1 then 'all calendar days except Sundays and the ' || word || ' legal public holidays'
            when 2 then 'three business days after they are delivered or placed in the mail'
            when 3 then 'by the third day after mailing, and in any case within ' || word || ' days'
            when 4 then priority || ' notices state 1,500 dollars, 2.50 percent and ' || word || ' days'
            else 'the creditor shall act on each Monday' end as quote,
          case when k % 5 = 0 then 'transaction.timeshare' when k % 5 = 1 then ''
               when k % 35 = 7 then 'loan.kind == "reverse"'
               else 'not transaction.timeshare' end as applies_when,
          case when k % 5 = 0 then 'transaction.timeshare' when k % 5 = 1 then ''
               when k % 5 = 2 then 'not(transaction.timeshare) and not(ltv = 1)'
               else 'not(transaction.timeshare)' end as feel_when,
          case k % 12
            when 0 then 'count(derived.business_days as day, d(day) >= d(derived.cd_receipt_date) and d(day) < d(closing_date)) >= ' || n
            when 1 then 'd(#).weekday() != 7 and not contains(calendar.holidays, #)'
            when 2 then case when k % 24 = 2 then 'd(closing_date).weekday() != ' || n
              else n || ' == d(cd.issue_date).add(1, "d").weekday()' end
            when 3 then 'filter(derived.business_days as day, d(day) > d(cd.mailed_date))[' || n || '] != null'
            when 4 then 'filter(derived.business_days, true)[-' || n || '] != null'
            when 5 then 'd(cd.closing) >= d(closing_date)'
            when 6 then 'len(derived.business_days) >= ' || n || ' and upper("a = 1") == "A"'
            when 7 then 'cd.amount = ' || n
            when 8 then 'cd.amount <= note.amount * 2.5 + ' || n || '00'
            when 9 then '{{ok: ltv < ' || n || '}}'
            when 10 then 'd(closing_date).add(' || n || ', "d").isBefore(d(derived.cd_receipt_date))'
            else 'cd.delivery_method == "in_person" ? cd.received_date : cd.mailed_date' end
            as requirement,
          case k % 12
            when 0 then 'count(derived_business_days[date(item) >= date(derived_cd_receipt_date) and date(item) < date(closing_date)]) >= ' || n
            when 1 then 'day of week(date(item)) != "Sunday" and not(list contains(calendar.holidays, item))'
            when 2 then 'day of week(date(closing_date)) != "' || case when k % 24 = 2 then 'Monday' else 'Funday' end || '"'
            when 3 then 'derived_business_days[date(item) > date(cd.mailed_date)][' || n || '] != null'
            when 4 then 'derived_business_days[-' || n || '] != null'
            when 5 then 'date(cd.closing) >= date(closing_date)'
            when 6 then 'business_days(closing_date) > ' || n
            when 7 then 'for i in 0..' || n || ' return date(cd.issue_date) + duration("P1D") * i'
            when 8 then 'cd.amount <= note.amount * 2.5 + ' || n || '00'
            when 9 then '{{ok: ltv < ' || n || '}}'
            when 10 then 'date(closing_date) + duration("P' || n || case when k % 24 = 10 then 'D' else 'H' end || '") < date(derived_cd_receipt_date)'
            else 'if cd.delivery_method = "in_person" then cd.received_date else cd.mailed_date' end
            as feel
        from (
          select o_orderkey as k, o_custkey as pack, o_orderpriority as priority,
            cast(o_orderkey % 9 + 1 as string) as n,
            case o_orderkey % 8 when 0 then 'two' when 1 then 'three' when 2 then 'four'
              when 3 then 'five' when 4 then 'seven' when 5 then 'ten' when 6 then 'twenty-one'
              else 'three hundred' end as word
          from {orders}) as base""",
    # Decision-table rows as a pack carries them: two per rule, some lost, some edited, some stray.
    "model_rows": """
        select pack, rule_id || '/pass' as row_id, rule_id, applies_when as i1,
          case when k % 23 = 0 then requirement || ' ' else requirement end as i2, 'pass' as result
        from {receipts} where kind = 'rule' and k % 29 <> 0
        union all
        select pack, case when k % 37 = 0 then 'stray' || cast(k as string) || '/r1/fail'
                    else rule_id || '/fail' end as row_id,
          case when k % 37 = 0 then 'stray' || cast(k as string) || '/r1' else rule_id end as rule_id,
          applies_when as i1,
          case when k % 31 = 0 then requirement else 'not (' || requirement || ')' end as i2,
          'fail' as result
        from {receipts} where kind = 'rule'""",
    # The same rows in the second format, some lost, some without the parentheses they need.
    "dmn_model_rows": """
        select pack, 'rule_o' || cast(k as string) || '_r1_pass' as xml_id, rule_id, 'pass' as result,
          rule_id || '/pass' as description,
          case when feel_when = '' then '-'
               when feel_when = 'not(transaction.timeshare)' and k % 19 <> 0 then '(' || feel_when || ')'
               else feel_when end as applies_when,
          feel as requirement
        from {receipts} where kind = 'rule' and k % 31 <> 0
        union all
        select pack, 'rule_o' || cast(k as string) || '_r1_fail' as xml_id, rule_id, 'fail' as result,
          rule_id || '/fail' as description,
          case when feel_when = '' then '-'
               when feel_when = 'not(transaction.timeshare)' and k % 19 <> 0 then '(' || feel_when || ')'
               else feel_when end as applies_when,
          case when k % 17 = 0 then 'not(' || feel || ')' else '(not(' || feel || '))' end as requirement
        from {receipts} where kind = 'rule' and k % 31 <> 0""",
    # Model nodes and edges: one graph per order, a node per line, an edge to the next line.
    "nodes": """
        select l_orderkey as pack, 'n' || cast(l_linenumber as string) as node_id,
          case when l_quantity < 3 then 1 when l_quantity > 48 then 3 else 2 end as n_inputs,
          2 as n_outputs
        from {lineitem}""",
    "edges": """
        select distinct l_orderkey as pack,
          'n' || cast(l_linenumber as string) || '-next' as edge_id,
          'n' || cast(l_linenumber as string) as source_id,
          'n' || cast(l_linenumber + 1 as string) as target_id
        from {lineitem} where l_linenumber < 7""",
    # Two versions of a rule set, for the diff.
    "old_rules": """
        select 'o' || cast(o_orderkey as string) as rule_id,
          'v1 ' || o_orderpriority || ' ' || cast(o_custkey as string) as content
        from {orders} where o_orderkey % 10 <> 0""",
    "new_rules": """
        select 'o' || cast(o_orderkey as string) as rule_id,
          case when o_orderkey % 7 = 0 then 'v2 ' else 'v1 ' end || o_orderpriority || ' ' ||
            cast(o_custkey as string) as content
        from {orders} where o_orderkey % 11 <> 0""",
    # A rule per order; it defines a field and reads the field of the rule at a third of its key.
    "definitions": """
        select 'o' || cast(o_orderkey as string) as rule_id,
          'f' || cast(o_orderkey as string) as field, o_orderkey % 37 = 5 as open
        from {orders}""",
    "uses": """
        select 'o' || cast(o_orderkey as string) as rule_id,
          'f' || cast((o_orderkey - o_orderkey % 3) / 3 as bigint) as field
        from {orders} where o_orderkey % 5 <> 0 and o_orderkey > 2""",
    "questions": """
        select 'q' || cast(o_orderkey as string) as question_id,
          cast(o_custkey as string) as sentence_id, o_orderpriority as issue
        from {orders} where o_orderstatus <> 'F'""",
    "answers": """
        select 'q' || cast(o_orderkey as string) as question_id,
          case when o_orderkey % 2 = 0 then 'a' else 'b' end as reading_id
        from {orders} where o_orderkey % 4 <> 0""",
    "fixtures": """
        select o_orderkey as fixture_id, cast(o_custkey as string) as subsection from {orders}""",
    # Facts for decision tables.
    "facts": """
        select o_orderkey as fact_id, c_mktsegment as tier, o_totalprice as total
        from {orders} join {customer} on o_custkey = c_custkey""",
    # A decision table of a row per order line: a tier or any, an interval of the total, some one-sided.
    "table_rows": """
        select l_orderkey * 10 + l_linenumber as row_no,
          case l_suppkey % 6 when 0 then 'AUTOMOBILE' when 1 then 'BUILDING' when 2 then 'FURNITURE'
            when 3 then 'MACHINERY' when 4 then 'HOUSEHOLD' end as tier_eq,
          case when l_orderkey % 19999 = 7 then null else l_extendedprice * 5 end as total_lo,
          case when l_orderkey % 19999 = 8 then null
            when l_orderkey % 19999 = 7 then l_extendedprice / 20 else l_extendedprice * 5 + l_quantity end as total_hi,
          l_linenumber = 2 as total_lo_open, l_linenumber = 3 as total_hi_open,
          'p' || cast(l_partkey as string) as price
        from {lineitem}""",
    # Model files and question files as they arrive, some cut off. chr(10) ends a line.
    "arrived_models": """
        select 'm' || cast(o_orderkey as string) as name,
          case when o_orderkey % 41 = 0 then '<definitions><decision id=' when o_orderkey % 43 = 0 then ' '
            else '<definitions><decision id="d"/></definitions>' end as body
        from {orders}""",
    "arrived_questions": """
        select 'q' || cast(c_custkey as string) as name,
          case when c_custkey % 41 = 0 then 'questions:' || chr(10) || '- id: "' || c_name
            when c_custkey % 43 = 0 then '' else 'questions:' || chr(10) || '- id: ' || c_name end as body
        from {customer}""",
    # Quotes: every sentence of a document is quoted by a receipt; some quotes are altered, some
    # name a sentence or a source state that is not there.
    "quotes": """
        select sentence_id || '/r1' as rule_id,
          case when (doc_id + n) % 29 = 0 then 'x' || sentence_id else sentence_id end as sentence_id,
          case when (doc_id + n) % 7 = 0 then '-' || text else substr(text, 3) end as quote
        from {doc_sentences}""",
}


# Tables whose rows are worked on at length, with their unique key.
SPREAD = {"orders": "o_orderkey", "documents": "doc_id"}
SPREAD_OVER = 200


def spread(frame: DataFrame, key: str) -> DataFrame:
    """A table of fewer splits than cores, as one small file is, over more cores. A table of many
    files has enough splits and is left as it is."""
    cores = min(frame.sparkSession.sparkContext.defaultParallelism, SPREAD_OVER)
    return frame if frame.rdd.getNumPartitions() >= cores else frame.repartition(cores, key)


class Inputs:
    """The tables of one directory, and what is derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        key = SPREAD.get(name)
        return frame if key is None else spread(frame, key)

    def __getitem__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        if name in SQL:
            text = SQL[name]
            needs = {n: self[n] for n in (*TABLES, *SQL, *BUILT) if "{" + n + "}" in text}
            return self.spark.sql(text, **needs)
        return BUILT[name](self)

    def stored(self, name: str) -> DataFrame:
        """A derived input as a table in the shared folder, where a plan reads it several times
        and would otherwise derive it each time."""
        path = shared_path(self.spark, name)
        self[name].write.parquet(path)
        return self.spark.read.parquet(path)

    def loans(self) -> DataFrame:
        return nest_loans(self["flat_loans"])


def nest_loans(flat: DataFrame, holidays=None) -> DataFrame:
    """Flat loan columns as the nested loan file. The holiday list comes in two orders, so loans
    do not all share one list."""
    if holidays is None:
        days = F.expr("array(" + ", ".join(f"date'{d}'" for d in holiday_dates()) + ")")
        holidays = F.when(F.col("loan_id") % 2 == 0, days).otherwise(F.reverse(days))
    return flat.select(
        "loan_id",
        F.struct(
            "issue_date",
            "delivery_method",
            "received_date",
            "mailed_date",
            F.col("amount").alias("amount"),
        ).alias("cd"),
        "closing_date",
        F.struct("timeshare").alias("transaction"),
        F.struct(holidays.alias("holidays")).alias("calendar"),
        F.struct("amount").alias("note"),
    )


def _raw_lines(inputs: Inputs) -> DataFrame:
    from clauseloom.functions.text import LINE_BREAK

    return inputs["documents"].select(
        "doc_id", F.posexplode(F.split("text", LINE_BREAK)).alias("line_no", "line")
    ).withColumn("line_no", F.col("line_no") + 1)


def _doc_sentences(inputs: Inputs) -> DataFrame:
    from clauseloom.operators.sentences import split_sentences

    labelled = inputs["documents"].select("doc_id", F.col("doc_id").cast("string").alias("label"), "text")
    return split_sentences(labelled, "label", "text", keep=("doc_id",)).withColumnRenamed(
        "id", "sentence_id"
    )


BUILT = {"raw_lines": _raw_lines, "doc_sentences": _doc_sentences}

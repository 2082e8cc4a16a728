"""Derivations and verdicts against plain Python, in both forms, over awkward loans."""

import json
import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from clauseloom import DaySet, Derived, Pack, Rule, Vocabulary, timing_pack
from clauseloom.model import GENERAL_RULE, LOAN_VOCABULARY, VocabularyError
from clauseloom.functions import ordinals
from clauseloom.operators import calendar, checks, conform, derive, rules
from clauseloom.sources import loans as source
from clauseloom.sources.verdicts import write_verdicts
from clauseloom.streaming import verdicts as stream
from tests import brute
from tests.conftest import LOAN


def make_loans(n=600, seed=7):
    rng = random.Random(seed)
    base = date(2026, 9, 1)
    lists = [
        [date(2026, 10, 12), date(2026, 11, 11), date(2026, 11, 26), date(2026, 12, 25)],
        [date(2026, 10, 12), None],
        [],
        None,
        [base + timedelta(days=k) for k in range(0, 120, 3)],
    ]
    out = []
    for k in range(n):
        issue = base + timedelta(days=rng.randrange(90))
        if k % 50 == 0:
            issue = date(1901, 3, 1) + timedelta(days=k)  # outside every calendar
        closing = issue + timedelta(days=rng.choice([-40, -21, -20, -3, 0, 1, 4, 7, 12, 25]))
        method = rng.choice(["in_person", "mail", "electronic", None])
        received = rng.choice([None, issue + timedelta(days=rng.randrange(-15, 20))])
        mailed = rng.choice([None, issue + timedelta(days=rng.randrange(-30, 40))])
        out.append(
            {
                "loan_id": k,
                "cd": {
                    "issue_date": None if k % 41 == 0 else issue, "delivery_method": method,
                    "received_date": received, "mailed_date": mailed, "amount": 1.0,
                },
                "closing_date": None if k % 43 == 0 else closing,
                "transaction": {"timeshare": rng.choice([True, False, None])},
                "calendar": {"holidays": rng.choice(lists)},
            }
        )
    return out


@pytest.fixture(scope="module")
def loans():
    return make_loans()


@pytest.fixture(scope="module")
def frame(spark, loans):
    return spark.createDataFrame(loans, LOAN).repartition(4).persist()


def wanted(loans):
    letter = {"A": "1026.19(f)(1)(ii)(A)/r1", "B": "1026.19(f)(1)(ii)(B)/r1"}
    return {(l["loan_id"], letter[k], v) for l in loans for k, v in brute.verdicts(l).items()}


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_business_days_and_receipt(frame, loans):
    got = {r.loan_id: (r.days, r.cd_receipt_date) for r in derive.receipt_dates(frame).collect()}
    assert got == {l["loan_id"]: (brute.business_days(l), brute.receipt(l)) for l in loans}


def test_array_form(frame, loans):
    assert rows(rules.evaluate(frame, timing_pack())) == wanted(loans)


def test_calendar_form(frame, loans):
    assert rows(calendar.evaluate_by_calendar(frame, timing_pack())) == wanted(loans)


def test_calendar_form_of_awkward_lists(spark):
    """Long runs of holidays, Sundays, repeats and nulls in lists, far days, long windows: receipt and
    count are those of the array form."""
    rng = random.Random(4)
    base = date(1969, 12, 1)
    out = []
    for k in range(400):
        issue = base + timedelta(days=rng.randrange(-800, 800))
        days = [issue + timedelta(days=rng.randrange(-30, 60)) for _ in range(rng.choice([0, 3, 20, 80]))]
        days += [issue + timedelta(days=n) for n in range(rng.choice([0, 0, 9, 15]))] + rng.choice([[], [None], days])
        rng.shuffle(days)
        closing = issue + timedelta(days=rng.choice([-25, -19, -5, 0, 3, 8, 30, 700]))
        out.append({
            "loan_id": k,
            "cd": {"issue_date": issue, "delivery_method": rng.choice(["in_person", "mail", None]),
                   "received_date": issue + timedelta(days=rng.randrange(-15, 20)),
                   "mailed_date": issue + timedelta(days=rng.randrange(-30, 40)), "amount": 1.0},
            "closing_date": closing, "transaction": {"timeshare": k % 2 == 0},
            "calendar": {"holidays": days},
        })
    frame = spark.createDataFrame(out, LOAN).repartition(4)
    want = rows(derive.days_before_closing(frame))
    assert rows(calendar.with_calendar(frame).select("loan_id", "cd_receipt_date", "n_days")) == want
    assert rows(calendar.evaluate_by_calendar(frame, timing_pack())) == wanted(out)


def test_calendar_form_has_no_join_and_no_list_of_days(frame):
    ready = calendar.with_calendar(frame.sparkSession.createDataFrame(frame.limit(5).collect(), frame.schema))
    plan = ready._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Join", "Exchange", "Generate", "sequence", "Window"))


def test_list_id_is_that_of_the_set(spark):
    days = [date(2026, 1, 1), date(2026, 5, 25), date(2026, 7, 4)]
    frame = spark.createDataFrame([(days,), (days[::-1] + [None],), (days + days,), (days[:2],), ([],), (None,)], "h array<date>")
    ids = [r[0] for r in frame.select(ordinals.list_id(F.col("h"))).collect()]
    assert ids[0] == ids[1] == ids[2] and len(set(ids[2:5])) == 3


def test_calendar_dim_counts_business_days(frame, loans):
    lists = calendar.holiday_lists(frame).where("size(holidays) > 3")
    found = {}
    for r in calendar.calendar_dim(lists).collect():
        found.setdefault((r.list_id, tuple(r.holidays)), []).append((r.day, r.is_business, r.n_before))
    assert len(found) == lists.count() == 2
    for (_, holidays), days in found.items():
        n = 0
        for day, is_business, n_before in sorted(days):
            assert is_business == (day.isoweekday() != 7 and day not in holidays) and n_before == n
            n += is_business


def test_every_list_and_every_day_has_its_calendar(frame):
    """Many lists, and days long ago and far ahead: no calendar and no day is left out."""
    many = frame.limit(1).crossJoin(frame.sparkSession.range(200).withColumnRenamed("id", "k")).withColumn(
        "calendar", F.struct(F.array(F.date_add(F.lit("2020-01-01"), F.col("k").cast("int"))).alias("holidays"))
    )
    assert calendar.holiday_lists(many).count() == 200
    for issue in ("1885-03-02", "1985-03-02", "2060-03-02"):
        old = many.withColumns({
            "cd": F.col("cd").withField("issue_date", F.to_date(F.lit(issue))),
            "closing_date": F.date_add(F.to_date(F.lit(issue)), 9),
        })
        dim = calendar.calendar_dim(calendar.holiday_lists(old))
        assert dim.select("holidays").distinct().count() == 200
        assert dim.where(F.col("day") == F.lit(issue)).count() == 200


def test_property_of_three_days(frame, loans):
    """Three business days from receipt to closing: receipt is no later than the third business
    day before closing, where closing is not before issue."""
    counted = derive.days_before_closing(frame).alias("a")
    days = derive.business_day_sets(frame)
    third = F.get(F.reverse(F.filter("days", lambda d: d < F.col("closing_date"))), F.lit(2))
    other = frame.join(days, "loan_id").withColumn("third", third)
    both = other.join(counted, "loan_id").where(
        "closing_date >= cd.issue_date and cd_receipt_date is not null"
        " and cd_receipt_date >= date_sub(cd.issue_date, 10) and calendar.holidays is not null"
        " and third is not null"
    )
    assert both.count() > 80
    assert both.where("(n_days >= 3) <> (cd_receipt_date <= third)").count() == 0


def test_folds_agree(frame, loans):
    pack = timing_pack()
    in_row = rows(rules.subsection_verdicts(frame, pack))
    stored = rows(rules.fold_verdict_rows(frame, rules.evaluate(frame, pack), pack))
    assert in_row == stored and len(in_row) == 2 * len(loans)


def test_a_missing_flag_fires_nothing_and_is_reported(frame, loans):
    silent = {l["loan_id"] for l in loans if l["transaction"]["timeshare"] is None}
    fired = {r.loan_id for r in rules.evaluate(frame, timing_pack()).collect()}
    assert not silent & fired
    gaps = rules.undecided(frame, timing_pack()).where(F.col("cell") == "applies_when")
    assert {r.loan_id for r in gaps.collect()} == silent


def test_missing_receipts(frame, loans):
    got = {r.loan_id for r in rules.missing_receipt(frame, timing_pack()).collect()}
    assert got == {l["loan_id"] for l in loans if brute.receipt(l) is None}


def test_result_document(frame, loans):
    for r in rules.result_document(frame, timing_pack()).limit(60).collect():
        loan = loans[r.loan_id]
        document = json.loads(r.document)
        results = {
            k: [e["result"] for e in v] for k, v in document["results"].items()
        }
        v = brute.verdicts(loan)
        assert results == {
            "s1026_19_f_1_ii_A": [v["A"]] if "A" in v else [],
            "s1026_19_f_1_ii_B": [v["B"]] if "B" in v else [],
        }


def test_derived_fields_in_any_order_and_other_packs(spark, frame):
    pack = Pack(
        derived=(
            Derived("slack", "datediff(closing_date, derived.first_day)"),
            Derived("first_day", "get(derived.days, 0)"),
            DaySet("days", "cd.issue_date", "closing_date", pad_days=2, test="day(day) % 2 = 1"),
        ),
        rules=(Rule("x/r1", "x", "transaction.timeshare", "derived.slack > 5"),
               Rule("x/r2", "x", "true", "size(derived.days) > 4")),
    )
    assert [d.name for d in pack.in_order()] == ["days", "first_day", "slack"]
    one = rules.collect_hits(frame, pack).where("loan_id = 3").collect()
    assert one[0].subsection == "x" and {h.rule_id for h in one[0].hits} <= {"x/r1", "x/r2"}


def test_no_shuffle_from_scan_to_verdict(frame):
    plan = rules.evaluate(frame.sparkSession.createDataFrame(frame.limit(5).collect(), frame.schema),
                          timing_pack())
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text
    assert text.count("array_except") == 1, "a day set is computed once per loan"


def test_read_loan_files(spark, tmp_path):
    loan = {
        "cd": {"issue_date": "2026-10-14", "delivery_method": "mail", "received_date": None,
               "mailed_date": "2026-10-16"},
        "closing_date": "2026-02-30", "transaction": {"timeshare": True},
        "calendar": {"holidays": ["2026-10-12", "soon"]},
    }
    (tmp_path / "a.json").write_text(json.dumps(loan, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"closing_date": "2026-10-19"}))
    got = {r.file[-6:]: r for r in source.read_loans(spark, str(tmp_path / "*.json")).collect()}
    assert got["a.json"].cd.mailed_date == date(2026, 10, 16)
    assert got["a.json"].closing_date is None
    assert got["a.json"].calendar.holidays == [date(2026, 10, 12), None]
    assert got["b.json"].closing_date == date(2026, 10, 19) and got["b.json"].cd.issue_date is None


def test_rejected_loans_are_findings_in_batch_and_stream(spark, tmp_path):
    good = json.dumps({"loan_id": "1", "closing_date": "2026-10-19"})
    bad = ['{"closing_date": "2026-', "not json"]
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "lines.json").write_text("\n".join([bad[0], good, bad[1], good]))
    path = str(folder / "*.json")
    assert [r.closing_date for r in source.read_loans(spark, path, one_per_file=False).collect()] == [date(2026, 10, 19)] * 2
    assert sorted(r.detail for r in source.rejected_loans(spark, path, one_per_file=False).collect()) == sorted(bad)
    (tmp_path / "whole.json").write_text(bad[0])
    assert source.read_loans(spark, str(tmp_path / "whole.json")).count() == 0
    lost = source.rejected_loans(spark, str(tmp_path / "whole.json")).collect()
    assert [(r.check, r.subject[-10:], r.detail) for r in lost] == [("unreadable", "whole.json", bad[0])]
    out = str(tmp_path / "out")
    stream.append_findings(stream.rejected_stream(spark, str(folder)), out).awaitTermination()
    assert sorted(r.detail for r in spark.read.parquet(f"{out}/findings").collect()) == sorted(bad)
    assert stream.loan_stream(spark, str(folder)).isStreaming


def test_conformance(spark):
    raw = spark.createDataFrame(
        [
            (1, ("2026-10-14", "mail", None, "2026-1-5"), "2026-02-30", (["2026-10-12"],)),
            (2, ("2026-10-14", "fax", None, None), "2026-10-19", (None,)),
            (3, ("x", None, None, None), None, (["2026-10-12", "x"],)),
            (4, ("2026-10-14", "in_person", None, None), "2026-10-19", (["2026-10-12", "2026-13-01"],)),
            (5, ("2026-10-14", "in_person", None, None), "2026-10-19", ([],)),
            (6, ("2026-10-14", "in_person", None, None), "2026-10-19", (["2026-10-12", None],)),
        ],
        "loan_id int, cd struct<issue_date:string,delivery_method:string,received_date:string,"
        "mailed_date:string>, closing_date string, calendar struct<holidays:array<string>>",
    )
    assert rows(conform.conform(raw, "loan_id")) == {
        (1, "cd.mailed_date", "not a date"),
        (1, "closing_date", "not a date"),
        (2, "cd.delivery_method", "not a listed value"),
        (2, "calendar.holidays", "no list"),
        (3, "cd.issue_date", "not a date"),
        (3, "calendar.holidays", "not a date"),
        (4, "calendar.holidays", "not a date"),
        (6, "calendar.holidays", "not a date"),
    }


@pytest.mark.parametrize(
    "bad",
    [
        {"fields": {"a": "money"}},
        {"fields": {"a": "enum"}},
        {"fields": {"a": "date"}, "derived": {"d": "list"}},
        {"fields": {"a": "date"}, "derived": {"d": "day_set"}},
        {"fields": {"a": "date", "b": "string"}, "derived": {"d": "day_set"},
         "windows": {"d": {"from": "a", "to": "b", "pad_days": 1}}},
    ],
)
def test_vocabulary_refuses(bad):
    with pytest.raises(VocabularyError):
        Vocabulary(**bad)


def test_vocabulary_schema():
    schema = LOAN_VOCABULARY.schema()
    assert schema["cd"].dataType["issue_date"].dataType.typeName() == "date"
    assert schema["calendar"].dataType["holidays"].dataType.elementType.typeName() == "date"


def test_written_verdicts_are_read_by_rule(spark, frame, tmp_path):
    path = write_verdicts(rules.evaluate(frame, timing_pack()), str(tmp_path / "v"))
    one = spark.read.parquet(path).where(F.col("rule_id") == GENERAL_RULE)
    assert "PartitionFilters: [isnotnull(rule_id" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == rules.evaluate(frame, timing_pack()).where(F.col("rule_id") == GENERAL_RULE).count()


def test_stream_equals_batch(spark, frame, loans, tmp_path):
    def texts(part):
        for l in part:
            item = dict(l, loan_id=str(l["loan_id"]))
            yield json.dumps(item, default=lambda d: d.isoformat())

    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text("\n".join(texts(loans[:300])))
    out = str(tmp_path / "out")
    incoming = stream.loan_stream(spark, str(folder))
    stream.stream_verdicts(incoming, timing_pack(), out).awaitTermination()
    (folder / "b.json").write_text("\n".join(texts(loans[300:])))
    stream.stream_verdicts(incoming, timing_pack(), out).awaitTermination()
    got = spark.read.parquet(f"{out}/verdicts").select(F.col("loan_id").cast("long"), "rule_id", "result")
    assert checks.disagreements(got, rules.evaluate(frame, timing_pack())).count() == 0

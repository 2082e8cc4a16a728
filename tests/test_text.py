"""Lines, sentences, numbers, keys: the published examples, and plain Python on given texts."""

import hashlib
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from clauseloom.functions import names
from clauseloom.functions import text as tx
from clauseloom.operators import quotes, sentences
from clauseloom.sources import texts as source

REGULATION = [
    "# a note",
    "",
    "[1026.2(a)(6)] _Business day_ means a day on which offices are open; See below. However, for"
    " purposes of 5 U.S.C. 6103(a), such as the Birthday of Martin Luther King, Jr., the term"
    " means all calendar days.",
    "[1026.19(f)(1)(i)] _Scope._ In a transaction, the creditor shall _not_ wait.",
    "no label here",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("text")
    (path / "one.txt").write_bytes("\r\n".join(REGULATION).encode())
    (path / "two.txt").write_bytes("[1026.19(f)(1)(i)] Again the same label [x] Other.".encode())
    return path


def test_files_to_sentences(spark, folder):
    good, bad = source.read_paragraphs(spark, str(folder))
    assert [(r.source[-7:], r.line_no, r.line) for r in bad.collect()] == [("one.txt", 5, "no label here")]
    got = sentences.split_sentences(good, "label", "text", keep=("source",)).collect()
    one = [(r.id, r.n, r.heading, r.text) for r in got if r.source.endswith("one.txt")]
    assert one == [
        ("1026.2(a)(6)", 1, None, "Business day means a day on which offices are open;"),
        ("1026.2(a)(6).s2", 2, None, "See below."),
        ("1026.2(a)(6).s3", 3, None,
         "However, for purposes of 5 U.S.C. 6103(a), such as the Birthday of Martin Luther King, Jr.,"
         " the term means all calendar days."),
        ("1026.19(f)(1)(i)", 1, "Scope.", "In a transaction, the creditor shall not wait."),
    ]
    twice = sentences.duplicates(
        sentences.split_sentences(good, "label", "text", keep=("source",)), "id"
    ).collect()
    assert [(r.id, r.n_uses) for r in twice] == [("1026.19(f)(1)(i)", 2)]


def test_fingerprints_are_of_the_raw_bytes(spark, folder):
    got = {r.source[-7:]: r.sha256 for r in source.read_fingerprints(spark, str(folder)).collect()}
    assert got["one.txt"] == hashlib.sha256((folder / "one.txt").read_bytes()).hexdigest()


def test_abbreviations(spark):
    text = (
        "Holidays in 5 U.S.C. 6103(a), such as the Birthday of Martin Luther King, Jr., under"
        " § 1026.38 apply. Next sentence. See No. Five, e.g. That one; “Quoted” next. TexCo. Stays."
    )
    frame = spark.createDataFrame([("x", text)], "label string, text string")
    got = [r.text for r in sentences.split_sentences(frame, "label", "text").orderBy("n").collect()]
    assert got == [
        "Holidays in 5 U.S.C. 6103(a), such as the Birthday of Martin Luther King, Jr., under"
        " § 1026.38 apply.",
        "Next sentence.",
        "See No. Five, e.g. That one;",
        "“Quoted” next.",
        "TexCo. Stays.",
    ]


def python_sentences(text):
    """Cut after each `.` or `;` that is followed by white space and a capital."""
    ends = [m.end() for m in re.finditer(r"[.;](?=\s+[\"'“‘(]?[A-Z])", text)]
    ends = [e for e in ends if not text[:e].endswith(tx.ABBREVIATIONS)]
    cuts = [0, *ends, len(text)]
    return [p for p in (text[a:b].strip() for a, b in zip(cuts, cuts[1:])) if p]


def test_given_documents_split_as_in_python(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where(~F.col("text").contains("_"))
    cut = docs.select("doc_id", "text", tx.sentences(F.col("text")).alias("parts")).collect()
    assert len(cut) > 100
    for r in cut:
        assert r.parts == python_sentences(r.text), r.doc_id


def python_numbers(text):
    """The numbers a text states, by the same tables, word by word."""
    from fractions import Fraction

    low = text.lower()
    found = {Fraction(d.replace(",", "")) for d in re.findall(tx.DIGITS, text)}
    for pair in re.findall(tx.HYPHENATED, low):
        head, tail = pair.split("-")
        if head in tx.TENS and tail in tx.BELOW_TEN:
            found.add(Fraction(tx.TENS[head] + tx.BELOW_TEN[tail]))
    words = re.findall("[a-z]+", low)
    for word, after in zip(words, [*words[1:], ""]):
        if word in tx.WORD_VALUES:
            found.add(Fraction(tx.WORD_VALUES[word]))
            found.add(Fraction(tx.WORD_VALUES[word] * tx.SCALES.get(after, 1)))
    return found


def number_texts():
    rng = random.Random(3)
    pieces = [*tx.WORD_VALUES, *tx.SCALES, "-", "-", " ", " ", " ", "é", "1,500", "007", "0.50", "1026.19",
              "12,34", "x", "10.", "3.0", "99999999999999999999999999999999999999999999.5", "\n", "The"]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 14))) for _ in range(400)] + [
        "no later than three business days, the third day, 1,500 and twenty-one",
        "three hundred", "three five-hundred", "a-twenty-one", "twenty-first", "Thirty-First", "",
    ]


def test_numbers(spark):
    from fractions import Fraction

    texts = list(enumerate(number_texts()))
    frame = spark.createDataFrame(texts, "id int, text string")
    got = {}
    for r in sentences.stated_numbers(frame, "id", "text").collect():
        got.setdefault(r.id, []).append(r.value)
    for i, text in texts:
        values = got.get(i, [])
        assert len(values) == len(set(values))
        assert {Fraction(v) for v in values} == python_numbers(text), text


def test_normal_form(spark):
    texts = [(1, "café"), (2, "café"), (3, "plain"), (4, "Å"), (5, "中"), (6, "ẋ̣")]
    frame = spark.createDataFrame(texts, "id int, text string")
    bad = {r.id for r in sentences.nfc_violations(frame, "id", "text").collect()}
    assert bad == {i for i, t in texts if unicodedata.normalize("NFC", t) != t}
    assert {2, 4} <= bad


def test_below_the_first_combining_mark_all_is_normal():
    """What the filter in front of the Python test relies on."""
    assert all(unicodedata.is_normalized("NFC", chr(c) + chr(d)) for c in range(0x300) for d in (0x41, 0xE9))


def test_keys(spark):
    frame = spark.createDataFrame([("1026.19(f)(1)(ii)(A)",)], "l string")
    got = frame.select(
        names.subsection_key(F.col("l")).alias("k"),
        names.rule_xml_id(F.concat("l", F.lit("/r1")), F.lit("pass")).alias("x"),
        names.feel_name(F.lit("derived.cd_receipt_date")).alias("f"),
        names.input_xml_id(F.lit("cd.issue_date")).alias("i"),
        *[names.label_phrase(F.lit(t)).alias(f"p{n}") for n, t in enumerate(("the day", "how it was", "theory"))],
    ).first()
    assert tuple(got) == (
        "s1026_19_f_1_ii_A", "rule_1026_19_f_1_ii_A_r1_pass", "derived_cd_receipt_date",
        "input_cd_issue_date", "the day", "how it was", "the theory",
    )


def test_quote_search_finds_all(spark):
    """Every pair of quote and text, by all classes of anchors, against a plain search."""
    rng = random.Random(5)
    words = ["no", "later", "than", "three", "business", "days", "é", "Kö", "a", "(f)", "1,5", "x-y", ";"]
    docs = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(0, 40)))) for i in range(150)]
    docs += [(1000 + i, docs[3][1]) for i in range(80)]  # copies of one text
    cuts = []
    for i in range(120):
        whole = docs[rng.randrange(150)][1]
        start = rng.randrange(0, max(1, len(whole)))
        cuts.append((i, whole[start:start + rng.choice([1, 2, 3, 5, 9, 20, 60])]))
    cuts += [(900, "than three business days no"), (901, "zzz"), (902, "; ;"), (903, "…")]
    cuts = [c for c in cuts if c[1]]
    q = spark.createDataFrame(cuts, "item_id int, text string")
    d = spark.createDataFrame(docs, "doc_id int, text string")
    got = [tuple(r) for r in quotes.quote_search(q, d, "item_id", "doc_id").collect()]
    want = {(i, j) for i, c in cuts for j, t in docs if c in t}
    assert len(got) == len(set(got)) and set(got) == want
    kinds = {r["class"] for r in quotes.anchors(q, "item_id", "text").select("class").distinct().collect()}
    assert kinds == {0, 1, 2, 3, 4}


def test_quote_search_makes_no_cross_join(spark, data):
    q = spark.read.parquet(f"{data}/benchmark.parquet")
    d = spark.read.parquet(f"{data}/documents.parquet")
    plan = quotes.quote_search(q, d, "item_id", "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan

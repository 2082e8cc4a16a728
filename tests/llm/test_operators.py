"""Operators on small tables: brute force, round trips, and the awkward cases of each."""

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clauseloom.llm import (
    exact_dedup, hamming, html_text, jaccard, langid, lm, mixing, pieces, pii, quality,
)
from clauseloom.llm.components import components
from clauseloom.llm.words import text_bytes, word_hashes, word_spans

DOCS = "doc_id long, text string, lang string, source string, n_chars long, row int, key string"
ODD = [None, "", "  \n", "a", "a", "é", "12 34", "A b c d e", "a b c d e", "word " * 3000]


def docs_of(spark, texts, langs=("en",), sources=("s",)):
    """Columns named as the operators' own ones are there, too."""
    rows = [
        (i, t, langs[i % len(langs)], sources[i % len(sources)], len(t or ""), 7, "k")
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, DOCS)


# --- words ----------------------------------------------------------------------------------------

def test_words_are_those_of_the_contract():
    rng = random.Random(1)
    letters = list("abAB \t\n\x0b\x1c\x85é ß")
    for _ in range(100):
        texts = ["".join(rng.choices(letters, k=rng.randint(0, 20))) for _ in range(4)] + [None]
        data, offsets = text_bytes(pa.array(texts, pa.string()))
        starts, ends, first = word_spans(data, offsets)
        hashes = word_hashes(data, starts, ends)
        got = [bytes(data[a:b]).lower() for a, b in zip(starts, ends)]
        want = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) for t in texts]
        assert got == sum(want, []) and list(np.diff(first)) == [len(w) for w in want]
        by_word = collections.defaultdict(set)
        for w, h in zip(got, hashes):
            by_word[w].add(h)
        assert all(len(v) == 1 for v in by_word.values())


# --- op1 ------------------------------------------------------------------------------------------

def brute_top_k(rows, queries, k, bits):
    codes = {i: [int((v[j] or 0) > 0) if j < len(v) else 0 for j in range(bits)] for i, v in rows if v is not None}
    out = {}
    for q in queries:
        if q in codes:
            near = sorted((sum(a != b for a, b in zip(codes[q], c)), i) for i, c in codes.items() if i != q)
            out[q] = [(i, d) for d, i in near[:k]]
    return out


@pytest.mark.parametrize("size", [None, 3, 5])
def test_hamming_top_k(spark, size):
    rng = random.Random(2)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(12)]) for i in range(60)]
    rows += [(100 + i, rows[3][1]) for i in range(30)]  # one code over and over
    rows += [(200, None), (201, [None] * 12), (202, [0.5])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, code int")
    found = collections.defaultdict(list)
    asked = frame.where("vec_id % 5 = 0")
    for r in hamming.top_k(frame, asked, k=7, size=size).orderBy("query_id", "rank").collect():
        found[r.query_id].append((r.vec_id, r.distance))
    assert dict(found) == brute_top_k(rows, [i for i, _ in rows if i % 5 == 0], 7, 12)


def test_hamming_small_tables(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert hamming.top_k(empty, empty).count() == 0
    two = spark.createDataFrame([(0, [1.0, -1.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0])], "vec_id long, embedding array<double>")
    got = hamming.top_k(two, two.where("vec_id = 0"), k=5).collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 1)]


# --- op2 ------------------------------------------------------------------------------------------

def test_exact_dedup(spark):
    texts = ODD + ["hot"] * 200 + ["cold", "cold"]
    docs = docs_of(spark, texts)
    docs = docs.union(docs.where("doc_id = 3"))  # a repeated row
    groups = collections.defaultdict(list)
    for r in docs.collect():
        groups[r.text or ""].append(r.doc_id)
    got = exact_dedup.groups(docs, capacity=8).collect()
    assert len(got) == docs.count()
    by_id = {r.doc_id: r for r in got}
    for text, ids in groups.items():
        for i in ids:
            assert (by_id[i].keep_id, by_id[i].group_size) == (max(ids), len(ids))
            assert by_id[i].text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert sum(r.kept for r in got) == len(groups)
    left = exact_dedup.deduplicate(docs, capacity=8)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(max(v) for v in groups.values())
    assert exact_dedup.groups(docs.limit(0)).count() == 0


# --- op3 ------------------------------------------------------------------------------------------

def test_lm_base_scores_and_normalisation(spark):
    rng = random.Random(3)
    texts = ODD + [" ".join(rng.choices("aa bb cc dd ee ff gg".split(), k=30)) for _ in range(40)]
    docs = docs_of(spark, texts)
    held = F.col("doc_id") % 4 == 1
    got = {r.doc_id: r for r in lm.score(docs, held, words=4, classes=8, head=3).collect()}
    words = {i: re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()) + [b"\n"] for i, t in enumerate(texts)}
    c = collections.Counter(w for i, ws in words.items() if i % 4 != 1 for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in words.items():
        r = got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(r.base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r.held_out == (i % 4 == 1) and r.score < 0
    assert lm.score(docs.limit(0), held).count() == 0


def test_lm_outputs_add_up_to_one():
    share = np.full(10, 0.1)
    model = lm.LogBilinear(share)
    first = np.array([0, 3])
    total = sum(10 ** model.log10_probabilities(np.array([4, 7, o]), first)[2] for o in range(10))
    assert math.isclose(total, 1, rel_tol=1e-5)


# --- op4 ------------------------------------------------------------------------------------------

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    def luhn(d):
        return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                    "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


def test_pii_base_spans(spark):
    rng = random.Random(4)
    bits = [*"ab.@ -+()1234567890%_\n", "é", "😀", "4111111111111111", "4111 1111 1111 1111", " a@b.co ",
            "1.2.3.4", "+1 (234) 555-1234", ".."]
    texts = ODD + ["".join(rng.choices(bits, k=rng.randint(0, 30))) for _ in range(400)]
    for r in pii.extract(docs_of(spark, texts)).collect():
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(r.spans.split(","))


def test_pii_learns_a_context(spark):
    texts = [f"please call me at +1 (555) 555-{1000 + i} today or later" for i in range(6)]
    texts += ["please call me at 555-123-4567 today or later", "the sum is 555-123-9999 here"]
    got = {r.doc_id: r for r in pii.extract(docs_of(spark, texts)).collect()}
    assert got[6].spans == "phone:18:30" and got[6].n_phone == 0 and got[6].n_added == 1
    assert got[7].spans == ""
    assert pii.extract(docs_of(spark, texts).limit(0)).count() == 0


# --- op5 ------------------------------------------------------------------------------------------

def brute_components(texts):
    sets = {}
    for i, t in enumerate(texts):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
    root = dict.fromkeys(sets)
    for i in sets:
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_texts(rng):
    words = [f"w{i}" for i in range(900)]
    texts = list(ODD)
    for _ in range(25):
        base = rng.choices(words, k=rng.choice([2, 5, 6, 9, 14, 40, 90, 200]))
        for _ in range(rng.choice([1, 3, 12])):
            new = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                new[rng.randrange(len(new))] = rng.choice(words)
            texts.append(" ".join(new))
            base = new if rng.random() < 0.5 else base  # chains
    passage = rng.choices(words, k=60)
    texts += [" ".join(rng.choices(words, k=50) + passage) for _ in range(60)]
    rng.shuffle(texts)
    return texts


def test_jaccard_join(spark):
    texts = near_texts(random.Random(5))
    docs = docs_of(spark, texts)
    want = brute_components(texts)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(docs).collect()}
    assert got == want
    left = jaccard.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted({v[1] for v in want.values()})


def test_jaccard_small_tables(spark):
    assert jaccard.join(docs_of(spark, ["a"]).limit(0)).count() == 0
    assert [tuple(r) for r in jaccard.join(docs_of(spark, [None])).collect()] == [(0, 0, 0)]


def test_sketch_distance_bounds_the_difference():
    rng = np.random.default_rng(6)
    for _ in range(50):
        a = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 200), dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.8], rng.integers(0, 1 << 63, 20, dtype=np.uint64)]))
        apart = len(np.setxor1d(a, b))
        assert jaccard.sketch_distance(jaccard.dense(a), jaccard.dense(b)) <= apart


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(200, 300), (5, 5)], "a long, b long")
    got = {r.key: r.root for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(71), 0), 200: 200, 300: 200}


# --- op6 ------------------------------------------------------------------------------------------

PAGES = [
    f"<html><body><nav><ul><li><a href='/'>Menu {i}</a></li></ul></nav><div class='ad'>Buy {i} now.</div>"
    f"<article><h1>Title {i} of it</h1>" + "".join(
        f"<p>Paragraph {j} of page {i}, with &amp; some more words in it, and an end.</p>" for j in range(2 + i % 5))
    + "</article><footer>&copy; Footer</footer></body></html>"
    for i in range(30)
]


def test_html_main_text(spark):
    rows = [(i, "u", h, 1) for i, h in enumerate([*PAGES, None, "", "no tags", "<p>x<script>y</p></script>"])]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    model = html_text.fit(PAGES, copies=2)
    got = {r.page_id: r for r in html_text.extract(frame, model, keep=["page_id", "url"]).collect()}
    assert len(got) == len(rows)
    right = 0
    for i, h in enumerate(PAGES):
        body = h[h.index("<article>") : h.index("</article>")]
        want = " ".join(re.sub("<[^>]*>", " ", body).replace("&amp;", "&").split())
        right += got[i].text == want
        assert got[i].n_chars == len(got[i].text)
    assert right >= 27
    assert got[30].text == got[31].text == ""
    assert "y" not in got[33].text


STORY = ("The first paragraph of the story goes on for a while, and then it ends here.",
         "The second one tells what came next, with some more words in it.",
         "The third says how it all came out, and that is the end of it.")
MENU = "<nav><ul><li><a href='/'>Home</a></li><li><a href='/b'>About us</a></li></ul></nav>"
ADVERT = "<div class=ad>Buy this now.</div>"


@pytest.fixture(scope="module")
def page_model():
    rng = random.Random(5)

    def words(low, high):
        return " ".join("".join(rng.choices("aeinorst", k=rng.randint(1, 9)))
                        for _ in range(rng.randint(low, high)))

    return html_text.fit([
        f"<html><body><article><h1>{words(2, 8)}</h1>" + "".join(
            f"<p>{words(5, 30)}, {words(3, 30)}.</p>" for _ in range(rng.randint(1, 9)))
        + f"</article><footer>{words(2, 8)}</footer></body></html>" for _ in range(60)
    ])


def test_html_text_directly_in_containers(page_model):
    a, b, c = STORY
    pages = {
        f"<html><body>{MENU}<article>{a}<br>{b}{ADVERT}{c}</article><footer>&copy; x</footer></body></html>": (a, b, c),
        f"<html><body>{MENU}{a}<br>{b}</body></html>": (a, b),
        f"<html><body>{MENU}{a}<br><br>{b}<br><br>{c}</body></html>": (a, b, c),
        f"<html><body>{MENU}{ADVERT}</body></html>{a} {b}": (a, b),
        f"{a}\n{b}<br>{c}": (a, b, c),
        "no tags": ("no tags",),
    }
    assert html_text.main_texts(list(pages), page_model) == [" ".join(w) for w in pages.values()]


def test_html_inline_markup_stays_in_its_sentence(page_model):
    a, b, c = STORY
    head, foot = f"<html><body>{MENU}<article><h1>A title of it</h1>", "</article><footer>&copy; x</footer></body></html>"
    pages = {
        f"{head}<p>See <a href='/x'>the long and full report</a> and <em>the</em> <code>code</code>. {a}</p><p>{b}</p>{foot}":
            f"A title of it See the long and full report and the code. {a} {b}",
        f"{head}<p>{a} <a href='/y'>{b}</a> <span>And</span> <strong><a href='/z'>more</a></strong>.</p><p>{c}</p>{foot}":
            f"A title of it {a} {b} And more. {c}",
        f"{head}<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x = 2</annotation></math> be. {a}</p><p>{b}</p>{foot}":
            f"A title of it Let x=2 be. {a} {b}",
    }
    assert html_text.main_texts(list(pages), page_model) == list(pages.values())


def test_html_states_never_contradict():
    rng = np.random.default_rng(7)
    for _ in range(100):
        n = 12
        parent = np.array([-1, *(rng.integers(0, i) for i in range(1, n))])
        log_p = np.log(rng.dirichlet([1, 1, 1], n))
        state = html_text.decode(log_p, parent, np.ones(n))
        for i in range(1, n):
            above = state[parent[i]]
            assert above != html_text.OTHER or state[i] == html_text.OTHER
            assert above != html_text.CONTENT or state[i] != html_text.MIXED


# --- op7 ------------------------------------------------------------------------------------------

def test_mixing_keeps_all_and_meets_the_limit(spark):
    rng = random.Random(8)
    texts = [" ".join("w" * rng.randint(1, 30)) for _ in range(400)] + [None, ""]
    sources = ["big"] * 12 + ["mid"] * 4 + [None, "small"]
    docs = docs_of(spark, texts, sources=sources)
    got = mixing.mixture(docs, repetition=2.0, block_rows=20).collect()
    assert len(got) == len(texts)
    paid, owned = collections.Counter(), collections.Counter()
    for r in got:
        assert 1 <= r.copies <= 2
        owned[r.source] += r.n_tokens
        paid[r.source] += r.n_tokens * r.copies
    largest = max(owned, key=owned.get)
    assert paid[largest] == owned[largest]
    weight = {r.source: r.weight for r in got}
    assert math.isclose(sum(weight.values()), 1)
    length = owned[largest] / weight[largest]
    for s in owned:  # the budget, and at most one document over it
        assert -1 <= paid[s] - weight[s] * length <= 31
    mixed = mixing.mix(docs, repetition=2.0, block_rows=20)
    assert mixed.columns == docs.columns
    assert collections.Counter(r.doc_id for r in mixed.collect()) == {r.doc_id: r.copies for r in got}


def test_mixing_by_entropy_and_budget(spark):
    docs = docs_of(spark, ["a b c d"] * 90 + ["a b"] * 10, sources=["x"] * 9 + ["y"])
    got = mixing.mixture(docs, repetition=None, entropy=0.9, budget=200).collect()
    w = {r.source: r.weight for r in got}
    entropy = -sum(v * math.log(v) for v in w.values()) / math.log(2)
    assert math.isclose(entropy, 0.9, abs_tol=1e-6)
    assert abs(sum(r.n_tokens * r.copies for r in got) - 200) <= 8
    assert mixing.mixture(docs.limit(0)).count() == 0


# --- op8 ------------------------------------------------------------------------------------------

def test_forward_backward_is_exact(monkeypatch):
    rng = np.random.default_rng(9)
    for segment in (1, 3, 48):
        monkeypatch.setattr(langid, "SEGMENT", segment)
        sizes = [0, 1, 7, 2]
        first = np.concatenate([[0], np.cumsum(sizes)])
        scores, steps = rng.normal(size=(10, 3)), rng.normal(size=(3, 3))
        got, pairs = langid.forward_backward(scores, first, steps, pairs=True)
        want, all_pairs, a = np.zeros_like(scores), np.zeros((3, 3)), np.exp(steps)
        for lo, hi in zip(first[:-1], first[1:]):
            total = 0.0
            marginal, joint = np.zeros((hi - lo, 3)), np.zeros((3, 3))
            for path in np.ndindex(*[3] * (hi - lo)):
                if not path:
                    continue
                p = a[:, path[0]].sum() * np.prod([math.exp(scores[lo + t, s]) for t, s in enumerate(path)])
                p *= np.prod([a[x, y] for x, y in zip(path, path[1:])])
                total += p
                for t, s in enumerate(path):
                    marginal[t, s] += p
                for x, y in zip(path, path[1:]):
                    joint[x, y] += p
            if hi > lo:
                want[lo:hi], all_pairs = marginal / total, all_pairs + joint / total
        assert np.allclose(got, want) and np.allclose(pairs, all_pairs)


def test_language_of_texts_and_words(spark):
    rng = random.Random(10)
    english, german = "the of and with this that from".split(), "der und nicht ein auf mit über".split()
    texts = [" ".join(rng.choices(english if i % 2 else german, k=40)) for i in range(60)]
    docs = docs_of(spark, texts, langs=("de", "en"))
    model = langid.train(docs.where("doc_id < 40"), rounds=10)
    odd = docs_of(spark, [*ODD, None, "12 ¿?", "the of and with der und nicht ein", "X"])
    got = {r.doc_id: r for r in langid.predict(odd, model, keep=["doc_id"]).collect()}
    assert {i for i, r in got.items() if r.lang_pred == "und"} == {0, 1, 2, 6, 10, 11}
    assert all(0 <= r.lang_score <= 1 for r in got.values())
    held = langid.predict(docs.where("doc_id >= 40"), model).collect()
    assert all(r.lang_pred == r.lang for r in held)
    words = {r.doc_id: r.languages for r in langid.label_words(odd, model).collect()}
    assert words[12] == ["en"] * 4 + ["de"] * 4
    none = langid.train(docs.limit(0))
    assert {r.lang_pred for r in langid.predict(odd, none).collect()} == {"und"}


def test_every_language_is_learned(spark):
    rng = random.Random(3)
    words_of = {f"l{i:02d}": ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(3, 8))) for _ in range(60)]
                for i in range(41)}

    def text_of(name, n):
        return " ".join(rng.choices(words_of[name], k=n))

    # l40 has only texts that are longer than what is fitted on; l39 is the rarest.
    rows = [(f"{name}-{j}", text_of(name, 600 if name == "l40" else 40), name)
            for name in words_of for j in range(2 if name == "l39" else 4)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, lang string")
    model = langid.train(docs, per_language=3, fit_bytes=1200, rounds=12)
    assert model.languages == sorted(words_of)
    new = spark.createDataFrame([(name, text_of(name, 30)) for name in words_of], "lang string, text string")
    assert all(r.lang == r.lang_pred for r in langid.predict(new, model).collect())


# --- op9 ------------------------------------------------------------------------------------------

def test_quality(spark):
    rng = random.Random(11)
    good = [" ".join(rng.choices("a quiet word and then another one".split(), k=60)) + "." for _ in range(80)]
    bad = [t.upper().replace(" ", "!! ") for t in good]
    docs = docs_of(spark, [*good, *bad, *ODD])
    labels = spark.createDataFrame(
        [(i, int(i < 80)) for i in range(0, 160, 2)] + [(1, None), (None, 1), (3, 7)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    got = {r.doc_id: r for r in quality.predict(docs, model).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert sum(got[i].predicted == (i < 80) for i in range(1, 160, 2)) >= 78
    assert quality.predict(docs.limit(0), model).count() == 0
    assert {r.score for r in quality.predict(docs, quality.train(docs, labels.limit(0))).collect()} == {0.5}


# --- op10 -----------------------------------------------------------------------------------------

def brute_pieces(text, p, lowest):
    if not text:
        return []
    w = pieces.MARK + text.replace(" ", pieces.MARK)
    score = {t: (s, i) for i, (t, s, k) in enumerate(zip(p.texts, p.scores, p.kinds)) if k == "normal"}
    best, came = [0.0] + [-math.inf] * len(w), [None] * (len(w) + 1)
    for i in range(1, len(w) + 1):
        for n in range(min(16, i), 0, -1):
            t = w[i - n : i]
            if t in score and best[i - n] + score[t][0] > best[i]:
                best[i], came[i] = best[i - n] + score[t][0], (n, [score[t][1]])
        if w[i - 1] not in score and best[i - 1] + lowest > best[i]:
            best[i], came[i] = best[i - 1] + lowest, (1, [3 + b for b in w[i - 1].encode()])
    out, i = [], len(w)
    while i:
        out = came[i][1] + out
        i -= came[i][0]
    return out


def test_pieces_are_the_best_path_and_come_back(spark):
    p = pieces.load()
    lowest = pieces.Encoder(p).lowest
    rng = random.Random(12)
    bits = [*"abcdeinrt  ", "the", "ing", "é", "ß", "\n", "①", "😀", "\t", "  ", "あ"]
    texts = ODD + ["".join(rng.choices(bits, k=rng.randint(0, 14))) for _ in range(300)]
    docs = docs_of(spark, texts)
    coded = pieces.with_ids(docs, p, score="score", trip="trip")
    got = {r.doc_id: r for r in coded.collect()}
    for i, t in enumerate(texts):
        assert got[i].trip
        if len(t or "") < 100:
            assert got[i].ids == brute_pieces(t, p, lowest)
    back = pieces.decoded(coded.drop("text"), p)
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert pieces.with_ids(docs.limit(0), p).count() == 0


def test_pages_deep_and_wide_take_linear_time():
    """A hundred thousand elements inside each other or side by side; closing tags out of order."""
    import time

    for page in ("<div>" * 100_000 + "x", "<p>a b</p>" * 100_000, "<p>" + "<span>a</span>" * 50_000, "<ul>" + "<li>a" * 50_000):
        started = time.time()
        html_text.features(html_text.nodes_of(html_text.parse(page)))
        assert time.time() - started < 40
    odd = html_text.parse("<table><tr><td><p>a<table><tr><td>b</p>c</table>d</td></tr></table><b>e</i></b>f</p></div>g")
    texts = [n for n in html_text.nodes_of(odd) if n.tag == "table"]
    assert len(texts) == 2 and texts[1].parent.tag in ("p", "td")

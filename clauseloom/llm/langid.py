"""Language identification: a linear-chain conditional random field over the words of a text.

Features of a word are its lexicon entry (the whole word), affixes of one to four bytes at either
end and all byte bi- and trigrams, each hashed to one row of a weight table with a column per
language. Transition weights between neighbouring words are learned. The forward-backward pass
gives each word its probability of each language, so code-switched text gets labels per word.

Every label that occurs is learned. Fitting takes at most `per_language` documents of each language,
and fewer of each beyond SHARED languages, so that their sum is bounded: those with the smallest hash of their
id, whole ones of at most `fit_bytes` bytes first, then runs of words of longer ones. They are spliced word run by word run
with runs of other languages, so that the transitions see switches. The sample is bounded, so the
model is fitted on the driver; labelling runs in Arrow batches on the executors.

Cases: null or empty text, or text without a letter: `und`, score 0. Ties between languages: the
first in code-point order. No labelled row at all: every text is `und`. Columns of the input other
than the key and the text are not read. Repeated rows each get their row.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseloom.llm.shared import lean
from clauseloom.llm.words import parts, ranges, row_blocks, text_bytes, word_hashes, word_spans

BITS = 17
SEGMENT = 48  # words per segment of the chain
BLOCK = 200_000  # words labelled at a time
WORDS = 20_000  # distinct words scored at a time
SHARED = 32  # beyond so many languages, they share the sample of so many
PAIRS = 20_000_000  # label pairs of words held at a time in fitting

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_MASK = np.int64((1 << BITS) - 1)
_LOW = np.arange(256, dtype=np.int64)
_LOW[65:91] += 32


@dataclass
class Model:
    """`weights[feature, language]`, `steps[from, to]` (log), languages in order."""

    languages: list[str]
    weights: np.ndarray
    steps: np.ndarray


# --- features -----------------------------------------------------------------------------


def features(data, starts, ends, hashes) -> tuple[np.ndarray, np.ndarray]:
    """(feature rows, number per word): hashed features of each word, one word after another."""
    lengths = ends - starts
    parts = [((hashes >> np.uint64(20)).astype(np.int64) & _MASK, np.arange(len(starts)))]
    owners = np.repeat(np.arange(len(starts)), lengths)
    at = ranges(starts, lengths)
    low = _LOW[data[at]]
    left = np.repeat(ends, lengths) - at  # bytes from here to the end of the word
    since = at - np.repeat(starts, lengths)
    gram = low + 1
    for n in range(1, 5):
        if n > 1:
            gram = gram[:-1] * 1_000_003 + low[n - 1 :] + 1
        inside = left[: len(gram)] >= n
        code = (gram * 0x9E3779B1 + n * 0x7F4A7C15) >> 13
        if n in (2, 3):
            parts.append((code[inside] & _MASK, owners[: len(gram)][inside]))
        first = inside & (since[: len(gram)] == 0)
        parts.append(((code[first] * 31 + 7) & _MASK, owners[: len(gram)][first]))
        last = inside & (left[: len(gram)] == n)
        parts.append(((code[last] * 37 + 11) & _MASK, owners[: len(gram)][last]))
    rows = np.concatenate([p[0] for p in parts])
    owner = np.concatenate([p[1] for p in parts])
    order = np.argsort(owner, kind="stable")
    return rows[order], np.bincount(owner, minlength=len(starts))


def _sum_runs(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of rows; every count is positive."""
    if len(counts) == 0:
        return np.zeros((0, values.shape[1]), values.dtype)
    return np.add.reduceat(values, np.cumsum(counts) - counts, axis=0)


# --- the chain -----------------------------------------------------------------------------


def forward_backward(scores, first, steps, pairs: bool = False):
    """Per word: the probability of each label. scores: (words, labels), log; words of chain i are
    first[i]:first[i + 1]. With `pairs`, also the expected label pairs over all chains.

    Chains are cut into segments. The product of a segment's matrices is worked out for all
    segments at once, then chained segment by segment, then run again from its true beginning.
    """
    n, k = scores.shape
    if n == 0:
        return np.zeros((0, k)), np.zeros((k, k))
    words = np.diff(first)
    per = -(-words // SEGMENT)
    chain = np.repeat(np.arange(len(words)), per)
    base = np.cumsum(per) - per
    nth = np.arange(len(chain)) - base[chain]
    begin = first[:-1][chain] + nth * SEGMENT
    size = np.minimum(first[1:][chain] - begin, SEGMENT)
    kind = scores.dtype
    a = np.exp(steps - steps.max()).astype(kind)
    at = begin[:, None] + np.arange(SEGMENT)
    there = np.arange(SEGMENT) < size[:, None]
    psi = np.exp(scores - scores.max(axis=1, keepdims=True))[np.minimum(at, n - 1)]
    psi = np.maximum(psi, 1e-30)

    def scaled(x):
        return x / x.sum(axis=-1, keepdims=True)

    whole = np.broadcast_to(np.eye(k, dtype=kind), (len(chain), k, k)).copy()
    for t in range(SEGMENT):
        on = there[:, t]
        if not on.any():
            break
        x = (whole[on] @ a) * psi[on, t][:, None, :]
        whole[on] = x / x.sum(axis=(1, 2), keepdims=True)
    entry = np.full((len(chain), k), 1.0 / k, kind)  # what goes into a segment
    leave = np.full((len(chain), k), 1.0 / k, kind)  # what comes back from behind it
    by_length = np.argsort(-per, kind="stable")
    most = int(per.max())
    alive = [by_length[: int(np.searchsorted(-per[by_length], -j, "right"))] for j in range(most + 1)]
    for j in range(1, most):
        s = base[alive[j + 1]] + j
        entry[s] = scaled(np.einsum("si,sij->sj", entry[s - 1], whole[s - 1]))
    for j in range(most - 1, 0, -1):
        s = base[alive[j + 1]] + j
        leave[s - 1] = scaled(np.einsum("sij,sj->si", whole[s], leave[s]))
    ahead = np.empty((len(chain), SEGMENT, k), kind)
    x = entry
    for t in range(SEGMENT):
        x = scaled((x @ a) * psi[:, t])
        ahead[:, t] = x
    back = np.empty((len(chain), SEGMENT, k), kind)
    y = leave.copy()
    for t in range(SEGMENT - 1, -1, -1):
        on = there[:, t]
        back[:, t] = y
        y[on] = scaled((psi[on, t] * y[on]) @ a.T)
    both = scaled(ahead * back)
    marginal = np.empty((n, k), kind)
    marginal[at[there]] = both[there]
    expected = np.zeros((k, k))
    if pairs:
        before = np.concatenate([entry[:, None], ahead[:, :-1]], axis=1)[there]
        after = (psi * back)[there]
        real = np.ones(n, bool)
        real[first[:-1][words > 0]] = False
        joint = before[:, :, None] * a[None] * after[:, None, :]
        joint /= joint.sum(axis=(1, 2), keepdims=True)
        expected = joint[real[at[there]]].sum(axis=0)
    return marginal, expected


# --- fitting -------------------------------------------------------------------------------


def sample(docs: DataFrame, text: str, label: str, key: str, per_language: int,
           fit_bytes: int) -> DataFrame:
    """(text, label, key): the bounded sample the model is fitted on; every label is in it."""
    fit = docs.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}"))
    number = max(fit.select(label).distinct().count(), 1)
    each = max(1, min(per_language, per_language * SHARED // number))
    long = F.octet_length(text) > fit_bytes
    # A run of words from anywhere in a long text; characters have four bytes at most.
    size = max(fit_bytes // 4, 1)
    begin = F.pmod(F.xxhash64(key, text), F.greatest(F.length(text) - size, F.lit(1))).cast("int") + 1
    run = F.substring(F.col(text), begin, F.lit(size))
    inner = F.regexp_extract(run, r"\s([\s\S]*)\s", 1)
    first = F.regexp_extract(text, r"\p{L}[\s\S]{0,%d}" % (size - 1), 0)
    cut = (F.when(inner.rlike(r"\p{L}"), inner).when(run.rlike(r"\p{L}"), run).otherwise(first))
    rank = F.row_number().over(
        Window.partitionBy("label").orderBy("long", F.xxhash64("key"), "key", F.xxhash64("text"))
    )
    return (
        fit.select(F.col(key).alias("key"), F.when(long, cut).otherwise(F.col(text)).alias("text"),
                   F.col(label).alias("label"), long.alias("long"))
        .withColumn("rank", rank)
        .where(F.col("rank") <= each)
        .select("text", "label", "key")
    )


def fit(rows: list[tuple[str, str]], rounds: int = 30, rate: float = 0.25, seed: int = 7) -> Model:
    """A model from (text, language) rows, by batch gradients with per-weight step sizes."""
    languages = sorted({r[1] for r in rows})
    k = len(languages)
    weights = np.zeros((1 << BITS, max(k, 1)))
    steps = np.zeros((k, k))
    if k == 0:
        return Model([], weights.astype(np.float32), steps)
    data, offsets = text_bytes(pa.array([r[0] for r in rows], pa.string()))
    starts, ends, first = word_spans(data, offsets)
    place_of = {name: i for i, name in enumerate(languages)}
    of_row = np.array([place_of[r[1]] for r in rows])
    truth = np.repeat(of_row, np.diff(first))
    hashes = word_hashes(data, starts, ends)
    _, one, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    rows_of, counts = features(data, starts[one], ends[one], hashes[one])
    owner = np.repeat(np.arange(len(one)), counts)
    # Runs of 5 to 60 words from all texts in a random order, in chains of some 20 runs.
    rng = np.random.default_rng(seed)
    cuts, at = [], 0
    while at < len(truth):
        cuts.append(at)
        at += int(rng.integers(5, 60))
    cuts = np.array(cuts)
    sizes = np.diff(np.append(cuts, len(truth)))
    order = rng.permutation(len(cuts))
    place = ranges(cuts[order], sizes[order])
    inverse, truth = inverse[place], truth[place]
    ends_of = np.cumsum(sizes[order])
    chains = np.unique(np.concatenate([[0], ends_of[19::20], [len(truth)]]))
    inner = np.ones(len(truth), bool)
    inner[chains[:-1]] = False
    seen = np.zeros((k, k))
    np.add.at(seen, (truth[np.flatnonzero(inner) - 1], truth[inner]), 1)
    # Chains are taken in groups, whose label pairs fit into memory for any number of languages.
    groups = [chains[lo : hi + 1] for lo, hi in row_blocks(chains, max(PAIRS // k**2, 1))]
    squares, squares_steps = np.full_like(weights, 1e-2), np.full_like(steps, 1e-2)
    for _ in range(rounds):
        by_word = _sum_runs(weights[rows_of], counts)
        miss, pairs = np.empty((len(truth), k)), np.zeros((k, k))
        for g in groups:
            marginal, p = forward_backward(by_word[inverse[g[0] : g[-1]]], g - g[0], steps, pairs=True)
            miss[g[0] : g[-1]] = -marginal
            pairs += p
        miss[np.arange(len(truth)), truth] += 1
        grad = np.zeros_like(weights)
        for j in range(k):
            word = np.bincount(inverse, weights=miss[:, j], minlength=len(one))
            grad[:, j] = np.bincount(rows_of, weights=word[owner], minlength=1 << BITS)
        grad -= 0.5 * weights
        squares += grad * grad
        weights += rate * grad / np.sqrt(squares)
        g = seen - pairs - 0.5 * steps
        squares_steps += g * g
        steps += rate * g / np.sqrt(squares_steps)
    return Model(languages, weights.astype(np.float32), steps)


def train(docs: DataFrame, text="text", label="lang", key="doc_id", per_language=150,
          fit_bytes=20_000, rounds=30) -> Model:
    """The model of the labelled rows. The sample has at most per_language * SHARED texts, or one of
    each language."""
    rows = sample(docs, text, label, key, per_language, fit_bytes).collect()
    return fit(sorted((r["text"], r["label"]) for r in rows), rounds)


# --- labelling -----------------------------------------------------------------------------


def word_scores(model: Model, data, starts, ends):
    """(scores of each distinct word, which of them each word is)."""
    hashes = word_hashes(data, starts, ends)
    _, one, inverse = np.unique(hashes, return_index=True, return_inverse=True)
    scores = np.empty((len(one), len(model.languages)), np.float32)
    for lo in range(0, len(one), WORDS):
        part = one[lo : lo + WORDS]
        rows, counts = features(data, starts[part], ends[part], hashes[part])
        scores[lo : lo + WORDS] = _sum_runs(model.weights[rows], counts)
    return scores, inverse


def _blocks(model: Model, column):
    """For each block of texts: (lo, hi, probabilities, letter words, first)."""
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets)
    scores, inverse = word_scores(model, data, starts, ends)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    k = len(model.languages)
    for lo, hi in row_blocks(first, BLOCK if k <= SHARED else max(1, BLOCK * SHARED**2 // k**2)):
        words = slice(first[lo], first[hi])
        f = first[lo : hi + 1] - first[lo]
        p = forward_backward(scores[inverse[words]], f, model.steps)[0]
        yield lo, hi, p, letters[ends[words]] > letters[starts[words]], f


def _has_letter(column, offsets, data) -> np.ndarray:
    """Whether each text has a letter of any script."""
    ascii_letter = np.zeros(256, bool)
    ascii_letter[65:91] = ascii_letter[97:123] = True
    seen = np.concatenate([[0], np.cumsum(ascii_letter[data], dtype=np.int64)])
    found = seen[offsets[1:]] > seen[offsets[:-1]]
    for i in np.flatnonzero(~found):
        found[i] = any(map(str.isalpha, column[int(i)].as_py() or ""))
    return found


def predict(docs: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None,
            label: str = "lang_pred", score: str = "lang_score") -> DataFrame:
    """The rows with `lang_pred` and `lang_score`, the mean probability of that language over the
    words with letters. `keep`: the columns returned besides (all if not given)."""
    keep = docs.columns if keep is None else keep
    read = docs.select(*keep, F.col(text).alias("__text")) if text not in keep else docs.select(*keep)
    column = text if text in keep else "__text"
    made = [F.lit("").alias(label), F.lit(0.0).alias(score)]
    schema = docs.select(*keep, *made).schema

    def label_batches(batches):
        for batch in (p for b in batches for p in parts(b, b.schema.get_field_index(column))):
            texts = batch.column(batch.schema.get_field_index(column))
            names, values = ["und"] * len(texts), np.zeros(len(texts))
            if model.languages:
                data, offsets = text_bytes(texts)
                lettered = _has_letter(texts, offsets, data)
                for lo, hi, p, mark, f in _blocks(model, texts):
                    shares = np.zeros((hi - lo, p.shape[1]))
                    p = p * mark[:, None]
                    full = np.flatnonzero(np.diff(f) > 0)
                    if len(full):
                        shares[full] = np.add.reduceat(p, f[:-1][full], axis=0)
                    for i, row in enumerate(shares):
                        if lettered[lo + i] and row.sum() > 0:
                            best = int(row.argmax())
                            names[lo + i] = model.languages[best]
                            values[lo + i] = min(1.0, row[best] / row.sum())
            columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(names, pa.string()), pa.array(values, pa.float64())],
                names=[*keep, label, score],
            )

    return read.mapInArrow(lean(label_batches), schema)


def label_words(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, languages): the most likely language of each word, in the order of the words."""
    schema = docs.select(key, F.array(F.lit("")).alias("languages")).schema

    def label_batches(batches):
        for batch in (p for b in batches for p in parts(b, 1)):
            rows = [[] for _ in range(batch.num_rows)]
            if model.languages:
                for lo, hi, p, _, f in _blocks(model, batch.column(1)):
                    best = p.argmax(axis=1)
                    for i in range(lo, hi):
                        rows[i] = [model.languages[j] for j in best[f[i - lo] : f[i - lo + 1]]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, pa.list_(pa.string()))], names=[key, "languages"]
            )

    return docs.select(key, text).mapInArrow(lean(label_batches), schema)

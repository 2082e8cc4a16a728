"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature of a text is cut into bins at quantiles. Boosting goes round the features again and
again; each step fits one shallow regression tree on one feature's bins to the current residuals and
adds a small part of it to that feature's look-up table, so that no feature can take what belongs to
another. Then the pairs of features whose coarse grid explains most of what is left are boosted
the same way with trees on two features. A score is an intercept plus look-ups: vectorised additions
of bins. The model can be read: it is a table per feature and per pair.

Fitting takes at most `rows` labelled texts, those with the smallest hash of their key; their
features are worked out by Spark and only these come to the driver. Scoring covers whole texts.

Cases: null text counts as empty, and has a score. Labels other than 0 and 1 and null labels are
left out; several labels of one key count as their mean, above one half as 1. No labels, or one
class only: every score is the smoothed share of label 1. Repeated rows are scored each; the least text
of a labelled key is learned from.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseloom.llm.words import parts, text_bytes, word_hashes, word_spans

ROWS = 20_000
BINS, COARSE, PAIRS = 64, 8, 8
ROUNDS, RATE = 200, 0.1

FEATURES = (
    "log words", "log bytes", "word length", "word length spread", "upper case", "lower case",
    "digits", "symbols", "sentence ends", "other marks", "beyond ascii", "line breaks",
    "capital first", "all capitals", "words of marks", "words ending in marks",
    "distinct words", "most frequent word", "same as word before", "distinct word pairs",
    "distinct lines", "log line length", "longest word", "short words",
)


# --- features ------------------------------------------------------------------------------


def _class_of(characters: str, *spans: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    for a, b in spans:
        out[a:b] = True
    return out


_UPPER, _LOWER = _class_of("", (65, 91)), _class_of("", (97, 123))
_DIGIT, _BEYOND = _class_of("", (48, 58)), _class_of("", (128, 256))
_SYMBOL = _class_of("#$%&*+<=>@\\^_`|~{}[]/")
_END, _MARK, _BREAK = _class_of(".!?"), _class_of(",;:'\"()-"), _class_of("\n")
_LETTER = _UPPER | _LOWER | _BEYOND


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64)])
    return total[bounds[1:]] - total[bounds[:-1]]


def _distinct(keys: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per owner: how many distinct keys, and how often the most frequent one occurs."""
    order = np.lexsort((keys, owner))
    k, o = keys[order], owner[order]
    if len(k) == 0:
        return np.zeros(n), np.zeros(n)
    new = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (o[1:] != o[:-1])]))
    times = np.diff(np.append(new, len(k)))
    most = np.zeros(n)
    np.maximum.at(most, o[new], times)
    return np.bincount(o[new], minlength=n).astype(float), most


def features(column) -> np.ndarray:
    """(texts, features) of whole texts; all finite, also for empty texts."""
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets)
    n = len(offsets) - 1
    size, words = np.diff(offsets).astype(float), np.diff(first).astype(float)
    owner = np.repeat(np.arange(n), np.diff(first))
    length = (ends - starts).astype(float)
    some, bytes_ = np.maximum(words, 1), np.maximum(size, 1)

    def share(table):
        return _sums(table[data], offsets) / bytes_

    def per_word(values):
        return _sums(values, first) / some

    h = word_hashes(data, starts, ends)
    same_text = np.zeros(len(h), bool)
    same_text[1:] = owner[1:] == owner[:-1]
    repeat, pair = np.zeros(len(h), bool), np.zeros(len(h), np.uint64)
    repeat[1:] = same_text[1:] & (h[1:] == h[:-1])
    pair[1:] = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]
    distinct, most = _distinct(h, owner, n)
    pairs, _ = _distinct(pair[same_text], owner[same_text], n)
    letters = np.concatenate([[0], np.cumsum(_LETTER[data])])
    uppers = np.concatenate([[0], np.cumsum(_UPPER[data])])
    n_letters, n_upper = letters[ends] - letters[starts], uppers[ends] - uppers[starts]
    mean = per_word(length)
    spread = np.sqrt(np.maximum(per_word(length**2) - mean**2, 0))
    longest = np.zeros(n)
    np.maximum.at(longest, owner, length)
    # Lines: cut at line feeds and at the beginnings of texts.
    cuts = np.unique(np.concatenate([np.flatnonzero(_BREAK[data]) + 1, offsets[:-1]]))
    cuts = cuts[cuts < len(data)]
    stops = np.append(cuts[1:], len(data)) if len(cuts) else cuts
    line_owner = np.searchsorted(offsets, cuts, "right") - 1
    lines = np.bincount(line_owner, minlength=n).astype(float)
    different, _ = _distinct(word_hashes(data, cuts, stops), line_owner, n)
    first_byte, last_byte = data[starts], data[np.maximum(ends - 1, 0)]
    return np.stack(
        [
            np.log1p(words), np.log1p(size), mean, spread, share(_UPPER), share(_LOWER),
            share(_DIGIT), share(_SYMBOL), share(_END), share(_MARK), share(_BEYOND), share(_BREAK),
            per_word(_UPPER[first_byte]), per_word((n_letters > 1) & (n_upper == n_letters)),
            per_word(n_letters == 0), per_word(~_LETTER[last_byte] & ~_DIGIT[last_byte]),
            distinct / some, most / some, per_word(repeat), pairs / np.maximum(words - 1, 1),
            different / np.maximum(lines, 1), np.log1p(size / np.maximum(lines, 1)),
            np.log1p(longest), per_word(length <= 3),
        ],
        axis=1,
    )


# --- the model ----------------------------------------------------------------------------------


@dataclass
class Additive:
    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)  # cuts between the bins of each feature
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # bin -> coarse bin
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        bins = self.bins(x)
        for table, b in zip(self.tables, bins):
            total += table[b]
        for (i, j), grid in zip(self.pairs, self.grids):
            total += grid[self.coarse[i][bins[i]], self.coarse[j][bins[j]]]
        return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def _leaf(g, h):
    return g / (h + 1.0)


def _split(g: np.ndarray, h: np.ndarray) -> tuple[int, float]:
    """The cut of ordered bins with the greatest gain: (first bin to the right, gain)."""
    if len(g) < 2:
        return 0, 0.0
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + 1) + gr**2 / (hr + 1) - g.sum() ** 2 / (h.sum() + 1)
    at = int(gain.argmax())
    return (at + 1, float(gain[at])) if gain[at] > 1e-9 else (0, 0.0)


def _tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """The values of a regression tree over ordered bins."""
    cut, _ = _split(g, h) if depth else (0, 0.0)
    if not cut:
        return np.full(len(g), _leaf(g.sum(), h.sum()))
    return np.concatenate([_tree(g[:cut], h[:cut], depth - 1), _tree(g[cut:], h[cut:], depth - 1)])


def _grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, float]:
    """A tree over two features: cut one, then the other within each side. (values, gain)."""
    best, most = np.full(g.shape, _leaf(g.sum(), h.sum())), 0.0
    whole = g.sum() ** 2 / (h.sum() + 1)
    for turned in (False, True):
        a, b = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(a)):
            out, gain = np.empty(a.shape), -whole
            for rows in (slice(0, cut), slice(cut, None)):
                gs, hs = a[rows].sum(axis=0), b[rows].sum(axis=0)
                at, _ = _split(gs, hs)
                for cols in ((slice(0, at), slice(at, None)) if at else (slice(None),)):
                    sg, sh = gs[cols].sum(), hs[cols].sum()
                    out[rows, cols] = _leaf(sg, sh)
                    gain += sg**2 / (sh + 1)
            if gain > most:
                best, most = (out.T if turned else out), gain
    return best, most


def fit(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, rate: float = RATE) -> Additive:
    share = (y.sum() + 1) / (len(y) + 2)
    model = Additive(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    p = x.shape[1]
    for j in range(p):
        cuts = np.unique(np.quantile(x[:, j], np.arange(1, BINS) / BINS))
        model.edges.append(cuts)
        model.tables.append(np.zeros(len(cuts) + 1))
        model.coarse.append(np.arange(len(cuts) + 1) * COARSE // (len(cuts) + 1))
    bins = model.bins(x)
    total = np.full(len(y), model.intercept)

    def residuals():
        q = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        return y - q, q * (1 - q)

    for _ in range(rounds):
        for j, b in enumerate(bins):
            r, w = residuals()
            size = len(model.tables[j])
            step = rate * _tree(np.bincount(b, r, size), np.bincount(b, w, size))
            model.tables[j] += step
            total += step[b]
    r, w = residuals()
    cells = [c[b] for c, b in zip(model.coarse, bins)]

    def grids(i, j):
        flat = cells[i] * COARSE + cells[j]
        return [np.bincount(flat, v, COARSE * COARSE).reshape(COARSE, COARSE) for v in residuals()]

    gains = sorted(
        ((_grid_tree(*grids(i, j))[1], i, j) for i in range(p) for j in range(i)), reverse=True
    )
    model.pairs = [(i, j) for _, i, j in gains[:PAIRS]]
    model.grids = [np.zeros((COARSE, COARSE)) for _ in model.pairs]
    for _ in range(rounds // 4):
        for grid, (i, j) in zip(model.grids, model.pairs):
            step = rate * _grid_tree(*grids(i, j))[0]
            grid += step
            total += step[cells[i], cells[j]]
    return model


# --- Spark ---------------------------------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text",
          label: str = "quality", rows: int = ROWS) -> Additive:
    """The model of the labelled rows: at most `rows` of them, by the hash of their key."""
    marked = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key).agg(
        F.avg(label).alias("share")
    )
    few = marked.orderBy(F.xxhash64(F.col(key).cast("string")), key).limit(rows).select(
        F.col(key).alias("__key"), (F.col("share") > 0.5).cast("double").alias("label")
    )
    texts = docs.select(F.col(key).alias("__key"), F.col(text).alias("text"))
    # Of a repeated key the least text, so that no more than `rows` come and always the same.
    fitted = texts.join(F.broadcast(few), "__key").groupBy("__key", "label").agg(F.min("text").alias("text"))

    def run(batches):
        for batch in (p for b in batches for p in parts(b, 2)):
            x = features(batch.column(2))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(x.tolist(), pa.list_(pa.float64()))],
                names=["__key", "label", "x"],
            )

    schema = fitted.select("__key", "label", F.array(F.lit(0.0)).alias("x")).schema
    found = sorted(
        (tuple(r) for r in fitted.mapInArrow(run, schema).collect()),
        key=lambda r: (r[0], r[2]),
    )
    if not found:
        return Additive()
    return fit(np.array([r[2] for r in found]), np.array([r[1] for r in found]))


def predict(docs: DataFrame, model: Additive, text: str = "text", keep: list[str] | None = None,
            score: str = "score", label: str = "predicted") -> DataFrame:
    """The rows (their columns `keep`) with `score` in 0 to 1 and `predicted`."""
    keep = docs.columns if keep is None else keep
    schema = docs.select(*keep, F.lit(0.0).alias(score), F.lit(0).alias(label)).schema
    column = "__text"

    def run(batches):
        for batch in (p for b in batches for p in parts(b, b.schema.get_field_index(column))):
            p = model.score(features(batch.column(batch.schema.get_field_index(column))))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in keep), pa.array(p),
                 pa.array((p >= 0.5).astype(np.int32))],
                names=schema.names,
            )

    return docs.select(*keep, F.col(text).alias(column)).mapInArrow(run, schema)

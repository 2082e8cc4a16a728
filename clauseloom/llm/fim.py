"""Fill-in-the-middle transformation by a sparse index of exceptions.

A text is UTF-8 bytes. For a batch of texts the index holds only the multibyte characters: the place
of each (as a byte and as a code point) and the sum of the bytes by which it and those before exceed
one a character. A cut given in code points becomes a byte place by one `searchsorted` in the code
points of the exceptions, and a byte place becomes a cut by one in their bytes. ASCII spans are plain
arithmetic; a batch of ASCII texts has an empty index.

`transform` draws the form and the cuts from a hash of the key, so a rerun gives the same output.
`restore` finds the marks in an output, rebuilds the text and, by the index, the cuts.

Cases: a null text counts as empty; an empty text, and one that holds a mark itself, stay plain. Both
cuts may fall on one place or on the ends of the text, which leaves parts empty. Repeated rows get
equal results. A null key counts as an empty key. Texts are taken whole, and parts of a batch of some
3 MB of text, one text at least, are held at a time. Further columns are kept; one with the name of
an output is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseloom.llm.words import parts, text_bytes

MARKS = ("<P>", "<S>", "<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"


class Exceptions:
    """Where code points and bytes part in a batch of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)  # first bytes of multibyte characters
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.over = np.concatenate([[0], np.cumsum(excess)])
        self.points = self.at - self.over[:-1]  # their places in code points
        self.offsets = offsets
        self.first = offsets - self.over[np.searchsorted(self.at, offsets)]

    def sizes(self) -> np.ndarray:
        """Code points of each text."""
        return np.diff(self.first)

    def to_bytes(self, rows: np.ndarray, cut: np.ndarray) -> np.ndarray:
        """Places in the bytes of the batch of cuts in code points of the given texts."""
        place = self.first[rows] + cut
        return place + self.over[np.searchsorted(self.points, place)]

    def to_points(self, rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Cuts in code points of places in the bytes of the batch."""
        return place - self.over[np.searchsorted(self.at, place)] - self.first[rows]


def draws(key: str, seed: int):
    """Four unsigned 32-bit numbers from the key, as columns."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def transform(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = 90,
              spm_percent: int = 20, seed: int = 1, marks: tuple[str, str, str] = MARKS,
              output: str = "output") -> DataFrame:
    """The rows with n (code points), form, prefix_chars, middle_chars and the output text."""
    new = ["n", "form", "prefix_chars", "middle_chars", output]
    keep = [c for c in docs.columns if c not in new]
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    own = F.lit(False)
    for mark in marks:
        own = own | F.contains(value, F.lit(mark))
    drawn = draws(key, seed)
    form = (
        F.when((value == "") | own | (drawn[2] % 100 >= percent), PLAIN)
        .when(drawn[3] % 100 < spm_percent, SPM).otherwise(PSM)
    )
    marked = docs.select(
        *keep, value.alias("__text"), form.alias("__form"), drawn[0].alias("__h1"), drawn[1].alias("__h2")
    )
    empty = F.lit(None).cast("long")
    schema = docs.select(
        *keep, F.lit(0).cast("long").alias("n"), F.lit("").alias("form"),
        empty.alias("prefix_chars"), empty.alias("middle_chars"), F.lit("").alias(output),
    ).schema
    p, s, m = (mark.encode() for mark in marks)
    width = len(keep)

    def run(batches):
        for batch in batches:
            for part in parts(batch, width):
                data, offsets = text_bytes(part.column(width))
                index = Exceptions(data, offsets)
                n = index.sizes()
                h1, h2 = (part.column(width + i).to_numpy() % (n + 1) for i in (2, 3))
                low, high = np.minimum(h1, h2), np.maximum(h1, h2)
                rows = np.arange(len(n))
                one, two = index.to_bytes(rows, low), index.to_bytes(rows, high)
                raw, forms, out = data.tobytes(), part.column(width + 1).to_pylist(), []
                for kind, a, b, c, d in zip(forms, offsets.tolist(), one.tolist(), two.tolist(), offsets[1:].tolist()):
                    if kind == PLAIN:
                        out.append(raw[a:d])
                    elif kind == PSM:
                        out.append(b"".join((p, raw[a:b], s, raw[c:d], m, raw[b:c])))
                    else:
                        out.append(b"".join((s, raw[c:d], p, raw[a:b], m, raw[b:c])))
                plain = np.array([kind == PLAIN for kind in forms], bool)
                yield pa.RecordBatch.from_arrays([
                    *part.columns[:width], pa.array(n), part.column(width + 1),
                    pa.array(low, mask=plain), pa.array(high - low, mask=plain), _strings(out),
                ], names=schema.names)

    return marked.mapInArrow(run, schema)


def restore(frame: DataFrame, output: str = "output", form: str = "form",
            marks: tuple[str, str, str] = MARKS, name: str = "restored",
            cuts: tuple[str, str] | None = None) -> DataFrame:
    """The rows with the text rebuilt from output and form alone; on wish the cuts, too, as (code
    points of the prefix, of the middle). A null output or form, and an output without its marks in
    their order, restores to null."""
    new = [name, *(cuts or ())]
    keep = [c for c in frame.columns if c not in new]
    given = frame.select(*keep, F.col(output).alias("__output"), F.col(form).alias("__form"))
    schema = frame.select(
        *keep, F.lit(None).cast("string").alias(name),
        *[F.lit(None).cast("long").alias(c) for c in cuts or ()],
    ).schema
    p, s, m = (mark.encode() for mark in marks)
    width = len(keep)

    def parted(raw: bytes, kind: str):
        """(prefix, middle, suffix) of an output that is not plain; None if a mark is missing."""
        first, second = (p, s) if kind == PSM else (s, p)
        if not raw.startswith(first):
            return None
        one, found, rest = raw[len(first):].partition(second)
        two, last, middle = rest.partition(m)
        if not found or not last:
            return None
        return (one, middle, two) if kind == PSM else (two, middle, one)

    def run(batches):
        for batch in batches:
            for part in parts(batch, width):
                out, places = [], []
                for text, kind in zip(part.column(width).to_pylist(), part.column(width + 1).to_pylist()):
                    found = place = None
                    if text is not None and kind == PLAIN:
                        found = text.encode()
                    elif text is not None and kind in (PSM, SPM) and (got := parted(text.encode(), kind)):
                        found, place = b"".join(got), (len(got[0]), len(got[0]) + len(got[1]))
                    out.append(found)
                    places.append(place)
                texts = _strings(out)
                columns = [*part.columns[:width], texts]
                if cuts:
                    data, offsets = text_bytes(texts)
                    index = Exceptions(data, offsets)
                    plain = np.array([x is None for x in places], bool)
                    rows = np.arange(len(places))
                    one, two = (
                        index.to_points(rows, offsets[:-1] + np.array([x[i] if x else 0 for x in places], np.int64))
                        for i in (0, 1)
                    )
                    columns += [pa.array(one, mask=plain), pa.array(two - one, mask=plain)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return given.mapInArrow(run, schema)

"""SentencePiece encoding and decoding: an Aho-Corasick automaton drives a one-pass Viterbi.

The automaton holds all pieces. It runs over a text once; at each position it reports, by its output
links, every piece that ends there, and each relaxes the best score of that position. The path of
the greatest sum of piece scores is the encoding; of equal sums the one whose last piece is longer
wins, position by position. A character that is no piece is written as its byte pieces (or as the
unknown piece if the model has none), at the lowest piece score less 10.

As the model says, text is not normalised, a space becomes U+2581 and one is put in front. If no
piece has U+2581 after another character, no piece crosses the beginning of a word, so words are
encoded one by one and distinct ones once; otherwise whole texts are.

The model file is read where the job is started; its pieces and scores travel with the task.
Scores are used as they are stored, also those of a BPE model, whose scores are ranks of merges: the
result is the best path under them, which is not the order of merges that BPE itself follows.

Cases: null or empty text has no pieces. A text with U+2581 in it decodes to a space there, as in
SentencePiece. Control pieces are never produced and decode to nothing. Repeated rows and further
columns are kept by `with_ids`.
"""

from __future__ import annotations

import math
import re
from array import array
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clauseloom.llm.shared import lean
from clauseloom.llm.words import parts, ranges

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
KEPT_WORDS = 50_000  # distinct words remembered by a task
PART = 1 << 18  # bytes of text encoded at a time: a word of it takes some 100 bytes meanwhile
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@dataclass
class Pieces:
    """What the operator needs of a model: plain lists, cheap to send."""

    texts: list[str]
    scores: list[float]
    kinds: list[str]  # normal, byte, unknown, control
    prefix: bool = True
    by_words: bool = field(init=False)

    def __post_init__(self):
        self.by_words = not any(
            MARK in t.lstrip(MARK) for t, k in zip(self.texts, self.kinds) if k == "normal"
        )


def load(path: str = MODEL) -> Pieces:
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    kinds = [
        "byte" if model.is_byte(i) else "unknown" if model.is_unknown(i)
        else "control" if model.is_control(i) or model.is_unused(i) else "normal"
        for i in range(n)
    ]
    return Pieces(
        [model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], kinds
    )


class Encoder:
    """Encodes words with a memory of those seen."""

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        normal = [i for i, k in enumerate(pieces.kinds) if k == "normal"]
        for i in normal:
            self.automaton.add_word(pieces.texts[i], (len(pieces.texts[i]), pieces.scores[i], i))
        if normal:
            self.automaton.make_automaton()
        self.single = {pieces.texts[i] for i in normal if len(pieces.texts[i]) == 1}
        self.lowest = min((pieces.scores[i] for i in normal), default=0.0) - 10
        self.bytes = {
            int(pieces.texts[i][3:5], 16): i for i, k in enumerate(pieces.kinds) if k == "byte"
        }
        self.unknown = next((i for i, k in enumerate(pieces.kinds) if k == "unknown"), 0)
        self.forget()

    def forget(self):
        self.place: dict[str, int] = {}
        self.ids, self.start, self.length = array("i"), array("q"), array("i")
        self.sums = array("d")

    def best_path(self, word: str) -> tuple[list[int], float]:
        n = len(word)
        best = [0.0] + [-math.inf] * n
        came = [(1, None)] * (n + 1)  # (length, id) of the last piece; id None: no piece
        if self.single.issuperset(word):
            for last, (length, score, piece) in self.automaton.iter(word):
                total = best[last + 1 - length] + score
                if total > best[last + 1]:
                    best[last + 1], came[last + 1] = total, (length, piece)
        else:
            self._relax_with_unknown(word, best, came)
        out, at = [], n
        while at:
            length, piece = came[at]
            if piece is None:
                raw = word[at - 1].encode("utf-8", "surrogatepass")
                known = all(b in self.bytes for b in raw)
                out.extend([self.bytes[b] for b in reversed(raw)] if known else [self.unknown])
            else:
                out.append(piece)
            at -= length
        out.reverse()
        return out, best[n]

    def _relax_with_unknown(self, word, best, came):
        """The same where some characters are no pieces: they cost `lowest` at their place."""
        ending: list[list] = [[] for _ in range(len(word) + 1)]
        if self.single:
            for last, found in self.automaton.iter(word):
                ending[last + 1].append(found)
        for end, c in enumerate(word, 1):
            for length, score, piece in ending[end]:
                total = best[end - length] + score
                if total > best[end]:
                    best[end], came[end] = total, (length, piece)
            if c not in self.single and best[end - 1] + self.lowest > best[end]:
                best[end], came[end] = best[end - 1] + self.lowest, (1, None)

    def words_of(self, text: str) -> list[str]:
        if not text:
            return []
        marked = text.replace(" ", MARK)
        if self.pieces.prefix:
            marked = MARK + marked
        return WORD.findall(marked) if self.pieces.by_words else [marked]

    def encode(self, texts: list[str | None]):
        """(ids, first, sums): pieces of text i are ids[first[i]:first[i + 1]]."""
        if len(self.place) > KEPT_WORDS:
            self.forget()
        numbers, counts = [], []
        for text in texts:
            words = self.words_of(text)
            for w in words:
                if w not in self.place:
                    ids, total = self.best_path(w)
                    self.place[w] = len(self.start)
                    self.start.append(len(self.ids))
                    self.length.append(len(ids))
                    self.sums.append(total)
                    self.ids.extend(ids)
            numbers.extend([self.place[w] for w in words])
            counts.append(len(words))
        at = np.array(numbers, np.int64)
        length = np.array(self.length, np.int64)[at]
        ids = np.array(self.ids, np.int32)[ranges(np.array(self.start, np.int64)[at], length)]
        bound = np.concatenate([[0], np.cumsum(counts)])
        first = np.concatenate([[0], np.cumsum(length)])[bound]
        sums = np.concatenate([[0.0], np.cumsum(np.array(self.sums)[at])])
        return ids, first, sums[bound[1:]] - sums[bound[:-1]]


class Decoder:
    """Bytes of the pieces in one array."""

    def __init__(self, pieces: Pieces):
        raw = []
        for text, kind in zip(pieces.texts, pieces.kinds):
            if kind == "byte":
                raw.append(bytes([int(text[3:5], 16)]))
            elif kind == "control":
                raw.append(b"")
            else:
                raw.append((text if kind == "normal" else " ⁇ ").replace(MARK, " ").encode())
        self.length = np.array([len(r) for r in raw], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.prefix = pieces.prefix

    def decode(self, ids: np.ndarray, first: np.ndarray) -> list[bytes]:
        length = self.length[ids]
        data = self.raw[ranges(self.start[ids], length)].tobytes()
        bound = np.concatenate([[0], np.cumsum(length)])[first]
        out = [data[a:b] for a, b in zip(bound[:-1], bound[1:])]
        return [x[1:] if self.prefix and x[:1] == b" " else x for x in out]


_LAST_ENCODER: list[Encoder] = []


def encoder_of(pieces: Pieces) -> Encoder:
    """The encoder of this process, which remembers no words yet: the next tasks with the same pieces
    have its automaton, too."""
    if not _LAST_ENCODER or _LAST_ENCODER[0].pieces != pieces:
        _LAST_ENCODER[:] = [Encoder(pieces)]
    _LAST_ENCODER[0].forget()
    return _LAST_ENCODER[0]


def _lists(ids, first, valid=None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(ids, pa.int32()))


def with_ids(docs: DataFrame, pieces: Pieces, text: str = "text", name: str = "ids",
             score: str | None = None, trip: str | None = None, drop_text: bool = False) -> DataFrame:
    """The rows with `name` (array<int>); on wish `score` (sum of piece scores) and `trip`
    (whether decoding gives the text back)."""
    keep = [c for c in docs.columns if not (drop_text and c == text)]
    schema = docs.select(
        *keep, F.array(F.lit(0)).alias(name),
        *([F.lit(0.0).alias(score)] if score else []), *([F.lit(True).alias(trip)] if trip else []),
    ).schema

    def run(batches):
        encoder, decoder = encoder_of(pieces), Decoder(pieces) if trip else None
        for batch in batches:
            place = batch.schema.get_field_index(text)
            for part in parts(batch, place, PART):
                texts = part.column(place).to_pylist()
                ids, first, sums = encoder.encode(texts)
                columns = [part.column(part.schema.get_field_index(c)) for c in keep]
                columns.append(_lists(ids, first))
                if score:
                    columns.append(pa.array(sums))
                if trip:
                    back = decoder.decode(ids, first)
                    columns.append(pa.array(
                        [b == (t or "").encode("utf-8", "surrogatepass") for b, t in zip(back, texts)]
                    ))
                yield pa.RecordBatch.from_arrays(columns, schema=None, names=schema.names)
        encoder.forget()

    return docs.mapInArrow(lean(run), schema)


def decoded(frame: DataFrame, pieces: Pieces, ids: str = "ids", name: str = "text") -> DataFrame:
    """The rows with the text of their pieces; bytes that are no UTF-8 become U+FFFD."""
    rest = [c for c in frame.columns if c != name]
    schema = frame.select(*rest, F.lit("").alias(name)).schema

    def run(batches):
        decoder = Decoder(pieces)
        for batch in batches:
            rows = [r or [] for r in batch.column(batch.schema.get_field_index(ids)).to_pylist()]
            first = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)
            flat = np.array([i for r in rows for i in r], np.int64)
            texts = [b.decode("utf-8", "replace") for b in decoder.decode(flat, first)]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(texts, pa.string())], names=schema.names
            )

    return frame.mapInArrow(lean(run), schema)

"""Packing by power-of-two decomposition: no sequence crosses documents, none is padded.

A document of L tokens is cut into L // LENGTH whole sequences and, for its rest, one piece per binary
digit, longest first: 2,600 tokens give 2,048 + 512 + 32 + 8. Every piece is a sequence by itself.
Sequences of one length make a bucket; they are numbered bucket by bucket, longest first, without
gaps, so that `batches` can take batches of one length and an equal number of tokens.

Numbering needs no sort of all pieces. A task counts the pieces of each length as it cuts them; the
counts of all (task, length) are added up in two levels, by groups of tasks and within them, and
each piece adds the sum to its own count. A repeated or null key changes nothing in that.

Tokenising: the tokenizer's file is read where the job is started and travels with the task. Its
words hold no white space and are letters, a digit, or neither, so a text is encoded in runs between
such borders, and a worker remembers the ids of the runs it has seen, from task to task; beyond MEMORY bytes it
starts anew.

Cases: a null or empty text is the end token alone, one piece of one token. Texts of any length are
cut whole. Repeated rows are packed each by itself; a null key stays null. An empty table gives no
rows. Columns of the input other than the key and the text are left out, so no name can clash.
"""

from __future__ import annotations

import json
import os
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clauseloom.llm.shared import written
from clauseloom.llm.words import parts, ranges, text_bytes, word_hashes

LENGTH = 2048
END = 1
MEMORY = 64 << 20  # bytes of runs and ids remembered by a task
GROUP = 4096  # tasks whose counts are added up together
LAST = r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"  # kinds of words: letters, a digit, neither
LATIN = "\u0250"  # below it no character is changed by composition
OTHER, SPACE, LETTER, POINT = range(4)
KIND = np.zeros(256, np.uint8)
KIND[[0x20, *range(0x09, 0x0E)]], KIND[97:123], KIND[list(b".,;:!?")] = SPACE, LETTER, POINT
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] = LOWER[97:123]
SMALL = 1_000_000  # rows of a table of counts that is broadcast


class Memory:
    """Ids of runs between white space, each encoded once by the tokenizer."""

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to other tasks
        from tokenizers import Tokenizer

        parts_ = json.loads(model)
        self.whole = Tokenizer.from_str(model)
        # The normalizer leaves Latin letters in lower case as they are, and what is a-z alone is one word.
        self.latin = Tokenizer.from_str(json.dumps(parts_ | {"normalizer": None}))
        split = {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.letters = Tokenizer.from_str(json.dumps(parts_ | split))
        suffix, vocabulary = parts_["model"]["end_of_word_suffix"], parts_["model"]["vocab"]
        self.last = np.zeros(1 + max([*vocabulary.values(), *(t["id"] for t in parts_["added_tokens"])]), bool)
        self.last[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.forget()

    def forget(self):
        self.place: dict[bytes, int] = {}
        self.ids, self.bound, self.bytes = np.zeros(0, np.uint32), np.zeros(1, np.int64), 0

    def learn(self, new: list[bytes]):
        kinds: tuple[list, list, list] = [], [], []
        for run in new:
            if run.isalpha() and run.islower():  # bytes: a-z alone
                kinds[0].append(run)
            else:
                text = run.decode()
                kinds[1 if max(text) < LATIN and text.lower() == text else 2].append(run)
        self._remember(kinds[0], *self._letters(kinds[0]))
        for runs, tokenizer in zip(kinds[1:], (self.latin, self.whole)):
            found = tokenizer.encode_batch_fast([r.decode() for r in runs], add_special_tokens=False)
            lists = [one.ids for one in found]
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            self._remember(runs, np.fromiter(chain.from_iterable(lists), np.uint32, size.sum()), size)

    def _letters(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and numbers of ids of words a-z, encoded some at a time: a last id tells itself."""
        texts = [b" ".join(runs[i:i + 50]).decode() for i in range(0, len(runs), 50)]
        found = self.letters.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(one.ids for one in found), np.uint32)
        return ids, np.diff(np.flatnonzero(self.last[ids]), prepend=-1)

    def _remember(self, runs: list[bytes], ids: np.ndarray, size: np.ndarray):
        if len(runs) != len(size) or len(ids) != size.sum():
            raise ValueError("a word of this tokenizer has not one last token")
        self.place.update(zip(runs, range(len(self.bound) - 1, len(self.bound) - 1 + len(runs))))
        self.bound = np.concatenate([self.bound, self.bound[-1] + np.cumsum(size)])
        self.ids = np.concatenate([self.ids, ids])
        self.bytes += 150 * len(runs) + sum(map(len, runs)) + 4 * len(ids)

    def encode(self, column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first): ids of text i, with the end token, are ids[first[i]:first[i + 1]]."""
        if self.bytes > MEMORY:
            self.forget()
        data, offsets = text_bytes(column)
        if b"<|" not in data.tobytes():  # no special token: A-Z may count as a-z
            data = LOWER[data]
        starts, stops, first_run = runs_of(data, offsets)
        # Equal runs of this part are found by sorting hashes and compared as bytes; then each is looked up once.
        _, at, same = np.unique(word_hashes(data, starts, stops, fold=False), return_index=True, return_inverse=True)
        if not equal_spans(data, starts, stops - starts, at[same]):
            at = same = np.arange(len(starts))
        raw = data.tobytes()
        runs = [raw[a:b] for a, b in zip(starts[at].tolist(), stops[at].tolist())]
        numbers = list(map(self.place.get, runs))
        if None in numbers:
            self.learn(list({r for r, n in zip(runs, numbers) if n is None}))
            numbers = list(map(self.place.get, runs))
        numbers = np.array(numbers, np.int64)[same]
        length = self.bound[numbers + 1] - self.bound[numbers]
        ids = self.ids[ranges(self.bound[numbers], length)]
        first = np.concatenate([[0], np.cumsum(length)])[first_run]
        ids = np.insert(ids, first[1:], np.uint32(end))  # one end token behind each row
        return ids, first + np.arange(len(first))


_LAST_MEMORY: dict[str, Memory] = {}


def memory_of(model: str) -> Memory:
    """The memory of this process: what one task has learned serves the next ones with the same tokenizer."""
    if model not in _LAST_MEMORY:
        _LAST_MEMORY.clear()
        _LAST_MEMORY[model] = Memory(model)
    return _LAST_MEMORY[model]


def runs_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first): byte spans of the runs between ASCII white space, cut also where a letter
    a-z meets a stop; runs of row i are first[i]:first[i + 1]."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    kind = KIND[data]
    border = np.ones(n + 1, bool)  # whether something ends before this byte
    border[1:-1] = (kind[1:] == SPACE) | (kind[:-1] == SPACE) | ((kind[1:] == POINT) & (kind[:-1] == LETTER))
    border[offsets] = True
    at = np.flatnonzero(border)
    held = kind[at[:-1]] != SPACE
    starts, ends = at[:-1][held], at[1:][held]
    return starts, ends, np.searchsorted(starts, offsets)


def equal_spans(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, other: np.ndarray) -> bool:
    """Whether each span equals, as bytes, the span numbered `other`."""
    if not np.array_equal(lengths, lengths[other]):
        return False
    twin = np.flatnonzero(other != np.arange(len(other)))
    for at in range(0, len(twin), 1 << 16):
        some = twin[at:at + (1 << 16)]
        if not np.array_equal(data[ranges(starts[some], lengths[some])],
                              data[ranges(starts[other[some]], lengths[some])]):
            return False
    return True


def cuts(lengths: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, length) of all pieces, by row and start; `most` is a power of two."""
    whole = lengths // most
    rows = [np.repeat(np.arange(len(lengths)), whole)]
    starts = [ranges(np.zeros(len(lengths), np.int64), whole) * most]
    sizes = [np.full(int(whole.sum()), most, np.int64)]
    for bit in reversed(range(most.bit_length() - 1)):
        has = np.flatnonzero(lengths >> bit & 1)
        rows.append(has)
        starts.append(lengths[has] >> (bit + 1) << (bit + 1))
        sizes.append(np.full(len(has), 1 << bit, np.int64))
    row, start, size = np.concatenate(rows), np.concatenate(starts), np.concatenate(sizes)
    order = np.lexsort((start, row))
    return row[order], start[order], size[order]


def read_tokenizer(path: str) -> str:
    """The tokenizer's file as text; an error if its tokens could reach over white space or from a
    letter to a stop, or tell A-Z from a-z."""
    with open(path, encoding="utf-8") as file:
        model = file.read()
    parts_ = json.loads(model)
    steps = [one["type"] for one in (parts_["normalizer"] or {}).get("normalizers", [])]
    cut = ((parts_["pre_tokenizer"] or {}).get("pretokenizers") or [{}])[0]
    known = cut.get("pattern", {}).get("Regex", "").endswith(LAST) and parts_["model"].get("end_of_word_suffix")
    if steps != ["NFC", "Replace", "Lowercase"] or not known:
        raise ValueError("this tokenizer does not encode words apart")
    return model


def pieces(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id",
           length: int = LENGTH, end: int = END, with_ids: bool = True,
           digest: str | None = None) -> DataFrame:
    """The pieces of every document: key, start, length, doc_tokens, task, place (how many pieces of
    that length the task cut before); `ids` (array<int>) and `digest` (CRC-32 of the ids as unsigned
    32-bit little-endian numbers) on wish."""
    if length < 1 or length & (length - 1):
        raise ValueError("the length of a sequence is a power of two")
    docs = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = docs.select(
        "key", *[F.lit(0).cast("long").alias(c) for c in ("start", "length", "doc_tokens", "task", "place")],
        *([F.array(F.lit(0)).alias("ids")] if with_ids else []),
        *([F.lit(0).cast("long").alias(digest)] if digest else []),
    ).schema

    def run(batches):
        memory, task = memory_of(model), TaskContext.get().partitionId()
        counts = np.zeros(length.bit_length(), np.int64)
        for batch in batches:
            for part in parts(batch, 1):
                ids, first = memory.encode(part.column(1), end)
                tokens = np.diff(first)
                row, start, size = cuts(tokens, length)
                bucket = np.log2(size).astype(np.int64)
                place = np.empty(len(row), np.int64)
                for b in np.unique(bucket):
                    of = np.flatnonzero(bucket == b)
                    place[of] = counts[b] + np.arange(len(of))
                    counts[b] += len(of)
                columns = [
                    part.column(0).take(pa.array(row)), pa.array(start), pa.array(size),
                    pa.array(tokens[row]), pa.array(np.full(len(row), task, np.int64)), pa.array(place),
                ]
                if with_ids:  # pieces follow each other as the ids do
                    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32))))
                if digest:
                    raw, at = ids.astype("<u4").tobytes(), 4 * (first[row] + start)
                    columns.append(pa.array(
                        [zlib.crc32(raw[a:b]) for a, b in zip(at.tolist(), (at + 4 * size).tolist())], pa.int64()
                    ))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def _bases(cut: DataFrame) -> DataFrame:
    """(task, length, base): the number of the first piece of each length in each task."""
    counts = cut.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "tasks", F.floor(F.col("task") / GROUP)
    )
    groups = counts.groupBy("length", "tasks").agg(F.sum("n").alias("n"))
    before = Window.orderBy(F.desc("length"), "tasks").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.select("length", "tasks", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("above"))
    within = Window.partitionBy("length", "tasks").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(within), F.lit(0)))
    return counts.join(groups, ["length", "tasks"]).select(
        "task", "length", (F.col("above") + F.col("base")).alias("base")
    )


def pack(docs: DataFrame, model: str, text: str = "text", key: str = "doc_id", length: int = LENGTH,
         end: int = END, with_ids: bool = True, digest: str | None = None) -> DataFrame:
    """All pieces as sequences: key, start, length, doc_tokens, sequence_id, offset, bucket (the
    binary logarithm of the length), and `ids` and `digest` as for `pieces`.

    The pieces are a table in the shared folder, so their numbers stay as they are whatever is lost.
    """
    cut = written(pieces(docs, model, text, key, length, end, with_ids, digest), "pieces")
    bases = written(_bases(cut), "piece-bases")
    few = bases.count() <= SMALL  # (tasks x lengths) rows: it grows with the table, so it is counted
    numbered = cut.join(F.broadcast(bases) if few else bases, ["task", "length"])
    return numbered.select(
        F.col("key").alias(key), "start", "length", "doc_tokens",
        (F.col("base") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"),
        *(["ids"] if with_ids else []), *([digest] if digest else []),
    )


def batches(packed: DataFrame, tokens: int = 1 << 16) -> DataFrame:
    """The sequences with `batch`, unique with the bucket: sequences of one length that follow each
    other, tokens // length of them (one at least). Only the last batch of a bucket can be smaller."""
    least = packed.groupBy("bucket").agg(F.min("sequence_id").alias("_least"))  # a row per length
    held = F.greatest(F.lit(1), F.floor(F.lit(tokens) / F.col("length")))
    return packed.join(F.broadcast(least), "bucket").withColumn(
        "batch", F.floor((F.col("sequence_id") - F.col("_least")) / held)
    ).drop("_least")

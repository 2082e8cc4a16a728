"""Jaccard join of shingle sets by parity sketches.

A text's set is its distinct runs of `size` words (A-Z as a-z); a shorter text is one run; a text
without words is empty and linked with nothing. Two texts link when
100 * |A and B| >= percent * |A or B|.

Every shingle hashes to one bit of a very wide sketch and flips it, so the Hamming distance of two
sketches is at most the symmetric difference of the sets. In a band of sizes, linked sets differ in
at most D shingles. The sketch of a band is cut into more than D segments, of which at least one
must be the same in both (pigeonhole). The bits of a segment are nearly all zero and are kept as one
XOR of the codes of the bits that are set. An empty segment tells nothing and is left out: a set
with more than D segments that are not empty has one of these in common with each partner. A set
with fewer also emits its empty ones, which then meet those of other such sets.

Steps: (1) a key for each text's set; equal sets are one node. (2) Segment codes, once per node and
task, are dealt to buckets in packed arrays and sorted there; equal codes are runs. (3) A node that
emits e codes has at most D that a given partner does not share, so of all its codes, rarest first,
one of the first D + 1 is shared with each partner, and the rarest shared one is among the first D + 1
of both. All others are left out: most nodes have D + 1 codes that nobody shares and are done,
and codes of boilerplate come last. (4) Each run of what is left gives pairs of one node and each other:
as many as nodes. They are checked, by the Hamming bound of a dense sketch first, then by the sets.
(5) In runs
whose nodes are still in several components, nodes of different components are all compared, by size and sketch within the
task; only pairs that may link leave it. At first a task hands on a forest of them, the nearest first, which is
checked and joins components; then all pairs that are left are looked at, so no link between components is
lost. Large runs are cut by size and into blocks, and pairs of blocks are dealt to many tasks. (6) Components.

Keys and shingles are 64-bit hashes. Cases: null text is empty; null and repeated doc_ids get a row
each; the component is named by its smallest doc_id. An empty table gives no rows. Other columns are
not read.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clauseloom.llm.components import components
from clauseloom.llm.shared import lean, shuffle_partitions, written
from clauseloom.llm.words import mix, parts, ranges, row_blocks, text_bytes, word_hashes, word_spans

BLOCK = 300_000  # words worked on at a time
PER_BUCKET = 1_000_000  # segment codes in a bucket, on average
PER_GROUP = 20_000  # rows of runs compared in one group, on average
PER_BLOCK = 2_000  # nodes of a run in a block, on average
FORESTS = 1  # turns of checks of a forest of the pairs across components, before all that are left
STARS = 1  # turns of checks against one node of each run, before all pairs across components
FILTER_BITS = 1 << 23  # of the filter that tells which texts are needed again

_STEP = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


# --- sets ----------------------------------------------------------------------------------


def shingle_sets(column, size: int):
    """For blocks of texts: (lo, hi, values, first): the sorted distinct shingles of each text."""
    data, offsets = text_bytes(column)
    starts, ends, first = word_spans(data, offsets)
    for lo, hi in row_blocks(first, BLOCK):
        w0, w1 = first[lo], first[hi]
        h = word_hashes(data, starts[w0:w1], ends[w0:w1])
        words = np.diff(first[lo : hi + 1])
        number = np.where(words >= size, words - size + 1, (words > 0).astype(words.dtype))
        at = ranges(first[lo:hi] - w0, number)
        span = np.repeat(np.minimum(words, size), number)
        values = span.astype(np.uint64)
        for j in range(size):
            inside = span > j
            part = h[np.minimum(at + j, len(h) - 1)] * _STEP[j] if len(h) else values
            values[inside] += part[inside]
        mix(values)
        bound = np.concatenate([[0], np.cumsum(number)])
        for a, b in zip(bound[:-1], bound[1:]):
            if b - a > 1:
                values[a:b].sort()
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        new[bound[:-1][number > 0]] = True
        kept = np.concatenate([[0], np.cumsum(new)])
        yield lo, hi, values[new], kept[bound]


def set_keys(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set; 0 for an empty one."""
    keys = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        sums = np.add.reduceat(mix(values * _STEP[60]), first[:-1][full])
        keys[full] = mix(sums + np.diff(first)[full].astype(np.uint64) * _STEP[61]) | np.uint64(1)
    return keys


def nodes(docs: DataFrame, key: str, text: str, size: int) -> DataFrame:
    """(doc_id, key, n, sketch): the set of every text, as a key, its size and a dense sketch."""
    schema = docs.select(F.col(key).alias("doc_id"), F.lit(0).cast("long").alias("key"),
                         F.lit(0).cast("long").alias("n"),
                         F.lit("").cast("binary").alias("sketch")).schema

    def run(batches):
        for batch in (p for b in batches for p in parts(b, 1)):
            keys, ns = np.zeros(batch.num_rows, np.uint64), np.zeros(batch.num_rows, np.int64)
            sketches = []
            for lo, hi, values, first in shingle_sets(batch.column(1), size):
                keys[lo:hi], ns[lo:hi] = set_keys(values, first), np.diff(first)
                sketches += [dense(values[a:b]) for a, b in zip(first[:-1], first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(keys.view(np.int64)), pa.array(ns),
                 pa.array(sketches, pa.binary())],
                names=["doc_id", "key", "n", "sketch"],
            )

    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(lean(run), schema)


# --- bands and segments ----------------------------------------------------------------------


def bounds(percent: int) -> np.ndarray:
    """Where the bands of set sizes begin. Partners are in one band or in neighbouring ones."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out, dtype=np.int64)


def most_apart(band: np.ndarray, edges: np.ndarray, percent: int) -> np.ndarray:
    """D: how many shingles two linked sets differ in at most, the larger being in this band."""
    return 2 * (edges[band + 1] - 1) * (100 - percent) // (100 + percent)


def segment_codes(values, first, edges, percent: int):
    """(node, turn, code) of the segments that nodes emit; turn 0: their own band, 1: the next.
    Also (nodes, 2): how many of these each may leave out, the most frequent ones."""
    n = np.diff(first)
    owner = np.repeat(np.arange(len(n)), n)
    out_node, out_turn, out_code = [], [], []
    spare = np.zeros((len(n), 2), np.int64)
    if len(values) == 0:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), spare
    code_of = values * _STEP[62]
    for turn in (0, 1):
        band = np.searchsorted(edges, np.maximum(n, 1), "right") - 1 + turn
        d = most_apart(band, edges, percent)
        segments = np.where(d > 0, d * 57 // 32 + 3, 1)
        seg = ((values >> np.uint64(32)) * segments[owner].astype(np.uint64)) >> np.uint64(32)
        new = np.ones(len(values), bool)
        new[1:] = (seg[1:] != seg[:-1]) | (owner[1:] != owner[:-1])
        at = np.flatnonzero(new)
        node, seg = owner[at], seg[at]
        code = np.bitwise_xor.reduceat(code_of, at)
        used = np.bincount(node, minlength=len(n))
        short = np.flatnonzero((used <= d) & (n > 0))
        if len(short):  # few segments that are not empty: the empty ones count, too
            extra_node, extra_seg = [], []
            for i in short:
                free = np.ones(segments[i], bool)
                a, b = np.searchsorted(node, [i, i + 1])
                free[seg[a:b].astype(np.int64)] = False
                extra_seg.append(np.flatnonzero(free).astype(np.uint64))
                extra_node.append(np.full(len(extra_seg[-1]), i))
            node = np.concatenate([node, *extra_node])
            code = np.concatenate([code, np.zeros(sum(map(len, extra_seg)), np.uint64)])
            seg = np.concatenate([seg, *extra_seg])
        full = code + seg * _STEP[10] + band[node].astype(np.uint64) * _STEP[11]
        out_code.append(mix(full))
        out_node.append(node)
        out_turn.append(np.full(len(node), turn))
        spare[:, turn] = np.maximum(used - d - 1, 0)
    return (np.concatenate(out_node), np.concatenate(out_turn), np.concatenate(out_code), spare)


def dealt_codes(docs: DataFrame, text: str, size: int, percent: int, buckets: int) -> DataFrame:
    """(bucket, codes, counts, keys, turns, spare): packed codes, once per node and task."""
    edges = bounds(percent)

    def run(batches):
        seen = set()
        for batch in (p for b in batches for p in parts(b, 0)):
            for _, _, values, first in shingle_sets(batch.column(0), size):
                keys = set_keys(values, first)
                wanted = []
                for i, k in enumerate(keys.tolist()):
                    if k and k not in seen:
                        seen.add(k)
                        wanted.append(i)
                if not wanted:
                    continue
                wanted = np.array(wanted)
                number = np.diff(first)[wanted]
                values = values[ranges(first[:-1][wanted], number)]
                bound = np.concatenate([[0], np.cumsum(number)])
                node, turn, code, spare = segment_codes(values, bound, edges, percent)
                spare = spare.ravel()
                keys = keys[wanted]
                bucket = ((code >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
                slot = (node * 2 + turn).astype(np.uint32)[order]
                low = code.astype(np.uint32)[order]
                rows = [b for b in range(buckets) if cut[b] < cut[b + 1]]
                packed = []
                for b in rows:
                    s = slot[cut[b] : cut[b + 1]]
                    by = np.argsort(s, kind="stable")
                    own, count = np.unique(s, return_counts=True)
                    packed.append((
                        low[cut[b] : cut[b + 1]][by].tobytes(),
                        np.minimum(count, 0xFFFFFFFF).astype(np.uint32).tobytes(),
                        keys[own >> 1].tobytes(), (own & 1).astype(np.uint8).tobytes(),
                        spare[own].astype(np.uint32).tobytes(),
                    ))
                for lo in range(0, len(rows), 64):
                    part = packed[lo : lo + 64]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rows[lo : lo + 64], pa.int32()),
                         *(pa.array([p[j] for p in part], pa.binary()) for j in range(5))],
                        names=["bucket", "codes", "counts", "keys", "turns", "spare"],
                    )

    return docs.select(text).mapInArrow(
        lean(run), "bucket int, codes binary, counts binary, keys binary, turns binary, spare binary"
    )


def runs_of(codes: np.ndarray):
    """(places in order of code, run of each place) for codes that occur more than once."""
    both = codes.astype(np.uint64)
    both <<= np.uint64(32)
    both |= np.arange(len(codes), dtype=np.uint32)
    both.sort()
    # The upper halves are the codes, read in place: most codes occur once, and only others are copied.
    code = both.view(np.uint32)[int(sys.byteorder == "little")::2]
    same = code[1:] == code[:-1]
    keep = np.zeros(len(codes), bool)
    keep[1:] |= same
    keep[:-1] |= same
    both = both[keep]
    code, place = both >> np.uint64(32), (both & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return place, np.cumsum(code != np.append(~code[:1], code[:-1]))


def joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    """The arrays that the rows of a binary column hold, one behind the other."""
    found = []
    for chunk in column.chunks:
        chunk = chunk.cast(pa.large_binary())
        _, where, data = chunk.buffers()
        if len(chunk) and data is not None:
            ends = np.frombuffer(where, np.int64)
            found.append(np.frombuffer(data, np.uint8)[ends[chunk.offset] : ends[chunk.offset + len(chunk)]])
    return np.concatenate(found or [np.zeros(0, np.uint8)]).view(kind)


def in_runs(dealt: DataFrame) -> DataFrame:
    """What the buckets show, by `kind`: 1: node a, in `turn`, has the code b, which n nodes have;
    2: node a, in `turn`, has n such codes here and may leave out b of all its codes."""
    schema = "kind int, a long, turn int, b long, n long"

    def run(group: pa.Table) -> pa.Table:
        codes = joined(group.column("codes"), np.uint32)
        place, number = runs_of(codes)
        code = codes[place]
        del codes
        slot = np.searchsorted(np.cumsum(joined(group.column("counts"), np.uint32), dtype=np.int64), place, "right")
        keys, turns, spare = (
            joined(group.column(c), kind)
            for c, kind in (("keys", np.uint64), ("turns", np.uint8), ("spare", np.uint32))
        )
        key = keys[slot]
        order = np.lexsort((key, number))
        key, number, code, slot = key[order], number[order], code[order], slot[order]
        new = np.ones(len(key), bool)  # a node that several tasks emitted counts once
        new[1:] = (key[1:] != key[:-1]) | (number[1:] != number[:-1])
        key, number, code, slot = key[new], number[new], code[new], slot[new]
        length = np.bincount(number)[number] if len(number) else number
        many = length > 1
        key, code, slot, length = key[many], code[many], slot[many], length[many]
        turn = turns[slot].astype(np.int32)
        bucket = group.column("bucket")[0].as_py() if group.num_rows else 0
        run_id = (np.uint64(bucket) << np.uint64(32)) | code.astype(np.uint64)
        by = np.lexsort((turn, key))
        k, t, sp = key[by], turn[by], spare[slot[by]]
        edge = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (t[1:] != t[:-1])])) if len(k) else by
        size = np.diff(np.append(edge, len(k)))
        columns = [
            np.concatenate([np.full(len(key), 1), np.full(len(edge), 2)]).astype(np.int32),
            np.concatenate([key, k[edge]]).view(np.int64),
            np.concatenate([turn, t[edge]]).astype(np.int32),
            np.concatenate([run_id.view(np.int64), sp[edge].astype(np.int64)]),
            np.concatenate([length, size]).astype(np.int64),
        ]
        return pa.table([pa.array(c) for c in columns], names=["kind", "a", "turn", "b", "n"])

    return dealt.groupBy("bucket").applyInArrow(lean(run), schema)


def kept_members(found: DataFrame) -> DataFrame:
    """(run, key): for each node and turn the rarest codes, as many as exactness asks for; runs of
    one node are gone."""
    open_nodes = (
        found.where("kind = 2").groupBy("a", "turn")
        .agg((F.sum("n") - F.max("b")).alias("asked")).where("asked > 0")
    )
    order = Window.partitionBy("a", "turn").orderBy("n", "b")
    ranked = found.where("kind = 1").select("a", "turn", "b", "n").join(open_nodes, ["a", "turn"])
    kept = ranked.withColumn("nth", F.row_number().over(order)).where("nth <= asked")
    return kept.select(F.col("b").alias("run"), F.col("a").alias("key")).distinct()


# --- checking ----------------------------------------------------------------------------------


def dense(values: np.ndarray) -> bytes:
    """A parity sketch of at least two bits a shingle, of a power of two bytes."""
    size = max(8, 1 << (2 * len(values) - 1).bit_length())
    bits = np.bincount((values & np.uint64(size - 1)).astype(np.int64), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def sketch_distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two dense sketches; the longer one is folded, which keeps the bound."""
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def key_filter(keys: DataFrame) -> np.ndarray:
    """A bit for each key that is needed; of a fixed size, whatever their number."""
    spot = F.col("key").bitwiseAND(FILTER_BITS - 1)
    words = keys.groupBy(F.shiftright(spot, 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(key & 63 as int))")).alias("bits")
    )
    out = np.zeros(FILTER_BITS // 64, np.int64)
    for word, bits in words.collect():  # at most FILTER_BITS / 64 rows
        out[word] = bits
    return out


def needed_sets(docs: DataFrame, keys: DataFrame, text: str, size: int) -> DataFrame:
    """(key, members) of the nodes in `keys`: their sorted shingles."""
    bits = key_filter(keys)

    def run(batches):
        seen = set()
        for batch in (p for b in batches for p in parts(b, 0)):
            for _, _, values, first in shingle_sets(batch.column(0), size):
                ks = set_keys(values, first).view(np.int64)
                spots = ks & (FILTER_BITS - 1)
                hit = (bits[spots >> 6] >> (spots & 63)) & 1
                rows = []
                for i in np.flatnonzero((hit == 1) & (ks != 0)):
                    if ks[i] not in seen:
                        seen.add(ks[i])
                        v = values[first[i] : first[i + 1]]
                        rows.append((int(ks[i]), v.tobytes()))
                for a in range(0, len(rows), 256):
                    part = list(zip(*rows[a : a + 256]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part[0], pa.int64()), pa.array(part[1], pa.binary())],
                        names=["key", "members"],
                    )

    found = docs.select(text).mapInArrow(lean(run), "key long, members binary")
    return found.join(keys, "key", "left_semi").dropDuplicates(["key"])


def sides(pairs: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """The pairs (a, b) with columns of both ends."""
    for side in ("a", "b"):
        named = table.select(F.col("key").alias(side), *(F.col(c).alias(f"{c}_{side}") for c in columns))
        pairs = pairs.join(named, side)
    return pairs


def checked(pairs: DataFrame, docs: DataFrame, sets: DataFrame, text: str, size: int,
            percent: int) -> DataFrame:
    """The pairs (a, b) that link: by sizes, then sketches (both in `sets`), then whole sets, which
    are made again of the texts that are still in question."""

    def near(batches):
        for batch in batches:
            xs, ys = batch.column("sketch_a").to_pylist(), batch.column("sketch_b").to_pylist()
            sums = np.asarray(batch.column("n_a")) + np.asarray(batch.column("n_b"))
            # |A and B| >= p/100 |A or B| means a difference of at most (100-p)/(100+p) of the sum.
            most = sums * (100 - percent) // (100 + percent)
            keep = np.array([sketch_distance(x, y) <= m for x, y, m in zip(xs, ys, most)], bool)
            at = np.flatnonzero(keep)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(at)), batch.column("b").take(pa.array(at))],
                names=["a", "b"],
            )

    def linked(batches):
        for batch in batches:
            keep = []
            xs, ys = batch.column("members_a"), batch.column("members_b")
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(c[i].as_py(), np.uint64) for c in (xs, ys))
                if len(x) > len(y):
                    x, y = y, x
                at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[at] == x).sum())
                if 100 * common >= percent * (len(x) + len(y) - common):
                    keep.append(i)
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(keep, pa.int64())),
                 batch.column("b").take(pa.array(keep, pa.int64()))], names=["a", "b"],
            )

    sized = sides(pairs.select("a", "b"), sets, "n", "sketch").where(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    )
    close = written(sized.mapInArrow(lean(near), "a long, b long"), "close")
    ends = close.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    whole = needed_sets(docs, written(ends, "ends"), text, size)
    return sides(close, whole, "members").mapInArrow(lean(linked), "a long, b long")


def split_runs(members: DataFrame, roots: DataFrame) -> DataFrame:
    """(run, key, root) of the runs whose nodes are in several components."""
    placed = members.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    split = placed.groupBy("run").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y")
    return written(placed.join(split.select("run"), "run", "left_semi"), "split-runs")


def star_pairs(placed: DataFrame, turn: int) -> DataFrame:
    """(a, b): the leader of each run, another one each turn, with the nodes of other components."""
    drawn = F.struct(F.xxhash64("key", F.lit(turn)), "key", "root")
    leads = placed.groupBy("run").agg(F.min(drawn).alias("lead"))
    pairs = placed.join(leads, "run").where(F.col("root") != F.col("lead.root"))
    return pairs.select(
        F.least("key", "lead.key").alias("a"), F.greatest("key", "lead.key").alias("b")
    ).distinct()


def cells(rows: DataFrame, percent: int) -> DataFrame:
    """rows with `unit` and `side`: what is compared with what.

    A run of at most PER_BLOCK nodes is a unit by itself. A larger one is cut by bands of sizes, of
    which linked sets are in one or in two neighbouring, and each band into blocks of some PER_BLOCK
    nodes; a unit is a block alone (all in `side` 0) or two blocks, one on each side. Every pair that
    sizes allow is in exactly one unit of its run, and no unit outgrows two blocks.
    """
    wide = max(math.log(100 / percent), 1e-6) * (1 + 1e-9)
    banded = rows.withColumn("band", F.floor(F.log("n") / wide))
    counted = banded.groupBy("run", "band").agg(F.count("*").alias("m"))
    whole = counted.groupBy("run").agg(
        F.sum("m").alias("all"),
        # As many as there are sizes of texts, on a scale of logarithms.
        F.map_from_entries(F.collect_list(F.struct(
            "band", F.ceil(F.col("m") / PER_BLOCK).alias("blocks")
        ))).alias("blocks"),
    )
    few = whole.where(F.col("all") <= PER_BLOCK).select("run")
    small = rows.join(few, "run", "left_semi").withColumns({"unit": F.col("run"), "side": F.lit(0)})
    large = banded.join(whole.where(F.col("all") > PER_BLOCK), "run")
    large = large.withColumn(
        "block", F.pmod(F.xxhash64("key"), F.try_element_at("blocks", F.col("band")))
    )

    def others(step: int):
        """The blocks of a band `step` away."""
        there = F.coalesce(F.try_element_at("blocks", F.col("band") + step), F.lit(0))
        return F.when(there > 0, F.sequence(F.lit(0).cast("long"), there - 1)).otherwise(
            F.array().cast("array<long>")
        )

    def unit(low, i, high, j):
        return F.xxhash64("run", low, i, high, j)

    band, block = F.col("band"), F.col("block")
    units = F.concat(
        F.transform(others(0), lambda j: F.struct(
            unit(band, F.least(block, j), band, F.greatest(block, j)).alias("unit"),
            (block > j).cast("int").alias("side"),
        )),
        F.transform(others(1), lambda j: F.struct(
            unit(band, block, band + 1, j).alias("unit"), F.lit(0).alias("side")
        )),
        F.transform(others(-1), lambda j: F.struct(
            unit(band - 1, j, band, block).alias("unit"), F.lit(1).alias("side")
        )),
    )
    large = large.select(*rows.columns, F.explode_outer(units).alias("u")).select(
        *rows.columns, "u.unit", "u.side"
    )
    return small.unionByName(large)


def forest(pairs: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """The columns of `pairs` (two numbers of components) that connect all that they connect together,
    the least apart first: at most one fewer than there are components."""
    top: dict[int, int] = {}

    def find(x):
        while (up := top.get(x, x)) != x:
            top[x] = x = top.get(up, up)
        return x

    kept = []
    for i in np.argsort(apart, kind="stable").tolist():
        x, y = find(int(pairs[0, i])), find(int(pairs[1, i]))
        if x != y:
            top[max(x, y)] = min(x, y)
            kept.append(i)
    return np.array(kept, np.int64)


def cross_pairs(placed: DataFrame, sets: DataFrame, percent: int, every: bool = True) -> DataFrame:
    """(a, b): the pairs of nodes of one run in different components whose sizes and sketches allow
    a link. Only these leave the task; units are dealt to groups of some PER_GROUP rows.

    Unless `every` is asked for, a group gives only a forest of its pairs, fewer than it has nodes,
    with `more` true if it has left out any.
    """
    rows = cells(placed.join(sets.select("key", "n"), "key"), percent)
    rows = written(rows.select("key", "root", "n", "unit", "side"), "units")
    # Units with the same first node mostly have the same nodes: they go together, as far as a
    # group holds them.
    first = rows.groupBy("unit").agg(F.min("key").alias("first"), F.count("*").alias("m"))
    family = first.groupBy("first").agg(F.ceil(F.sum("m") / PER_GROUP).alias("shares"))
    groups = max(shuffle_partitions(placed.sparkSession), rows.count() // PER_GROUP + 1)
    dealt = first.join(family, "first").select("unit", F.pmod(
        F.xxhash64("first", F.pmod(F.xxhash64("unit"), "shares")), F.lit(groups)
    ).alias("group"))
    dealt = rows.join(dealt, "unit").join(sets.select("key", "sketch"), "key")

    def compare(table: pa.Table) -> pa.Table:
        unit, side, key, root, n = (
            table.column(c).to_numpy() for c in ("unit", "side", "key", "root", "n")
        )
        sketches = table.column("sketch").to_pylist()
        order = np.lexsort((side, unit))
        cut = np.flatnonzero(np.concatenate([[True], unit[order][1:] != unit[order][:-1], [True]]))
        # Rows (a, b, root of a, root of b) and how much of what a link allows they are apart.
        out, shares, waiting, more = [np.zeros((4, 0), np.int64)], [np.zeros(0)], 0, False

        def kept():
            pairs, at = np.unique(np.concatenate(out, axis=1), axis=1, return_index=True)
            share = np.concatenate(shares)[at]
            few = np.arange(len(share)) if every else forest(pairs[2:], share)
            return pairs[:, few], share[few], len(few) < len(share)

        for lo, hi in zip(cut[:-1], cut[1:]):
            at = order[lo:hi]
            size = min(len(sketches[i]) for i in at)
            # Folded to the shortest, which keeps the bound.
            bits = np.stack([
                np.bitwise_xor.reduce(np.frombuffer(sketches[i], np.uint8).reshape(-1, size), axis=0)
                for i in at
            ])
            bits = bits.view(np.uint64) if size % 8 == 0 else bits
            k, r, m = key[at], root[at], n[at]
            left = np.count_nonzero(side[at] == 0)
            for j in range(left):
                rest = slice(j + 1 if left == len(at) else left, None)
                apart = np.bitwise_count(bits[rest] ^ bits[j]).sum(axis=1, dtype=np.int64)
                most = (m[rest] + m[j]) * (100 - percent) // (100 + percent)
                fits = (r[rest] != r[j]) & (apart <= most)
                fits &= 100 * np.minimum(m[rest], m[j]) >= percent * np.maximum(m[rest], m[j])
                if fits.any():
                    other, its, low = k[rest][fits], r[rest][fits], k[rest][fits] < k[j]
                    out.append(np.stack([
                        np.minimum(other, k[j]), np.maximum(other, k[j]),
                        np.where(low, its, r[j]), np.where(low, r[j], its),
                    ]))
                    shares.append(apart[fits] / np.maximum(most[fits], 1))
                    waiting += len(other)
                if waiting > 100_000:
                    pairs, share, less = kept()
                    out, shares, waiting, more = [pairs], [share], 0, more or less
        pairs, _, less = kept()
        return pa.table([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(np.full(len(pairs[0]), more or less))],
                        names=["a", "b", "more"])

    found = dealt.groupBy("group").applyInArrow(lean(compare), "a long, b long, more boolean")
    return found.groupBy("a", "b").agg(F.max("more").alias("more"))


# --- the join ------------------------------------------------------------------------------------


def links(docs: DataFrame, sets: DataFrame, text: str, size: int, percent: int) -> DataFrame:
    """(a, b): enough links between nodes to connect every pair that is linked in any way."""
    spark = docs.sparkSession
    total = sets.agg(F.sum("n")).first()[0] or 0
    buckets = max(shuffle_partitions(spark), total // PER_BUCKET + 1)
    dealt = dealt_codes(docs, text, size, percent, buckets)
    members = written(kept_members(written(in_runs(dealt), "runs")), "members")
    # Runs of the same nodes are one.
    sets_of = members.groupBy("run").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("key")).alias("x"), F.min("key").alias("y")
    ).where("size > 1").groupBy("size", "x", "y").agg(F.min("run").alias("run"))
    members = written(members.join(sets_of.select("run", "size"), "run"), "distinct-runs")
    alone = spark.createDataFrame([], "key long, root long")
    placed = members.withColumn("root", F.col("key"))
    found, roots = None, alone
    for turn in range(STARS):
        pairs = written(star_pairs(placed, turn), "pairs")
        new = written(checked(pairs, docs, sets, text, size, percent), "links")
        found = new if found is None else found.unionByName(new)
        if turn and new.isEmpty():
            break
        roots = components(found)
        # A run of two nodes has been checked as a whole.
        placed = split_runs(members.where("size > 2").drop("size"), roots)
    # Forests first: links found join components, so that few pairs are left to look at one by one.
    for turn in range(FORESTS + 1):
        more = written(cross_pairs(placed, sets, percent, every=turn == FORESTS), "more-pairs")
        if more.isEmpty():
            break
        new = written(checked(more, docs, sets, text, size, percent), "more-links")
        found = found.unionByName(new)
        if more.where("more").isEmpty():
            break
        placed = split_runs(placed.drop("root"), components(found))
    return found


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5,
         percent: int = 75) -> DataFrame:
    """One row per document: key, n_shingles, component_id."""
    all_nodes = written(nodes(docs, key, text, size), "nodes")
    least = written(
        all_nodes.where("n > 0").groupBy("key").agg(
            F.min("doc_id").alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
        ),
        "sets",
    )
    roots = components(links(docs, least, text, size, percent))
    least = least.select("key", "least")
    placed = least.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    smallest = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    named = written(placed.join(smallest, "root").select("key", "component_id"), "named")
    return (
        all_nodes.join(named, "key", "left")
        .select(
            F.col("doc_id").alias(key), F.col("n").alias("n_shingles"),
            F.coalesce("component_id", "doc_id").alias("component_id"),
        )
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5,
                percent: int = 75) -> DataFrame:
    """The documents that name their component, with their columns."""
    stay = join(docs, key, text, size, percent).where(
        F.col(key).isNull() | (F.col(key) == F.col("component_id"))
    )
    ids = stay.select(F.col(key).alias("__key")).distinct()
    return docs.join(ids, F.col(key).eqNullSafe(F.col("__key")), "left_semi")

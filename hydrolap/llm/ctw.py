"""Language-model scoring by context-tree weighting, and a word-unigram base score.

Model. Every byte is eight binary decisions (a path through 255 nodes); the context of a decision is the node and the up to
``DEPTH`` bytes before the byte. Each context and node has a Krichevsky-Trofimov estimate from its training counts. A
context's weighted probability is the mean of its own estimate and the product of its children's (contexts one byte longer),
so all depths are mixed by how well they coded the training text; a text's code length follows from the mixed
predictions along its path. The tree holds every context of the training texts and grows with them.

A text's bytes (A-Z lower-cased) are coded after ``DEPTH`` zero bytes and closed by a zero byte.

Counting. Each task sums its own byte strings and words before the shuffle. The strings of all texts, those of no training text
with a count of zero, meet by the ``TOP`` bytes nearest to the coded one and are read in the order of their contexts, nearest byte
first, so that whole subtrees of one byte more pass by and are weighted bottom-up, a few at a time. What is above them has at most
256 ** TOP contexts, is weighted on the driver and turned into a table of two numbers for each context, byte and bit, from
which a second pass takes the value of every string.

Scoring: the ``HOT_STRINGS`` and ``HOT_WORDS`` most frequent strings and words are broadcast as caches, both bounded by
parameters; the values of all other strings and the counts of all other words come by joins, which by then have no
hot key. Words are told apart by 64-bit hashes.

Edge cases: null text counts as empty: one token, the end; a null doc_id is training; without training texts every bit costs
one bit; repeated rows count and are scored each; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .common import id_text, work_table

DEPTH = 5
TOP = 2
HOT_WORDS = 1 << 17
HOT_STRINGS = 1 << 21
SLICE_BYTES = 1_000_000
OWNER_BITS = 15  # of the index of a text in its slice; 8 * (DEPTH + 1) more hold a byte string
FLUSH = 250_000
SUBTREE_ROWS = 1 << 18

WORD, GRAM, DOCUMENT = range(3)
U = np.uint64


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word) - (1 << 63)


def grams(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(byte strings of DEPTH + 1 bytes as integers, index of the text) for every coded byte of every text."""
    data = bytes(DEPTH) + bytes(DEPTH + 1).join(raws) + bytes(9)
    n = np.fromiter((len(raw) + 1 for raw in raws), np.int64, len(raws))
    owner = np.repeat(np.arange(len(raws)), n)
    at = np.arange(len(owner)) + DEPTH * owner  # start of each string in ``data``
    windows = np.ndarray(len(data) - 8, ">u8", data, strides=(1,)).astype(U)  # the eight bytes from each place on
    return windows[at] >> U(8 * (7 - DEPTH)), owner


def nearest_first(strings: np.ndarray) -> np.ndarray:
    """Byte strings with the context bytes turned round, so that sorting puts contexts with the same nearest bytes side by side."""
    strings = strings.astype(U)
    turned = (strings >> U(8)).byteswap() >> U(8 * (8 - DEPTH))
    return (turned << U(8) | strings & U(255)).astype(np.int64)


def string_counts(strings: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct byte strings, how often each is in training texts (``learned`` for each of ``strings``) and in all."""
    marked = np.sort(strings << 1 | learned)  # sorted as they are: far cheaper than an order to sort by
    first = np.flatnonzero(np.diff(marked, prepend=-1))
    times, marked = np.diff(first, append=len(marked)), marked[first]
    return merged(marked >> 1, times * (marked & 1), times)


def raw_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[bytes]]]:
    ids, raws, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids.append(doc_id.as_py())
            raws.append(text.as_py().encode().lower())  # bytes: A-Z only
            size += len(raws[-1])
            if size > SLICE_BYTES or len(ids) == 1 << OWNER_BITS:
                yield ids, raws
                ids, raws, size = [], [], 0
    if ids:
        yield ids, raws


def corpus_counts(docs: DataFrame, is_training: Column) -> DataFrame:
    """(kind, key, n, times), not yet summed over tasks: words by hash and documents of the training texts; byte strings of all
    texts, ``n`` times in training texts and ``times`` in all."""

    def run(batches: Iterator[pa.RecordBatch]):
        words: Counter = Counter()
        runs, documents = [], 0

        def out(kind, k, n, times):
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), kind, np.int32)), *(pa.array(x, pa.int64()) for x in (k, n, times))], names=["kind", "key", "n", "times"])

        def flush_words():
            batch = out(WORD, [word_hash(w) for w in words], list(words.values()), list(words.values()))
            words.clear()
            return batch

        for learned, raws in raw_slices(batches):
            documents += sum(learned)
            for raw in itertools.compress(raws, learned):
                words.update(raw.split())
            if len(words) > FLUSH:
                yield flush_words()
            strings, owner = grams(raws)
            runs.append(string_counts(nearest_first(strings), np.asarray(learned, bool)[owner]))
            if 2 * sum(len(run[0]) for run in runs[1:]) > len(runs[0][0]):
                runs = [merged_runs(runs)]
            if len(runs[0][0]) > 4 * FLUSH:
                yield out(GRAM, *merged_runs(runs))
                runs = []
        yield flush_words()
        if runs:
            yield out(GRAM, *merged_runs(runs))
        yield out(DOCUMENT, [0], [documents], [documents])

    rows = docs.select(F.coalesce(is_training, F.lit(False)).alias("training"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return rows.mapInArrow(run, "kind int, key long, n long, times long")


def mask(depth: int) -> int:
    return (1 << 8 * depth) - 1


SMALL = 1 << 16
_lgamma = np.frompyfunc(math.lgamma, 1, 1)


@lru_cache
def small_lgamma(plus: float) -> np.ndarray:
    return _lgamma(np.arange(SMALL) + plus).astype(float)


def lgamma(n: np.ndarray, plus: float) -> np.ndarray:
    """Logarithm of the gamma function at whole numbers plus a constant; from a table for all but large ones."""
    out = small_lgamma(plus)[np.minimum(n, SMALL - 1)]
    large = np.flatnonzero(n >= SMALL)
    if len(large):
        out[large] = _lgamma(n[large] + plus).astype(float)
    return out


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Log probability that a Krichevsky-Trofimov estimator gives n0 zeros and n1 ones."""
    return lgamma(n0, 0.5) + lgamma(n1, 0.5) - lgamma(n0 + n1, 1.0) - 2 * math.lgamma(0.5)


def weigh(keys: np.ndarray, n: np.ndarray, below: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the rows of a depth (sorted context and byte, count) and the bits of the byte: the own estimate of the bit, its share in
    the mixture and the log weighted probability of the node, which stands at the first of the node's rows only.

    ``below``: the children's log weighted probabilities, to be summed over a node's rows; None at the greatest depth.
    """
    own_bit, share, weighted = np.empty((len(keys), 8)), np.ones((len(keys), 8)), np.zeros((len(keys), 8))
    for j in range(8):
        start = np.diff(keys >> (8 - j), prepend=-1) != 0
        first, node, bit = np.flatnonzero(start), np.cumsum(start) - 1, keys >> (7 - j) & 1
        total, n1 = np.add.reduceat(n, first), np.add.reduceat(n * bit, first)
        own = log_kt(total - n1, n1)
        own_bit[:, j] = (np.where(bit == 1, n1[node], (total - n1)[node]) + 0.5) / (total[node] + 1)
        if below is None:
            weighted[first, j] = own
        else:
            children = np.add.reduceat(below[:, j], first)
            share[:, j] = (1 / (1 + np.exp(np.clip(children - own, -700, 700))))[node]
            weighted[first, j] = np.logaddexp(own, children) - math.log(2)
    return own_bit, share, weighted


def climb(keys: np.ndarray, n: np.ndarray, below: np.ndarray | None, depths: range) -> tuple[np.ndarray, ...]:
    """Weights from the first of ``depths`` up to the last. ``keys``: sorted rows of the first one, all that their contexts of the last have.

    Returns for each row and bit (plus, times): the probability of the bit is plus + times x its probability one depth
    below the first; and rows, counts and ``below`` for the depth above the last.
    """
    plus, times, at = np.zeros((len(keys), 8)), np.ones((len(keys), 8)), np.arange(len(keys))
    for _ in depths:
        own_bit, share, weighted = weigh(keys, n, below)
        own_bit, share = own_bit[at], share[at]
        plus, times = share * own_bit + (1 - share) * plus, (1 - share) * times
        keys, up = np.unique(keys >> 16 << 8 | keys & 255, return_inverse=True)  # the farthest byte goes
        n = np.bincount(up, n, len(keys)).astype(np.int64)
        below = np.stack([np.bincount(up, weighted[:, j], len(keys)) for j in range(8)], 1)
        at = up[at]
    return plus, times, keys, n, below


def merged(keys: np.ndarray, *sums: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted ``keys`` once each and the sums of the rest."""
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], *(np.add.reduceat(x, first) if len(first) else x for x in sums)


def merged_runs(runs: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """One run of several sorted ones: keys and their sums."""
    columns = [np.concatenate(c) for c in zip(*runs)]
    order = np.argsort(columns[0], kind="stable")  # finds the runs and merges them
    return merged(*(c[order] for c in columns))


class Tree:
    """The whole model in one process: what the jobs below compute in pieces, for corpora that fit."""

    def __init__(self, depth: np.ndarray, context: np.ndarray, byte: np.ndarray, n: np.ndarray):
        at = depth == DEPTH
        self.strings, self.n = nearest_first(context[at] << 8 | byte[at]), n[at]

    def log10(self, strings: np.ndarray) -> np.ndarray:
        """Log10 probability of the last byte of each string after the bytes before it."""
        wanted = nearest_first(strings)
        keys, at = np.unique(np.concatenate([self.strings, wanted]), return_inverse=True)
        n = np.bincount(at[: len(self.n)], self.n, len(keys)).astype(np.int64)
        return np.log10(climb(keys, n, None, range(DEPTH, -1, -1))[0]).sum(1)[at[len(self.n):]]


def packed(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binary values."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def unpacked(column, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(x.as_py() for x in column), kind).reshape(-1, 8)


def subtrees(counts: DataFrame) -> DataFrame:
    """Every byte string (``top`` false) with its ``times`` in all texts and the probabilities of its bits in the subtree of its TOP + 1
    nearest bytes; and the rows of depth TOP (``top`` true), in parts, with their counts and what the subtrees weigh."""
    names = ["top", "key", "n", "numbers"]

    def out(top, keys, n, numbers):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), top)), pa.array(keys), pa.array(n), packed(numbers)], names=names)

    def weighed(keys, n, times):
        keys, n, times = merged(keys, n, times)
        bits, _, above, sums, below = climb(keys, n, None, range(DEPTH, TOP, -1))
        yield out(False, keys, times, bits.astype("<f4"))
        yield out(True, above, sums, below.astype("<f8"))

    def run(batches: Iterator[pa.RecordBatch]):
        held, size, enough = [], 0, SUBTREE_ROWS
        for batch in batches:
            held.append([batch.column(c).to_numpy() for c in range(3)])
            size += batch.num_rows
            if size < enough:
                continue
            columns = [np.concatenate(c) for c in zip(*held)]
            bits = 8 * (DEPTH - TOP)
            cut = int(np.searchsorted(columns[0], columns[0][-1] >> bits << bits))  # the last subtree may go on
            if cut:
                yield from weighed(*(c[:cut] for c in columns))
            held, size = [[c[cut:] for c in columns]], len(columns[0]) - cut
            enough = max(SUBTREE_ROWS, 2 * size)
        if size:
            yield from weighed(*(np.concatenate(c) for c in zip(*held)))

    strings = counts.where(F.col("kind") == GRAM).select("key", "n", "times")
    near = strings.repartition(F.shiftright("key", 8 * (DEPTH - TOP + 1))).sortWithinPartitions("key")
    return near.mapInArrow(run, "top boolean, key long, n long, numbers binary")


def summed(parts: DataFrame) -> DataFrame:
    """The parts (key, n, numbers) of the rows of depth TOP, one row a key: at most 256 ** (TOP + 1), however many parts there are."""

    def run(batches: Iterator[pa.RecordBatch]):
        keys, n, numbers = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, 8))
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            n = np.concatenate([n, batch.column(1).to_numpy()])
            numbers = np.concatenate([numbers, unpacked(batch.column(2), "<f8")])
            order = np.argsort(keys, kind="stable")
            keys, n, numbers = merged(keys[order], n[order], numbers[order])
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n), packed(numbers)], names=["key", "n", "numbers"])

    # by the whole key, so the parts of a context's bytes lie apart, and in a fixed order, as they are sums of doubles
    return parts.repartition("key").sortWithinPartitions("key", "n", "numbers").mapInArrow(run, "key long, n long, numbers binary")


def string_values(counts: DataFrame) -> DataFrame:
    """(key, value, times): log10 probability of the last byte of every byte string after the bytes before it."""
    found = work_table(subtrees(counts), "subtrees")
    rows = work_table(summed(found.where("top").select("key", "n", "numbers")), "top").toArrow()
    keys, n = (rows.column(c).to_numpy().astype(np.int64) for c in ("key", "n"))
    order = np.argsort(keys, kind="stable")
    keys, n, below = merged(keys[order], n[order], unpacked(rows.column("numbers"), "<f8")[order])
    plus, times, *_ = climb(keys, n, below, range(TOP, -1, -1)) if len(keys) else (np.empty((0, 8)),) * 2
    shared = counts.sparkSession.sparkContext.broadcast((keys, plus.astype("<f4"), times.astype("<f4")))

    def run(batches: Iterator[pa.RecordBatch]):
        known, plus, times = shared.value
        for batch in batches:
            key = batch.column(0).to_numpy()
            at = np.searchsorted(known, key >> 8 * (DEPTH - TOP + 1) << 8 | key & 255)
            value = np.log10(plus[at] + times[at].astype(float) * unpacked(batch.column(2), "<f4")).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(value), batch.column(1)], names=["key", "value", "times"])

    return found.where("NOT top").select("key", "n", "numbers").mapInArrow(run, "key long, value double, times long")


def least_hot(values: DataFrame) -> int:
    """The least ``times`` from which on there are at most HOT_STRINGS strings."""
    found = values.groupBy("times").agg(F.count(F.lit(1)).alias("n")).toArrow()
    times, n = (found.column(c).to_numpy() for c in ("times", "n"))
    order = np.argsort(-times)
    fitting = times[order][np.cumsum(n[order]) <= HOT_STRINGS]
    return int(fitting[-1]) if len(fitting) else 1 << 62


def look_up(held: tuple[np.ndarray, np.ndarray], strings: np.ndarray) -> np.ndarray:
    """Values of the frequent byte strings (sorted keys, values), not-a-number for strings that are not held."""
    keys, values = held
    if not len(keys):
        return np.full(len(strings), np.nan)
    at = np.minimum(np.searchsorted(keys, strings), len(keys) - 1)
    return np.where(keys[at] == strings, values[at], np.nan)


def text_scores(raws: list[bytes], held: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's sum of the values of its frequent byte strings, its number of other ones, and these, text after text.

    Strings are sorted together with the index of their text: each different one is looked up once, and in order.
    """
    strings, owner = grams(raws)
    marked = np.sort(nearest_first(strings) << OWNER_BITS | owner)
    strings, owner = marked >> OWNER_BITS, marked & (1 << OWNER_BITS) - 1
    first = np.flatnonzero(np.diff(strings, prepend=-1))
    values = np.repeat(look_up(held, strings[first]), np.diff(first, append=len(strings)))
    rare = np.isnan(values)
    scores = np.bincount(owner, np.where(rare, 0, values), len(raws))
    strings, owner = strings[rare], owner[rare]
    return scores, np.bincount(owner, minlength=len(raws)), strings[np.argsort(owner, kind="stable")]


class HotWords(dict):
    """Word -> its hash or, if hot, log10 of its count plus one, the one a whole number and the other a float."""

    def __init__(self, counts: dict[int, int]):
        self.counts = counts

    def __missing__(self, word: bytes) -> int | float:
        if len(self) > FLUSH:
            self.clear()
        h = word_hash(word)
        c = self.counts.get(h)
        out = self[word] = h if c is None else math.log10(c + 1)
        return out


SCORED = "row long, doc_id long, n_tokens long, known long, logs double, score double, rest array<long>, times array<int>, strings array<long>"


def score_rows(docs: DataFrame, hot_strings: tuple[np.ndarray, np.ndarray], hot: dict[int, int], end_count: int) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((hot_strings, hot))
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]):
        held, counts = shared.value
        words = HotWords(counts)
        row = TaskContext.get().partitionId() << 40
        for ids, raws in raw_slices(batches):
            scores, n_rare, rare = text_scores(raws, held)
            out = []
            for doc_id, raw, total in zip(ids, raws, scores):
                found = raw.split()
                known, logs, rest, times = int(end_count > 0), math.log10(end_count + 1), [], []
                for w, n in Counter(found).items():
                    value = words[w]
                    if type(value) is int:
                        rest.append(value)
                        times.append(n)
                    else:
                        known += n
                        logs += n * value
                out.append((row, doc_id, len(found) + 1, known, logs, float(total), rest, times))
                row += 1
            left = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_rare)]), pa.int32()), pa.array(rare))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(zip(*out), kinds)), left], names=[x.split()[0] for x in SCORED.split(", ")])

    return id_text(docs).mapInArrow(run, SCORED)


def score(docs: DataFrame, is_training: Column) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of every document; the model learns from ``is_training`` rows."""
    counts = work_table(corpus_counts(docs, is_training), "counts")
    words = work_table(counts.where(F.col("kind") == WORD).groupBy(F.col("key").alias("hash")).agg(F.sum("n").alias("n")), "words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    ends = counts.where(F.col("kind") == DOCUMENT).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    train_tokens, distinct = total["n"] + ends, total["v"] + (ends > 0)
    top = words.orderBy(F.desc("n"), "hash").limit(HOT_WORDS).toArrow()
    hot = dict(zip(top.column("hash").to_pylist(), top.column("n").to_pylist()))
    values = work_table(string_values(counts), "values")
    least = least_hot(values)
    often = values.where(F.col("times") >= least).select("key", "value").toArrow().sort_by("key")
    hot_strings = often.column("key").to_numpy(), often.column("value").to_numpy()
    scored = work_table(score_rows(docs, hot_strings, hot, ends), "scored")
    rest = scored.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("hash"), F.col("x.times").alias("times"))
    more = rest.join(words, "hash").groupBy("row").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs"))
    rare = scored.select("row", F.explode("strings").alias("key")).join(values.where(F.col("times") < least).select("key", "value"), "key")
    more_score = rare.groupBy("row").agg(F.sum("value").alias("more_score"))
    unit = math.log10(train_tokens + distinct + 1)
    return scored.select("row", "doc_id", "n_tokens", "known", "logs", "score").join(more, "row", "left").join(more_score, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(unit)).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"))

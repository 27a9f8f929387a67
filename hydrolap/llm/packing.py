"""Best-fit decreasing packing of pieces into sequences of fixed capacity.

Pieces of one length are alike, and so are open sequences of one remaining capacity. The count of pieces by length (at
most ``capacity`` rows, whatever the input) is therefore all that the packing needs: a segment tree over remaining
capacities finds the tightest open sequence in logarithmic time, and a run of equal pieces is placed at once, exactly as
if they came one by one in descending length. The plan (runs of ranks within a length) is bounded by capacity squared;
the pieces themselves stay distributed and look their place up by rank.

Edge cases: a null or empty text is a piece with the end id alone; repeated documents are packed each; an empty
table gives an empty result; only documents beyond the capacity are cut, and their first piece takes the remainder.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import id_text, work_table
from .tokens import encode_batches, tokenizer_json

CAPACITY = 2048
ROWS_PER_SLICE = 100_000


class TightestFit:
    """Segment tree over capacities: how many sequences are open at each, and the least one not below a size."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)

    def add(self, remaining: int, n: int) -> None:
        i = remaining + self.leaves
        while i:
            self.count[i] += n
            i >>= 1

    def find(self, size: int) -> int | None:
        i = size + self.leaves
        if not self.count[i]:
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.leaves


@dataclass(frozen=True)
class Run:
    """Pieces of ``length`` with ranks from ``rank`` on go to sequences from ``sequence`` on, one each, at ``offset``."""

    length: int
    rank: int
    n: int
    sequence: int
    offset: int


def best_fit_decreasing(counts: dict[int, int], capacity: int = CAPACITY) -> list[Run]:
    tree = TightestFit(capacity)
    open_: dict[int, list[tuple[int, int]]] = {}  # remaining capacity -> runs (first sequence, how many)
    runs: list[Run] = []
    sequences = 0

    def keep(remaining: int, first: int, n: int) -> None:
        if n and remaining:
            open_.setdefault(remaining, []).append((first, n))
            tree.add(remaining, n)

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            remaining = tree.find(length)
            if remaining is None:
                remaining, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            else:
                first, n = open_[remaining].pop()
                tree.add(remaining, -n)
            each = remaining // length  # a sequence that took one stays the tightest until the next does not fit
            full = min(n, left // each)
            for k in range(each if full else 0):
                runs.append(Run(length, rank, full, first, capacity - remaining + k * length))
                rank += full
            left -= full * each
            keep(remaining - each * length, first, full)
            rest = left if full < n and left < each else 0
            for k in range(rest):
                runs.append(Run(length, rank, 1, first + full, capacity - remaining + k * length))
                rank += 1
            left -= rest
            keep(remaining - rest * length, first + full, 1 if rest else 0)
            unused = n - full - (rest > 0)
            keep(remaining, first + n - unused, unused)
    return runs


def pieces(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece; only documents longer than ``capacity`` are cut."""
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer_path))

    def run(batches: Iterator[pa.RecordBatch]):
        rows: list[tuple] = []
        for doc_id, ids in encode_batches(batches, shared.value, end_id):
            cuts = [0, *range(len(ids) % capacity or capacity, len(ids), capacity), len(ids)]
            rows += [(doc_id, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
            if len(rows) >= 10_000:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return id_text(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])


def ranked(rows: DataFrame) -> DataFrame:
    """Rank of each piece among those of its length, by hash slices whose number follows the rows: no task gets a whole length."""
    slices = rows.count() // ROWS_PER_SLICE + 1
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "start", "ids_crc32")
    numbered = sliced.withColumn("place", F.row_number().over(inside) - 1)
    return numbered.join(offsets, ["length", "slice"]).withColumn("rank", F.col("place") + F.col("before")).drop("slice", "place", "before")


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows``: pieces as a written table. Adds sequence_id and offset."""
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most ``capacity`` rows
    plan = best_fit_decreasing(counts, capacity)
    by_length: dict[int, np.ndarray] = {}
    for length in counts:
        by_length[length] = np.asarray([(r.rank, r.sequence, r.offset) for r in plan if r.length == length], np.int64)
    shared = rows.sparkSession.sparkContext.broadcast(by_length)
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            for size in np.unique(length):
                at = np.flatnonzero(length == size)
                table = shared.value[int(size)]
                hit = np.searchsorted(table[:, 0], rank[at], "right") - 1
                sequence[at] = table[hit, 1] + rank[at] - table[hit, 0]
                offset[at] = table[hit, 2]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(sequence), pa.array(offset)],
                                             names=[*names, "sequence_id", "offset"])

    return ranked(rows).select(*names, "rank").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: int = CAPACITY) -> DataFrame:
    return pack(work_table(pieces(docs, tokenizer_path, end_id, capacity), "pieces"), capacity)

"""Token-id files: canonical length-limited Huffman code of the ids, from global counts.

Format. A folder with two Parquet tables. ``code``: one row, the code length of every id (one byte each, 0: the id does
not occur). ``blocks``: rows of (file_no, block_no, first, doc_ids, doc_lengths, checkpoints, bits); files are ranges of
doc_id in ascending order, ``first`` counts the ids before the block within its file. ``bits`` holds the codes, first
bit highest; ``checkpoints`` has the bit offset of every 128th id as little-endian 32-bit integers. A block holds
whole documents of about 65,536 ids and is decoded on its own: all its checkpoints advance together through one
decoding table, one id a step.

Edge cases: a null or empty text has the end id alone; repeated ids (documents) keep all their rows, ordered by
their content; a null doc_id sorts first; an empty table gives empty files; one distinct id has a code of one bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from .tokens import flat_binary

BLOCK_IDS = 65_536
STEP = 128
MAX_BITS = 20

BLOCKS = (
    "file_no int, block_no int, first long, doc_ids array<long>, doc_lengths array<long>, checkpoints binary, bits binary")


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package-merge); 0 where the count is 0."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    n = len(used)
    if n <= 1:
        lengths[used] = 1
        return lengths
    if n > 1 << limit:
        raise ValueError("more ids than codes of that length")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    levels, packages = [], np.empty(0)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        rank = np.argsort(merged, kind="stable")
        levels.append(rank < n)
        merged = merged[rank]
        pairs = len(merged) // 2
        packages = merged[: 2 * pairs : 2] + merged[1 : 2 * pairs : 2]
    take = 2 * n - 2
    for leaf in reversed(levels):
        leaves = int(leaf[:take].sum())
        lengths[order[:leaves]] += 1
        take = 2 * (take - leaves)
    return lengths


def canonical(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids in code order, code of each id)."""
    ids = np.flatnonzero(lengths)
    ids = ids[np.lexsort((ids, lengths[ids]))]
    size = lengths[ids].astype(np.int64)
    width = int(size.max()) if len(size) else 1
    starts = np.concatenate([[0], np.cumsum(np.int64(1) << (width - size))[:-1]]) if len(size) else size
    codes = np.zeros(len(lengths), np.int64)
    codes[ids] = starts >> (width - size)
    return ids, codes


class Encoder:
    def __init__(self, lengths: np.ndarray):
        self.lengths, self.codes = lengths.astype(np.int64), canonical(lengths)[1]

    def block(self, ids: np.ndarray) -> tuple[bytes, bytes]:
        """(checkpoints, bits). A code and its shift fit in four bytes; codes do not overlap, so sums stand for unions."""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        at = ends - size
        words = self.codes[ids] << (32 - size - (at & 7))
        where = at >> 3
        out = np.zeros((int(ends[-1]) + 7) // 8 + 4 if len(ids) else 4)
        for k in range(4):
            out += np.bincount(where + k, (words >> (24 - 8 * k)) & 255, minlength=len(out))
        return at[::STEP].astype("<u4").tobytes(), out.astype(np.uint8).tobytes()


class Decoder:
    def __init__(self, lengths: np.ndarray):
        ids, _ = canonical(lengths)
        size = lengths[ids].astype(np.int64)
        self.width = int(size.max()) if len(size) else 1
        self.ids = np.zeros(1 << self.width, np.uint32)
        self.sizes = np.zeros(1 << self.width, np.int64)
        spread = np.repeat(np.arange(len(ids)), np.int64(1) << (self.width - size))
        self.ids[: len(spread)], self.sizes[: len(spread)] = ids[spread], size[spread]

    def block(self, checkpoints: bytes, bits: bytes, n: int) -> np.ndarray:
        raw = np.frombuffer(bits, np.uint8).astype(np.int64)
        windows = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at = np.frombuffer(checkpoints, "<u4").astype(np.int64)
        out = np.zeros((len(at), STEP), np.uint32)
        last = len(windows) - 1
        for step in range(min(STEP, n)):
            live = len(at) if step < (n % STEP or STEP) else len(at) - 1
            a = at[:live]
            code = windows[np.minimum(a >> 3, last)] << (a & 7) & 0xFFFFFFFF
            code >>= 32 - self.width
            out[:live, step] = self.ids[code]
            at[:live] += self.sizes[code]
        return out.reshape(-1)[:n]


def id_counts(tokens: DataFrame, width: str) -> DataFrame:
    """(id, n) over all documents: one partial table of at most a vocabulary's size from each task."""

    def run(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(0, np.int64)
        for batch in batches:
            seen = np.bincount(flat_binary(batch.column(0), width)[0])
            if len(seen) > len(total):
                total = np.concatenate([total, np.zeros(len(seen) - len(total), np.int64)])
            total[: len(seen)] += seen
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_files(tokens: DataFrame, width: str, path: str) -> None:
    """``tokens``: doc_id, n_tokens, ids of ``width`` (as ``tokens.token_rows`` gives). Reads it three times: let it be a written table."""
    spark = tokens.sparkSession
    counted = id_counts(tokens, width).toArrow()  # at most one row for each id of the vocabulary
    counts = np.zeros(max(counted.column("id").to_pylist(), default=0) + 1, np.int64)
    counts[counted.column("id").to_numpy()] = counted.column("n").to_numpy()
    lengths = code_lengths(counts)
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").write.parquet(f"{path}/code")
    shared = spark.sparkContext.broadcast(lengths.tobytes())

    def run(batches: Iterator[pa.RecordBatch]):
        encoder = Encoder(np.frombuffer(shared.value, np.uint8))
        file_no, block_no, first = TaskContext.get().partitionId(), 0, 0
        docs, parts, size = [], [], 0

        def close():
            nonlocal block_no, first, docs, parts, size
            checkpoints, bits = encoder.block(np.concatenate(parts))
            row = {"file_no": file_no, "block_no": block_no, "first": first, "doc_ids": docs, "doc_lengths": [len(p) for p in parts],
                   "checkpoints": checkpoints, "bits": bits}
            block_no, first, docs, parts, size = block_no + 1, first + size, [], [], 0
            return pa.RecordBatch.from_pylist([row], schema=pa.schema([
                ("file_no", pa.int32()), ("block_no", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                ("doc_lengths", pa.list_(pa.int64())), ("checkpoints", pa.binary()), ("bits", pa.binary())]))

        for batch in batches:
            for doc_id, ids in zip(batch.column(0), batch.column(1)):
                docs.append(doc_id.as_py())
                parts.append(np.frombuffer(ids.as_buffer(), width))
                size += len(parts[-1])
                if size >= BLOCK_IDS:
                    yield close()
        if docs:
            yield close()

    ordered = tokens.select("doc_id", "ids").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(run, BLOCKS).write.option("compression", "none").parquet(f"{path}/blocks")


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids (little-endian 32-bit) of every document in the files."""
    lengths = bytes(spark.read.parquet(f"{path}/code").first()["lengths"])
    shared = spark.sparkContext.broadcast(lengths)

    def run(batches: Iterator[pa.RecordBatch]):
        decoder = Decoder(np.frombuffer(shared.value, np.uint8))
        for batch in batches:
            for row in range(batch.num_rows):
                file_no, first, docs, sizes, checkpoints, bits = (batch.column(c)[row] for c in range(6))
                sizes = np.asarray(sizes.as_py(), np.int64)
                ends = np.cumsum(sizes)
                raw = decoder.block(checkpoints.as_py(), bits.as_py(), int(ends[-1])).astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays([
                    pa.array([file_no.as_py()] * len(sizes), pa.int32()), pa.array(docs.as_py(), pa.int64()),
                    pa.array(first.as_py() + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.array([raw[4 * (e - n) : 4 * e] for e, n in zip(ends, sizes)], pa.binary())],
                    names=["file_no", "doc_id", "at", "n_tokens", "ids"])

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    rows = blocks.select("file_no", "first", "doc_ids", "doc_lengths", "checkpoints", "bits").mapInArrow(
        run, "file_no int, doc_id long, at long, n_tokens long, ids binary")
    totals = blocks.groupBy("file_no").agg(F.sum(F.aggregate("doc_lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n"))
    offsets = file_offsets(totals)
    return rows.join(F.broadcast(offsets), "file_no").select("doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids")


def file_offsets(totals: DataFrame) -> DataFrame:
    """Ids before each file; one row for each file, that is for each range partition of the writer."""
    from pyspark.sql import Window

    earlier = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("file_no", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

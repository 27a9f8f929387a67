"""SimHash near duplicates, found through tables of distances to reference fingerprints.

The table of a fingerprint holds its Hamming distance to each reference, apart for each of four bands of 16 bits. By the triangle
inequality a coordinate of two fingerprints differs by at most their own distance in that band, so of two that differ in at most
three bits all coordinates of at least one band are equal, and none differ by more than three over all bands. The
first fact deals fingerprints into cells, the second discards pairs of a cell, and what is left is verified bit by bit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import checked_broadcast, id_text, work_table
from .components import components

U = np.uint64
SEED = 42                # fixed value: seed of the shingles' hash
BANDS = 4                # one more than the bits that may differ
MOST_BITS = 3
REFERENCES = 24
SLICE_SHINGLES = 1 << 17  # hashes whose bits are counted at once
CELL_ROWS = 4096          # a cell of more fingerprints is compared in blocks of about so many
PAIRS_AT_ONCE = 1 << 21

CELLS = "node long, copies long, band int, cell long"
FOUND = "node long, head long, links long"


def references() -> np.ndarray:
    """The reference fingerprints: fixed by their number, so that every task and every retry has the same table."""
    return np.asarray([xxhash.xxh64_intdigest(b"reference %d" % n) for n in range(REFERENCES)], U)


def shingle_hashes(text: str, size: int) -> np.ndarray:
    words = text.encode().lower().split()  # bytes: A-Z and the six white-space characters only
    if not words:
        return np.empty(0, U)
    if len(words) < size:
        return np.asarray([xxhash.xxh64_intdigest(b" ".join(words), SEED)], U)
    plain = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(plain[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())), U, len(words) - size + 1)


def majority(hashes: list[np.ndarray]) -> np.ndarray:
    """Fingerprint of each array of hashes: the bits set in more than half of it; zero of an empty one."""
    ones = np.zeros((len(hashes), 64), np.int64)
    n = np.asarray([len(h) for h in hashes], np.int64)
    owner, every = np.repeat(np.arange(len(hashes)), n), np.concatenate([np.empty(0, U), *hashes])
    for low in range(0, len(every), SLICE_SHINGLES):
        part, own = every[low : low + SLICE_SHINGLES], owner[low : low + SLICE_SHINGLES]
        first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        bits = np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[own[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little")
    return packed.view("<u8").reshape(-1).astype(U)


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id and node, the fingerprint as a signed number, of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]):
        def out():
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(majority(hashes).view(np.int64))], names=["doc_id", "node"])

        ids, hashes, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                hashes.append(shingle_hashes(text.as_py(), size))
                held += len(hashes[-1])
                if held >= SLICE_SHINGLES:
                    yield out()
                    ids, hashes, held = [], [], 0
        if ids:
            yield out()

    return id_text(docs).mapInArrow(run, "doc_id long, node long")


def distance_table(prints: np.ndarray) -> np.ndarray:
    """(rows, bands, references): distance to each reference in each band."""
    apart = (prints[:, None] ^ references()[None, :]).astype("<u8")
    return np.bitwise_count(apart.view("<u2")).reshape(len(prints), REFERENCES, BANDS).transpose(0, 2, 1)


def cells(nodes: DataFrame) -> DataFrame:
    """Each fingerprint once a band, in the cell of its coordinates there."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            node = batch.column(0).to_numpy()
            table = distance_table(node.view(U))
            cell = [xxhash.xxh64_intdigest(row.tobytes(), seed=band) for band in range(BANDS) for row in np.ascontiguousarray(table[:, band])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(node, BANDS)), pa.array(np.tile(batch.column(1).to_numpy(), BANDS)), pa.array(np.repeat(np.arange(BANDS, dtype=np.int32), len(node))), pa.array(np.asarray(cell, U).view(np.int64))],
                names=["node", "copies", "band", "cell"])

    return nodes.select("node", "copies").mapInArrow(run, CELLS)


def units(placed: DataFrame) -> DataFrame:
    """unit, band, side, node, copies: rows to be compared with each other. A cell is a unit; a large one is cut into blocks, and
    each two blocks (also one with itself) are a unit, in which ``side`` tells them apart."""
    large = work_table(placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CELL_ROWS).select(
        F.col("cell").alias("large"), F.ceil(F.col("n") / CELL_ROWS).cast("int").alias("blocks")), "simhash-large")
    sized = placed.join(checked_broadcast(large), F.col("cell") == F.col("large"), "left")
    whole = sized.where("blocks IS NULL").select(F.col("cell").alias("unit"), "band", F.lit(0).alias("side"), "node", "copies")
    block = F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int")
    cut = sized.where("blocks IS NOT NULL").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return whole.unionByName(cut.select(
        F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "band",
        F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1).otherwise(2).alias("side"), "node", "copies"))


def close_pairs(unit: np.ndarray, band: np.ndarray, side: np.ndarray, prints: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs inside units that differ in at most MOST_BITS bits, each in the first band only in which it meets."""
    table = distance_table(prints)
    whole = table.sum(1, dtype=np.int16)
    key = unit * 128 + whole[:, 0]  # distances are at most 64
    order = np.argsort(key, kind="stable")
    key, whole, prints, side, band = key[order], np.ascontiguousarray(whole[order].T), prints[order], side[order], band[order]
    last = np.searchsorted(key, key + MOST_BITS, "right")
    count = last - np.arange(len(key)) - 1  # partners behind in the order of the first coordinate, within reach of it
    bounds = np.searchsorted(np.cumsum(count), np.arange(PAIRS_AT_ONCE, int(count.sum()) + PAIRS_AT_ONCE, PAIRS_AT_ONCE), "left") + 1
    low = 0
    for high in np.unique(np.minimum(bounds, len(key))).tolist():
        n = count[low:high]
        i = np.repeat(np.arange(low, high), n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        low = high
        near = (side[i] != side[j]) | (side[i] == 0)
        i, j = i[near], j[near]
        for coordinate in whole[1:]:
            near = np.abs(coordinate[i] - coordinate[j]) <= MOST_BITS
            i, j = i[near], j[near]
            if not len(i):
                break
        apart = prints[i] ^ prints[j]
        near = np.bitwise_count(apart) <= MOST_BITS
        first = np.argmax(apart.astype("<u8").view("<u2").reshape(-1, BANDS) == 0, axis=1)
        near &= first == band[i]
        yield order[i[near]], order[j[near]]


def heads(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least position that links reach, for each of ``n`` positions."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        after = label.copy()
        for end in (a, b, label[a], label[b]):
            np.minimum.at(after, end, low)
        after = after[after]
        if (after == label).all():
            return label
        label = after


def compare(rows: DataFrame) -> DataFrame:
    """``rows`` as ``units`` gives them. For each fingerprint with a link in a batch of units: one that it is linked to (directly or through others
    there) and the number of documents it links with there."""

    def batch_links(unit, band, side, node, copies):
        _, unit = np.unique(unit, return_inverse=True)
        links, a, b = np.zeros(len(node), np.int64), [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for i, j in close_pairs(unit, band, side, node.view(U)):
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            a.append(i)
            b.append(j)
        label = heads(len(node), np.concatenate(a), np.concatenate(b))
        at = np.flatnonzero(links)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in (node[at], node[label[at]], links[at])], names=["node", "head", "links"])

    def run(batches: Iterator[pa.RecordBatch]):
        held = None
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            if held is not None:
                columns = [np.concatenate(c) for c in zip(held, columns)]
            cut = int(np.searchsorted(columns[0], columns[0][-1])) if len(columns[0]) else 0  # the last unit may go on
            held = [c[cut:] for c in columns]
            if cut:
                yield batch_links(*(c[:cut] for c in columns))
        if held is not None and len(held[0]):
            yield batch_links(*held)

    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, FOUND)


def near_duplicates(docs: DataFrame, size: int = 3) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id that links reach) and n_links (other documents linked directly).

    A null text is empty; texts without words have fingerprint zero and are linked like any other. Every row is a document of its own, also where
    doc_ids repeat; null doc_ids take part, and component_id is null where links reach none but null ones. Without documents
    there are no rows. Other columns are ignored.
    """
    found = work_table(fingerprints(docs, size), "simhash")
    nodes = work_table(found.groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "simhash-nodes")
    placed = work_table(cells(nodes), "simhash-cells")
    linked = work_table(compare(units(placed)), "simhash-links")
    labels = components(linked.select(F.col("node").alias("a"), F.col("head").alias("b")).where("a <> b"), "simhash-components")
    degree = linked.groupBy("node").agg(F.sum("links").alias("links"))
    named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    lowest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    grouped = named.join(degree, "node", "left").where("copies > 1 OR links IS NOT NULL").join(lowest, "label")
    classes = work_table(grouped.select(F.col("node").alias("class_node"), "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "simhash-classes")
    return found.join(checked_broadcast(classes), F.col("node") == F.col("class_node"), "left").select(
        "doc_id", F.lpad(F.lower(F.hex("node")), 16, "0").alias("fingerprint"),
        F.when(F.col("class_node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))

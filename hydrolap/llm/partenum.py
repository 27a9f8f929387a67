"""N-gram Jaccard join with PartEnum signatures.

Sets of similarity t or more whose sizes lie in one band differ in at most k elements. The feature domain (64-bit hashes
of word shingles) is cut into k // 2 + 1 + e parts, so that more than e of them hold at most one difference. Each part
is cut into three, and one of the three pairs of thirds of such a part is then free of differences: the hashes of a
set's elements in each pair of thirds are its signatures, and similar sets share a signature in more than e parts. Bands
overlap, so every similar pair lies in a common band. Some of the shared ones may be signatures of no elements; a set with
more than ``empty`` such parts emits those too, others need not, and still share more than e - ``empty`` parts.

That number is a test for a single set: one that shares signatures with any other set in fewer parts has no partner. It
removes nearly all sets that merely hold a frequent passage, whose signatures in a few parts consist of that passage.

Work follows distinct sets, not documents: equal sets are one node. Signatures meet in sorted rows that stream by, so no
group is ever held. What passes the test is tied to the first node of each signature, and the connected candidate groups are
verified exactly: all pairs of a group, in blocks of bounded size, by matrix products over the shingles that two
members share. Groups beyond one block are spread over all pairs of blocks. Links that hold are contracted to stars
before they leave the task.

Edge cases: a null or empty text, or one without words, has the empty set: linked with nothing, its own component;
texts with fewer words than a shingle are one shingle of all words; equal rows link like equal texts; a null doc_id is a
node without number, which links like others: its component is that of the numbered documents it is linked with, or null; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ..session import release_shuffles, work_folder
from .common import id_text, work_table, work_tables
from .components import components

U = np.uint64
SLICE_BYTES = 4_000_000
BAND = 1.5
CHUNK_BYTES = 1 << 19
LONG_WORD = 64
IS_BLANK = np.isin(np.arange(256), (0x20, *range(0x09, 0x0E)))
NEXT_BLANK = re.compile(rb"[\x20\x09-\x0D]")
BLOCK_SETS = 2048
BLOCK_SHINGLES = 1_000_000
FILTER_BITS = 1 << 23
TURNS, TURN_SHINGLES = 2, 2_000_000  # signatures are dealt out in so many turns from so many shingles on, else at once


@dataclass(frozen=True)
class Band:
    """Sizes ``low`` to ``high``. Similar pairs share signatures in ``needed`` parts at least; a set may have ``empty`` parts with a
    signature of no elements before it has to emit those."""

    no: int
    low: int
    high: int
    parts: int
    empty: int
    needed: int


@lru_cache
def bands(percent: int, up_to: int) -> tuple[Band, ...]:
    """Bands for sizes from 1 to ``up_to`` and a similarity of percent / 100; bands where only equal sets are similar are left out."""
    out, low, no = [], 1, 0
    while low <= up_to:
        high = max(low, low * 100 // percent, int(low * BAND))
        differences = 2 * high * (100 - percent) // (100 + percent)
        if differences:
            least = differences // 2 + 1
            spare = max(least * 3 // 10, int(least > 1))
            empty = least // 10
            out.append(Band(no, low, high, least + spare, empty, spare + 1 - empty))
        no += 1
        low = (high + 1) * percent // 100  # the least size whose partner may be larger than ``high``
        while low * 100 // percent <= high:
            low += 1
    return tuple(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits depend on all input bits (splitmix64's finish)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


@lru_cache(1)
def byte_powers() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random-looking number for each byte value, and the powers of an odd number and of its inverse modulo 2**64."""
    base = 0xD1342543DE82EF95
    up = np.cumprod(np.full(CHUNK_BYTES, base, U), dtype=U)
    down = np.cumprod(np.full(CHUNK_BYTES, pow(base, -1, 1 << 64), U), dtype=U)
    return mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15)), up, down


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word, in order.

    Sums of byte numbers times powers run over a chunk; the difference of two sums, shifted to the word's start, is a hash of
    the word alone. Words over LONG_WORD bytes, where powers modulo 2**64 could be steered into each other, are hashed one by one.
    """
    number, up, down = byte_powers()
    hashes, starts, at = [], [], 0
    while at < len(raw):
        data = np.frombuffer(raw, np.uint8, min(CHUNK_BYTES, len(raw) - at), at)
        blank = IS_BLANK[data]
        if at + len(data) < len(raw):
            cut = np.flatnonzero(blank)
            if not len(cut):  # one word fills the chunk
                end = NEXT_BLANK.search(raw, at)
                end = end.start() if end else len(raw)
                hashes.append(np.asarray([xxhash.xxh64_intdigest(raw[at:end])], U))
                starts.append(np.asarray([at]))
                at = end
                continue
            data, blank = data[: cut[-1] + 1], blank[: cut[-1] + 1]
        border = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        first, behind = border[::2], border[1::2]
        sums = np.zeros(len(data) + 1, U)
        np.cumsum(number[data] * up[: len(data)], out=sums[1:])
        found = (sums[behind] - sums[first]) * down[first]
        for i in np.flatnonzero(behind - first > LONG_WORD):
            found[i] = xxhash.xxh64_intdigest(raw[at + first[i] : at + behind[i]])
        hashes.append(found)
        starts.append(first + at)
        at += len(data)
    return (np.concatenate(hashes), np.concatenate(starts)) if hashes else (np.empty(0, U), np.empty(0, np.int64))


def shingle_sets(raws: list[bytes], size: int) -> list[np.ndarray]:
    """For each lower-cased text its sorted distinct shingle hashes."""
    joined = b" ".join(raws)
    h, starts = word_hashes(joined)
    text_at = np.cumsum([0, *(len(r) + 1 for r in raws)])
    word_at = np.searchsorted(starts, text_at)
    windows = np.zeros(max(0, len(h) - size + 1), U)
    for k in range(size):
        windows = mix(windows + h[k : k + len(windows)])
    out = []
    for raw, low, high in zip(raws, word_at, word_at[1:]):
        if high - low >= size:
            out.append(np.unique(windows[low : high - size + 1]))
        else:
            found = raw.split()
            out.append(np.asarray([xxhash.xxh64_intdigest(b" ".join(found), seed=len(found))] if found else [], U))
    return out


def digest(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else 0


def signatures(shingles: np.ndarray, percent: int, turn: int = 0, turns: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """All signatures of one set, or those of every ``turns``-th part, and the part that each belongs to (band number x 2**32 + part)."""
    n = len(shingles)
    out, places = [], []
    for band in bands(percent, max(64, 1 << int(n).bit_length())):
        if not band.low <= n <= band.high:
            continue
        seed = U(band.no * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
        spread = mix(shingles + seed)
        third = (spread % U(3 * band.parts)).astype(np.int64)  # part * 3 + third of it
        filled = np.bincount(third, minlength=3 * band.parts)
        if turns > 1:
            own = third // 3 % turns == turn
            spread, third = spread[own], third[own]
        value = mix(spread ^ U(0xD6E8FEB86659FD93))
        sums = np.zeros(3 * band.parts, U)
        np.add.at(sums, third, value)
        sums, filled = sums.reshape(-1, 3), filled.reshape(-1, 3)
        pair = np.stack([sums[:, a] + sums[:, b] * U(3) for a, b in ((0, 1), (0, 2), (1, 2))], 1)
        count = np.stack([filled[:, a] + filled[:, b] for a, b in ((0, 1), (0, 2), (1, 2))], 1)
        place = np.arange(3 * band.parts, dtype=U).reshape(-1, 3)
        every = mix(mix(pair + count.astype(U)) + mix(seed + place))
        part = np.repeat(np.arange(band.parts)[:, None] + (band.no << 32), 3, 1)
        emit = np.ones_like(count, bool) if int((count == 0).any(1).sum()) > band.empty else count > 0
        every, part, emit = every[turn::turns], part[turn::turns], emit[turn::turns]
        out.append(every[emit])
        places.append(part[emit])
    return (np.concatenate(out), np.concatenate(places)) if out else (np.empty(0, U), np.empty(0, np.int64))


def set_slices(batches: Iterator[pa.RecordBatch], size: int, wanted=None) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    ids, raws, total = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            if wanted is not None and not wanted(doc_id.as_py()):
                continue
            ids.append(doc_id.as_py())
            raws.append(text.as_py().encode().lower())  # bytes: A-Z only
            total += len(raws[-1])
            if total > SLICE_BYTES:
                yield list(zip(ids, shingle_sets(raws, size)))
                ids, raws, total = [], [], 0
    if ids:
        yield list(zip(ids, shingle_sets(raws, size)))


def digests(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, node: equal sets have equal nodes."""

    def run(batches: Iterator[pa.RecordBatch]):
        for rows in set_slices(batches, size):
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in rows], pa.int64()), pa.array([len(s) for _, s in rows], pa.int64()), pa.array([digest(s) for _, s in rows], pa.int64())],
                names=["doc_id", "n_shingles", "node"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_shingles long, node long")


ROW = "y long, x long, part long"
HASH_BITS = 40  # of a signature that holds the number of its part


def with_part(signature: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Signatures that hold the number of their part (equal ones have equal parts) and zeros; numbers that need more bits stay beside
    their signature, plus one. The number stands in the high bytes, next to the zeros: together they take little room in a shuffle."""
    band, no = part >> 32, part & 0xFFFFFFFF
    fits = (band < 1 << 7) & (no < 1 << 16)
    return np.where(fits, signature & (1 << HASH_BITS) - 1 | (band << 16 | no) << HASH_BITS, signature), np.where(fits, 0, part + 1)


def part_of(signature: np.ndarray, beside: np.ndarray) -> np.ndarray:
    return np.where(beside > 0, beside - 1, signature >> HASH_BITS + 16 << 32 | signature >> HASH_BITS & 0xFFFF)


def shared_signatures(docs: DataFrame, size: int, percent: int, turn: int = 0, turns: int = 1) -> DataFrame:
    """(signature, node, part) of every signature of a turn that two nodes or more have, for all of them. Each part belongs to one turn.

    Where a slice of documents has several nodes for one signature, only the first takes part in the shuffle by signature; the
    others are known to share it and travel under their own number, so a signature of many sets is no hot key.
    """

    def emit(batches: Iterator[pa.RecordBatch]):
        for rows in set_slices(batches, size):
            sets = {digest(s): s for _, s in rows}
            found = [(node, *signatures(s, percent, turn, turns)) for node, s in sets.items()]
            if not found:
                continue
            sig = np.concatenate([x for _, x, _ in found]).view(np.int64)
            sig, part = with_part(sig, np.concatenate([x for _, _, x in found]))
            node = np.repeat(np.asarray([x for x, _, _ in found], np.int64), [len(x) for _, x, _ in found])
            every = sig, node, part
            order = np.argsort(sig, kind="stable")
            sig, node, part = sig[order], node[order], part[order]
            again = np.zeros(len(sig), bool)
            again[1:] = sig[1:] == sig[:-1]
            several = again.copy()
            several[:-1] |= again[1:]
            lead = np.sort(order[~again])  # by node: neighbours in a shuffle block then differ in few bytes
            yield _rows(every[1][lead], every[0][lead], every[2][lead])
            if several.any():
                yield _rows(sig[several], node[several], ~part[several])

    def meet(batches: Iterator[pa.RecordBatch]):
        held = None  # last signature's row, not yet known to be shared; then (signature, node, part, whether it was given out)
        for batch in batches:
            y, x, part = (batch.column(c).to_numpy() for c in range(3))
            known = part < 0
            out = [(y[known], x[known], part_of(y[known], ~part[known]))]
            s, node = x[~known], y[~known]
            p = part_of(s, part[~known])
            if len(s):
                if held is not None:
                    s, node, p = (np.concatenate([[h], v]) for h, v in zip(held[:3], (s, node, p)))
                same = s[1:] == s[:-1]
                start = np.concatenate([[True], ~same])
                run = np.cumsum(start) - 1
                low = np.minimum.reduceat(node, np.flatnonzero(start))
                high = np.maximum.reduceat(node, np.flatnonzero(start))
                shared = (low != high)[run]
                if held is not None and held[3]:
                    shared |= run == 0
                given = shared.copy()
                if held is not None and held[3]:
                    given[0] = False
                out.append((s[given], node[given], p[given]))
                held = s[-1], node[-1], p[-1], bool(shared[-1])
                # earlier rows of the last run that share it with nobody yet are the same node: the held row speaks for them
            columns = [np.concatenate(c) for c in zip(*out)]
            if len(columns[0]):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["signature", "node", "part"])

    rows = id_text(docs).mapInArrow(emit, ROW)
    return rows.repartition("x").sortWithinPartitions("x").mapInArrow(meet, "signature long, node long, part long")


def _rows(y: np.ndarray, x: np.ndarray, part: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(y), pa.array(x), pa.array(part)], names=["y", "x", "part"])


def candidate_edges(docs: DataFrame, nodes: DataFrame, size: int, percent: int, folder: str) -> DataFrame:
    """(a, b): nodes that pass the test of shared parts, tied to the least one of each signature that they share.

    All signatures together take two to three times the room of the texts in a shuffle, so they are made in turns.
    """
    most, total = nodes.agg(F.coalesce(F.max("n_shingles"), F.lit(1)), F.coalesce(F.sum("n_shingles"), F.lit(0))).first()
    turns = TURNS if total >= TURN_SHINGLES else 1
    shared = work_tables([shared_signatures(docs, size, percent, turn, turns) for turn in range(turns)], "shared", folder).distinct()
    needed = {b.no: b.needed for b in bands(percent, max(64, 1 << int(most).bit_length()))}
    table = docs.sparkSession.createDataFrame(sorted(needed.items()), "band int, needed int")
    parts = shared.select("node", "part").distinct().groupBy("node", F.shiftright("part", 32).cast("int").alias("band")).agg(F.count(F.lit(1)).alias("parts"))
    passed = parts.join(F.broadcast(table), "band").where("parts >= needed").select("node", "band")
    kept = work_table(shared.withColumn("band", F.shiftright("part", 32).cast("int")).join(passed, ["node", "band"]).select("signature", "node"), "kept", folder)
    heads = kept.groupBy("signature").agg(F.min("node").alias("head"))
    return kept.join(heads, "signature").where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()


def id_bits(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(U)) % U(FILTER_BITS)).astype(np.int64)


def id_filter(ids: DataFrame) -> bytes:
    """A bitmap of fixed size that holds the doc_ids; others pass it by chance only."""

    def run(batches: Iterator[pa.RecordBatch]):
        bits = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            bits[id_bits(batch.column(0).to_numpy())] = True
        used = np.unique(np.flatnonzero(bits) >> 6)
        words = np.packbits(bits.reshape(-1, 64)[used], axis=1).view(">u8").reshape(-1).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(words)], names=["word", "bits"])

    found = ids.mapInArrow(run, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # fixed size at most
    words = np.zeros(FILTER_BITS // 64, np.int64)
    words[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return words.astype(">i8").tobytes()


def may_link(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean mask of the sets that can be similar to another one, none of them missed.

    Similar sets share at least the given share of each one's shingles. So with shingles in one order for all, the rarest
    first, the first shingles of both beyond the rest of that size have one in common; shingles that many sets share come last and do not count.
    """
    n = np.asarray([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    values, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.lexsort((column, often[column], owner))
    place = np.arange(len(order)) - np.repeat(np.cumsum(n) - n, n)
    early = order[place <= np.repeat(n - -(-percent * n // 100), n)]
    met = np.bincount(column[early], minlength=len(values)) > 1
    out = np.zeros(len(sets), bool)
    out[owner[early[met[column[early]]]]] = True
    return out


def linked(sets: list[np.ndarray], left: np.ndarray, percent: int) -> np.ndarray:
    """Boolean matrix of similar pairs; ``left``: mask of the first block's members, or all True for pairs inside one block."""
    hit = np.zeros((len(sets), len(sets)), bool)
    at = np.flatnonzero(may_link(sets, percent))
    if len(at) > 1:
        hit[np.ix_(at, at)] = shared_enough([sets[i] for i in at], percent)
    if not left.all():
        hit &= left[:, None] != left[None, :]
    return hit


def shared_enough(sets: list[np.ndarray], percent: int) -> np.ndarray:
    """Boolean matrix of similar pairs by exact intersections."""
    n = np.asarray([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    values, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often[column] > 1
    owner, column = owner[shared], column[shared]
    _, column = np.unique(column, return_inverse=True)
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    width = int(column[-1]) + 1 if len(column) else 0
    both = np.zeros((len(sets), len(sets)), np.float32)
    step = max(1, 8_000_000 // len(sets))
    for start in range(0, width, step):
        lo, hi = np.searchsorted(column, [start, start + step])
        part = np.zeros((len(sets), min(step, width - start)), np.float32)
        part[owner[lo:hi], column[lo:hi] - start] = 1
        both += part @ part.T
    union = n[:, None] + n[None, :] - both
    hit = 100 * both >= percent * union
    np.fill_diagonal(hit, False)
    return hit


def stars(hit: np.ndarray) -> np.ndarray:
    """Smallest index that links reach, for each row of a symmetric matrix."""
    label = np.arange(len(hit))
    while True:
        near = np.where(hit, label[None, :], len(hit)).min(1, initial=len(hit))
        after = np.minimum(label, near)
        after = after[after]
        if (after == label).all():
            return label
        label = after


VERIFIED = "node long, head long, links long"


def verify(members: DataFrame, percent: int) -> DataFrame:
    """``members``: group, node, copies, n_shingles, shingles. For each node with a link in a block: a node linked to it (directly or
    through members of the block) and the number of documents it links with there."""
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("sets"), F.sum("n_shingles").alias("total")).select(
        "group", F.ceil(F.greatest(F.col("sets") / BLOCK_SETS, F.col("total") / BLOCK_SHINGLES)).cast("int").alias("blocks"), "total")
    small = sizes.where("blocks = 1").agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n")).first()["n"]
    batches = int(small // BLOCK_SHINGLES) * 2 + 1
    sized = members.join(sizes.select("group", "blocks"), "group").withColumn(
        "block", F.when(F.col("blocks") > 1, F.pmod(F.xxhash64("node", F.lit(7)), "blocks").cast("int")).otherwise(0))
    alone = sized.where("blocks = 1").select(F.pmod(F.xxhash64("group"), F.lit(batches)).alias("task"), F.lit(-1).alias("i"), F.lit(-1).alias("j"), "*")
    spread = sized.where("blocks > 1").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        F.col("group").alias("task"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), *sized.columns)
    columns = ["task", "i", "j", "group", "node", "copies", "shingles", "block"]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("group")
        ends = np.flatnonzero(np.diff(table.column("group").to_numpy())) + 1
        out = {"node": [], "head": [], "links": []}
        for low, high in zip([0, *ends], [*ends, table.num_rows]):
            part = table.slice(low, high - low)
            if not part.num_rows:
                continue
            nodes, copies = part.column("node").to_numpy(), part.column("copies").to_numpy()
            sets = [np.frombuffer(s.as_buffer(), U) for s in part.column("shingles")]
            i, j = part.column("i")[0].as_py(), part.column("j")[0].as_py()
            left = part.column("block").to_numpy() == i if i < j else np.ones(len(nodes), bool)
            if i < j and (left.all() or not left.any()):  # one block is empty; pairs inside the other belong to its own cell
                continue
            hit = linked(sets, left, percent)
            label, links = stars(hit), hit @ copies
            at = np.flatnonzero(links)
            out["node"].append(nodes[at])
            out["head"].append(nodes[label[at]])
            out["links"].append(links[at])
        return pa.table({k: pa.array(np.concatenate([np.empty(0, np.int64), *v]).astype(np.int64), pa.int64()) for k, v in out.items()})

    return alone.select(columns).unionByName(spread.select(columns)).groupBy("task", "i", "j").applyInArrow(run, VERIFIED)


def join(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id and n_links (other documents linked directly) of every document."""
    found = work_table(digests(docs, size), "digests")
    release_shuffles(docs.sparkSession)
    with work_folder(docs.sparkSession, "jaccard-join") as folder:
        nodes = work_table(found.where("n_shingles > 0").groupBy("node").agg(
            F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles")), "nodes", folder)
        candidates = components(work_table(candidate_edges(docs, nodes, size, percent, folder), "candidate-edges", folder), "candidates", folder).select("node", F.col("label").alias("group"))
        chosen = work_table(candidates.join(nodes, "node"), "chosen", folder)
        nulls = bool(chosen.where("least IS NULL").limit(1).count())
        wanted_bits = docs.sparkSession.sparkContext.broadcast(id_filter(chosen.where("least IS NOT NULL").select("least")))

        def fetch(batches: Iterator[pa.RecordBatch]):
            bits = np.unpackbits(np.frombuffer(wanted_bits.value, np.uint8)).astype(bool)

            def wanted(doc_id):
                return nulls if doc_id is None else bits[id_bits(np.asarray([doc_id]))[0]]

            for rows in set_slices(batches, size, wanted):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in rows], pa.int64()), pa.array([digest(s) for _, s in rows], pa.int64()), pa.array([s.tobytes() for _, s in rows], pa.binary())],
                    names=["doc_id", "seen", "shingles"])

        sets = id_text(docs).mapInArrow(fetch, "doc_id long, seen long, shingles binary")
        release_shuffles(docs.sparkSession)
        members = work_table(chosen.join(sets, F.col("least").eqNullSafe(F.col("doc_id")) & (F.col("node") == F.col("seen"))).select(
            "group", "node", "copies", "n_shingles", "shingles").dropDuplicates(["node"]), "members", folder)
        release_shuffles(docs.sparkSession)
        verified = work_table(verify(members, percent), "verified", folder)
        labels = components(verified.select(F.col("node").alias("a"), F.col("head").alias("b")).where("a <> b"), "links", folder)
        degree = verified.groupBy("node").agg(F.sum("links").alias("links"))
        named = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
        lowest = named.groupBy("label").agg(F.min("least").alias("component_id"))
        per_node = work_table(named.join(lowest, "label").join(degree, "node", "left").select(
            "node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "classes")
    rows = found.withColumn("key", F.when(F.col("n_shingles") > 0, F.col("node")))
    return rows.join(per_node.withColumnRenamed("node", "key"), "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))

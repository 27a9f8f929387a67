"""Ranked lexical search: accumulators from short lists, then document-at-a-time skipping over long ones.

Documents are cut into segments of bounded text. A segment is one row of a written table: its documents, and for each term the
places and frequencies of the documents that hold it. Frequencies over all documents come from the segments; each task then ranks its
segments for all queries of a block and passes on only the best of each query.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import id_text, work_table

# Bytes that separate terms, the weights' scale and the saturation of a term's frequency.
APART = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
TABLE = bytes(32 if b in APART else b + 32 if 65 <= b <= 90 else b for b in range(256))
GAIN, TF_SCALE, LENGTH_SCALE = 1_000_000_000, 1000, 8
FLAT_PERCENT, LENGTH_PERCENT = 25, 75

SEGMENT_BYTES = 4 << 20   # text in a segment, unless one document is longer
SHORT_SHARE = 16          # a list is short if it holds at most 1 / SHORT_SHARE of a segment's documents
WINDOW = 1024             # neighbouring documents that are looked at together
BLOCK_TERMS = 400_000     # terms of the queries that are held at once
VOCABULARY = 1_000_000    # different query terms up to which only these are indexed

SEGMENT = "ids array<bigint>, lengths array<int>, terms array<binary>, starts array<int>, places array<int>, times array<int>"
HITS = "query long, doc_id long, score long"


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(TABLE).split(b" ") if text else []


def segments(docs: DataFrame, vocabulary: list[bytes] | None = None) -> DataFrame:
    """``docs`` (doc_id, text) as segments. With a ``vocabulary`` the others' lists are left out; lengths count all terms."""
    known = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(vocabulary)})

    def segment(ids: list, raws: list[list[bytes]]) -> pa.RecordBatch:
        numbers = known.value if known else {}
        if known:
            flat = [numbers.get(t, -1) for raw in raws for t in raw]
        else:
            flat = [numbers.setdefault(t, len(numbers)) for raw in raws for t in raw]
        names = list(numbers)
        lengths = np.asarray([len(r) for r in raws], np.int64)
        term = np.asarray(flat, np.int64)
        keys, times = np.unique((term * len(raws) + np.repeat(np.arange(len(raws)), lengths))[term >= 0], return_counts=True)
        term, place = np.divmod(keys, max(len(raws), 1))
        used, starts = np.unique(term, return_index=True)
        columns = [ids, lengths.astype(np.int32), [names[t] for t in used.tolist()], starts.astype(np.int32), place.astype(np.int32), times.astype(np.int32)]
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32(), pa.int32()]
        return pa.RecordBatch.from_arrays([pa.array([c], pa.list_(k)) for c, k in zip(columns, kinds)], names=["ids", "lengths", "terms", "starts", "places", "times"])

    def run(batches: Iterator[pa.RecordBatch]):
        ids, raws, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                raw = text.as_py()
                ids.append(doc_id.as_py())
                raws.append([t for t in terms_of(raw) if t])
                size += len(raw) + 64
                if size > SEGMENT_BYTES:
                    yield segment(ids, raws)
                    ids, raws, size = [], [], 0
        if ids:
            yield segment(ids, raws)

    return docs.mapInArrow(run, SEGMENT)


def term_counts(items: DataFrame) -> DataFrame:
    """query, term, times of ``items`` (query, text)."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            query, term = [], []
            for q, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = [t for t in terms_of(text) if t]
                query += [q] * len(found)
                term += found
            yield pa.RecordBatch.from_arrays([pa.array(query, pa.int64()), pa.array(term, pa.binary())], names=["query", "term"])

    return items.mapInArrow(run, "query long, term binary").groupBy("query", "term").agg(F.count(F.lit(1)).alias("times"))


def weight(documents: Column, df: Column) -> Column:
    return F.floor(1000 * F.log((2 * documents + 2).cast("double") / (2 * df + 1).cast("double")))


class Best:
    """The ``k`` best (score, doc_id) so far; equal scores by doc_id, null ones last."""

    def __init__(self, k: int):
        self.k, self.score, self.ids, self.null = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    @property
    def enough(self) -> int:
        """The least score that may still enter: that of the last one, as its doc_id may be larger."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def offer(self, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        score, ids, null = (np.concatenate(x) for x in ((self.score, score), (self.ids, ids), (self.null, null)))
        keep = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.ids, self.null = score[keep], ids[keep], null[keep]


class Postings:
    """One iterator of the document-at-a-time pass: documents in ascending place, what each adds, and the most that any adds."""

    def __init__(self, places: np.ndarray, adds: np.ndarray):
        self.places, self.adds, self.bound = places, adds, int(adds.max())

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = np.searchsorted(self.places, (low, high))
        return self.places[a:b], self.adds[a:b]

    def seek(self, wanted: np.ndarray) -> np.ndarray:
        """What the list adds to each of the wanted documents, skipping over all others."""
        at = np.minimum(np.searchsorted(self.places, wanted), len(self.places) - 1)
        return np.where(self.places[at] == wanted, self.adds[at], 0)


def summed(places: list[np.ndarray], adds: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Lists added up: ascending places and the sum at each."""
    place, add = np.concatenate(places), np.concatenate(adds)
    order = np.argsort(place, kind="stable")
    place, add = place[order], add[order]
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if len(place) else np.empty(0, np.int64)
    return place[first], np.add.reduceat(add, first) if len(first) else add


class Segment:
    def __init__(self, row: dict[str, pa.ListScalar], documents: int, terms: int):
        ids = row["ids"].values
        self.ids, self.null = ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)
        lengths, self.places, times = (row[c].values.to_numpy().astype(np.int64) for c in ("lengths", "places", "times"))
        scale = FLAT_PERCENT + LENGTH_PERCENT * lengths * documents // max(terms, 1)
        self.values = (GAIN * times) // (TF_SCALE * times + LENGTH_SCALE * scale[self.places])
        starts = row["starts"].values.to_pylist() + [len(self.places)]
        self.lists = {t: (a, b) for t, a, b in zip(row["terms"].values.to_pylist(), starts, starts[1:])}

    def rank(self, query: list[tuple[bytes, int]], best: Best) -> None:
        """Offer ``best`` every document that may be among the best for ``query`` (term, weight times repeats)."""
        lists = [(*self.lists[t], w) for t, w in query if t in self.lists and w]
        if not lists:
            return
        short = [x for x in lists if (x[1] - x[0]) * SHORT_SHARE <= len(self.ids)]
        iterators = [Postings(self.places[a:b], self.values[a:b] * w) for a, b, w in lists if (b - a) * SHORT_SHARE > len(self.ids)]
        if short:  # term at a time: sums of the short lists, from here on one list like the others
            iterators.append(Postings(*summed([self.places[a:b] for a, b, _ in short], [self.values[a:b] * w for a, b, w in short])))
        iterators.sort(key=lambda i: i.bound)
        reach = np.cumsum([i.bound for i in iterators])  # the most that a document in the first lists alone can score
        low = 0
        while low < len(self.ids):
            need = int(np.searchsorted(reach, best.enough))  # documents in the lists before this one only cannot enter
            if need == len(iterators):
                return
            ahead = [i.places[at] for i in iterators[need:] if (at := int(np.searchsorted(i.places, low))) < len(i.places)]
            if not ahead:
                return
            low = int(min(ahead))  # skip to the next document of a list that matters
            high = low + WINDOW
            places, score = summed(*zip(*(i.between(low, high) for i in iterators[need:])))
            for k in range(need - 1, -1, -1):
                hopeful = score + reach[k] >= best.enough
                places, score = places[hopeful], score[hopeful]
                if not len(places):
                    break
                score = score + iterators[k].seek(places)
            enters = score >= best.enough
            if enters.any():
                best.offer(score[enters], self.ids[places[enters]], self.null[places[enters]])
            low = high


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents (doc_id, text) with a score above 0 of every item (item_id, text).

    Null texts have no terms: such a document is in no answer and not counted, such an item has no rows. Repeated rows of documents
    are documents of their own; repeated rows of items are one item, and equal item_ids with different texts are each answered by
    themselves. Equal scores go by ascending doc_id, null ones last. Without documents or items there are no rows. Other columns
    are ignored.
    """
    spark = docs.sparkSession
    asked = items.select(F.col("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).distinct()
    asked = work_table(asked.withColumn("query", F.xxhash64("item_id", "text")), "queries")
    wanted = work_table(term_counts(asked.select("query", "text")), "query-terms")
    distinct = wanted.select("term").distinct()
    few = distinct.count() <= VOCABULARY
    vocabulary = [bytes(r["term"]) for r in distinct.collect()] if few else None
    index = work_table(segments(id_text(docs), vocabulary), "segments")
    lengths = index.select(F.explode("lengths").alias("n")).agg(
        F.count_if(F.col("n") > 0).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    ends = F.concat(F.slice("starts", 2, F.size("starts")), F.array(F.size("places")))
    df = index.where(F.size("terms") > 0).select(F.explode(F.arrays_zip("terms", F.transform(F.arrays_zip("starts", ends.alias("ends")), lambda x: x["ends"] - x["starts"]).alias("n"))).alias("t")).groupBy(
        F.col("t.terms").alias("term")).agg(F.sum("t.n").alias("df"))
    weighed = wanted.join(df, "term").select("query", "term", (weight(F.lit(lengths["documents"]), F.col("df")) * F.col("times")).alias("weight"))
    held = wanted.count()
    blocks = max(1, math.ceil(held / BLOCK_TERMS))
    weighed = work_table(weighed.withColumn("block", F.pmod(F.xxhash64("query", F.lit(3)), F.lit(blocks))), "query-weights")
    parts = [hits(index, weighed.where(F.col("block") == b), lengths["documents"], lengths["terms"], k) for b in range(blocks)]
    best = parts[0]
    for part in parts[1:]:
        best = best.unionByName(part)
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    return best.withColumn("rank", place).where(F.col("rank") <= k).join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def hits(index: DataFrame, weighed: DataFrame, documents: int, terms: int, k: int) -> DataFrame:
    """The best documents of each task's segments for the queries of one block."""
    queries: dict[int, list[tuple[bytes, int]]] = {}
    for r in weighed.toArrow().to_pylist():  # a block: bounded
        queries.setdefault(r["query"], []).append((r["term"], r["weight"]))
    shared = index.sparkSession.sparkContext.broadcast(queries)

    def run(batches: Iterator[pa.RecordBatch]):
        best = {q: Best(k) for q in shared.value}
        for batch in batches:
            for n in range(batch.num_rows):
                part = Segment({c: batch.column(c)[n] for c in batch.schema.names}, documents, terms)
                for q, query in shared.value.items():
                    part.rank(query, best[q])
        for q, b in best.items():
            if len(b.score):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.score), q)), pa.array(b.ids, mask=b.null), pa.array(b.score)], names=["query", "doc_id", "score"])

    return index.mapInArrow(run, HITS)


def search_sql() -> str:
    """DuckDB twin of ``search`` with its defaults."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    term = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = f"unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{term}'))"
    return f"""
WITH d AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {terms} AS term FROM documents) GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {terms} AS term FROM benchmark) GROUP BY ALL),
n AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM d GROUP BY doc_id), a AS (SELECT count(*) AS c, sum(n)::BIGINT AS l FROM n),
w AS (SELECT term, floor(1000 * ln((2 * a.c + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM d GROUP BY term), a),
scored AS (SELECT item_id, doc_id, sum(w * times * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * a.c) // a.l))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN d USING (term) JOIN n USING (doc_id), a GROUP BY item_id, doc_id),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 10
"""

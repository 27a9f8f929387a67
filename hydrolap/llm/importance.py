"""Importance resampling of documents towards a target collection, by hashed runs of words."""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import id_text, work_table

# What stands between words once A-Z are lower-case, and the constant of the drawing's hash.
SEPARATORS = regex.compile(rb"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SEED = "2024"
UINT32 = 1 << 32

FEATURES = "doc_id long, n_words long, n_features long, buckets array<int>, times array<int>"


def collapsed(text: str) -> bytes:
    """UTF-8 of the text with A-Z in lower case and every separator run as one space."""
    return SEPARATORS.sub(b" ", text.encode().lower())


def run_pattern(words: int) -> regex.Pattern:
    """``words`` consecutive words of a collapsed text: look-arounds hold the match to whole words."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (words - 1))


def run_buckets(plain: bytes, patterns: list[regex.Pattern], buckets: int) -> np.ndarray:
    """Bucket of every run, repeats included. Overlapped scanning starts a match at each word."""
    return np.fromiter((crc32(m.group()) for p in patterns for m in p.finditer(plain, overlapped=True)), np.uint32) % np.uint32(buckets)


def features(texts: DataFrame, longest: int, buckets: int) -> DataFrame:
    """Per row of ``texts`` (doc_id, text): its words, its runs of 1 to ``longest`` words and how many fall into each bucket."""

    def run(batches: Iterator[pa.RecordBatch]):
        patterns = [run_pattern(n) for n in range(1, longest + 1)]
        for batch in batches:
            words, total, found, times = [], [], [], []
            for text in batch.column(1):
                plain = collapsed(text.as_py())
                at = run_buckets(plain, patterns, buckets)
                bucket, n = np.unique(at, return_counts=True)
                words.append(len(plain.split(b" ")) - plain.startswith(b" ") - plain.endswith(b" ") if plain.strip(b" ") else 0)
                total.append(len(at))
                found.append(bucket.astype(np.int32))
                times.append(n.astype(np.int32))
            ends = pa.array(np.concatenate([[0], np.cumsum([len(b) for b in found])]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.empty(0, np.int32), *x]))) for x in (found, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words, pa.int64()), pa.array(total, pa.int64()), *lists],
                                             names=["doc_id", "n_words", "n_features", "buckets", "times"])

    return texts.mapInArrow(run, FEATURES)


def bucket_totals(found: DataFrame, buckets: int) -> np.ndarray:
    """Runs in each bucket over all rows. A task gives one row a bucket at most, and so many reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]):
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(sums, batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy())
        used = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used])], names=["bucket", "n"])

    rows = found.select("buckets", "times").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    sums = np.zeros(buckets, np.int64)
    sums[rows.column("bucket").to_numpy()] = rows.column("n").to_numpy()
    return sums


def gains(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's share in the target to its share in the documents, one added to each bucket."""
    more = len(raw)
    t_all, s_all = float(target.sum() + more), float(raw.sum() + more)
    return np.asarray([math.floor(1000 * math.log(float(t + 1) * s_all / (float(s + 1) * t_all))) for t, s in zip(target.tolist(), raw.tolist())], np.int64)


def weigh(found: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features, weight: floored mean gain of a row's runs, 0 without any."""
    shared = found.sparkSession.sparkContext.broadcast(gain)  # one number a bucket

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            lists, times = batch.column(3), batch.column(4).flatten().to_numpy()
            worth = np.concatenate([[0], np.cumsum(shared.value[lists.flatten().to_numpy()] * times)]).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            n = batch.column(2).to_numpy()
            weight = np.where(n > 0, (worth[ends[1:]] - worth[ends[:-1]]) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in range(3)), pa.array(weight, pa.int64())], names=["doc_id", "n_words", "n_features", "weight"])

    return found.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def noise(doc_id: Column) -> Column:
    """Thousandths of a Gumbel variate decided by the doc_id alone; null ids share one."""
    digest = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("null"))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(float(UINT32)))))


def ranked(scored: DataFrame, eligible: Column, percent: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... by falling score, then doc_id (null last), for the drawn share of eligible rows; else null.

    Scores are whole numbers from the logarithms of doubles, so there are few different ones (some 100,000 at most): their counts
    tell where the drawing ends and how many rows stand above each score. Only equal scores are ordered among themselves.
    """
    counts = scored.where(eligible).groupBy("score").agg(F.count(F.lit(1)).alias("n")).toArrow()
    score, n = (counts.column(c).to_numpy().astype(np.int64) for c in ("score", "n"))
    order = np.argsort(-score)
    score, n = score[order], n[order]
    above = np.cumsum(n) - n
    drawn = int(n.sum()) * percent // 100
    reached = above < drawn
    offsets = scored.sparkSession.createDataFrame(pa.table({"score": pa.array(score[reached], pa.int64()), "above": pa.array(above[reached], pa.int64())}))
    lowest = F.lit(int(score[reached][-1]) if drawn else None).cast("long")
    inside = F.coalesce(eligible & (F.col("score") >= lowest), F.lit(False))
    place = F.row_number().over(Window.partitionBy("score").orderBy(F.col("doc_id").asc_nulls_last(), "n_features", "weight")) + F.col("above")
    columns = scored.columns
    top = scored.where(inside).join(F.broadcast(offsets), "score").withColumn("rank", place.cast("long"))
    return top.select(*columns, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")).unionByName(
        scored.where(~inside).withColumn("rank", F.lit(None).cast("long")))


def resample(docs: DataFrame, target: DataFrame, longest: int = 1, buckets: int = 10_000, min_words: int = 20, percent: int = 10) -> DataFrame:
    """doc_id, n_words, n_features, weight, score, rank of every row of ``docs`` (doc_id, text); ``target`` needs a text.

    A null text has no words and weight 0. Every row is a document of its own, also where a doc_id repeats or is null; rows that are alike
    in doc_id get neighbouring ranks if their scores are equal. Without documents there are no rows, without target texts all gains
    come from the documents. Other columns are ignored.
    """
    found = work_table(features(id_text(docs), longest, buckets), "features")
    aims = work_table(features(id_text(target.select(F.lit(0).alias("doc_id"), "text")), longest, buckets), "target-features")
    gain = gains(bucket_totals(aims, buckets), bucket_totals(found, buckets))
    scored = work_table(weigh(found, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"))), "scored")
    return ranked(scored, F.col("n_words") >= min_words, percent)


def resample_sql() -> str:
    """DuckDB twin of ``resample`` with its defaults. A word's crc32 is folded bit by bit over its bytes, once per distinct word."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = f"unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), '{word}'))"
    return f"""
WITH d AS (SELECT doc_id, {words} AS word FROM documents), b AS (SELECT {words} AS word FROM benchmark),
every AS (SELECT DISTINCT word, hex(encode(word)) AS h FROM (SELECT word FROM d UNION ALL SELECT word FROM b)),
bytes AS (SELECT word, list_transform(range(1, length(h), 2), lambda i: 16 * (strpos('0123456789ABCDEF', h[i:i]) - 1) + strpos('0123456789ABCDEF', h[i+1:i+1]) - 1) AS raw FROM every),
steps AS (SELECT word, list_prepend(4294967295::BIGINT, flatten(list_transform(raw, lambda x: [x, 0, 0, 0, 0, 0, 0, 0]))::BIGINT[]) AS s FROM bytes),
hashed AS (SELECT word, xor(list_reduce(s, lambda c, x: xor(xor(c, x) >> 1, 3988292384 * (xor(c, x) & 1))), 4294967295) % 10000 AS bucket FROM steps),
s AS (SELECT bucket, count(*) AS n FROM d JOIN hashed USING (word) GROUP BY bucket), t AS (SELECT bucket, count(*) AS n FROM b JOIN hashed USING (word) GROUP BY bucket),
gain AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + 10000)::DOUBLE
  / ((s.n + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS g FROM s LEFT JOIN t USING (bucket)),
w AS (SELECT doc_id, count(*) AS n_features, floor(sum(g)::DOUBLE / count(*))::BIGINT AS weight FROM d JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN w USING (doc_id)),
placed AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM scored LEFT JOIN placed USING (doc_id)
"""

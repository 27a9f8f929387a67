"""What the operators share: input columns, work tables, checked broadcasts, hash folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import new_folder, release_shuffles

# What separates words, and a word.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def id_text(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` as string, null text as empty; other columns go, so their names cannot clash."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def work_table(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, and later passes see the same rows in the same files.

    ``folder``: a work folder that is removed when what was made from the table is stored; without one the table stays.
    """
    return work_tables([df], name, folder)


def work_tables(parts: list[DataFrame], name: str, folder: str | None = None) -> DataFrame:
    """One table of frames with one schema, which are made one after the other, so that only one's shuffle files are there at a time."""
    spark = parts[0].sparkSession
    path = f"{folder}/{name}" if folder else new_folder(spark, f"llm-{name}")
    for i, part in enumerate(parts):
        part.write.mode("append" if i else "error").option("compression", "zstd").parquet(path)
        if len(parts) > 1:
            release_shuffles(spark)
    return spark.read.schema(parts[0].schema).parquet(path)


BROADCAST_ROWS = 2_000_000


def checked_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast hint where a written table of narrow rows is small, else left to a shuffled join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def row_key(doc_id: Column, text_hash: Column) -> Column:
    """One number for a doc_id and text; null doc_ids are told apart by text alone."""
    return F.xxhash64(doc_id.cast("long"), text_hash)


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose (doc_id, text_hash) is in ``gone``; null doc_ids are told apart by text alone."""
    keys = work_table(gone.select(F.xxhash64("doc_id", "text_hash").alias("gone_key")).distinct(), "gone")
    hashed = row_key(F.col("doc_id"), F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    rows = docs.select(F.struct("*").alias("source"), hashed.alias("row_key"))  # names of further columns cannot clash
    return rows.join(checked_broadcast(keys), F.col("row_key") == F.col("gone_key"), "left_anti").select("source.*")


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``; a null key belongs to fold -1."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % F.lit(folds), F.lit(-1))

"""Positions, ranks and running totals over a whole frame, without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stable

_ROW_BITS = 33  # monotonically_increasing_id(): partition above, row number within it below


def running_totals(df: DataFrame, order: list[str | Column], sums: list[str] = ()) -> DataFrame:
    """Add ``position`` (from 1) and, per column of ``sums``, ``cum_<column>`` (inclusive).

    Rows are range-partitioned, numbered inside their partition and offset by the totals of the
    partitions before it. The placement is checkpointed because range bounds are sampled: both
    readers below must see the same one. ``order`` must be unique, or a hot value would fill one
    range.
    """
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = stable(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftrightunsigned("_row", _ROW_BITS))
    totals = placed.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{c}") for c in sums])
    # One row per range partition, so the window and the broadcast are bounded by the partition count.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_n"),
        *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_t_{c}") for c in sums])
    local = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    out = placed.join(F.broadcast(offsets), "_part")
    columns = {"position": F.col("_n") + F.col("_row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1}
    for c in sums:
        columns[f"cum_{c}"] = F.col(f"_t_{c}") + F.sum(c).over(local)
    return out.withColumns(columns).drop("_row", "_part", "_n", *[f"_t_{c}" for c in sums])


def surrogate_keys(names: DataFrame, order: str, key: str) -> DataFrame:
    """Keys 1, 2, 3 … in sorted order of distinct names."""
    return running_totals(names, [order]).withColumn(key, F.col("position").cast("int")).drop("position")


#: Rows of a group that are ranked in one window partition, about.
SLICE_ROWS = 100_000


def hashed_rank(df: DataFrame, by: str, identity: list[str | Column], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add ``rank`` (from 1) inside each ``by`` group, in the order of the md5 of the identity. Groups are a closed list.

    A group may hold any share of the rows: it is cut into hash ranges of about ``slice_rows``, as many as its size asks for,
    ranked inside each, and shifted by the sizes of the ranges before.
    """
    ids = [F.col(c) if isinstance(c, str) else c for c in identity]
    hashed = df.withColumn("_hash", F.md5(F.concat_ws("|", *[c.cast("string") for c in ids])))
    slices = F.greatest(F.ceil(F.count(F.lit(1)) / slice_rows), F.lit(1))
    sizes = df.groupBy(F.col(by).alias("_by")).agg(slices.alias("_slices"))  # one row per class
    part = F.floor(F.conv(F.substring("_hash", 1, 8), 16, 10).cast("bigint") * F.col("_slices") / F.lit(1 << 32))
    hashed = hashed.join(F.broadcast(sizes), F.col(by).eqNullSafe(F.col("_by"))).withColumn("_slice", part).drop("_by", "_slices")
    before = Window.partitionBy(by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        hashed.groupBy(by, "_slice").agg(F.count(F.lit(1)).alias("_n"))
        .select(F.col(by).alias("_by"), F.col("_slice").alias("_s"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    )
    within = Window.partitionBy(by, "_slice").orderBy("_hash", *ids)
    return (
        hashed.withColumn("_rn", F.row_number().over(within))
        .join(shift, F.col(by).eqNullSafe(F.col("_by")) & (F.col("_slice") == F.col("_s")))
        .withColumn("rank", F.col("_shift") + F.col("_rn"))
        .drop("_hash", "_slice", "_n", "_by", "_s", "_shift", "_rn")
    )

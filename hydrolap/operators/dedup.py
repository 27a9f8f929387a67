"""Copies: first-wins choice, membership and counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .quantiles import _match


def _repeated(df: DataFrame, key: list[str], order: list[str] = ()) -> DataFrame:
    """Keys that occur more than once. Partial aggregation shrinks hot keys before the shuffle."""
    first = [F.min(F.struct(*order)).alias("_first")] if order else []
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *first).where("_n > 1")
        .withColumnsRenamed({c: f"_k_{c}" for c in key})
    )


def mark_first(df: DataFrame, key: list[str], order: list[str], flag: str = "is_first") -> DataFrame:
    """Flag the first row of each key in ``order`` (a total order). Reads ``df`` twice: give it a stored frame.

    Only keys that repeat are joined back, so a clean batch joins with almost nothing and a hot
    key is an ordinary skewed join instead of one window partition.
    """
    copies = _repeated(df, key, order)
    joined = df.join(copies, _match(key, [f"_k_{c}" for c in key]), "left")
    first = F.col("_first").isNull() | (F.struct(*order) == F.col("_first"))
    return joined.withColumn(flag, first).drop("_n", "_first", *[f"_k_{c}" for c in key])


def first_rows(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in ``order``: one aggregate over one pass. Tasks choose among their own rows before the
    shuffle, so a hot key arrives as one row a task."""
    first = F.min_by(F.struct(*[F.col(c) for c in df.columns]), F.struct(*order))
    return df.groupBy(*[F.col(c).alias(f"_k_{c}") for c in key]).agg(first.alias("_row")).select("_row.*")


def later_rows(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """All rows but the first of each key. Reads ``df`` twice: give it a stored frame."""
    return mark_first(df, key, order).where("NOT is_first").drop("is_first")


def duplicate_members(df: DataFrame, key: list[str]) -> DataFrame:
    """Every row whose key occurs more than once, first copies included. Reads ``df`` twice: give it a stored frame."""
    copies = _repeated(df, key).drop("_n")
    return df.join(copies, _match(key, [f"_k_{c}" for c in key]), "left_semi")


def duplicate_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: rows, extra copies, repeated groups and both percentages."""
    groups = df.groupBy(*(columns or df.columns)).agg(F.count(F.lit(1)).alias("_n"))
    counted = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("extra_rows"),
        F.count_if(F.col("_n") > 1).alias("duplicate_groups"),
    )
    total = F.nullif(F.col("rows").cast("double"), F.lit(0.0))
    return counted.withColumns({
        "pct_extra": F.col("extra_rows") * 100.0 / total,
        "pct_groups": F.col("duplicate_groups") * 100.0 / total,
    })

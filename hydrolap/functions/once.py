"""Evaluate derived columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_columns_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` whose results later filters cannot be rewritten through.

    A filter on a derived column is normally pushed below the projection, which copies the whole
    expression into the filter; a chain of such columns grows past what code generation accepts.
    Generator output is opaque to that rewrite, and costs one small row per record.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))

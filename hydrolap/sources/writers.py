"""Sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def land(df: DataFrame, path: str, batch: int) -> None:
    """Empty the staging folder and load the raw columns with batch id and load time."""
    (df.withColumns({"lote_id": F.lit(batch), "fecha_carga": F.current_timestamp()})
     .write.mode("overwrite").parquet(path))


def replace_batch(df: DataFrame, path: str, keys: list[str]) -> None:
    """Replace only the partitions present in ``df``."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*keys).parquet(path))


def append_log(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").parquet(path)  # one row


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """CSV with a header and a fixed column order; null becomes an empty field."""
    out = df.select(*columns) if columns else df
    out.write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(path)


def to_json_document(row_key: str, column_key: str, value: Column) -> Column:
    """Aggregate: one JSON object per group, the cells sorted by column key."""
    cells = F.array_sort(F.collect_list(F.struct(F.col(column_key).cast("string").alias("k"), value.alias("v"))))
    return F.to_json(F.map_from_entries(cells))

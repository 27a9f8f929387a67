"""The batch load, once per micro-batch, with or without a limit on how late rows may be."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..domain import LATE, Domain
from ..operators.cleaning import VALID, RawSchema, Run, Warehouse, _logged, begin, load_prepared, loaded_before, prepare
from ..operators.cleaning import run_batch
from ..operators.quantiles import _match
from ..session import broadcast_if_small, drop_folder, store, work_folder


def load_stream(arriving: DataFrame, warehouse: Warehouse, schema: RawSchema, domain: Domain, iteration: int,
                checkpoint: str) -> StreamingQuery:
    """Clean and load every micro-batch of raw rows against what is already stored.

    A replayed micro-batch finds its rows in the destination and replaces its own review rows, so
    delivery more than once has no effect. The state is the destination itself; nothing is kept in
    memory between batches.
    """

    def load(rows: DataFrame, batch_id: int) -> None:
        run_batch(rows, warehouse, schema, domain, batch_id, iteration, f"micro-lote {batch_id}")

    return (
        arriving.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def load_stream_within(arriving: DataFrame, warehouse: Warehouse, schema: RawSchema, domain: Domain, iteration: int,
                       checkpoint: str, delay: str) -> StreamingQuery:
    """``load_stream`` for rows that may be at most ``delay`` (as in ``withWatermark``) behind the latest date seen; later ones go to review.

    The key's state is kept by Spark until the watermark has passed its date. Rows go two ways to the same micro-batch: all of them, and through
    ``dropDuplicatesWithinWatermark`` those that are first of their key and in time. A valid row that is missing from the second is a
    copy if its key is known (there or in the destination), else it came too late.
    """
    rows = prepare(arriving, schema, domain)
    in_time = rows.where(F.col("route") == VALID).withColumn("_at", F.col("fecha").cast("timestamp")).withWatermark("_at", delay)
    firsts = in_time.dropDuplicatesWithinWatermark(schema.key).drop("_at").withColumn("_first", F.lit(True))
    both = rows.withColumn("_first", F.lit(False)).unionByName(firsts)

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = begin(spark, warehouse, batch_id, iteration, f"micro-lote {batch_id}")
        if not _logged(spark, warehouse, run):
            with work_folder(spark, f"stream-{batch_id}-{iteration}") as folder:
                stored = store(batch, f"{folder}/arrived")
                every = with_late_routed(stored, warehouse, schema, run, folder)
                load_prepared(every, arriving.columns, warehouse, schema, run, folder)
        drop_folder(spark, warehouse.manifest(batch_id, iteration))

    return (
        both.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def with_late_routed(stored: DataFrame, warehouse: Warehouse, schema: RawSchema, run: Run, folder: str) -> DataFrame:
    """All rows of a micro-batch, those that came too late under their own route."""
    order = list(schema.order)
    every, firsts = stored.where("NOT _first").drop("_first"), stored.where("_first")
    known = firsts.select(*schema.key)
    before = loaded_before(stored.sparkSession, warehouse, run)
    if before is not None:
        known = known.unionByName(before.select(*schema.key))
    known = known.select(*[F.col(c).alias(f"_k_{c}") for c in schema.key])
    late = every.where(F.col("route") == VALID).join(known, _match(schema.key, [f"_k_{c}" for c in schema.key]), "left_anti")
    late = store(late.select(*[F.col(c).alias(f"_l_{c}") for c in order], F.lit(True).alias("_late")), f"{folder}/late")
    joined = every.join(broadcast_if_small(late), _match(order, [f"_l_{c}" for c in order]), "left")
    return joined.withColumn("route", F.when(F.col("_late"), F.lit(LATE)).otherwise(F.col("route"))).select(*every.columns)

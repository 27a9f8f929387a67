"""Cleaning: normalise, route, type, choose first copies, load incrementally, log."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..domain import LATE, LATE_REASON, REJECT_REASONS, Domain
from ..functions import (
    is_missing, missing_to_category, month_agrees, normalise_place, null_if_missing, parse_date, risk_class, risk_group,
    safe_double,
)
from ..functions.dates import iso_text
from ..functions.once import with_columns_once
from ..functions.text import strip
from ..session import drop_folder, release_shuffles, work_folder, written
from ..sources.readers import _exists
from .dedup import first_rows, later_rows, mark_first
from .quantiles import _match

VALID, ACCEPTED, DUPLICATE = "VALID", "ACCEPTED", "P07"

#: From so many valid rows on, first copies of a batch are chosen in so many turns by a hash of the key, else at once.
TURN_ROWS, TURNS = 1_000_000, 8


@dataclass(frozen=True)
class RawSchema:
    """Where the cleaning steps find their columns. ``order`` is a total order of arrival."""

    order: tuple[str, ...]
    extra_key: tuple[str, ...] = ()
    date: str = "fecha_txt"
    month: str = "mes_txt"
    place: str = "place_txt"
    system: str = "system_txt"
    value: str = "irca_txt"
    scope: str = "scope"
    conversions: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def key(self) -> list[str]:
        return ["fecha", "place", "system", *self.extra_key]


# Raw column -> (typed column, type) of the published destination table.
WATER_CONVERSIONS = {
    "anio_txt": ("anio", "smallint"), "mes_txt": ("mes", "smallint"), "storage_txt": ("storage", "decimal(5,2)"),
    "inflow_txt": ("inflow", "decimal(8,2)"), "rain_txt": ("rain", "decimal(8,2)"),
    "temperature_txt": ("temperature", "decimal(5,2)"), "use_txt": ("water_use", "decimal(8,2)"),
    "latitude_txt": ("latitude", "decimal(9,6)"), "longitude_txt": ("longitude", "decimal(9,6)"),
    "coverage_txt": ("coverage", "decimal(5,2)"),
}


def convert(c: Column | str, kind: str) -> Column:
    """Text to a type; a missing marker and a failure are both null (tell them apart with `failed`)."""
    if kind == "date":
        return parse_date(c)
    if kind in ("int", "smallint", "bigint"):
        return strip(c).try_cast(kind)
    return safe_double(c) if kind == "double" else safe_double(c).try_cast(kind)


def failed(c: Column | str, kind: str) -> Column:
    return ~is_missing(c) & convert(c, kind).isNull()


def normalise(raw: DataFrame, s: RawSchema, domain: Domain) -> DataFrame:
    value = null_if_missing(s.value)
    return with_columns_once(raw, {
        "fecha_iso": iso_text(s.date),
        "place": normalise_place(s.place),
        "system": missing_to_category(s.system, domain.out_of_coverage),
        "irca_clean": value,
        "irca_reported": F.when(value.isNull(), "No").otherwise("Si"),
    })


def route(normalised: DataFrame, s: RawSchema, domain: Domain) -> DataFrame:
    """First rule that applies: scope, date, domain, conversion; else VALID. One reason per row."""
    number = safe_double("irca_clean")
    not_converted = F.col("fecha_iso").try_cast("date").isNull() | failed("irca_clean", "double")
    for column, (_, kind) in s.conversions.items():
        not_converted = not_converted | failed(column, kind)
    rule = (
        F.when(strip(s.scope) == domain.global_scope, "P05")
        .when(~month_agrees("fecha_iso", s.month), "P09")
        .when((number < 0) | (number > 100), "P08")
        .when(not_converted, "CONV")
        .otherwise(VALID)
    )
    return with_columns_once(normalised, {"route": rule})


def typed(routed: DataFrame, s: RawSchema) -> DataFrame:
    """Typed columns; the class is always recomputed from the index."""
    columns = {target: convert(source, kind) for source, (target, kind) in s.conversions.items()}
    out = routed.withColumns({**columns, "fecha": F.col("fecha_iso").try_cast("date"), "irca": safe_double("irca_clean")})
    return out.withColumns({"risk_class": risk_class("irca"), "risk_group": risk_group("irca")})


def prepare(raw: DataFrame, s: RawSchema, domain: Domain) -> DataFrame:
    return typed(route(normalise(raw, s, domain), s, domain), s)


def clean_records(raw: DataFrame, s: RawSchema, domain: Domain) -> DataFrame:
    """Accepted rows: valid, and first of their key."""
    return first_rows(prepare(raw, s, domain).where(F.col("route") == VALID), s.key, list(s.order))


def with_reason(rejects: DataFrame, rule: Column) -> DataFrame:
    """Rule, field and text of the rejection."""
    def pick(i: int) -> Column:
        out = F.lit(None).cast("string")
        for name, texts in {**REJECT_REASONS, LATE: LATE_REASON}.items():
            out = F.when(rule == name, F.lit(texts[i])).otherwise(out)
        return out

    return rejects.withColumns({"regla_id": rule, "campo_afectado": pick(0), "motivo": pick(1)})


def outcomes(raw: DataFrame, s: RawSchema, domain: Domain) -> DataFrame:
    """Every row with its end: ACCEPTED, P07 (later copy) or the rule that rejected it.

    Prepared rows are stored, as the choice of first copies reads the valid ones twice; rejected rows are never compared with each other.
    """
    rows = written(prepare(raw, s, domain), "prepared")
    valid = mark_first(rows.where(F.col("route") == VALID), s.key, list(s.order))
    rejected = rows.where(F.col("route") != VALID).withColumn("is_first", F.lit(True))
    final = F.when(F.col("route") != VALID, F.col("route")).when(F.col("is_first"), ACCEPTED).otherwise(DUPLICATE)
    return valid.unionByName(rejected).withColumn("outcome", final).drop("is_first")


def review_records(raw: DataFrame, s: RawSchema, domain: Domain) -> DataFrame:
    """Rejected rows with their original text, and later copies with theirs."""
    return with_reason(outcomes(raw, s, domain).where(F.col("outcome") != ACCEPTED), F.col("outcome"))


def split_loaded(rows: DataFrame, destination: DataFrame, key: list[str]) -> tuple[DataFrame, DataFrame]:
    """(already in the destination, new) on the key."""
    keys = destination.select(*[F.col(c).alias(f"_k_{c}") for c in key]).distinct()
    match = _match(key, [f"_k_{c}" for c in key])
    return rows.join(keys, match, "left_semi"), rows.join(keys, match, "left_anti")


def conversion_failures(rows: DataFrame, conversions: dict[str, str]) -> DataFrame:
    """Per column: how many texts do not convert (missing ones are counted apart)."""
    counts = rows.agg(*[
        F.struct(F.count_if(failed(c, k)).alias("fallidos"), F.count_if(is_missing(c)).alias("ausentes")).alias(c)
        for c, k in conversions.items()])
    lines = F.array(*[F.struct(F.lit(c).alias("columna"), F.col(f"{c}.fallidos"), F.col(f"{c}.ausentes")) for c in conversions])
    return counts.select(F.inline(lines))


@dataclass(frozen=True)
class Warehouse:
    """Folders of the destination, the review rows, the run log and the manifests of unfinished runs."""

    root: str

    @property
    def destination(self) -> str:
        return f"{self.root}/destination"

    @property
    def review(self) -> str:
        return f"{self.root}/review"

    @property
    def log(self) -> str:
        return f"{self.root}/log"

    def manifest(self, batch: int, iteration: int) -> str:
        return f"{self.root}/pending/lote_id={batch}/iteracion={iteration}"


LOG_SCHEMA = (
    "log_id bigint, lote_id int, iteracion int, fecha_inicio timestamp, fecha_fin timestamp, recibidos bigint, "
    "aceptados bigint, duplicados bigint, revision bigint, ya_cargados bigint, estado string, observacion string"
)
MANIFEST_SCHEMA = "log_id bigint, fecha_inicio timestamp, observacion string"


@dataclass(frozen=True)
class Run:
    """One run of a batch. What it stores lies in folders of its own, so that a retry replaces it."""

    log_id: int
    batch: int
    iteration: int
    started: dt.datetime
    note: str

    def accepted(self, warehouse: Warehouse) -> str:
        return f"{warehouse.destination}/iteracion={self.iteration}/log_id={self.log_id}"

    def review(self, warehouse: Warehouse) -> str:
        return f"{warehouse.review}/lote_id={self.batch}/iteracion={self.iteration}"


def begin(spark: SparkSession, warehouse: Warehouse, batch: int, iteration: int, note: str = "") -> Run:
    """The unfinished run of this batch, or a new one: its manifest is written before anything else."""
    path = warehouse.manifest(batch, iteration)
    left = spark.read.schema(MANIFEST_SCHEMA).parquet(path).first() if _exists(spark, path) else None
    if left is not None:
        return Run(left["log_id"], batch, iteration, left["fecha_inicio"], left["observacion"])
    started = dt.datetime.now(dt.timezone.utc)
    run = Run(int(started.timestamp() * 1_000_000), batch, iteration, started, note)
    spark.createDataFrame([(run.log_id, started, note)], MANIFEST_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)
    return run


def _logged(spark: SparkSession, warehouse: Warehouse, run: Run) -> bool:
    return _exists(spark, warehouse.log) and bool(
        spark.read.schema(LOG_SCHEMA).parquet(warehouse.log).where(F.col("log_id") == run.log_id).limit(1).count())


def loaded_before(spark: SparkSession, warehouse: Warehouse, run: Run) -> DataFrame | None:
    """Rows of the run's iteration in the destination, without those that this run stored before it failed."""
    if not _exists(spark, f"{warehouse.destination}/iteracion={run.iteration}"):
        return None
    return spark.read.parquet(warehouse.destination).where((F.col("iteracion") == run.iteration) & (F.col("log_id") != run.log_id))


def _replace(df: DataFrame, path: str) -> int:
    """Store rows in the run's folder in place of any earlier ones, and count what is there."""
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).count()


def _append_log(spark: SparkSession, warehouse: Warehouse, line: tuple) -> None:
    spark.createDataFrame([line], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(warehouse.log)


def _turn(key: list[str], types: StructType) -> Column:
    """The turn of a key. Equal keys have one turn, whatever the types of the frame that they stand in: those of ``types`` count."""
    return F.pmod(F.xxhash64(*[F.col(c).try_cast(types[c].dataType) for c in key]), F.lit(TURNS)).cast("int")


def mark_stored(done: DataFrame, path: str, before: DataFrame | None, s: RawSchema, turns: bool, out: str) -> DataFrame:
    """The valid rows of ``done`` (stored under ``path`` by route and ``_turn``) whose keys are not in ``before``, with ``is_first``, stored in ``out``.

    With ``turns`` the keys of one turn are taken at a time: only its rows are in a shuffle, and its stored rows go when they are marked.
    """
    spark, fresh = done.sparkSession, done.where(F.col("route") == VALID)
    for turn in range(TURNS) if turns else [None]:
        rows, loaded = fresh, before
        if turns:
            rows = fresh.where(F.col("_turn") == turn)
            loaded = None if before is None else before.where(_turn(s.key, done.schema) == turn)
        rows = rows.drop("_turn")
        if loaded is not None:
            _, rows = split_loaded(rows, loaded, s.key)
        marked = mark_first(rows, s.key, list(s.order))
        marked.write.mode("append").option("compression", "zstd").parquet(out)
        if turns:
            drop_folder(spark, f"{path}/route={VALID}/_turn={turn}")
            release_shuffles(spark)
    return spark.read.schema(marked.schema).parquet(out)


def load_prepared(rows: DataFrame, columns: list[str], warehouse: Warehouse, s: RawSchema, run: Run, folder: str) -> None:
    """Store a run's prepared rows (``columns``: the raw ones): review rows, then accepted rows, then its log line.

    Rows are stored first, by route, in a work folder. The choice of first copies follows a total order, so a retry chooses the same rows. Rows
    already loaded are found before copies are: a re-run counts both copies as loaded. Counts in the log come from what is stored.
    """
    spark, path = rows.sparkSession, f"{folder}/rows"
    placed = rows.withColumn("_turn", F.when(F.col("route") == VALID, _turn(s.key, rows.schema)).otherwise(0))
    placed.write.option("compression", "zstd").partitionBy("route", "_turn").parquet(path)
    release_shuffles(spark)
    done = spark.read.schema(placed.schema).parquet(path)
    received, valid = done.agg(F.count(F.lit(1)), F.count_if(F.col("route") == VALID)).first()
    marked = mark_stored(done, path, loaded_before(spark, warehouse, run), s, valid >= TURN_ROWS, f"{folder}/marked")
    known = valid - marked.count()
    copies = marked.where("NOT is_first").drop("is_first").withColumn("route", F.lit(DUPLICATE))
    rejected = with_reason(done.where(F.col("route") != VALID).drop("_turn").unionByName(copies), F.col("route")).select(
        *columns, "regla_id", "campo_afectado", "motivo")
    reviewed = _replace(rejected, run.review(warehouse))
    duplicates = spark.read.schema(rejected.schema).parquet(run.review(warehouse)).where(F.col("regla_id") == DUPLICATE).count()
    # The destination comes after the review rows: these were chosen against it as it was.
    accepted = _replace(marked.where("is_first").drop("is_first", "route").withColumn("lote_id", F.lit(run.batch)), run.accepted(warehouse))
    ended = dt.datetime.now(dt.timezone.utc)
    _append_log(spark, warehouse, (run.log_id, run.batch, run.iteration, run.started, ended, received, accepted, duplicates,
                                   reviewed - duplicates, known, "OK", run.note))


def run_batch(raw: DataFrame, warehouse: Warehouse, s: RawSchema, domain: Domain, batch: int, iteration: int, note: str = "") -> None:
    """Load one batch. A second run of the same batch accepts nothing and leaves the same review rows.

    A manifest marks the run as begun and goes when its log line is stored. If a run fails in between, the next call for the same batch
    and iteration takes it up again under its number: whatever it had stored is replaced, and a run that had its log line is only closed.
    Prepared rows are stored once in a work folder that is removed on success and on failure.
    """
    spark = raw.sparkSession
    run = begin(spark, warehouse, batch, iteration, note)
    if not _logged(spark, warehouse, run):
        with work_folder(spark, f"batch-{batch}-{iteration}") as folder:
            load_prepared(prepare(raw, s, domain), raw.columns, warehouse, s, run, folder)
    drop_folder(spark, warehouse.manifest(batch, iteration))


def control(log: DataFrame) -> DataFrame:
    """Received = accepted + copies + review + already loaded, per run."""
    total = F.col("aceptados") + F.col("duplicados") + F.col("revision") + F.col("ya_cargados")
    return log.select("log_id", "lote_id", "iteracion", "recibidos", total.alias("suma"),
                      (F.col("aceptados") + F.col("duplicados")).alias("nuevos"), (F.col("recibidos") == total).alias("cuadra"))


def compare_runs(log: DataFrame) -> DataFrame:
    """First against last run of each iteration that ran at least twice."""
    row = F.struct("aceptados", "ya_cargados", "revision")
    ends = log.groupBy("iteracion").agg(
        F.count(F.lit(1)).alias("ejecuciones"), F.min_by(row, "log_id").alias("a"), F.max_by(row, "log_id").alias("z"))
    return ends.where("ejecuciones >= 2").select(
        "iteracion", "ejecuciones", (F.col("a.aceptados") - F.col("z.aceptados")).alias("delta_aceptados"),
        (F.col("z.ya_cargados") - F.col("a.ya_cargados")).alias("delta_ya_cargados"),
        (F.col("a.revision") == F.col("z.revision")).alias("misma_revision"))


def real_load(log: DataFrame) -> DataFrame:
    """The load of the last iteration that found nothing loaded before; its first run if there is none."""
    last = log.agg(F.max_by("iteracion", "log_id").alias("_last"))  # one row
    rank = F.struct((F.col("ya_cargados") != 0), "log_id")
    return log.join(F.broadcast(last), F.col("iteracion") == F.col("_last")).drop("_last") \
        .agg(F.min_by(F.struct(*log.columns), rank).alias("r")).select("r.*")


__all__ = [
    "ACCEPTED", "DUPLICATE", "LATE", "RawSchema", "VALID", "WATER_CONVERSIONS", "Warehouse", "clean_records",
    "compare_runs", "control", "conversion_failures", "convert", "failed", "first_rows", "later_rows", "normalise",
    "outcomes", "prepare", "real_load", "review_records", "route", "run_batch", "split_loaded", "typed", "with_reason",
]

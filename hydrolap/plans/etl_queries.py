"""Cleaning and incremental loading over the dirty view."""

from pyspark.sql import functions as F

from ..domain import TRADE
from ..operators import cleaning as cl
from ..operators.dedup import duplicate_members as members
from ..session import new_folder, written
from .registry import query
from .views import RAW_ORDER, Tables

SCHEMA = cl.RawSchema(
    order=tuple(RAW_ORDER),
    extra_key=("l_linenumber",),
    conversions={"rain_txt": ("rain", "double"), "storage_txt": ("storage", "double")},
)
_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey, copy_no"
_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "copy_no"]
_CLEAN = "fecha, place, system, irca, irca_reported, risk_class, TRY_CAST(rain_txt AS DOUBLE) AS rain, TRY_CAST(storage_txt AS DOUBLE) AS storage"
_CLEAN_COLUMNS = ["fecha", "place", "system", "irca", "irca_reported", "risk_class", "rain", "storage"]
_REASONS = ", ".join(
    "('{}', '{}', '{}')".format(rule, field, text) for rule, (field, text) in cl.REJECT_REASONS.items())


@query("route_records", views="valid", sql=f"SELECT {_ID}, route FROM routed")
def route_records(t: Tables):
    return cl.route(cl.normalise(t.raw, SCHEMA, TRADE), SCHEMA, TRADE).select(*_KEYS, "route")


@query("convert_or_reject", views="valid", sql=f"""
SELECT {_ID}, fecha, irca, TRY_CAST(rain_txt AS DOUBLE) AS rain, TRY_CAST(storage_txt AS DOUBLE) AS storage, route = 'CONV' AS rejected FROM routed
WHERE route IN ('CONV', 'VALID')""")
def convert_or_reject(t: Tables):
    rows = cl.prepare(t.raw, SCHEMA, TRADE).where(F.col("route").isin("CONV", cl.VALID))
    return rows.select(*_KEYS, "fecha", "irca", "rain", "storage", (F.col("route") == "CONV").alias("rejected"))


@query("conversion_failures", views="valid", sql="""
SELECT c AS columna, count(*) FILTER (WHERE v <> '' AND lower(v) <> 'n/a' AND TRY_CAST(v AS DOUBLE) IS NULL) AS fallidos,
 count(*) FILTER (WHERE v = '' OR lower(v) = 'n/a') AS ausentes FROM (
 SELECT 'irca_txt' AS c, irca_txt AS v FROM raw UNION ALL SELECT 'rain_txt', rain_txt FROM raw UNION ALL SELECT 'storage_txt', storage_txt FROM raw
 UNION ALL SELECT 'use_txt', use_txt FROM raw) x GROUP BY c""")
def conversion_failures(t: Tables):
    return cl.conversion_failures(t.raw, {c: "double" for c in ("irca_txt", "rain_txt", "storage_txt", "use_txt")})


@query("clean_records", views="valid", sql=f"SELECT {_ID}, {_CLEAN} FROM valid WHERE rn = 1")
def clean_records(t: Tables):
    return cl.clean_records(t.raw, SCHEMA, TRADE).select(*_KEYS, *_CLEAN_COLUMNS)


def _valid(t: Tables):
    return cl.prepare(t.raw, SCHEMA, TRADE).where(F.col("route") == cl.VALID)


@query("dedup_accept", views="valid", sql=f"SELECT {_ID}, fecha, place, system FROM valid WHERE rn = 1")
def dedup_accept(t: Tables):
    return cl.first_rows(_valid(t).select(*RAW_ORDER, "fecha", "place", "system"), SCHEMA.key, RAW_ORDER).select(*_KEYS, "fecha", "place", "system")


@query("dedup_reject", views="valid", sql=f"SELECT {_ID}, fecha, place, system FROM valid WHERE rn > 1")
def dedup_reject(t: Tables):
    valid = written(_valid(t).select(*RAW_ORDER, "fecha", "place", "system"), "valid")
    return cl.later_rows(valid, SCHEMA.key, RAW_ORDER).select(*_KEYS, "fecha", "place", "system")


@query("duplicate_members", views="valid", sql=f"""
SELECT {_ID}, place FROM (SELECT *, count(*) OVER (PARTITION BY fecha, place, system, l_linenumber) AS n FROM valid) v WHERE n > 1""")
def duplicate_members(t: Tables):
    valid = written(_valid(t).select(*RAW_ORDER, "fecha", "place", "system"), "valid")
    return members(valid, SCHEMA.key).select(*_KEYS, "place")


_ENDS = f"""SELECT r.{_ID.replace(', ', ', r.')}, fecha_txt, irca_txt,
 CASE WHEN route = 'VALID' THEN 'P07' ELSE route END AS regla_id FROM routed r
 LEFT JOIN (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, copy_no, rn FROM valid) v
 USING (l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, copy_no) WHERE route <> 'VALID' OR rn > 1"""


@query("review_records", views="valid", sql=f"""
SELECT e.*, campo_afectado, motivo FROM ({_ENDS}) e JOIN (VALUES {_REASONS}) x(rule, campo_afectado, motivo) ON rule = regla_id""")
def review_records(t: Tables):
    return cl.review_records(t.raw, SCHEMA, TRADE).select(*_KEYS, "fecha_txt", "irca_txt", "regla_id", "campo_afectado", "motivo")


@query("review_union", views="valid", sql=f"SELECT regla_id, scope, count(*) AS n FROM ({_ENDS.replace('fecha_txt', 'scope, fecha_txt')}) e GROUP BY ALL")
def review_union(t: Tables):
    """The reject streams together; one routed frame, so their union costs no extra pass."""
    return cl.review_records(t.raw, SCHEMA, TRADE).groupBy("regla_id", "scope").agg(F.count(F.lit(1)).alias("n"))


@query("review_examples", views="valid", sql=f"""
SELECT {_ID}, irca_txt FROM routed WHERE route = 'P08' ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, copy_no LIMIT 15""")
def review_examples(t: Tables):
    rows = cl.route(cl.normalise(t.raw, SCHEMA, TRADE), SCHEMA, TRADE).where(F.col("route") == "P08")
    return rows.orderBy(*RAW_ORDER).limit(15).select(*_KEYS, "irca_txt")


_MATCH = "d.fecha = v.fecha AND d.place = v.place AND d.system = v.system AND d.l_linenumber = v.l_linenumber"
_DEST = "SELECT fecha, place, system, l_linenumber FROM valid WHERE rn = 1 AND year(fecha) < 2000"


def _split(t: Tables):
    valid = written(_valid(t).select(*RAW_ORDER, "fecha", "place", "system"), "valid")
    destination = cl.first_rows(valid, SCHEMA.key, RAW_ORDER).where(F.year("fecha") < 2000)
    return cl.split_loaded(valid, destination, SCHEMA.key)


@query("load_already", views="valid", sql=f"""
SELECT {_ID}, fecha FROM valid v WHERE EXISTS (SELECT 1 FROM ({_DEST}) d WHERE {_MATCH})""")
def load_already(t: Tables):
    return _split(t)[0].select(*_KEYS, "fecha")


@query("load_new", views="valid", sql=f"""
SELECT {_ID}, fecha FROM valid v WHERE NOT EXISTS (SELECT 1 FROM ({_DEST}) d WHERE {_MATCH})""")
def load_new(t: Tables):
    return _split(t)[1].select(*_KEYS, "fecha")


@query("before_after_dates", views="valid", sql="""
SELECT DISTINCT s.fecha_txt AS fecha_original, d.fecha AS fecha_corregida, d.place FROM raw s
JOIN (SELECT fecha, place FROM valid WHERE rn = 1) d ON d.place = upper(trim(s.place_txt)) AND d.fecha = CAST(try_strptime(s.fecha_txt, '%d/%m/%Y') AS DATE)
WHERE s.fecha_txt LIKE '%/%'""")
def before_after_dates(t: Tables):
    """Staged rows next to the destination row they became, joined on computed keys."""
    raw = written(t.raw, "raw")
    loaded = cl.clean_records(raw, SCHEMA, TRADE).select("fecha", "place").distinct()
    staged = raw.where(F.contains("fecha_txt", F.lit("/"))).select(
        F.col("fecha_txt").alias("fecha_original"), cl.normalise_place("place_txt").alias("place"),
        F.when(F.col("fecha_txt").rlike(r"^\d{2}/\d{2}/\d{4}$"), F.try_to_date("fecha_txt", "dd/MM/yyyy")).alias("fecha")).distinct()
    return staged.join(loaded, ["place", "fecha"]).select("fecha_original", F.col("fecha").alias("fecha_corregida"), "place")


@query("dest_completeness", views="valid", sql="""
SELECT count(*) AS total, round(1e2 * count(TRY_CAST(rain_txt AS DOUBLE)) / count(*), 6) AS pct_precipitacion,
 round(1e2 * count(TRY_CAST(storage_txt AS DOUBLE)) / count(*), 6) AS pct_almacenamiento, round(1e2 * count(irca) / count(*), 6) AS pct_irca
FROM valid WHERE rn = 1""")
def dest_completeness(t: Tables):
    rows = cl.clean_records(t.raw, SCHEMA, TRADE)
    total = F.count(F.lit(1))
    share = lambda c: F.round(F.count(c) * 100.0 / F.nullif(total.cast("double"), F.lit(0.0)), 6)
    return rows.agg(total.alias("total"), share("rain").alias("pct_precipitacion"), share("storage").alias("pct_almacenamiento"), share("irca").alias("pct_irca"))


_COUNTS = """SELECT (SELECT count(*) FROM raw) AS recibidos, (SELECT count(*) FROM valid WHERE rn = 1) AS aceptados,
 (SELECT count(*) FROM valid WHERE rn > 1) AS duplicados, (SELECT count(*) FROM routed WHERE route <> 'VALID') AS revision"""


def _log(t: Tables, runs: list[tuple[int, int]]):
    warehouse = cl.Warehouse(new_folder(t.spark, "warehouse"))
    for batch, iteration in runs:
        cl.run_batch(t.raw, warehouse, SCHEMA, TRADE, batch, iteration, f"iteracion {iteration}")
    return warehouse, t.spark.read.parquet(warehouse.log)


@query("etl_run_log", views="valid", sql=f"""
SELECT 1 AS lote_id, 2 AS iteracion, recibidos, aceptados, duplicados, revision, 0::BIGINT AS ya_cargados, 'OK' AS estado,
 'iteracion 2' AS observacion, TRUE AS en_orden FROM ({_COUNTS}) c""")
def etl_run_log(t: Tables):
    _, log = _log(t, [(1, 2)])
    return log.select("lote_id", "iteracion", "recibidos", "aceptados", "duplicados", "revision", "ya_cargados", "estado", "observacion",
                      (F.col("fecha_inicio") <= F.col("fecha_fin")).alias("en_orden"))


@query("etl_control", views="valid", sql=f"""
SELECT 1 AS lote_id, 1 AS iteracion, recibidos, recibidos AS suma, aceptados + duplicados AS nuevos, TRUE AS cuadra FROM ({_COUNTS}) c""")
def etl_control(t: Tables):
    _, log = _log(t, [(1, 1)])
    return cl.control(log).drop("log_id")


@query("etl_rerun", views="valid", sql=f"""
SELECT 'primera' AS ejecucion, recibidos, aceptados, duplicados, revision, 0::BIGINT AS ya_cargados, aceptados AS en_destino, revision + duplicados AS en_revision FROM ({_COUNTS}) c
UNION ALL SELECT 'segunda', recibidos, 0, 0, revision, aceptados + duplicados, aceptados, revision FROM ({_COUNTS}) c""")
def etl_rerun(t: Tables):
    """The same batch twice: nothing new, the same review rows, one copy of the destination."""
    warehouse, log = _log(t, [(1, 3)])
    stored = lambda: (t.spark.read.parquet(warehouse.destination).count(), t.spark.read.parquet(warehouse.review).count())
    first = stored()
    cl.run_batch(t.raw, warehouse, SCHEMA, TRADE, 1, 3)
    second = stored()
    log = t.spark.read.parquet(warehouse.log)
    start = log.agg(F.min("log_id").alias("_first"))
    is_first = F.col("log_id") == F.col("_first")
    pick = lambda i: F.when(is_first, F.lit(first[i])).otherwise(F.lit(second[i])).cast("bigint")
    return log.join(F.broadcast(start)).select(
        F.when(is_first, "primera").otherwise("segunda").alias("ejecucion"), "recibidos", "aceptados", "duplicados", "revision",
        "ya_cargados", pick(0).alias("en_destino"), pick(1).alias("en_revision"))


@query("run_comparison", views="valid", sql=f"""
SELECT 3 AS iteracion, 2::BIGINT AS ejecuciones, aceptados AS delta_aceptados, aceptados + duplicados AS delta_ya_cargados, TRUE AS misma_revision FROM ({_COUNTS}) c""")
def run_comparison(t: Tables):
    _, log = _log(t, [(1, 2), (1, 3), (1, 3)])
    return cl.compare_runs(log)

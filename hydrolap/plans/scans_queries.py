"""Sources, sinks, filters."""

from pyspark.sql import functions as F

from ..domain import RISK_DIMENSION, TRADE
from ..operators import cube, filters
from ..session import new_folder
from ..sources import readers, writers
from .registry import query
from .views import ORDER, Tables


@query("scan_csv_text", views=None, sql="""
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""")
def scan_csv_text(t: Tables):
    path = new_folder(t.spark, "customer-csv")
    writers.write_csv(t["customer"].select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), path)
    return readers.read_text_csv(t.spark, path, ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"], encoding="windows-1252")


@query("scan_missing_empty", views=None, sql="""
SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name FROM nation""")
def scan_missing_empty(t: Tables):
    absent = readers.read_or_empty(t.spark, t.path("absent_table"), ["n_nationkey", "n_name"])
    return absent.unionByName(t["nation"].select(F.col("n_nationkey").cast("string"), "n_name"))


@query("scan_table", views=None, sql="""
SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_orderstatus""")
def scan_table(t: Tables):
    orders = readers.read_table(t.spark, t.path("orders"))
    return orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("land_staging", views="raw", sql="""
SELECT l_orderkey, l_linenumber, copy_no, fecha_txt, place_txt, irca_txt, 7 AS lote_id, TRUE AS has_load_time FROM raw""")
def land_staging(t: Tables):
    path = new_folder(t.spark, "staging")
    columns = ["l_orderkey", "l_linenumber", "copy_no", "fecha_txt", "place_txt", "irca_txt"]
    writers.land(t.raw.select(*columns), path, 7)
    return readers.read_table(t.spark, path).select(*columns, "lote_id", F.col("fecha_carga").isNotNull().alias("has_load_time"))


@query("sink_csv_roundtrip", views="raw", sql="""
SELECT l_orderkey, copy_no, fecha_txt, place_txt, irca_txt FROM raw""")
def sink_csv_roundtrip(t: Tables):
    columns = ["l_orderkey", "copy_no", "fecha_txt", "place_txt", "irca_txt"]
    path = new_folder(t.spark, "raw-csv")
    # Blanks at both ends are content here, so the reader and the writer must keep them.
    out = t.raw.select(*columns)
    out.write.mode("overwrite").option("header", True).option("emptyValue", "") \
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    back = readers.read_text_csv(t.spark, path, columns)
    return back.select(F.col("l_orderkey").cast("bigint"), F.col("copy_no").cast("int"), "fecha_txt", "place_txt", "irca_txt")


_DIM_RISK_SQL = ", ".join(
    "({}, '{}', '{}', {}, {}, {})".format(
        k, c, g, "NULL" if lo is None else lo, "NULL" if hi is None else hi, o) for k, c, g, lo, hi, o in RISK_DIMENSION)


@query("dim_risk", sql=f"""
SELECT d.riesgo_key, d.clasificacion, d.grupo_riesgo, CAST(d.rango_min AS DOUBLE) AS rango_min, CAST(d.rango_max AS DOUBLE) AS rango_max,
 d.orden, count(m.l_orderkey) AS mediciones
FROM (VALUES {_DIM_RISK_SQL}) d(riesgo_key, clasificacion, grupo_riesgo, rango_min, rango_max, orden)
LEFT JOIN measure m ON coalesce(m.risk_class, 'Sin dato de IRCA') = d.clasificacion GROUP BY ALL""")
def dim_risk(t: Tables):
    from ..operators.star import risk_dimension
    used = t.measure.groupBy(F.coalesce("risk_class", F.lit("Sin dato de IRCA")).alias("clasificacion")).agg(F.count(F.lit(1)).alias("n"))
    return risk_dimension(t.spark).join(used, "clasificacion", "left").select(
        "riesgo_key", "clasificacion", "grupo_riesgo", "rango_min", "rango_max", "orden",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("mediciones"))


@query("dim_service", sql="""
SELECT d.servicio_key, d.nivel_servicio, d.es_continuo, d.orden, count(m.l_orderkey) AS mediciones
FROM (VALUES (0, 'Desconocido', 0, 0), (1, 'Continuous', 1, 1), (2, 'Intermittent', 0, 2), (3, 'Rationed', 0, 3), (4, 'No service', 0, 4))
 d(servicio_key, nivel_servicio, es_continuo, orden)
LEFT JOIN measure m ON m.service = d.nivel_servicio GROUP BY ALL""")
def dim_service(t: Tables):
    from ..operators.star import service_dimension
    used = t.measure.groupBy(F.col("service").alias("nivel_servicio")).agg(F.count(F.lit(1)).alias("n"))
    return service_dimension(t.spark, TRADE).join(used, "nivel_servicio", "left").select(
        "servicio_key", "nivel_servicio", "es_continuo", "orden", F.coalesce("n", F.lit(0)).cast("bigint").alias("mediciones"))


@query("matrix_json", sql="""
SELECT region, '{' || string_agg('"' || service || '":' || CAST(n AS VARCHAR), ',' ORDER BY service) || '}' AS cells
FROM (SELECT region, service, count(*) AS n FROM measure GROUP BY ALL) c GROUP BY region""")
def matrix_json(t: Tables):
    cells = t.measure.groupBy("region", "service").agg(F.count(F.lit(1)).alias("n"))
    return cells.groupBy("region").agg(writers.to_json_document("region", "service", F.col("n")).alias("cells"))


@query("filter_optional", sql="""
SELECT l_orderkey, l_linenumber, fecha, place, service, irca FROM measure WHERE region = 'EUROPE' AND anio BETWEEN 2000 AND 2001""")
def filter_optional(t: Tables):
    wanted = {"region": "EUROPE", "anio": "Todos", "periodo": "2000-2001", "servicio": "", "color": "red"}
    return filters.filter_optional(t.measure, wanted, TRADE).select("l_orderkey", "l_linenumber", "fecha", "place", "service", "irca")


@query("filter_in", sql="""
SELECT l_orderkey, l_linenumber, region, anio, system, storage FROM measure
WHERE region IN ('EUROPE', 'ASIA') AND anio IN (1999, 2001) AND system IN ('BUILDING', 'MACHINERY')""")
def filter_in(t: Tables):
    wanted = {"region": ["EUROPE", "ASIA"], "anio": ["1999", "2001"], "sistema": ["BUILDING", "MACHINERY"], "riesgo": "Todos"}
    return filters.filter_in(t.measure, wanted).select("l_orderkey", "l_linenumber", "region", "anio", "system", "storage")


@query("filter_named_period", sql="""
SELECT anio, count(*) AS n FROM measure WHERE anio BETWEEN 1995 AND 1999 GROUP BY anio""")
def filter_named_period(t: Tables):
    return t.measure.where(filters.named_period(TRADE, "1995-1999")).groupBy("anio").agg(F.count(F.lit(1)).alias("n"))


@query("filter_options", sql="""
SELECT DISTINCT filtro, valor FROM (
 SELECT 'region' AS filtro, region AS valor FROM measure UNION ALL SELECT 'departamento', department FROM measure
 UNION ALL SELECT 'anio', CAST(anio AS VARCHAR) FROM measure UNION ALL SELECT 'trimestre', periodo FROM measure
 UNION ALL SELECT 'sistema', system FROM measure UNION ALL SELECT 'servicio', service FROM measure
 UNION ALL SELECT 'riesgo', risk_group FROM measure WHERE risk_group <> 'Sin dato') x""")
def filter_options(t: Tables):
    return cube.filter_options(t.measure)


@query("selection_label", sql="""
SELECT region, anio, 'Región = ' || region || ' | Año = ' || CAST(anio AS VARCHAR) AS seleccion, count(*) AS n
FROM measure GROUP BY region, anio""")
def selection_label(t: Tables):
    label = F.concat_ws(" | ", F.concat(F.lit("Región = "), "region"), F.concat(F.lit("Año = "), F.col("anio").cast("string")))
    return t.measure.groupBy("region", "anio").agg(F.count(F.lit(1)).alias("n")).select("region", "anio", label.alias("seleccion"), "n")


@query("order_by_catalogue", sql="""
SELECT service AS grupo, CASE service WHEN 'Continuous' THEN 1 WHEN 'Intermittent' THEN 2 WHEN 'Rationed' THEN 3 ELSE 4 END AS orden,
 count(*) AS n FROM measure GROUP BY service""")
def order_by_catalogue(t: Tables):
    counts = t.measure.groupBy(F.col("service").alias("grupo")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("grupo", cube.catalogue_order("servicio", TRADE, "grupo").alias("orden"), "n").orderBy("orden")


@query("union_scopes", sql="""
SELECT 'dia' AS grano, fecha, region, place, irca FROM measure
UNION ALL SELECT 'anio', make_date(anio, 6, 30), region, NULL, CAST(avg(irca) AS DOUBLE)
FROM measure GROUP BY anio, region""")
def union_scopes(t: Tables):
    """Yearly rows of a coarser scope appended to the daily rows; columns they lack stay null."""
    daily = t.measure.select(F.lit("dia").alias("grano"), "fecha", "region", "place", "irca")
    yearly = t.measure.groupBy("anio", "region").agg(F.avg("irca").alias("irca")).select(
        F.lit("anio").alias("grano"), F.make_date("anio", F.lit(6), F.lit(30)).alias("fecha"), "region", "irca")
    return daily.unionByName(yearly, allowMissingColumns=True)

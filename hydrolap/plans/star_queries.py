"""Star schema and its checks."""

from pyspark.sql import functions as F

from ..domain import TRADE
from ..operators import cube, star as st
from .registry import query
from .views import ORDER, Tables

_TIME = """SELECT DISTINCT CAST(strftime(fecha, '%Y%m%d') AS INTEGER) AS fecha_key, strftime(fecha, '%Y-%m-%d') AS fecha, anio, trimestre,
 periodo AS anio_trimestre, mes, (['Enero','Febrero','Marzo','Abril','Mayo','Junio','Julio','Agosto','Septiembre','Octubre','Noviembre','Diciembre'])[mes] AS nombre_mes,
 strftime(fecha, '%Y-%m') AS anio_mes, CAST(day(fecha) AS INTEGER) AS dia FROM measure
 UNION ALL SELECT 0, 'Desconocida', 0, 0, 'Desconocido', 0, 'Desconocido', 'Desconocido', 0"""
_GEO = """SELECT CAST(row_number() OVER (ORDER BY municipio) AS INTEGER) AS municipio_key, municipio, departamento, tipo_region FROM (
 SELECT place AS municipio, department AS departamento, region AS tipo_region FROM (
  SELECT *, row_number() OVER (PARTITION BY place ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM measure) m
 WHERE rn = 1) g UNION ALL SELECT 0, 'Desconocido', 'Desconocido', 'Desconocido'"""
_SYS = """SELECT CAST(row_number() OVER (ORDER BY system) AS INTEGER) AS sistema_key, system AS sistema, 1 AS cubierto
 FROM (SELECT DISTINCT system FROM measure) s UNION ALL SELECT 0, 'Desconocido', 0"""
_FACT = f"""SELECT md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT))) AS id_medicion,
 CAST(strftime(fecha, '%Y%m%d') AS INTEGER) AS fecha_key, g.municipio_key, s.sistema_key,
 CASE WHEN irca IS NULL THEN 6 WHEN irca <= 5 THEN 1 WHEN irca <= 14 THEN 2 WHEN irca <= 28 THEN 3 WHEN irca <= 40 THEN 4 ELSE 5 END AS riesgo_key,
 CASE service WHEN 'Continuous' THEN 1 WHEN 'Intermittent' THEN 2 WHEN 'Rationed' THEN 3 ELSE 4 END AS servicio_key,
 irca, CASE WHEN irca IS NULL THEN 0 ELSE 1 END AS irca_reportado, coverage AS cobertura_acueducto_pct,
 storage AS nivel_almacenamiento_pct, rain AS precipitacion_mm, water_use AS consumo_m3s
 FROM measure m JOIN ({_GEO}) g ON g.municipio = m.place JOIN ({_SYS}) s ON s.sistema = m.system"""


def _star(t: Tables) -> st.Star:
    return st.build_star(t.measure, TRADE, ORDER)


@query("dim_time", sql=_TIME)
def dim_time(t: Tables):
    return st.time_dimension(t.measure)


@query("dim_geography", sql=_GEO)
def dim_geography(t: Tables):
    return st.geography_dimension(t.measure, ORDER)


@query("dim_system", sql=_SYS)
def dim_system(t: Tables):
    return st.system_dimension(t.measure, TRADE)


@query("fact_load", sql=_FACT)
def fact_load(t: Tables):
    return _star(t).fact


@query("star_join", sql=f"""
WITH f AS ({_FACT}) SELECT f.id_medicion, m.anio_trimestre, g.municipio, s.sistema, f.irca,
 CASE WHEN f.riesgo_key = 6 THEN 'Sin dato' WHEN f.riesgo_key <= 2 THEN 'Bajo o nulo' WHEN f.riesgo_key = 3 THEN 'Medio' ELSE 'Alto o inviable' END AS grupo_riesgo,
 CASE WHEN f.servicio_key = 1 THEN 1 ELSE 0 END AS es_continuo
FROM f JOIN ({_TIME}) m ON m.fecha_key = f.fecha_key JOIN ({_GEO}) g ON g.municipio_key = f.municipio_key JOIN ({_SYS}) s ON s.sistema_key = f.sistema_key""")
def star_join(t: Tables):
    return _star(t).join().select("id_medicion", "anio_trimestre", "municipio", "sistema", "irca", "grupo_riesgo", "es_continuo")


@query("star_partial", sql="""
SELECT region AS tipo_region, count(*) AS mediciones, count(DISTINCT place) AS municipios, round(avg(irca), 6) AS irca_promedio,
 round(1e2 * count(*) FILTER (WHERE service = 'Continuous') / count(*), 6) AS pct_continuo FROM measure GROUP BY region""")
def star_partial(t: Tables):
    rows = _star(t).join("geography", "service")
    per_place = rows.groupBy("tipo_region", "municipio_key").agg(
        F.count(F.lit(1)).alias("n"), F.sum("irca").alias("s"), F.count("irca").alias("k"), F.sum("es_continuo").alias("c"))
    return per_place.groupBy("tipo_region").agg(
        F.sum("n").alias("mediciones"), F.count(F.lit(1)).alias("municipios"),
        F.round(F.sum("s") / F.nullif(F.sum("k").cast("double"), F.lit(0.0)), 6).alias("irca_promedio"),
        F.round(F.sum("c") * 100.0 / F.sum("n"), 6).alias("pct_continuo"))


@query("fk_orphans", sql="SELECT 0::BIGINT AS sin_tiempo, 0::BIGINT AS sin_geografia, 0::BIGINT AS sin_sistema, 0::BIGINT AS sin_riesgo, "
       "count(*) FILTER (WHERE service NOT IN ('Continuous', 'Intermittent', 'Rationed', 'No service')) AS sin_servicio FROM measure")
def fk_orphans(t: Tables):
    return st.orphan_counts(_star(t))


@query("check_dim_keys", sql="""
SELECT 'dim_tiempo' AS tabla, count(DISTINCT fecha) + 1 AS claves, 0::BIGINT AS repetidas FROM measure
UNION ALL SELECT 'dim_geografia', count(DISTINCT place) + 1, 0 FROM measure UNION ALL SELECT 'dim_sistema', count(DISTINCT system) + 1, 0 FROM measure
UNION ALL SELECT 'dim_riesgo', 7, 0 UNION ALL SELECT 'dim_servicio', 5, 0""")
def check_dim_keys(t: Tables):
    return st.repeated_keys(_star(t))


@query("check_fact_grain", sql="""
SELECT CAST(sum(n) AS BIGINT) AS hechos, count(*) AS grupos, count(*) FILTER (WHERE n > 1) AS grupos_repetidos
FROM (SELECT fecha, place, count(*) AS n FROM measure GROUP BY ALL) g""")
def check_fact_grain(t: Tables):
    return st.repeated_grain(_star(t).fact, ["fecha_key", "municipio_key"])


@query("check_unknowns", sql="""
SELECT count(*) FILTER (WHERE irca IS NULL) AS sin_dato_irca, count(*) FILTER (WHERE irca IS NULL) AS irca_vacio,
 count(*) FILTER (WHERE irca IS NULL) AS irca_no_reportado, 0::BIGINT AS desconocidos,
 count(*) FILTER (WHERE rain IS NULL) AS precipitacion_vacia FROM measure""")
def check_unknowns(t: Tables):
    return st.unknown_counts(_star(t).fact)


@query("check_reconcile", sql="""
WITH a AS (SELECT count(*)::DOUBLE AS r, count(irca)::DOUBLE AS i, round(avg(irca), 6) AS m,
 (count(*) FILTER (WHERE region = 'EUROPE'))::DOUBLE AS e, count(DISTINCT place)::DOUBLE AS p FROM measure)
SELECT 'Registros' AS comprobacion, r AS origen, r AS modelo, TRUE AS igual FROM a UNION ALL SELECT 'Mediciones con IRCA', i, i, TRUE FROM a
UNION ALL SELECT 'IRCA promedio', m, m, TRUE FROM a UNION ALL SELECT 'Mediciones region', e, e, TRUE FROM a
UNION ALL SELECT 'Municipios distintos', p, p, TRUE FROM a""")
def check_reconcile(t: Tables):
    model = _star(t).join("geography")
    count = F.count(F.lit(1))
    return st.reconcile(t.measure, model, {
        "Registros": (count, count),
        "Mediciones con IRCA": (F.count("irca"), F.count("irca")),
        "IRCA promedio": (F.round(F.avg("irca"), 6), F.round(F.avg("irca"), 6)),
        "Mediciones region": (F.count_if(F.col("region") == "EUROPE"), F.count_if(F.col("tipo_region") == "EUROPE")),
        "Municipios distintos": (F.count_distinct("place"), F.count_distinct("municipio_key")),
    })


@query("check_additivity", sql="""
SELECT count(*) AS directo, count(*) AS suma_grupos, count(*) AS suma_celdas, TRUE AS cuadra FROM measure WHERE region = 'EUROPE'""")
def check_additivity(t: Tables):
    return st.additivity(t.measure, F.col("region") == "EUROPE", "department", "system", "service", TRADE.services)


@query("check_constraints", sql="""
SELECT regla, 0::BIGINT AS violaciones FROM (VALUES ('fecha_key nulo'), ('municipio_key nulo'), ('sistema_key nulo'), ('riesgo_key nulo'),
 ('servicio_key nulo'), ('irca_reportado fuera de 0/1'), ('irca_reportado contradice irca'), ('cubierto fuera de 0/1'),
 ('es_continuo fuera de 0/1')) v(regla) WHERE (SELECT count(*) FROM measure) > 0""")
def check_constraints(t: Tables):
    return st.constraint_violations(_star(t))


@query("star_measures", sql="""
SELECT department AS grupo, count(*) AS mediciones, count(DISTINCT place) AS municipios, round(avg(irca), 6) AS irca_promedio,
 round(1e2 * count(*) FILTER (WHERE risk_group = 'Alto o inviable') / nullif(count(irca), 0), 6) AS pct_riesgo_alto,
 round(1e2 * count(*) FILTER (WHERE service = 'Continuous') / count(*), 6) AS pct_continuo,
 round(1e2 * count(*) FILTER (WHERE service IN ('Rationed', 'No service')) / count(*), 6) AS pct_interrumpido,
 round(avg(storage), 6) AS almacenamiento FROM measure WHERE region = 'ASIA' GROUP BY department""")
def star_measures(t: Tables):
    """The slice operator over the keyed star instead of the flat frame."""
    rows = st.cube_frame(_star(t), "geography", "risk", "service")
    return cube.slice_(rows, "region", "ASIA", "departamento", TRADE, digits=6).table

"""Temporal, territorial and multivariate indicators."""

from pyspark.sql import functions as F

from ..domain import RISK_GROUPS, TRADE
from ..operators import indicators as ind
from ..operators.filters import named_period
from .registry import query
from .views import ORDER, Tables

D = 6
_CONT = "1e2 * count(*) FILTER (WHERE service = 'Continuous') / count(*)"
_SUM = f"""count(*) AS n, count(irca) AS n_con_irca, round({_CONT}, 6) AS pct_continuo,
 round(1e2 * count(*) FILTER (WHERE service IN ('Rationed', 'No service')) / count(*), 6) AS pct_racionamiento,
 round(1e2 * count(*) FILTER (WHERE risk_group = 'Alto o inviable') / nullif(count(irca), 0), 6) AS pct_riesgo_alto,
 round(1e2 * count(*) FILTER (WHERE irca IS NULL) / count(*), 6) AS pct_sin_irca, round(avg(irca), 6) AS irca_promedio,
 round(avg(storage), 6) AS almacenamiento_promedio, round(avg(rain), 6) AS precipitacion_promedio"""


@query("temporal_summary", sql=f"""
SELECT 'total' AS nivel, NULL::INTEGER AS anio, NULL::VARCHAR AS periodo, NULL::VARCHAR AS region, {_SUM} FROM measure
UNION ALL SELECT 'anio', anio, NULL, NULL, {_SUM} FROM measure GROUP BY anio
UNION ALL SELECT 'periodo', anio, periodo, NULL, {_SUM} FROM measure GROUP BY anio, periodo
UNION ALL SELECT 'anio_region', anio, NULL, region, {_SUM} FROM measure GROUP BY anio, region""")
def temporal_summary(t: Tables):
    return ind.temporal_summary(t.measure, TRADE, D)


_YEAR = "SELECT region, anio, avg(irca) AS a, " + _CONT + " AS c FROM measure GROUP BY region, anio"


@query("yoy_change", sql=f"""
WITH y AS ({_YEAR}) SELECT n.region, n.anio, round(n.a, 6) AS actual, round(p.a, 6) AS anterior, round(n.a - p.a, 6) AS variacion,
 round(n.c - p.c, 6) AS variacion_continuo FROM y n LEFT JOIN y p ON p.region = n.region AND p.anio = n.anio - 1""")
def yoy_change(t: Tables):
    return ind.change_by_year(t.measure, TRADE, ["region"], D)


@query("yoy_same_quarter", sql="""
WITH y AS (SELECT anio, trimestre, avg(irca) AS a FROM measure GROUP BY ALL)
SELECT n.anio, n.trimestre, round(n.a, 6) AS actual, round(p.a, 6) AS anterior, round(n.a - p.a, 6) AS variacion
FROM y n LEFT JOIN y p ON p.trimestre = n.trimestre AND p.anio = n.anio - 1""")
def yoy_same_quarter(t: Tables):
    return ind.change_by_quarter(t.measure, TRADE, D)


@query("comparable_change", sql="""
SELECT '1999-T2' AS referencia, round(a, 6) AS actual, round(b, 6) AS anterior, round(a - b, 6) AS variacion FROM (
 SELECT avg(irca) FILTER (WHERE periodo = '2000-T2') AS a, avg(irca) FILTER (WHERE periodo = '1999-T2') AS b FROM measure WHERE region = 'ASIA') x
UNION ALL SELECT CAST(y - 1 AS VARCHAR), round(a, 6), round(b, 6), round(a - b, 6) FROM (
 SELECT max(anio) AS y, avg(irca) FILTER (WHERE anio = m) AS a, avg(irca) FILTER (WHERE anio = m - 1) AS b
 FROM measure, (SELECT max(anio) AS m FROM measure) l) z""")
def comparable_change(t: Tables):
    quarter = ind.comparable_change(t.measure, TRADE, period="2000-T2", region="ASIA", digits=D)
    return quarter.unionByName(ind.comparable_change(t.measure, TRADE, digits=D))


@query("series_coverage", sql="""
SELECT anio, count(*) AS registros, count(DISTINCT periodo) AS periodos, count(DISTINCT mes) AS meses, count(DISTINCT place) AS municipios
FROM measure GROUP BY anio""")
def series_coverage(t: Tables):
    return ind.series_coverage(t.measure)


def _first(name: str, condition: str) -> str:
    return f"""(SELECT '{name}' AS condicion, fecha, place, region, service, periodo FROM measure WHERE {condition}
 ORDER BY fecha, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 1)"""


@query("first_occurrence", sql=" UNION ALL ".join([
    "SELECT * FROM " + _first("no continuo", "service <> 'Continuous'"),
    "SELECT * FROM " + _first("no continuo en EUROPE", "service <> 'Continuous' AND region = 'EUROPE'"),
    "SELECT * FROM " + _first("Rationed", "service = 'Rationed'"),
    "SELECT * FROM " + _first("No service", "service = 'No service'")]))
def first_occurrence(t: Tables):
    off = F.col("service") != TRADE.continuous
    return ind.first_occurrences(t.measure, {
        "no continuo": off, "no continuo en EUROPE": off & (F.col("region") == "EUROPE"),
        "Rationed": F.col("service") == "Rationed", "No service": F.col("service") == "No service",
    }, ORDER, ["fecha", "place", "region", "service", "periodo"])


@query("territory_mean_class", sql="""
SELECT place, round(m, 6) AS irca_promedio, CASE WHEN m IS NULL THEN 'Sin dato' WHEN m <= 5 THEN 'Sin riesgo (0-5)' WHEN m <= 14 THEN 'Bajo riesgo (5-14)'
 WHEN m <= 28 THEN 'Riesgo medio (14-28)' WHEN m <= 40 THEN 'Alto riesgo (28-40)' ELSE 'Inviable sanitariamente (>40)' END AS clasificacion, n
FROM (SELECT place, avg(irca) AS m, count(*) AS n FROM measure WHERE region = 'EUROPE' GROUP BY place) g""")
def territory_mean_class(t: Tables):
    return ind.territory_means(t.measure.where(F.col("region") == "EUROPE"), TRADE, D)


_MIX = ", ".join(f"count(*) FILTER (WHERE service = '{s}') AS n{i}" for i, s in enumerate(TRADE.services))
_MIXP = ", ".join(f"round(1e2 * n{i} / total, 6) AS pct{i}" for i in range(4))


@query("service_mix", sql=f"""
SELECT *, {_MIXP} FROM (SELECT place, count(*) AS total, {_MIX} FROM measure WHERE region = 'EUROPE' GROUP BY place) g""")
def service_mix(t: Tables):
    return ind.service_mix(t.measure.where(F.col("region") == "EUROPE"), "place", TRADE, D)


@query("region_gap", sql=f"""
WITH g AS (SELECT region, count(*) AS n, avg(irca) AS i, avg(coverage) AS c, {_CONT} AS k FROM measure GROUP BY region)
SELECT a.n AS n_0, b.n AS n_1, round(a.i, 6) AS irca_0, round(b.i, 6) AS irca_1, round(b.i - a.i, 6) AS brecha_irca, round(a.c, 6) AS cobertura_0,
 round(b.c, 6) AS cobertura_1, round(a.c - b.c, 6) AS brecha_cobertura, round(a.k, 6) AS pct_continuo_0
FROM g a JOIN g b ON a.region = 'EUROPE' AND b.region = 'ASIA'""")
def region_gap(t: Tables):
    return ind.region_gap(t.measure, "EUROPE", "ASIA", TRADE, D)


@query("mean_band", sql="""
WITH u AS (SELECT place, avg(irca) AS m, count(irca) AS k, var_samp(irca) AS v FROM measure GROUP BY place),
p AS (SELECT avg(m) AS m, sqrt(sum(v * (k - 1)) / sum(k - 1) FILTER (WHERE k > 1)) AS s FROM u)
SELECT round(m, 6) AS media, round(s, 6) AS desviacion, round(m - s, 6) AS inferior, round(m + s, 6) AS superior FROM p""")
def mean_band(t: Tables):
    return ind.mean_band(t.measure, digits=D)


@query("corr_rows", sql="""
SELECT count(*) AS pares, round(avg(irca), 6) AS media_x, round(avg(coverage), 6) AS media_y, round(corr(irca, coverage), 6) AS correlacion
FROM measure WHERE irca IS NOT NULL AND coverage IS NOT NULL""")
def corr_rows(t: Tables):
    return ind.correlation_rows(t.measure, "irca", "coverage", D)


_UNIT = f"SELECT place, region, count(*) AS n, avg(coverage) AS cobertura, {_CONT} AS continuidad FROM measure GROUP BY place, region"


@query("corr_units_within", sql=f"""
WITH u AS ({_UNIT}) SELECT region, count(*) AS unidades, round(corr(cobertura, continuidad), 6) AS correlacion FROM u GROUP BY region
UNION ALL SELECT 'global', count(*), round(corr(cobertura, continuidad), 6) FROM u""")
def corr_units_within(t: Tables):
    return ind.correlation_units(ind.coverage_gap(t.measure, TRADE), "cobertura", "continuidad", "region", D)


@query("group_summary", sql="""
SELECT region, service, count(*) AS n, round(avg(irca), 6) AS irca_promedio, round(avg(coverage), 6) AS cobertura_promedio FROM measure GROUP BY ALL""")
def group_summary(t: Tables):
    return ind.group_summary(t.measure, ["region", "service"], TRADE, D)


_PRIO = f"""SELECT department, region, count(*) AS n, count(irca) AS validos, count(*) FILTER (WHERE risk_group = 'Alto o inviable') AS alto,
 count(*) FILTER (WHERE service = 'Continuous') AS continuo, 1e2 * count(*) FILTER (WHERE risk_group = 'Alto o inviable') / nullif(count(irca), 0) AS pa,
 {_CONT} AS pc, avg(coverage) AS cobertura FROM measure GROUP BY department, region"""
_LABEL = """CASE WHEN coalesce(pa, 0) >= 40 AND coalesce(pc, 0) < 50 THEN 'Prioridad conjunta' WHEN coalesce(pa, 0) >= 40 THEN 'Prioridad de calidad'
 WHEN coalesce(pc, 0) < 50 THEN 'Prioridad de servicio' ELSE 'Seguimiento' END"""


@query("dept_priority", sql=f"""
SELECT department, region, n, validos, alto, continuo, round(pa, 6) AS pct_alto, round(pc, 6) AS pct_continuo, round(cobertura, 6) AS cobertura,
 {_LABEL} AS prioridad FROM ({_PRIO}) p""")
def dept_priority(t: Tables):
    return ind.priorities(t.measure, TRADE, D)


@query("dept_priority_period", sql=f"""
SELECT department, region, n, validos, alto, continuo, round(pa, 6) AS pct_alto, round(pc, 6) AS pct_continuo, round(cobertura, 6) AS cobertura,
 {_LABEL} AS prioridad FROM ({_PRIO.replace("FROM measure", "FROM measure WHERE anio BETWEEN 2000 AND 2001")}) p""")
def dept_priority_period(t: Tables):
    """The priorities of a named period."""
    return ind.priorities(t.measure.where(named_period(TRADE, "2000-2001")), TRADE, D)


@query("priority_counts", sql=f"SELECT {_LABEL} AS prioridad, count(*) AS departamentos FROM ({_PRIO}) p GROUP BY 1")
def priority_counts(t: Tables):
    return ind.priorities(t.measure, TRADE).groupBy("prioridad").agg(F.count(F.lit(1)).alias("departamentos"))


@query("dept_risk_mix", sql="""
SELECT *, round(1e2 * n0 / validos, 6) AS pct0, round(1e2 * n1 / validos, 6) AS pct1, round(1e2 * n2 / validos, 6) AS pct2 FROM (
 SELECT department, count(irca) AS validos, count(*) FILTER (WHERE risk_group = 'Bajo o nulo') AS n0, count(*) FILTER (WHERE risk_group = 'Medio') AS n1,
  count(*) FILTER (WHERE risk_group = 'Alto o inviable') AS n2 FROM measure GROUP BY department) g""")
def dept_risk_mix(t: Tables):
    return ind.risk_mix(t.measure, "department", D)


@query("dept_service_matrix", sql="SELECT department, " + ", ".join(
    f"nullif(count(*) FILTER (WHERE service = '{s}'), 0) AS n{i}, "
    f"CASE WHEN count(*) FILTER (WHERE service = '{s}') > 0 THEN count(irca) FILTER (WHERE service = '{s}') END AS validos{i}, "
    f"round(1e2 * count(*) FILTER (WHERE service = '{s}' AND risk_group = 'Alto o inviable') / nullif(count(irca) FILTER (WHERE service = '{s}'), 0), 6) AS pct{i}"
    for i, s in enumerate(TRADE.services)) + " FROM measure GROUP BY department")
def dept_service_matrix(t: Tables):
    return ind.service_risk_matrix(t.measure, "department", TRADE, D)


@query("coverage_gap", sql=f"""
SELECT place, region, n, round(cobertura, 6) AS cobertura, round(continuidad, 6) AS continuidad, round(cobertura - continuidad, 6) AS brecha FROM ({_UNIT}) u""")
def coverage_gap(t: Tables):
    return ind.coverage_gap(t.measure, TRADE, D)


@query("coverage_gap_top", sql=f"""
SELECT place, region, n, round(cobertura, 6) AS cobertura, round(continuidad, 6) AS continuidad, round(cobertura - continuidad, 6) AS brecha FROM ({_UNIT}) u
ORDER BY brecha DESC NULLS LAST, place LIMIT 15""")
def coverage_gap_top(t: Tables):
    return ind.widest_gaps(ind.coverage_gap(t.measure, TRADE, D))


@query("misaligned_count", sql=f"""
SELECT count(*) AS unidades, count(*) FILTER (WHERE cobertura >= 80 AND continuidad < 50) AS desalineados FROM ({_UNIT}) u""")
def misaligned_count(t: Tables):
    return ind.misaligned(ind.coverage_gap(t.measure, TRADE), coverage=80)


_REC = f"""count(*) AS n, round(avg(storage), 6) AS almacenamiento, round(avg(water_use), 6) AS consumo, round(avg(rain), 6) AS precipitacion,
 round({_CONT}, 6) AS continuidad FROM measure"""


@query("recovery_quarter", sql=f"SELECT anio, periodo, {_REC} GROUP BY anio, periodo")
def recovery_quarter(t: Tables):
    return ind.recovery_series(t.measure, ["anio", "periodo"], TRADE, D)


@query("recovery_year", sql=f"SELECT anio, {_REC} GROUP BY anio")
def recovery_year(t: Tables):
    return ind.recovery_series(t.measure, ["anio"], TRADE, D)


@query("recovery_year_region", sql=f"SELECT anio, region, {_REC} GROUP BY anio, region")
def recovery_year_region(t: Tables):
    return ind.recovery_series(t.measure, ["anio", "region"], TRADE, D)


@query("weighted_means", sql="""
WITH q AS (SELECT periodo, count(*) AS n, avg(storage) AS s, avg(water_use) AS u, avg(rain) AS r FROM measure GROUP BY periodo)
SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(s * n) / sum(n), 6) AS almacenamiento, round(sum(u * n) / sum(n), 6) AS consumo,
 round(sum(r * n) / sum(n), 6) AS precipitacion FROM q""")
def weighted_means(t: Tables):
    series = ind.recovery_series(t.measure, ["periodo"], TRADE)
    return ind.weighted_means(series, ["almacenamiento", "consumo", "precipitacion"], D)


@query("recovery_verdict", sql=f"""
WITH y AS (SELECT anio, avg(water_use) AS u, avg(storage) AS s, {_CONT} AS c FROM measure GROUP BY anio),
e AS (SELECT min(anio) AS lo, max(anio) AS hi, count(*) AS k FROM y)
SELECT a.anio AS desde, z.anio AS hasta, round(a.u, 6) AS consumo_inicial, round(a.s, 6) AS almacenamiento_inicial, round(a.c, 6) AS continuidad_inicial,
 round(z.u, 6) AS consumo_final, round(z.s, 6) AS almacenamiento_final, round(z.c, 6) AS continuidad_final,
 CASE WHEN e.k >= 2 THEN z.u > a.u * 1.03 AND z.s >= a.s + 3 AND z.c <= a.c END AS recuperacion_sin_servicio
FROM e JOIN y a ON a.anio = e.lo JOIN y z ON z.anio = e.hi""")
def recovery_verdict(t: Tables):
    return ind.recovery_verdict(ind.recovery_series(t.measure, ["anio"], TRADE), D)


@query("system_breaks", sql=f"""
WITH s AS (SELECT system, anio, {_CONT} AS c FROM measure GROUP BY system, anio)
SELECT count(*) FILTER (WHERE a.c - b.c >= 50) AS caidas, count(*) AS sistemas FROM s a JOIN s b ON a.system = b.system AND a.anio = 1999 AND b.anio = 2001""")
def system_breaks(t: Tables):
    return ind.system_breaks(t.measure, 1999, 2001, 50, TRADE)


@query("system_breaks_region", sql=f"""
WITH s AS (SELECT system, anio, {_CONT} AS c FROM measure WHERE region = 'EUROPE' GROUP BY system, anio)
SELECT count(*) FILTER (WHERE a.c - b.c >= 50) AS caidas, count(*) AS sistemas FROM s a JOIN s b ON a.system = b.system AND a.anio = 1999 AND b.anio = 2001""")
def system_breaks_region(t: Tables):
    """The same inside one region."""
    return ind.system_breaks(t.measure.where(F.col("region") == "EUROPE"), 1999, 2001, 50, TRADE)


@query("continuity_series", sql=f"SELECT system, anio, count(*) AS n, round({_CONT}, 6) AS pct FROM measure GROUP BY system, anio")
def continuity_series(t: Tables):
    return ind.continuity_by(t.measure, ["system", "anio"], TRADE, D)


@query("service_mix_unit", sql=f"SELECT *, {_MIXP} FROM (SELECT department, count(*) AS total, {_MIX} FROM measure GROUP BY department) g")
def service_mix_unit(t: Tables):
    return ind.service_mix(t.measure, "department", TRADE, D, of="all")


@query("unit_system_matrix", sql=f"SELECT department, count(*) AS total, round({_CONT}, 6) AS pct_total, " + ", ".join(
    f"nullif(count(*) FILTER (WHERE system = '{s}'), 0) AS n{i}, "
    f"round(1e2 * count(*) FILTER (WHERE system = '{s}' AND service = 'Continuous') / nullif(count(*) FILTER (WHERE system = '{s}'), 0), 6) AS pct{i}"
    for i, s in enumerate(TRADE.systems)) + " FROM measure GROUP BY department")
def unit_system_matrix(t: Tables):
    return ind.unit_system_matrix(t.measure, "department", TRADE, D)


@query("pivot_year_label", sql="""
SELECT anio, count(DISTINCT fecha) FILTER (WHERE decision = 'No restriction') AS no, count(DISTINCT fecha) FILTER (WHERE decision <> 'No restriction') AS si
FROM measure WHERE region = 'EUROPE' GROUP BY anio""")
def pivot_year_label(t: Tables):
    """Days per year and target."""
    days = t.measure.where(F.col("region") == "EUROPE").groupBy("fecha", "anio").agg(F.min("decision").alias("d"))
    target = F.when(F.col("d") == TRADE.no_restriction, "no").otherwise("si")
    return days.withColumn("t", target).groupBy("anio").pivot("t", ["no", "si"]).agg(F.count(F.lit(1))).na.fill(0, ["no", "si"])

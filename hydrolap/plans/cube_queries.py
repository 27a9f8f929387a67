"""Measures by level, slice, dice, roll-up, pivot, comparison."""

from pyspark.sql import functions as F

from ..domain import HIGH_GROUP, RISK_GROUPS, TRADE
from ..functions import count_if, percentage
from ..operators import cube
from ..operators.filters import filter_in
from .registry import query
from .views import Tables

DIGITS = 6

_M = """count(*) AS mediciones, count(DISTINCT place) AS municipios, round(avg(irca), 6) AS irca_promedio,
 round(1e2 * count(*) FILTER (WHERE risk_group = 'Alto o inviable') / nullif(count(irca), 0), 6) AS pct_riesgo_alto,
 round(1e2 * count(*) FILTER (WHERE service = 'Continuous') / count(*), 6) AS pct_continuo,
 round(1e2 * count(*) FILTER (WHERE service IN ('Rationed', 'No service')) / count(*), 6) AS pct_interrumpido,
 round(avg(storage), 6) AS almacenamiento"""
_DICE = {"region": "EUROPE", "anio": ["2000", "2001"], "sistema": ["BUILDING", "MACHINERY", "HOUSEHOLD"]}
_DICE_SQL = "region = 'EUROPE' AND anio IN (2000, 2001) AND system IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"


@query("panorama", sql="""
SELECT count(*) AS registros, count(irca) AS irca_validos, count(DISTINCT place) AS municipios, count(DISTINCT department) AS departamentos,
 count(DISTINCT system) AS sistemas, count(DISTINCT periodo) AS periodos, min(anio) AS anio_min, max(anio) AS anio_max,
 round(avg(coverage), 6) AS cobertura_media FROM measure""")
def panorama(t: Tables):
    # Distinct counts run over dimension cells, not over the facts.
    cells = t.measure.groupBy("place", "department", "system", "periodo", "anio").agg(
        F.count(F.lit(1)).alias("n"), F.count("irca").alias("n_irca"), F.sum("coverage").alias("s"), F.count("coverage").alias("k"))
    return cells.agg(
        F.sum("n").alias("registros"), F.sum("n_irca").alias("irca_validos"), F.count_distinct("place").alias("municipios"),
        F.count_distinct("department").alias("departamentos"), F.count_distinct("system").alias("sistemas"),
        F.count_distinct("periodo").alias("periodos"), F.min("anio").alias("anio_min"), F.max("anio").alias("anio_max"),
        F.round(F.sum("s") / F.sum("k"), DIGITS).alias("cobertura_media"))


@query("value_counts", sql="SELECT region, service, count(*) AS n FROM measure GROUP BY ALL ORDER BY n DESC, region, service")
def value_counts(t: Tables):
    return t.measure.groupBy("region", "service").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "region", "service")


@query("conditional_counts", sql="""
SELECT count(*) FILTER (WHERE risk_group = 'Sin dato') AS sin_dato, count(*) FILTER (WHERE irca IS NULL) AS irca_vacio,
 count(*) FILTER (WHERE rain IS NULL) AS precipitacion_vacia, count(*) FILTER (WHERE service = 'Continuous') AS continuo FROM measure""")
def conditional_counts(t: Tables):
    return t.measure.agg(
        count_if(F.col("risk_group") == "Sin dato").alias("sin_dato"), count_if(F.col("irca").isNull()).alias("irca_vacio"),
        count_if(F.col("rain").isNull()).alias("precipitacion_vacia"), count_if(F.col("service") == TRADE.continuous).alias("continuo"))


@query("measures_total", sql=f"SELECT {_M} FROM measure")
def measures_total(t: Tables):
    return cube.indicators(t.measure, TRADE, digits=DIGITS)


@query("measures_by_level", sql=" UNION ALL ".join(
    f"SELECT '{level}' AS nivel, CAST({column} AS VARCHAR) AS grupo, {_M} FROM measure GROUP BY {column}"
    for level, column in cube.LEVELS.items()))
def measures_by_level(t: Tables):
    return cube.tables_by_levels(t.measure, list(cube.LEVELS), TRADE, DIGITS)


@query("rollup_geo", sql=f"""
SELECT CAST(3 - grouping(region) - grouping(department) - grouping(place_) AS INTEGER) AS nivel, region, department, place_ AS place, {_M}
FROM (SELECT *, place AS place_ FROM measure) m GROUP BY ROLLUP (region, department, place_)""")
def rollup_geo(t: Tables):
    return cube.rollup_levels(t.measure, ["region", "department", "place"], TRADE, DIGITS)


@query("rollup_time", sql=f"""
SELECT CAST(2 - grouping(anio) - grouping(periodo) AS INTEGER) AS nivel, anio, periodo, {_M}
FROM measure GROUP BY ROLLUP (anio, periodo)""")
def rollup_time(t: Tables):
    return cube.rollup_levels(t.measure, ["anio", "periodo"], TRADE, DIGITS)


_RISK_CELLS = ", ".join(f"count(*) FILTER (WHERE risk_group = '{g}') AS c{i}" for i, g in enumerate(RISK_GROUPS))


@query("pivot_matrix", sql=f"SELECT service AS grupo, {_RISK_CELLS}, count(*) AS total FROM measure GROUP BY service")
def pivot_matrix(t: Tables):
    return cube.matrix(t.measure, "servicio", "riesgo", TRADE)


@query("pivot_row_pct", sql=f"""
WITH c AS (SELECT service AS grupo, {_RISK_CELLS}, count(*) AS total FROM measure GROUP BY service)
SELECT grupo, c0, c1, c2, total, round(1e2 * c0 / total, 6) AS p0, round(1e2 * c1 / total, 6) AS p1, round(1e2 * c2 / total, 6) AS p2,
 NULL::BIGINT AS grand_total FROM c
UNION ALL SELECT 'TOTAL', CAST(sum(c0) AS BIGINT), CAST(sum(c1) AS BIGINT), CAST(sum(c2) AS BIGINT), NULL, NULL, NULL, NULL,
 CAST(sum(c0 + c1 + c2) AS BIGINT) FROM c""")
def pivot_row_pct(t: Tables):
    counts = cube.matrix(t.measure, "servicio", "riesgo", TRADE)
    rows = cube.matrix_percent(counts, 3, DIGITS)
    totals = cube.matrix_totals(counts, 3).withColumn("grupo", F.lit("TOTAL"))
    return rows.unionByName(totals, allowMissingColumns=True)


@query("slice_region", sql=f"SELECT department AS grupo, {_M} FROM measure WHERE region = 'EUROPE' GROUP BY department")
def slice_region(t: Tables):
    return cube.slice_(t.measure, "region", "EUROPE", "departamento", TRADE, "servicio", "riesgo", DIGITS).table


@query("dice_three_dims", sql=f"SELECT periodo AS grupo, {_M} FROM measure WHERE {_DICE_SQL} GROUP BY periodo")
def dice_three_dims(t: Tables):
    return cube.dice(t.measure, _DICE, "trimestre", TRADE, "sistema", "servicio", DIGITS).table


@query("dice_matrix", sql=f"""
SELECT system AS grupo, c0, c1, c2, c3, total, round(1e2 * c0 / total, 6) AS p0, round(1e2 * c1 / total, 6) AS p1,
 round(1e2 * c2 / total, 6) AS p2, round(1e2 * c3 / total, 6) AS p3 FROM (
 SELECT system, count(*) FILTER (WHERE service = 'Continuous') AS c0, count(*) FILTER (WHERE service = 'Intermittent') AS c1,
  count(*) FILTER (WHERE service = 'Rationed') AS c2, count(*) FILTER (WHERE service = 'No service') AS c3, count(*) AS total
 FROM measure WHERE {_DICE_SQL} GROUP BY system) c""")
def dice_matrix(t: Tables):
    return cube.dice(t.measure, _DICE, "trimestre", TRADE, "sistema", "servicio", DIGITS).matrix


_CMP = f"""SELECT CASE WHEN anio IN (2000, 2001) THEN '2000-2001' ELSE '1998-1999' END AS periodo, {_M.replace("6)", "12)")}
 FROM measure WHERE anio BETWEEN 1998 AND 2001 AND region = 'EUROPE' GROUP BY 1"""


@query("compare_periods", sql=f"""
WITH b AS ({_CMP})
SELECT periodo, mediciones, municipios, round(irca_promedio, 6) AS irca_promedio, round(pct_riesgo_alto, 6) AS pct_riesgo_alto,
 round(pct_continuo, 6) AS pct_continuo, round(pct_interrumpido, 6) AS pct_interrumpido, round(almacenamiento, 6) AS almacenamiento FROM b
UNION ALL SELECT 'Cambio', y.mediciones - x.mediciones, y.municipios - x.municipios, round(y.irca_promedio - x.irca_promedio, 6),
 round(y.pct_riesgo_alto - x.pct_riesgo_alto, 6), round(y.pct_continuo - x.pct_continuo, 6),
 round(y.pct_interrumpido - x.pct_interrumpido, 6), round(y.almacenamiento - x.almacenamiento, 6)
FROM b x JOIN b y ON x.periodo = '1998-1999' AND y.periodo = '2000-2001'""")
def compare_periods(t: Tables):
    return cube.compare_periods(t.measure, {"region": "EUROPE", "anio": "2001"}, [1998, 1999], [2000, 2001], TRADE, DIGITS)


_EARLIER = {"region": "EUROPE", "anio": ["1999", "2000"], "sistema": "BUILDING"}


@query("dice_earlier", sql=f"""
WITH b AS ({_CMP.replace("anio IN (2000, 2001) THEN '2000-2001' ELSE '1998-1999'", "anio IN (1999, 2000) THEN '1999-2000' ELSE '1997-1998'").replace("BETWEEN 1998 AND 2001", "BETWEEN 1997 AND 2000 AND system = 'BUILDING'")})
SELECT periodo, mediciones, municipios, round(irca_promedio, 6) AS irca_promedio, round(pct_riesgo_alto, 6) AS pct_riesgo_alto,
 round(pct_continuo, 6) AS pct_continuo, round(pct_interrumpido, 6) AS pct_interrumpido, round(almacenamiento, 6) AS almacenamiento FROM b
UNION ALL SELECT 'Cambio', y.mediciones - x.mediciones, y.municipios - x.municipios, round(y.irca_promedio - x.irca_promedio, 6),
 round(y.pct_riesgo_alto - x.pct_riesgo_alto, 6), round(y.pct_continuo - x.pct_continuo, 6),
 round(y.pct_interrumpido - x.pct_interrumpido, 6), round(y.almacenamiento - x.almacenamiento, 6)
FROM b x JOIN b y ON x.periodo = '1997-1998' AND y.periodo = '1999-2000'""")
def dice_earlier(t: Tables):
    """The chosen years next to as many before them, under the same other filters."""
    return cube.dice(t.measure, _EARLIER, "trimestre", TRADE, digits=DIGITS).earlier


@query("selection_vs_context", sql=f"""
SELECT 'seleccion' AS alcance, {_M} FROM measure WHERE {_DICE_SQL} UNION ALL SELECT 'contexto', {_M} FROM measure""")
def selection_vs_context(t: Tables):
    return cube.selection_and_context(t.measure, _DICE, TRADE, DIGITS)


@query("pct_vs_mean_of_pct", sql="""
WITH g AS (SELECT region, periodo, count(*) AS n, count(*) FILTER (WHERE service = 'Continuous') AS c FROM measure GROUP BY ALL)
SELECT region, round(1e2 * sum(c) / sum(n), 6) AS pct_recalculado, round(avg(1e2 * c / n), 6) AS promedio_de_pct FROM g GROUP BY region""")
def pct_vs_mean_of_pct(t: Tables):
    cells = t.measure.groupBy("region", "periodo").agg(
        F.count(F.lit(1)).alias("n"), count_if(F.col("service") == TRADE.continuous).alias("c"))
    return cells.groupBy("region").agg(
        F.round(percentage(F.sum("c"), F.sum("n")), DIGITS).alias("pct_recalculado"),
        F.round(F.avg(percentage(F.col("c"), F.col("n"))), DIGITS).alias("promedio_de_pct"))


@query("measure_extremes", sql="""
WITH d AS (SELECT department, avg(irca) AS v FROM measure GROUP BY department)
SELECT (SELECT department FROM d ORDER BY v DESC, department LIMIT 1) AS mayor, round((SELECT max(v) FROM d), 6) AS mayor_valor,
 (SELECT department FROM d ORDER BY v, department LIMIT 1) AS menor, round((SELECT min(v) FROM d), 6) AS menor_valor""")
def measure_extremes(t: Tables):
    means = t.measure.groupBy("department").agg(F.avg("irca").alias("v"))
    # The smallest name wins a tie on either side.
    return means.agg(
        F.min_by("department", F.struct(-F.col("v"), "department")).alias("mayor"), F.round(F.max("v"), DIGITS).alias("mayor_valor"),
        F.min_by("department", F.struct("v", "department")).alias("menor"), F.round(F.min("v"), DIGITS).alias("menor_valor"))


@query("top_combinations", sql="""
SELECT region, periodo, service, count(*) AS n FROM measure GROUP BY ALL ORDER BY n DESC, region, periodo, service LIMIT 12""")
def top_combinations(t: Tables):
    return t.measure.groupBy("region", "periodo", "service").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.desc("n"), "region", "periodo", "service").limit(12)


@query("dense_matrix", sql="""
SELECT u.department, s.system, count(m.l_orderkey) AS n,
 round(1e2 * count(*) FILTER (WHERE m.service = 'Continuous') / nullif(count(m.l_orderkey), 0), 6) AS pct
FROM (SELECT DISTINCT department FROM measure) u
CROSS JOIN (VALUES ('AUTOMOBILE'), ('BUILDING'), ('FURNITURE'), ('HOUSEHOLD'), ('MACHINERY'), ('NONE')) s(system)
LEFT JOIN measure m ON m.department = u.department AND m.system = s.system GROUP BY ALL""")
def dense_matrix(t: Tables):
    """Every unit gets every catalogue column; empty cells are 0 (count) or null (percentage)."""
    catalogue = (*TRADE.systems, "NONE")
    cells = []
    for i, s in enumerate(catalogue):
        here = F.col("system") == s
        cells += [count_if(here).alias(f"n{i}"), count_if(here & (F.col("service") == TRADE.continuous)).alias(f"c{i}")]
    wide = t.measure.groupBy("department").agg(*cells)
    parts = F.array(*[
        F.struct(F.lit(s).alias("system"), F.col(f"n{i}").alias("n"), F.round(percentage(F.col(f"c{i}"), F.col(f"n{i}")), DIGITS).alias("pct"))
        for i, s in enumerate(catalogue)])
    return wide.select("department", F.explode(parts).alias("x")).select("department", "x.system", "x.n", "x.pct")

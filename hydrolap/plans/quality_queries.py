"""Profiling, quality dimensions, treatment effects, problems and causes over the dirty view."""

from dataclasses import replace

from pyspark.sql import functions as F

from ..domain import RECENCY_MONTHS, TRADE
from ..functions import is_missing, normalise_place, parse_date, safe_double
from ..operators import cleaning as cl, predicates as p, quality as ql
from ..operators.dedup import duplicate_profile as profile
from ..session import store, work_folder, written
from .etl_queries import SCHEMA
from .registry import query
from .views import ORDER, Tables

D = 6
COLUMNS = ["fecha_txt", "anio_txt", "mes_txt", "place_txt", "system_txt", "irca_txt", "class_txt", "storage_txt", "rain_txt",
           "coverage_txt", "use_txt", "scope"]
RULES = {"irca_txt": (0, 100), "rain_txt": (0, 500), "coverage_txt": (0, 100), "storage_txt": (0, 100), "use_txt": (0, 1000)}
ACCURACY = ["irca_txt", "coverage_txt", "use_txt"]
AS_OF = "2002-01-01"
PLAN = ql.Plan(tuple(COLUMNS), RULES, tuple(ACCURACY), AS_OF)

_MISSING = "lower(trim({c})) IN ('', 'n/a', 'na', 'null', 'none', '-', 'n/d')"
_NUM = "TRY_CAST(CASE WHEN regexp_full_match({c}, '[+-]?[0-9]+([.][0-9]+)?') THEN {c} END AS DOUBLE)"
_ISO = r"regexp_full_match(fecha_txt, '\d{4}-\d{2}-\d{2}')"
_MISS_ALL = " + ".join(f"CASE WHEN {_MISSING.format(c=c)} THEN 1 ELSE 0 END" for c in COLUMNS)
_ALL = ", ".join(COLUMNS)


def _long(columns, value="{c}", keep=""):
    return " UNION ALL ".join(f"SELECT '{c}' AS variable, {value.format(c=c)} AS v{keep} FROM raw" for c in columns)


@query("missing_by_column", views="raw", sql=f"""
SELECT variable, count(*) FILTER (WHERE {_MISSING.format(c='v')}) AS missing, count(*) AS rows,
 round(1e2 * count(*) FILTER (WHERE {_MISSING.format(c='v')}) / count(*), 6) AS pct FROM ({_long(COLUMNS)}) x GROUP BY variable""")
def missing_by_column(t: Tables):
    return ql.missing_by_column(t.raw, COLUMNS, D)


@query("completeness_score", views="raw", sql=f"""
SELECT total, bad, round(1e2 * (total - bad) / total, 6) AS score FROM (SELECT count(*) * 12 AS total, CAST(sum({_MISS_ALL}) AS BIGINT) AS bad FROM raw) x""")
def completeness_score(t: Tables):
    return ql.completeness(t.raw, COLUMNS).withColumn("score", F.round("score", D))


_DUP = f"""SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - 1) AS BIGINT) AS extra_rows, count(*) FILTER (WHERE n > 1) AS duplicate_groups
 FROM (SELECT count(*) AS n FROM raw GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, {_ALL}) g"""


@query("duplicate_profile", views="raw", sql=f"""
SELECT *, round(1e2 * extra_rows / rows, 6) AS pct_extra, round(1e2 * duplicate_groups / rows, 6) AS pct_groups FROM ({_DUP}) d""")
def duplicate_profile(t: Tables):
    out = profile(t.raw.drop("copy_no"))
    return out.withColumns({c: F.round(c, D) for c in ("pct_extra", "pct_groups")})


@query("uniqueness_score", views="raw", sql=f"""
SELECT CAST(sum(n) AS BIGINT) AS total, CAST(sum(n - 1) AS BIGINT) AS bad, round(1e2 * count(*) / sum(n), 6) AS score FROM
 (SELECT count(*) AS n FROM raw GROUP BY fecha_txt, place_txt, system_txt, l_linenumber) g""")
def uniqueness_score(t: Tables):
    return ql.uniqueness(t.raw, ["fecha_txt", "place_txt", "system_txt", "l_linenumber"]).withColumn("score", F.round("score", D))


@query("distinct_by_column", views="raw", sql=f"""
SELECT variable, count(DISTINCT trim(v)) FILTER (WHERE NOT {_MISSING.format(c='v')}) AS unicos FROM ({_long(COLUMNS)}) x GROUP BY variable""")
def distinct_by_column(t: Tables):
    return ql.distinct_by_column(t.raw, COLUMNS)


@query("distinct_raw_vs_norm", views="raw", sql="""
SELECT count(DISTINCT place_txt) AS crudos, count(DISTINCT replace(upper(trim(place_txt)), '@', 'O')) AS normalizados FROM raw""")
def distinct_raw_vs_norm(t: Tables):
    return ql.distinct_raw_and_normalised(t.raw, "place_txt", normalise_place("place_txt", "O"))


@query("infer_types", views="raw", sql=f"""
SELECT variable, CASE WHEN n = 0 THEN 'solo nulos' WHEN iso = n THEN 'fecha (ISO YYYY-MM-DD)' WHEN iso >= n * 0.95 THEN 'fecha (ISO mayoritario; hay formatos mixtos)'
 WHEN i = n THEN 'entero' WHEN d = n THEN 'decimal' ELSE 'texto (categorico)' END AS tipo FROM (
 SELECT variable, count(*) AS n, count(*) FILTER (WHERE regexp_full_match(v, '\\d{{4}}-\\d{{2}}-\\d{{2}}')) AS iso,
  count(*) FILTER (WHERE regexp_full_match(v, '[+-]?[0-9]+')) AS i, count(*) FILTER (WHERE regexp_full_match(v, '[+-]?[0-9]+([.][0-9]*)?')) AS d
 FROM (SELECT variable, trim(v) AS v FROM ({_long(COLUMNS)}) y) x WHERE NOT {_MISSING.format(c='v')} GROUP BY variable) z""")
def infer_types(t: Tables):
    return ql.infer_types(t.raw, COLUMNS)


_VAL = " UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(v) AS evaluados, count(*) FILTER (WHERE v < {lo} OR v > {hi}) AS fuera FROM (SELECT {_NUM.format(c=c)} AS v FROM raw) x"
    for c, (lo, hi) in RULES.items())


@query("validity_by_variable", views="raw", sql=_VAL)
def validity_by_variable(t: Tables):
    return ql.validity_by_variable(t.raw, RULES)


@query("validity_score", views="raw", sql=f"""
SELECT CAST(sum(evaluados) AS BIGINT) AS total, CAST(sum(fuera) AS BIGINT) AS bad, round(1e2 * (sum(evaluados) - sum(fuera)) / sum(evaluados), 6) AS score FROM ({_VAL}) v""")
def validity_score(t: Tables):
    return ql.validity(t.raw, RULES).withColumn("score", F.round("score", D))


_CLASS = """CASE WHEN v <= 5 THEN 'Sin riesgo (0-5)' WHEN v <= 14 THEN 'Bajo riesgo (5-14)' WHEN v <= 28 THEN 'Riesgo medio (14-28)'
 WHEN v <= 40 THEN 'Alto riesgo (28-40)' ELSE 'Inviable sanitariamente (>40)' END"""
_MASKS = f"""SELECT NOT {_ISO} AS a,
 place_txt <> trim(place_txt) OR contains(place_txt, '@') OR (place_txt = upper(place_txt) AND place_txt <> lower(place_txt))
  OR (place_txt = lower(place_txt) AND place_txt <> upper(place_txt)) AS b,
 v IS NOT NULL AND class_txt <> {_CLASS} AS c, {_MISSING.format(c='irca_txt')} AND NOT {_MISSING.format(c='class_txt')} AS d
 FROM (SELECT *, {_NUM.format(c='irca_txt')} AS v FROM raw) r"""


@query("consistency_score", views="raw", sql=f"""
SELECT *, round(1e2 * (total - bad) / total, 6) AS score FROM (
 SELECT count(*) AS total, count(*) FILTER (WHERE a OR b OR c OR d) AS bad, count(*) FILTER (WHERE a) AS n_fecha, count(*) FILTER (WHERE b) AS n_lugar,
  count(*) FILTER (WHERE c) AS n_incoherente, count(*) FILTER (WHERE d) AS n_huerfano FROM ({_MASKS}) m) x""")
def consistency_score(t: Tables):
    return ql.consistency(t.raw, PLAN.text).withColumn("score", F.round("score", D))


def _fences(source: str = "raw") -> str:
    return " , ".join(
        f"(SELECT quantile_cont(v, 0.25) - 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS lo, "
        f"quantile_cont(v, 0.75) + 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS hi FROM (SELECT {_NUM.format(c=c)} AS v FROM {source}) s) f{i}"
        for i, c in enumerate(ACCURACY))


def _out(i: int, c: str) -> str:
    return f"coalesce({_NUM.format(c=c)} < f{i}.lo OR {_NUM.format(c=c)} > f{i}.hi, FALSE)"


_BAD = " OR ".join(_out(i, c) for i, c in enumerate(ACCURACY))


@query("accuracy_score", views="raw", sql=f"""
SELECT count(*) AS total, count(*) FILTER (WHERE {_BAD} OR class_txt LIKE 'Inviabile%') AS bad,
 round(1e2 * count(*) FILTER (WHERE NOT ({_BAD} OR class_txt LIKE 'Inviabile%')) / count(*), 6) AS score FROM raw, {_fences()}""")
def accuracy_score(t: Tables):
    return ql.accuracy(t.raw, ACCURACY, "class_txt").withColumn("score", F.round("score", D))


_REC = f"""SELECT @keys count(*) AS total, count(*) - count(*) FILTER (WHERE d >= DATE '1997-01-01') AS bad,
 round(1e2 * count(*) FILTER (WHERE d >= DATE '1997-01-01') / count(*), 6) AS score, max(d) AS ultima,
 CAST(DATE '{AS_OF}' - max(d) AS INTEGER) AS desfase_dias, round((DATE '{AS_OF}' - max(d)) / 30.44, 6) AS desfase_meses
 FROM (SELECT scope, CASE WHEN {_ISO} THEN TRY_CAST(fecha_txt AS DATE) END AS d FROM raw) r"""


def _rec(keys: str) -> str:
    return _REC.replace("@keys", keys)


@query("recency_score", views="raw", sql=_rec("'Todos' AS scope,") + " UNION ALL " + _rec("scope,") + " GROUP BY scope")
def recency_score(t: Tables):
    day = F.when(~p.not_iso("fecha_txt"), parse_date("fecha_txt"))
    whole = ql.recency(t.raw, day, AS_OF).select(F.lit("Todos").alias("scope"), "*")
    out = whole.unionByName(ql.recency(t.raw, day, AS_OF, by="scope"))
    return out.withColumns({c: F.round(c, D) for c in ("score", "desfase_meses")})


_SIX = f"""SELECT 'Completitud' AS dimension, count(*) * 12 AS total, CAST(sum({_MISS_ALL}) AS BIGINT) AS bad FROM raw
UNION ALL SELECT 'Unicidad', CAST(sum(n) AS BIGINT), CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM raw GROUP BY {_ALL}) g
UNION ALL SELECT 'Validez', CAST(sum(evaluados) AS BIGINT), CAST(sum(fuera) AS BIGINT) FROM ({_VAL}) v
UNION ALL SELECT 'Consistencia', count(*), count(*) FILTER (WHERE a OR b OR c OR d) FROM ({_MASKS}) m
UNION ALL SELECT 'Exactitud', count(*), count(*) FILTER (WHERE {_BAD} OR class_txt LIKE 'Inviabile%') FROM raw, {_fences()}
UNION ALL SELECT 'Actualidad', total, bad FROM ({_rec('')}) r"""


@query("quality_scorecard", views="raw", sql=f"""
SELECT dimension, total, bad, round(1e2 * (total - bad) / total, 6) AS score,
 CASE dimension WHEN 'Completitud' THEN 1e2 * (total - bad) / total >= 92 WHEN 'Unicidad' THEN 1e2 * (total - bad) / total >= 95
  WHEN 'Validez' THEN 1e2 * (total - bad) / total >= 95 WHEN 'Consistencia' THEN 1e2 * (total - bad) / total >= 92
  WHEN 'Exactitud' THEN 1e2 * (total - bad) / total >= 92
  ELSE (SELECT desfase_dias FROM ({_rec('')}) r) <= 1825 END AS cumple FROM ({_SIX}) s""")
def quality_scorecard(t: Tables):
    return ql.scorecard(t.raw, PLAN, D)


@query("quality_compliance", views="raw", sql=f"""
SELECT scope, desfase_dias, desfase_dias <= 1825 AS actualidad_ok, completitud, completitud >= 92 AS completitud_ok FROM (
 SELECT scope, CAST(DATE '{AS_OF}' - max(CASE WHEN {_ISO} THEN TRY_CAST(fecha_txt AS DATE) END) AS INTEGER) AS desfase_dias,
  round(1e2 * (count(*) * 12 - sum({_MISS_ALL})) / (count(*) * 12), 6) AS completitud FROM raw GROUP BY scope) x""")
def quality_compliance(t: Tables):
    missing = sum((is_missing(c).cast("int") for c in COLUMNS), F.lit(0))
    day = F.when(~p.not_iso("fecha_txt"), parse_date("fecha_txt"))
    cells = F.count(F.lit(1)) * len(COLUMNS)
    by = t.raw.groupBy("scope").agg(
        F.date_diff(F.lit(AS_OF).cast("date"), F.max(day)).alias("desfase_dias"),
        F.round((cells - F.sum(missing)) * 100.0 / cells, D).alias("completitud"))
    return by.select(
        "scope", "desfase_dias", ql.complies(F.lit("Actualidad"), F.lit(0.0), F.col("desfase_dias")).alias("actualidad_ok"),
        "completitud", ql.complies(F.lit("Completitud"), F.col("completitud"), F.lit(0)).alias("completitud_ok"))


def _treated(raw):
    """The loaded rows back as text columns, so that the same measures apply before and after."""
    return cl.clean_records(raw, SCHEMA, TRADE).select(
        F.col("fecha").cast("string").alias("fecha_txt"), F.year("fecha").cast("string").alias("anio_txt"), F.month("fecha").cast("string").alias("mes_txt"),
        F.initcap("place").alias("place_txt"), F.col("system").alias("system_txt"), F.col("irca_clean").alias("irca_txt"),
        F.col("risk_class").alias("class_txt"), "storage_txt", "rain_txt", "coverage_txt", "use_txt", "scope", "l_linenumber")


_TREATED = f"""SELECT CAST(fecha AS VARCHAR) AS fecha_txt, upper(substr(place, 1, 1)) || lower(substr(place, 2)) AS place_txt, system AS system_txt,
 irca_clean AS irca_txt, risk_class AS class_txt, storage_txt, rain_txt, coverage_txt, use_txt, l_linenumber FROM valid WHERE rn = 1"""
_TVAL = _VAL.replace("FROM raw", "FROM tr")
_TBAD = f"SELECT count(*) AS total, count(*) FILTER (WHERE {_BAD} OR class_txt LIKE 'Inviabile%') AS bad FROM tr, {_fences('tr')}"


@query("quality_before_after", views="valid", sql=f"""
WITH tr AS ({_TREATED}),
before AS (SELECT dimension, 1e2 * (total - bad) / total AS s FROM ({_SIX}) x WHERE dimension IN ('Completitud', 'Validez', 'Consistencia', 'Exactitud')
 UNION ALL SELECT 'Unicidad', 1e2 * count(*) / sum(n) FROM (SELECT count(*) AS n FROM raw GROUP BY fecha_txt, place_txt, system_txt, l_linenumber) g),
after AS (SELECT 'Completitud' AS dimension, 1e2 * (12 * count(*) - count(*) FILTER (WHERE {_MISSING.format(c='irca_txt')})) / (12 * count(*)) AS s FROM raw
 UNION ALL SELECT 'Unicidad', 1e2 * count(*) / sum(n) FROM (SELECT count(*) AS n FROM tr GROUP BY fecha_txt, place_txt, system_txt, l_linenumber) g
 UNION ALL SELECT 'Validez', 1e2 * (sum(evaluados) - sum(fuera)) / sum(evaluados) FROM ({_TVAL}) v
 UNION ALL SELECT 'Consistencia', 1e2 * count(*) FILTER (WHERE NOT (contains(place_txt, '@') OR (irca_txt IS NOT NULL AND class_txt <> {_CLASS.replace('v <=', 'CAST(irca_txt AS DOUBLE) <=')}))) / count(*) FROM tr
 UNION ALL SELECT 'Exactitud', 1e2 * (total - bad) / total FROM ({_TBAD}) b)
SELECT dimension, round(b.s, 6) AS antes, round(a.s, 6) AS despues, round(a.s - b.s, 6) AS delta FROM before b JOIN after a USING (dimension)""")
def quality_before_after(t: Tables):
    """Completeness after treatment counts every raw row: rain is imputed, the system gets a category, the index stays missing."""
    plan = replace(PLAN, key=("fecha_txt", "place_txt", "system_txt", "l_linenumber"))
    with work_folder(t.spark, "before-after") as folder:
        raw = store(t.raw, folder)
        before, after = ql.scores_before_and_after(raw, _treated(raw), plan)
        filled = ql.impute_median(raw.withColumn("rain", safe_double("rain_txt")), ["rain"], ["mes_txt", "scope"], stored=True)
        filled = filled.withColumns({"rain_txt": F.col("rain").cast("string"), "system_txt": F.coalesce(cl.null_if_missing("system_txt"), F.lit(TRADE.out_of_coverage))})
        complete = written(ql.completeness(filled, COLUMNS), "completeness").select(F.lit("Completitud").alias("dimension"), "score")
    after = after.where(~F.col("dimension").isin("Completitud", "Actualidad")).select("dimension", "score").unionByName(complete)
    return ql.compare_scores(before, after, D)


_Q = "round(quantile_cont(v, {p}), 6)"


@query("numeric_profile", views="raw", sql=f"""
SELECT variable, count(v) AS n, round(avg(v), 6) AS media, round(stddev_samp(v), 6) AS desv, round(min(v), 6) AS min, {_Q.format(p=0.25)} AS q1,
 {_Q.format(p=0.5)} AS mediana, {_Q.format(p=0.75)} AS q3, round(max(v), 6) AS max FROM ({_long(RULES, _NUM)}) x WHERE v IS NOT NULL GROUP BY variable""")
def numeric_profile(t: Tables):
    return ql.numeric_profile(t.raw, list(RULES), D)


@query("tukey_outliers", views="raw", sql=f"""
WITH x AS (SELECT * FROM ({_long(RULES, _NUM)}) y WHERE v IS NOT NULL),
f AS (SELECT variable, count(*) AS n, quantile_cont(v, 0.25) - 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS lo,
 quantile_cont(v, 0.75) + 1.5 * (quantile_cont(v, 0.75) - quantile_cont(v, 0.25)) AS hi FROM x GROUP BY variable)
SELECT variable, n, round(lo, 6) AS li, round(hi, 6) AS ls, count(*) FILTER (WHERE v < lo OR v > hi) AS conteo,
 round(1e2 * count(*) FILTER (WHERE v < lo OR v > hi) / n, 6) AS porcentaje, min(v) AS min, max(v) AS max FROM x JOIN f USING (variable) GROUP BY variable, n, lo, hi""")
def tukey_outliers(t: Tables):
    return ql.tukey_outliers(t.raw, list(RULES), D)


@query("group_median", sql="SELECT mes, region, count(rain) AS n, quantile_cont(rain, 0.5) AS mediana FROM measure WHERE rain IS NOT NULL GROUP BY mes, region")
def group_median(t: Tables):
    return ql.group_median(t.measure, "rain", ["mes", "region"])


@query("impute_group_median", sql="""
WITH m AS (SELECT mes, region, quantile_cont(rain, 0.5) AS r, quantile_cont(irca, 0.5) AS i FROM measure GROUP BY mes, region)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(rain, r, 0) AS rain, rain IS NULL AS rain_imputado, coalesce(irca, i, 0) AS irca, irca IS NULL AS irca_imputado
FROM measure JOIN m USING (mes, region)""")
def impute_group_median(t: Tables):
    out = ql.impute_median(t.measure, ["rain", "irca"], ["mes", "region"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "rain", "rain_imputado", "irca", "irca_imputado")


@query("calendar_gaps", views=None, sql="""
SELECT *, CAST(ultima - primera AS INTEGER) + 1 AS dias_rango, CAST(ultima - primera AS INTEGER) + 1 - dias_con_datos AS dias_sin_datos FROM (
 SELECT user_id, min(d) AS primera, max(d) AS ultima, count(DISTINCT d) AS dias_con_datos FROM (SELECT user_id, CAST(ts AS DATE) AS d FROM events) e GROUP BY user_id) g""")
def calendar_gaps(t: Tables):
    return ql.calendar_gaps(t["events"].withColumn("d", F.col("ts").cast("date")), "d", ["user_id"])


@query("calendar_gap_days", views=None, sql="""
WITH e AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS d FROM events), r AS (SELECT user_id, min(d) AS a, max(d) AS z FROM e GROUP BY user_id)
SELECT user_id, CAST(g AS DATE) AS d FROM (SELECT user_id, unnest(generate_series(a, z, INTERVAL 1 DAY)) AS g FROM r) s
WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.user_id = s.user_id AND e.d = CAST(s.g AS DATE))""")
def calendar_gap_days(t: Tables):
    return ql.calendar_gap_days(t["events"].withColumn("d", F.col("ts").cast("date")), "d", ["user_id"])


_ZERO = [
    ("storage_txt", "almacenamiento negativo", "Validez", f"{_NUM.format(c='storage_txt')} < 0"),
    ("irca_txt", "irca sobre 100", "Validez", f"{_NUM.format(c='irca_txt')} > 100"),
    ("rain_txt", "lluvia negativa", "Validez", f"{_NUM.format(c='rain_txt')} < 0"),
    ("rain_txt", "fuera de -10 a 50", "Validez", f"{_NUM.format(c='rain_txt')} < -10 OR {_NUM.format(c='rain_txt')} > 50"),
    ("coverage_txt", "cobertura sobre 100", "Validez", f"{_NUM.format(c='coverage_txt')} > 100"),
    ("use_txt", "consumo negativo", "Validez", f"{_NUM.format(c='use_txt')} < 0"),
    ("fecha_txt / anio_txt / mes_txt", "fecha contra anio y mes", "Consistencia", f"""{_ISO} AND TRY_CAST(fecha_txt AS DATE) IS NOT NULL
  AND (year(TRY_CAST(fecha_txt AS DATE)) <> CAST(anio_txt AS INTEGER) OR month(TRY_CAST(fecha_txt AS DATE)) <> CAST(mes_txt AS INTEGER))"""),
]
_DAY = f"CASE WHEN {_ISO} THEN TRY_CAST(fecha_txt AS DATE) END"


@query("zero_checks", views="raw", sql=" UNION ALL ".join(
    f"SELECT '{v}' AS variable, '{n}' AS prueba, count(*) FILTER (WHERE {c}) AS registros, '{d}' AS dimension FROM raw" for v, n, d, c in _ZERO) + f"""
UNION ALL SELECT 'fecha_txt', 'dias sin registros', CAST(max(d) - min(d) AS BIGINT) + 1 - count(DISTINCT d), 'Actualidad' FROM (SELECT {_DAY} AS d FROM raw) x""")
def zero_checks(t: Tables):
    n = lambda c: safe_double(c)
    day = F.when(~p.not_iso("fecha_txt"), parse_date("fecha_txt"))
    conditions = [n("storage_txt") < 0, n("irca_txt") > 100, n("rain_txt") < 0, p.outside(n("rain_txt"), -10, 50), n("coverage_txt") > 100,
                  n("use_txt") < 0, p.date_parts_differ("fecha_txt", "anio_txt", "mes_txt")]
    checks = [ql.ZeroCheck(v, name, d, c) for (v, name, d, _), c in zip(_ZERO, conditions)]
    return ql.zero_checks(t.raw.select(*COLUMNS), [*checks, ql.ZeroCheck("fecha_txt", "dias sin registros", "Actualidad", count=ql.days_without_rows(day))])


def _problems() -> list[ql.Problem]:
    rules = ql.consistency_rules(PLAN.text)
    irca = safe_double("irca_txt")
    day = F.when(~p.not_iso("fecha_txt"), parse_date("fecha_txt"))
    return [
        ql.Problem("P01", "rain_txt", "Completitud", "Medio", is_missing("rain_txt")),
        ql.Problem("P03", "irca_txt", "Completitud", "Alto", is_missing("irca_txt")),
        ql.Problem("P04", "system_txt", "Completitud", "Medio", is_missing("system_txt")),
        ql.Problem("P05", "scope", "Completitud", "Bajo", F.col("scope") == "Global"),
        ql.Problem("P07", "(fila completa)", "Unicidad", "Alto", count=ql.extra_copies([*ORDER, *COLUMNS])),
        ql.Problem("P08", "irca_txt", "Validez", "Alto", p.outside(irca, 0, 100)),
        ql.Problem("P09", "fecha_txt", "Consistencia", "Alto", rules["fecha"]),
        ql.Problem("P10", "place_txt", "Consistencia", "Alto", rules["lugar"]),
        ql.Problem("P11", "irca_txt / class_txt", "Consistencia", "Alto", rules["incoherente"]),
        ql.Problem("P12", "class_txt", "Consistencia", "Medio", rules["huerfano"]),
        ql.Problem("P16", "class_txt", "Exactitud", "Bajo", p.misspelled_class("class_txt")),
        ql.Problem("P17", "irca_txt", "Exactitud", "Medio", ql.outlier(ql.beyond("irca_txt"))),
        ql.Problem("P18", "coverage_txt", "Exactitud", "Bajo", ql.outlier(ql.beyond("coverage_txt"))),
        ql.Problem("P19", "use_txt", "Exactitud", "Bajo", ql.outlier(ql.beyond("use_txt"))),
        ql.Problem("P20", "fecha_txt", "Actualidad", "Medio", ~p.recent(day, F.lit(AS_OF).cast("date"), RECENCY_MONTHS)),
        ql.Problem("P21", "fecha_txt / scope", "Actualidad", "Medio", count=ql.lagging_part(F.col("scope") == "Global", day)),
    ]


_ABOUT = """(VALUES ('P01', 'rain_txt', 'Completitud', 'Medio'), ('P03', 'irca_txt', 'Completitud', 'Alto'), ('P04', 'system_txt', 'Completitud', 'Medio'),
 ('P05', 'scope', 'Completitud', 'Bajo'), ('P07', '(fila completa)', 'Unicidad', 'Alto'), ('P08', 'irca_txt', 'Validez', 'Alto'), ('P09', 'fecha_txt', 'Consistencia', 'Alto'),
 ('P10', 'place_txt', 'Consistencia', 'Alto'), ('P11', 'irca_txt / class_txt', 'Consistencia', 'Alto'), ('P12', 'class_txt', 'Consistencia', 'Medio'),
 ('P16', 'class_txt', 'Exactitud', 'Bajo'), ('P17', 'irca_txt', 'Exactitud', 'Medio'), ('P18', 'coverage_txt', 'Exactitud', 'Bajo'),
 ('P19', 'use_txt', 'Exactitud', 'Bajo'), ('P20', 'fecha_txt', 'Actualidad', 'Medio'), ('P21', 'fecha_txt / scope', 'Actualidad', 'Medio')) i(id, variable, dimension, impacto)"""
_INV = f"""SELECT i.id, i.variable, c.registros, round(1e2 * c.registros / (SELECT count(*) FROM raw), 6) AS porcentaje, i.dimension, i.impacto FROM {_ABOUT} JOIN (
 SELECT 'P01' AS id, count(*) AS registros FROM raw WHERE {_MISSING.format(c='rain_txt')} UNION ALL SELECT 'P03', count(*) FROM raw WHERE {_MISSING.format(c='irca_txt')}
 UNION ALL SELECT 'P04', count(*) FROM raw WHERE {_MISSING.format(c='system_txt')} UNION ALL SELECT 'P05', count(*) FROM raw WHERE scope = 'Global'
 UNION ALL SELECT 'P08', count(*) FROM raw WHERE {_NUM.format(c='irca_txt')} < 0 OR {_NUM.format(c='irca_txt')} > 100
 UNION ALL SELECT unnest(['P09', 'P10', 'P11', 'P12']), unnest([count(*) FILTER (WHERE a), count(*) FILTER (WHERE b), count(*) FILTER (WHERE c), count(*) FILTER (WHERE d)]) FROM ({_MASKS}) m
 UNION ALL SELECT 'P07', extra_rows FROM ({_DUP}) u
 UNION ALL SELECT unnest(['P17', 'P18', 'P19']), unnest([{', '.join(f'count(*) FILTER (WHERE {_out(i, c)})' for i, c in enumerate(ACCURACY))}]) FROM raw, {_fences()}
 UNION ALL SELECT 'P20', bad FROM ({_rec('')}) r
 UNION ALL SELECT 'P21', CASE WHEN g < z OR (g IS NULL AND z IS NOT NULL) THEN n ELSE 0 END FROM (SELECT count(*) FILTER (WHERE scope = 'Global') AS n,
  max({_DAY}) FILTER (WHERE scope = 'Global') AS g, max({_DAY}) AS z FROM raw) l
 UNION ALL SELECT 'P16', count(*) FROM raw WHERE class_txt LIKE 'Inviabile%') c ON c.id = i.id"""
_CAUSES = "(VALUES " + ", ".join(f"('{i}', '{a}', '{b}')" for i, (a, b) in ql.CAUSES.items()) + ") k(id, causa_raiz, causa_secundaria)"
_TREAT = "(VALUES " + ", ".join(f"('{i}', '{a}')" for i, a in ql.TREATMENTS.items()) + ") r(id, tipo_accion)"


def _inventory(t: Tables):
    return ql.problem_inventory(t.raw.select(*ORDER, *COLUMNS), _problems(), D, fenced=ACCURACY)


@query("problem_inventory", views="raw", sql=_INV)
def problem_inventory(t: Tables):
    return _inventory(t)


@query("problem_tally", views="raw", sql=f"""
SELECT 'dimension' AS tipo, dimension AS valor, count(*) AS problemas, string_agg(id, ', ' ORDER BY id) AS ids FROM ({_INV}) x WHERE registros > 0 GROUP BY dimension
UNION ALL SELECT 'impacto', impacto, count(*), string_agg(id, ', ' ORDER BY id) FROM ({_INV}) x WHERE registros > 0 GROUP BY impacto""")
def problem_tally(t: Tables):
    found = _inventory(t).where("registros > 0")
    one = lambda by: ql.problem_tally(found, by).select(F.lit(by).alias("tipo"), F.col(by).alias("valor"), "problemas", "ids")
    return one("dimension").unionByName(one("impacto"))


@query("missing_causes", views="raw", sql=f"""
SELECT id, registros, FALSE AS con_causa FROM ({_INV}) x WHERE id IN ('P08', 'P10', 'P16')
UNION ALL SELECT id, registros, TRUE FROM ({_INV}) x WHERE id NOT IN ('P08', 'P10', 'P16')""")
def missing_causes(t: Tables):
    """Against a cause table that lacks three problems, so that the guard has something to report."""
    partial = ql.cause_table(t.spark, {i: c for i, c in ql.CAUSES.items() if i not in ("P08", "P10", "P16")})
    inventory = _inventory(t)
    lost = ql.missing_causes(inventory, partial).withColumn("con_causa", F.lit(False))
    return inventory.select("id", "registros").join(lost, "id", "left").select("id", "registros", F.coalesce("con_causa", F.lit(True)).alias("con_causa"))


@query("causes_join", views="raw", sql=f"SELECT x.*, k.causa_raiz, k.causa_secundaria FROM ({_INV}) x JOIN {_CAUSES} ON k.id = x.id")
def causes_join(t: Tables):
    return ql.join_causes(_inventory(t), ql.cause_table(t.spark))


@query("cause_summary", views="raw", sql=f"""
WITH j AS (SELECT x.*, k.causa_raiz, k.causa_secundaria FROM ({_INV}) x JOIN {_CAUSES} ON k.id = x.id WHERE registros > 0),
r AS (SELECT id, dimension, impacto, causa_raiz AS causa, TRUE AS raiz FROM j UNION ALL SELECT id, dimension, impacto, causa_secundaria, FALSE FROM j WHERE causa_secundaria <> '')
SELECT causa, count(*) FILTER (WHERE raiz) AS como_raiz, count(*) FILTER (WHERE NOT raiz) AS como_secundaria, count(*) FILTER (WHERE raiz AND impacto = 'Alto') AS impacto_alto,
 coalesce(string_agg(id, ', ' ORDER BY id) FILTER (WHERE raiz), '') AS ids, coalesce(string_agg(DISTINCT dimension, ', ' ORDER BY dimension) FILTER (WHERE raiz), '') AS dimensiones
FROM r GROUP BY causa""")
def cause_summary(t: Tables):
    return ql.cause_summary(ql.join_causes(_inventory(t).where("registros > 0"), ql.cause_table(t.spark)))


@query("rules_with_impact", views="raw", sql=f"""
SELECT r.id, r.tipo_accion, coalesce(x.impacto, '') AS impacto, coalesce(x.dimension, '') AS dimension, coalesce(x.registros, 0) AS registros FROM {_TREAT} LEFT JOIN ({_INV}) x ON x.id = r.id""")
def rules_with_impact(t: Tables):
    inventory = _inventory(t)
    rules = ql.rules_with_impact(ql.treatment_table(t.spark), inventory).drop("porcentaje")
    return rules.join(inventory.select("id", "registros"), "id", "left").na.fill(0, ["registros"])


@query("rules_applied", views="raw", sql=f"SELECT r.id, r.tipo_accion FROM {_TREAT} WHERE r.id IN (SELECT id FROM ({_INV}) x WHERE registros > 0)")
def rules_applied(t: Tables):
    return ql.rules_applied(ql.treatment_table(t.spark), _inventory(t).where("registros > 0"))

"""Column functions and row predicates."""

from pyspark.sql import functions as F

from .. import functions as fn
from ..domain import TRADE
from ..operators import predicates as p
from .registry import query
from .views import ORDER, RAW_ORDER, Tables

_MARKERS = "('', 'n/a', 'na', 'null', 'none', '-', 'n/d')"
_ISO = r"regexp_full_match(fecha_txt, '\d{4}-\d{2}-\d{2}')"
_IRCA = "TRY_CAST(CASE WHEN regexp_full_match(irca_txt, '[+-]?[0-9]+([.][0-9]+)?') THEN irca_txt END AS DOUBLE)"
_ID = "l_orderkey, l_linenumber, l_partkey, l_suppkey, copy_no"
_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "copy_no"]


@query("missing_markers", views="raw", sql=f"""
SELECT {_ID}, lower(trim(irca_txt)) IN {_MARKERS} AS irca_missing, lower(trim(system_txt)) IN {_MARKERS} AS system_missing FROM raw""")
def missing_markers(t: Tables):
    return t.raw.select(*_KEYS, fn.is_missing("irca_txt").alias("irca_missing"), fn.is_missing("system_txt").alias("system_missing"))


@query("date_format_check", views="raw", sql=f"""
SELECT {_ID}, fecha_txt FROM raw WHERE NOT {_ISO}""")
def date_format_check(t: Tables):
    return t.raw.where(p.not_iso("fecha_txt")).select(*_KEYS, "fecha_txt")


@query("text_hygiene", views="raw", sql=f"""
SELECT {_ID}, place_txt FROM raw WHERE place_txt <> trim(place_txt) OR contains(place_txt, '@')
 OR (place_txt = upper(place_txt) AND place_txt <> lower(place_txt)) OR (place_txt = lower(place_txt) AND place_txt <> upper(place_txt))""")
def text_hygiene(t: Tables):
    return t.raw.where(p.untidy("place_txt")).select(*_KEYS, "place_txt")


_CLASS = """CASE WHEN v <= 5 THEN 'Sin riesgo (0-5)' WHEN v <= 14 THEN 'Bajo riesgo (5-14)' WHEN v <= 28 THEN 'Riesgo medio (14-28)'
 WHEN v <= 40 THEN 'Alto riesgo (28-40)' ELSE 'Inviable sanitariamente (>40)' END"""


@query("class_coherence", views="raw", sql=f"""
SELECT {_ID}, irca_txt, class_txt FROM (SELECT *, {_IRCA} AS v FROM raw) r
WHERE v IS NOT NULL AND class_txt <> {_CLASS}""")
def class_coherence(t: Tables):
    return t.raw.where(p.class_mismatch("irca_txt", "class_txt")).select(*_KEYS, "irca_txt", "class_txt")


@query("class_orphans", views="raw", sql=f"""
SELECT {_ID}, irca_txt, class_txt FROM raw WHERE lower(trim(irca_txt)) IN {_MARKERS} AND lower(trim(class_txt)) NOT IN {_MARKERS}""")
def class_orphans(t: Tables):
    return t.raw.where(p.class_orphan("irca_txt", "class_txt")).select(*_KEYS, "irca_txt", "class_txt")


@query("date_parts_coherence", views="raw", sql=f"""
SELECT {_ID}, fecha_txt, anio_txt, mes_txt FROM (SELECT *, CASE WHEN {_ISO} THEN TRY_CAST(fecha_txt AS DATE) END AS d FROM raw) r
WHERE d IS NOT NULL AND (year(d) <> CAST(anio_txt AS INTEGER) OR month(d) <> CAST(mes_txt AS INTEGER))""")
def date_parts_coherence(t: Tables):
    return t.raw.where(p.date_parts_differ("fecha_txt", "anio_txt", "mes_txt")).select(*_KEYS, "fecha_txt", "anio_txt", "mes_txt")


@query("category_typo", views="raw", sql="""
SELECT class_txt, count(*) AS n, count(DISTINCT place_txt) AS places FROM raw WHERE class_txt LIKE 'Inviabile%' GROUP BY class_txt""")
def category_typo(t: Tables):
    return t.raw.where(p.misspelled_class("class_txt")).groupBy("class_txt").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("place_txt").alias("places"))


@query("risk_despite_service", sql="""
SELECT region, count(*) AS n, count(*) FILTER (WHERE service = 'Continuous' AND irca > 40) AS cases FROM measure GROUP BY region""")
def risk_despite_service(t: Tables):
    both = (F.col("service") == TRADE.continuous) & (F.col("irca") > 40)
    return t.measure.groupBy("region").agg(F.count(F.lit(1)).alias("n"), fn.count_if(both).alias("cases"))


@query("normalised_diff", views="raw", sql=f"""
SELECT {_ID}, '[' || place_txt || ']' AS original, upper(trim(place_txt)) AS destino FROM raw WHERE place_txt <> upper(trim(place_txt))""")
def normalised_diff(t: Tables):
    fixed = fn.normalise_place("place_txt")
    return t.raw.where(F.col("place_txt") != fixed).select(
        *_KEYS, F.concat(F.lit("["), "place_txt", F.lit("]")).alias("original"), fixed.alias("destino"))


@query("normalise_place", views="raw", sql=f"""
SELECT {_ID}, upper(trim(place_txt)) AS place, replace(upper(trim(place_txt)), '@', 'O') AS place_fixed FROM raw""")
def normalise_place(t: Tables):
    return t.raw.select(*_KEYS, fn.normalise_place("place_txt").alias("place"), fn.normalise_place("place_txt", "O").alias("place_fixed"))


@query("null_and_flag", views="raw", sql=f"""
SELECT {_ID}, v AS irca_clean, CASE WHEN v IS NULL THEN 'No' ELSE 'Si' END AS irca_reportado
FROM (SELECT *, CASE WHEN lower(trim(irca_txt)) NOT IN {_MARKERS} THEN trim(irca_txt) END AS v FROM raw) r""")
def null_and_flag(t: Tables):
    value = fn.null_if_missing("irca_txt")
    return t.raw.select(*_KEYS, value.alias("irca_clean"), F.when(value.isNull(), "No").otherwise("Si").alias("irca_reportado"))


@query("na_to_category", views="raw", sql=f"""
SELECT system, count(*) AS n FROM (SELECT CASE WHEN lower(trim(system_txt)) IN {_MARKERS} THEN 'Out of coverage' ELSE trim(system_txt) END AS system FROM raw) r
GROUP BY system""")
def na_to_category(t: Tables):
    return t.raw.groupBy(fn.missing_to_category("system_txt", TRADE.out_of_coverage).alias("system")).agg(F.count(F.lit(1)).alias("n"))


@query("parse_dates", views="valid", sql=f"SELECT {_ID}, fecha_txt, fecha_iso, fecha FROM routed")
def parse_dates(t: Tables):
    from ..functions.dates import iso_text
    return t.raw.select(*_KEYS, "fecha_txt", iso_text("fecha_txt").alias("fecha_iso"), fn.parse_date("fecha_txt").alias("fecha"))


@query("bucketise_risk", sql="SELECT risk_class, count(*) AS n, min(irca) AS low, max(irca) AS high FROM measure GROUP BY risk_class")
def bucketise_risk(t: Tables):
    return t.measure.groupBy(fn.risk_class("irca").alias("risk_class")).agg(
        F.count(F.lit(1)).alias("n"), F.min("irca").alias("low"), F.max("irca").alias("high"))


@query("risk_group_counts", sql="SELECT region, risk_group, count(*) AS n FROM measure GROUP BY ALL")
def risk_group_counts(t: Tables):
    return t.measure.groupBy("region", fn.risk_group("irca").alias("risk_group")).agg(F.count(F.lit(1)).alias("n"))


@query("safe_cast", views="raw", sql=f"""
SELECT {_ID}, irca_txt, {_IRCA} AS irca, TRY_CAST(use_txt AS DOUBLE) AS water_use FROM raw""")
def safe_cast(t: Tables):
    return t.raw.select(*_KEYS, "irca_txt", fn.safe_double("irca_txt").alias("irca"), fn.safe_double("use_txt").alias("water_use"))


@query("date_patterns", views="raw", sql=f"""
SELECT regexp_replace(fecha_txt, '[0-9]', '9', 'g') AS pattern, count(*) AS n FROM raw GROUP BY 1""")
def date_patterns(t: Tables):
    return t.raw.groupBy(fn.mask_digits("fecha_txt").alias("pattern")).agg(F.count(F.lit(1)).alias("n"))


@query("display_name", views=None, sql="""
SELECT p_partkey, CASE p_name WHEN 'red widget' THEN 'RED Widget' ELSE
 upper(substr(split_part(p_name, ' ', 1), 1, 1)) || lower(substr(split_part(p_name, ' ', 1), 2)) || ' ' ||
 upper(substr(split_part(p_name, ' ', 2), 1, 1)) || lower(substr(split_part(p_name, ' ', 2), 2)) END AS display_name FROM part""")
def display_name(t: Tables):
    return t["part"].select("p_partkey", fn.display_name("p_name", {"red widget": "RED Widget"}).alias("display_name"))


@query("metric_from_text", views=None, sql="""
SELECT event_id, TRY_CAST(regexp_extract(props, '[-+]?\\d+(?:\\.\\d+)?') AS DOUBLE) AS metric FROM events""")
def metric_from_text(t: Tables):
    return t["events"].select("event_id", fn.number_from_text("props").alias("metric"))


@query("period_previous", sql="""
SELECT p.periodo, p.previous, q.periodo IS NOT NULL AS has_data FROM
 (SELECT DISTINCT periodo, CAST(anio - 1 AS VARCHAR) || substr(periodo, 5, 3) AS previous FROM measure) p
 LEFT JOIN (SELECT DISTINCT periodo FROM measure) q ON q.periodo = p.previous""")
def period_previous(t: Tables):
    periods = t.measure.select("periodo").distinct()
    back = periods.select(F.col("periodo").alias("previous"), F.lit(True).alias("_hit"))
    return periods.withColumn("previous", fn.previous_period("periodo")).join(back, "previous", "left").select(
        "periodo", "previous", F.coalesce("_hit", F.lit(False)).alias("has_data"))


@query("format_thousands", sql="""
SELECT region, count(*) AS n, replace(format('{:,}', count(*)), ',', '.') AS texto FROM measure GROUP BY region""")
def format_thousands(t: Tables):
    return t.measure.groupBy("region").agg(F.count(F.lit(1)).alias("n")).select("region", "n", fn.format_thousands("n").alias("texto"))

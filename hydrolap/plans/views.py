"""The measurement views over the order tables: as DataFrames and as SQL for the oracle."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions import risk_class, risk_group
from ..functions.dates import quarter_label

ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
RAW_ORDER = ORDER + ["copy_no"]

# Reading a footer for the schema costs a job per table; the tables do not change.
_SCHEMAS: dict[str, StructType] = {}


class Tables:
    """Lazy access to one scale-factor folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def __getitem__(self, name: str) -> DataFrame:
        path = self.path(name)
        if path not in _SCHEMAS:
            _SCHEMAS[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_SCHEMAS[path]).parquet(path)

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with their order's place. The order side is joined first, so that the
        largest table is shuffled once. Line items and orders both grow with the data, so neither
        is broadcast; a merge join lets AQE split a hot order key."""
        geography = self["nation"].join(self["region"], F.col("n_regionkey") == F.col("r_regionkey"))
        buyers = self["customer"].join(geography, F.col("c_nationkey") == F.col("n_nationkey"))
        orders = (
            self["orders"]
            .join(buyers, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", F.col("o_orderdate").cast("date").alias("fecha"), "c_name", "c_mktsegment", "n_name", "r_name")
        )
        return self["lineitem"].hint("merge").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))

    @cached_property
    def measure(self) -> DataFrame:
        """Clean, typed measurements."""
        year, month = F.year("fecha"), F.month("fecha")
        flag, status = F.col("l_returnflag"), F.col("l_linestatus")
        service = (
            F.when(((year < 2000) & (F.col("r_name") == "EUROPE")) | (flag == "A"), "Continuous")
            .when((flag == "N") & (status == "O"), "Intermittent")
            .when((flag == "N") & (status == "F"), "Rationed")
            .otherwise("No service")
        )
        decision = F.when((year >= 2000) & (month % 3 == 0), "Rationing").otherwise("No restriction")
        typed = self.lines.select(
            *ORDER,
            "fecha",
            year.alias("anio"),
            month.alias("mes"),
            F.quarter("fecha").alias("trimestre"),
            quarter_label("fecha").alias("periodo"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("department"),
            F.col("c_name").alias("place"),
            F.col("c_mktsegment").alias("system"),
            F.when(F.col("l_partkey") % 50 != 0, F.col("l_quantity")).alias("irca"),
            (100 - F.col("l_tax") * 500).alias("coverage"),
            (20 + F.col("l_discount") * 700).alias("storage"),
            (F.col("l_extendedprice") / 1000).alias("water_use"),
            F.when(F.col("l_suppkey") % 20 != 0, (F.col("l_partkey") % 15).cast("double")).alias("rain"),
            service.alias("service"),
            decision.alias("decision"),
        )
        return typed.withColumns({"risk_class": risk_class("irca"), "risk_group": risk_group("irca")})

    @cached_property
    def raw(self) -> DataFrame:
        """Text-only records with defects placed by integer arithmetic on the keys."""
        okey, pkey, skey = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey"))
        fecha, name, qty = F.col("fecha"), F.col("c_name"), F.col("l_quantity").cast("int")
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        storage = F.round(20 + F.col("l_discount") * 700).cast("int")
        stored_class = risk_class(qty, (
            "Sin riesgo (0-5)", "Bajo riesgo (5-14)", "Riesgo medio (14-28)", "Alto riesgo (28-40)",
            "Inviabile sanitariamente (>40)"))
        bad_date, iso = okey % 100, fecha.cast("string")
        copies = F.when(okey % 200 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        texts = [
            F.when(bad_date == 1, F.concat_ws("/", iso.substr(9, 2), iso.substr(6, 2), iso.substr(1, 4)))
            .when(bad_date == 2, F.concat_ws("-", iso.substr(6, 2), iso.substr(9, 2), iso.substr(1, 4)))
            .when(bad_date == 3, F.translate(iso, "-", "/"))
            .when(bad_date == 4, F.concat(iso.substr(1, 4), F.lit("-13-"), iso.substr(9, 2)))
            .otherwise(iso).alias("fecha_txt"),
            (F.year(fecha) + F.when(okey % 997 == 5, 1).otherwise(0)).cast("string").alias("anio_txt"),
            F.month(fecha).cast("string").alias("mes_txt"),
            F.when(pkey % 67 == 1, F.upper(name)).when(pkey % 67 == 2, F.lower(name))
            .when(pkey % 67 == 3, F.translate(name, "o", "@")).when(pkey % 67 == 4, F.concat(F.lit(" "), name))
            .when(pkey % 67 == 5, F.concat(name, F.lit(" "))).otherwise(name).alias("place_txt"),
            F.when(skey % 3 == 0, "N/A").otherwise(F.col("c_mktsegment")).alias("system_txt"),
            F.when(pkey % 50 == 0, "").when(pkey % 50 == 1, "N/A")
            .when(pkey % 125 == 7, F.concat(F.lit("-"), qty)).when(pkey % 401 == 9, "abc")
            .otherwise(qty.cast("string")).alias("irca_txt"),
            stored_class.alias("class_txt"),
            F.when(pkey % 97 == 5, storage + 60).otherwise(storage).cast("string").alias("storage_txt"),
            F.when(skey % 20 == 0, "").otherwise((pkey % 15).cast("string")).alias("rain_txt"),
            F.round(100 - F.col("l_tax") * 500).cast("int").cast("string").alias("coverage_txt"),
            F.concat(F.floor(cents / 1000), F.lit("."), F.lpad((cents % 1000).cast("string"), 3, "0")).alias("use_txt"),
            F.when(F.col("r_name") == "AFRICA", "Global").when(F.col("r_name") == "EUROPE", "Regional")
            .otherwise("Nacional").alias("scope"),
        ]
        # Stored texts in real use: a generator keeps their derivation out of later filters.
        rows = self.lines.select(*ORDER, copies.alias("copies"), F.inline(F.array(F.struct(*texts))))
        return rows.select(*ORDER, F.explode("copies").alias("copy_no"), *rows.columns[len(ORDER) + 1:])


_LINES = """lines AS (
 SELECT l.*, CAST(o.o_orderdate AS DATE) AS fecha, c.c_name, c.c_mktsegment, n.n_name, r.r_name
 FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
 JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

_MEASURE = """typed AS (
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, fecha,
  CAST(year(fecha) AS INTEGER) AS anio, CAST(month(fecha) AS INTEGER) AS mes, CAST(quarter(fecha) AS INTEGER) AS trimestre,
  CAST(year(fecha) AS VARCHAR) || '-T' || CAST(quarter(fecha) AS VARCHAR) AS periodo,
  r_name AS region, n_name AS department, c_name AS place, c_mktsegment AS system,
  CASE WHEN l_partkey % 50 <> 0 THEN l_quantity END AS irca,
  100 - l_tax * 500 AS coverage, 20 + l_discount * 700 AS storage, l_extendedprice / 1000 AS water_use,
  CASE WHEN l_suppkey % 20 <> 0 THEN CAST(l_partkey % 15 AS DOUBLE) END AS rain,
  CASE WHEN (year(fecha) < 2000 AND r_name = 'EUROPE') OR l_returnflag = 'A' THEN 'Continuous'
       WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Intermittent'
       WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'Rationed' ELSE 'No service' END AS service,
  CASE WHEN year(fecha) >= 2000 AND month(fecha) % 3 = 0 THEN 'Rationing' ELSE 'No restriction' END AS decision
 FROM lines),
measure AS (
 SELECT *, CASE WHEN irca IS NULL THEN NULL WHEN irca <= 5 THEN 'Sin riesgo (0-5)' WHEN irca <= 14 THEN 'Bajo riesgo (5-14)'
  WHEN irca <= 28 THEN 'Riesgo medio (14-28)' WHEN irca <= 40 THEN 'Alto riesgo (28-40)'
  ELSE 'Inviable sanitariamente (>40)' END AS risk_class,
  CASE WHEN irca IS NULL THEN 'Sin dato' WHEN irca <= 14 THEN 'Bajo o nulo' WHEN irca <= 28 THEN 'Medio'
  ELSE 'Alto o inviable' END AS risk_group
 FROM typed)"""

_RAW = """raw AS (
 SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, copy_no,
  CASE l_orderkey % 100 WHEN 1 THEN strftime(fecha, '%d/%m/%Y') WHEN 2 THEN strftime(fecha, '%m-%d-%Y')
   WHEN 3 THEN strftime(fecha, '%Y/%m/%d') WHEN 4 THEN strftime(fecha, '%Y') || '-13-' || strftime(fecha, '%d')
   ELSE strftime(fecha, '%Y-%m-%d') END AS fecha_txt,
  CAST(year(fecha) + CASE WHEN l_orderkey % 997 = 5 THEN 1 ELSE 0 END AS VARCHAR) AS anio_txt,
  CAST(month(fecha) AS VARCHAR) AS mes_txt,
  CASE l_partkey % 67 WHEN 1 THEN upper(c_name) WHEN 2 THEN lower(c_name) WHEN 3 THEN replace(c_name, 'o', '@')
   WHEN 4 THEN ' ' || c_name WHEN 5 THEN c_name || ' ' ELSE c_name END AS place_txt,
  CASE WHEN l_suppkey % 3 = 0 THEN 'N/A' ELSE c_mktsegment END AS system_txt,
  CASE WHEN l_partkey % 50 = 0 THEN '' WHEN l_partkey % 50 = 1 THEN 'N/A'
   WHEN l_partkey % 125 = 7 THEN '-' || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR)
   WHEN l_partkey % 401 = 9 THEN 'abc' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS irca_txt,
  CASE WHEN l_quantity <= 5 THEN 'Sin riesgo (0-5)' WHEN l_quantity <= 14 THEN 'Bajo riesgo (5-14)'
   WHEN l_quantity <= 28 THEN 'Riesgo medio (14-28)' WHEN l_quantity <= 40 THEN 'Alto riesgo (28-40)'
   ELSE 'Inviabile sanitariamente (>40)' END AS class_txt,
  CAST(CAST(round(20 + l_discount * 700) AS INTEGER) + CASE WHEN l_partkey % 97 = 5 THEN 60 ELSE 0 END AS VARCHAR) AS storage_txt,
  CASE WHEN l_suppkey % 20 = 0 THEN '' ELSE CAST(l_partkey % 15 AS VARCHAR) END AS rain_txt,
  CAST(CAST(round(100 - l_tax * 500) AS INTEGER) AS VARCHAR) AS coverage_txt,
  CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // 1000 AS VARCHAR) || '.' ||
   lpad(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) % 1000 AS VARCHAR), 3, '0') AS use_txt,
  CASE r_name WHEN 'AFRICA' THEN 'Global' WHEN 'EUROPE' THEN 'Regional' ELSE 'Nacional' END AS scope
 FROM (SELECT *, 0 AS copy_no FROM lines UNION ALL SELECT *, 1 AS copy_no FROM lines WHERE l_orderkey % 200 = 0) x)"""

# Normalised, typed and routed raw records; the cleaning queries share this text.
_ROUTED = r"""norm AS (
 SELECT *, upper(trim(place_txt)) AS place,
  CASE WHEN lower(trim(system_txt)) IN ('', 'n/a', 'na', 'null', 'none', '-', 'n/d') THEN 'Out of coverage' ELSE trim(system_txt) END AS system,
  CASE WHEN lower(trim(irca_txt)) IN ('', 'n/a', 'na', 'null', 'none', '-', 'n/d') THEN NULL ELSE trim(irca_txt) END AS irca_clean,
  CASE WHEN regexp_full_match(fecha_txt, '\d{4}-\d{2}-\d{2}') THEN fecha_txt
   WHEN regexp_full_match(fecha_txt, '\d{2}/\d{2}/\d{4}') THEN substr(fecha_txt, 7, 4) || '-' || substr(fecha_txt, 4, 2) || '-' || substr(fecha_txt, 1, 2)
   WHEN regexp_full_match(fecha_txt, '\d{2}-\d{2}-\d{4}') THEN substr(fecha_txt, 7, 4) || '-' || substr(fecha_txt, 1, 2) || '-' || substr(fecha_txt, 4, 2)
   WHEN regexp_full_match(fecha_txt, '\d{4}/\d{2}/\d{2}') THEN replace(fecha_txt, '/', '-') END AS fecha_iso
 FROM raw),
routed AS (
 SELECT *, TRY_CAST(fecha_iso AS DATE) AS fecha, TRY_CAST(irca_clean AS DOUBLE) AS irca,
  CASE WHEN irca_clean IS NULL THEN 'No' ELSE 'Si' END AS irca_reported,
  CASE WHEN scope = 'Global' THEN 'P05'
   WHEN fecha_iso IS NULL OR coalesce(TRY_CAST(substr(fecha_iso, 6, 2) AS INTEGER) <> TRY_CAST(mes_txt AS INTEGER), TRUE) THEN 'P09'
   WHEN TRY_CAST(irca_clean AS DOUBLE) < 0 OR TRY_CAST(irca_clean AS DOUBLE) > 100 THEN 'P08'
   WHEN TRY_CAST(fecha_iso AS DATE) IS NULL OR (irca_clean IS NOT NULL AND TRY_CAST(irca_clean AS DOUBLE) IS NULL)
     OR (rain_txt <> '' AND TRY_CAST(rain_txt AS DOUBLE) IS NULL) OR TRY_CAST(storage_txt AS DOUBLE) IS NULL THEN 'CONV'
   ELSE 'VALID' END AS route
 FROM norm),
valid AS (
 SELECT *, CASE WHEN irca IS NULL THEN NULL WHEN irca <= 5 THEN 'Sin riesgo (0-5)' WHEN irca <= 14 THEN 'Bajo riesgo (5-14)'
  WHEN irca <= 28 THEN 'Riesgo medio (14-28)' WHEN irca <= 40 THEN 'Alto riesgo (28-40)'
  ELSE 'Inviable sanitariamente (>40)' END AS risk_class,
  row_number() OVER (PARTITION BY fecha, place, system, l_linenumber
   ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, copy_no) AS rn
 FROM routed WHERE route = 'VALID')"""

SQL_VIEWS = {
    "measure": [_LINES, _MEASURE],
    "raw": [_LINES, _RAW],
    "valid": [_LINES, _RAW, _ROUTED],
    "both": [_LINES, _MEASURE, _RAW, _ROUTED],
}


def with_views(sql: str, views: str | None) -> str:
    """Put the named views in front of a query."""
    if not views:
        return sql
    return "WITH " + ",\n".join(SQL_VIEWS[views]) + f"\nSELECT * FROM ({sql}) q"

"""Star schema: dimensions, fact, lazy star joins and checks. Published table and column names."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..domain import NO_VALUE_CLASS, RISK_DIMENSION, UNKNOWN, Domain
from ..functions.dates import calendar_columns, date_key
from ..session import broadcast_if_small, written
from .ordered import surrogate_keys
from .quantiles import _match

KEYS = ("fecha_key", "municipio_key", "sistema_key", "riesgo_key", "servicio_key")

_RISK = ("riesgo_key", "clasificacion", "grupo_riesgo", "rango_min", "rango_max", "orden")
_SERVICE = ("servicio_key", "nivel_servicio", "es_continuo", "orden")
_UNKNOWN_DAY = {"fecha_key": 0, "fecha": "Desconocida", "anio": 0, "trimestre": 0, "anio_trimestre": UNKNOWN, "mes": 0,
                "nombre_mes": UNKNOWN, "anio_mes": UNKNOWN, "dia": 0}


def risk_dimension(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(RISK_DIMENSION),
        "riesgo_key int, clasificacion string, grupo_riesgo string, rango_min double, rango_max double, orden int")


def _service_rows(domain: Domain) -> list[tuple]:
    return [(0, UNKNOWN, 0, 0)] + [
        (i, name, int(name == domain.continuous), i) for i, name in enumerate(domain.services, start=1)]


def service_dimension(spark: SparkSession, domain: Domain) -> DataFrame:
    return spark.createDataFrame(_service_rows(domain), "servicio_key int, nivel_servicio string, es_continuo int, orden int")


def time_dimension(df: DataFrame) -> DataFrame:
    """One row per date, plus the unknown member."""
    days = df.select("fecha").where("fecha IS NOT NULL").distinct().select(
        *[c.alias(n) for n, c in calendar_columns("fecha").items()])
    unknown = df.sparkSession.createDataFrame([tuple(_UNKNOWN_DAY[c] for c in days.columns)], days.schema)
    return days.unionByName(unknown)


def place_cells(df: DataFrame, place: Column | None = None) -> DataFrame:
    """Distinct (municipio, system, department, region), stored: what the dimensions and keys are made of."""
    name = F.col("place") if place is None else place
    return written(df.select(name.alias("municipio"), "system", "department", "region").distinct(), "star-cells")


def first_seen(df: DataFrame, cells: DataFrame, order: list[str], place: Column | None = None) -> DataFrame:
    """municipio, departamento, tipo_region: those seen first. Rows are read only for places that stand with several."""
    seen = cells.where("municipio IS NOT NULL").select("municipio", "department", "region").distinct()
    several = written(seen.groupBy("municipio").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("municipio"), "star-several")
    single = seen.join(broadcast_if_small(several), "municipio", "left_anti")
    if several.limit(1).count():
        name = F.col("place") if place is None else place
        rows = df.select(name.alias("municipio"), "department", "region", *order).join(broadcast_if_small(several), "municipio", "left_semi")
        first = rows.groupBy("municipio").agg(F.min_by(F.struct("department", "region"), F.struct(*order)).alias("f"))
        single = single.unionByName(first.select("municipio", "f.department", "f.region"))
    return single.withColumnsRenamed({"department": "departamento", "region": "tipo_region"})


def geography_dimension(df: DataFrame, order: list[str], place: Column | None = None, cells: DataFrame | None = None) -> DataFrame:
    """One row per place with the department and region seen first, keyed in order of the name, plus the unknown member."""
    named = first_seen(df, place_cells(df, place) if cells is None else cells, order, place)
    keyed = surrogate_keys(named, "municipio", "municipio_key").select("municipio_key", "municipio", "departamento", "tipo_region")
    unknown = df.sparkSession.createDataFrame([(0, UNKNOWN, UNKNOWN, UNKNOWN)], keyed.schema)
    return keyed.unionByName(unknown)


def system_dimension(df: DataFrame, domain: Domain) -> DataFrame:
    """One row per supply system, keyed in order of the name, plus the unknown member. The names, a catalogue, are numbered in one row."""
    names = df.where("system IS NOT NULL").select("system").distinct().agg(F.sort_array(F.collect_list("system")).alias("names"))
    keyed = names.select(F.posexplode("names").alias("pos", "sistema")).select(
        (F.col("pos") + 1).alias("sistema_key"), "sistema", F.when(F.col("sistema") == domain.out_of_coverage, 0).otherwise(1).alias("cubierto"))
    unknown = df.sparkSession.createDataFrame([(0, UNKNOWN, 0)], keyed.schema)
    return keyed.unionByName(unknown)


def measurement_id(order: list[str]) -> Column:
    """Row id as a digest of the natural key: the same on every run, without numbering all rows in one task."""
    parts = [F.round(F.col(c) * 100).cast("bigint") if c == "l_extendedprice" else F.col(c) for c in order]
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def _member(rows: list[tuple], by: int, value: Column, field: int) -> Column:
    """A field of the row of a small closed dimension whose ``by``-th field equals ``value``; null without one."""
    pairs = [F.lit(x) for row in rows if row[field] is not None for x in (row[by], row[field])]
    return F.try_element_at(F.create_map(*pairs), value)


class Star:
    """Fact and dimensions over one frame of measurements; each is built when it is asked for.

    Places and systems get their keys through one stored table of their distinct pairs, which is broadcast if small and else the one shuffle
    of the fact. Keys and attributes of dates, risk classes and service levels are expressions. A key that is not found is 0; a missing
    index is its own class, not unknown.
    """

    def __init__(self, df: DataFrame, domain: Domain, order: list[str], place: Column | None = None):
        self.df, self.domain, self.order, self.place = df, domain, order, place

    @cached_property
    def cells(self) -> DataFrame:
        return place_cells(self.df, self.place)

    @cached_property
    def time(self) -> DataFrame:
        return time_dimension(self.df)

    @cached_property
    def geography(self) -> DataFrame:
        return geography_dimension(self.df, self.order, self.place, self.cells)

    @cached_property
    def system(self) -> DataFrame:
        return system_dimension(self.cells, self.domain)

    @cached_property
    def risk(self) -> DataFrame:
        return risk_dimension(self.df.sparkSession)

    @cached_property
    def service(self) -> DataFrame:
        return service_dimension(self.df.sparkSession, self.domain)

    @cached_property
    def keys(self) -> DataFrame:
        """Place and system as in the rows, with the keys and attributes of both."""
        pairs = self.cells.select("municipio", "system").distinct()
        places = self.geography.where("municipio_key > 0")
        systems = self.system.where("sistema_key > 0")
        return written(pairs.join(places, "municipio", "left").join(F.broadcast(systems), F.col("system") == F.col("sistema"), "left").select(  # systems: a catalogue
            F.col("municipio").alias("_place"), F.col("system").alias("_system"), "municipio_key", "sistema_key", "departamento", "tipo_region", "cubierto"), "star-keys")

    @cached_property
    def rows(self) -> DataFrame:
        """The measurements with all five keys."""
        name = F.col("place") if self.place is None else self.place
        risk_name = F.coalesce(F.col("risk_class"), F.when(F.col("irca").isNull(), F.lit(NO_VALUE_CLASS)), F.lit(""))
        keyed = self.df.withColumn("_name", name).join(broadcast_if_small(self.keys), _match(["_name", "system"], ["_place", "_system"]), "left")
        return keyed.withColumns({
            "fecha_key": F.coalesce(date_key("fecha"), F.lit(0)),
            "municipio_key": F.coalesce("municipio_key", F.lit(0)),
            "sistema_key": F.coalesce("sistema_key", F.lit(0)),
            "riesgo_key": F.coalesce(_member(list(RISK_DIMENSION), 1, risk_name, 0), F.lit(0)),
            "servicio_key": F.coalesce(_member(_service_rows(self.domain), 1, F.col("service"), 0), F.lit(0)),
        })

    def _fact(self) -> dict[str, Column]:
        return {
            "id_medicion": measurement_id(self.order), **{k: F.col(k) for k in KEYS}, "irca": F.col("irca"),
            "irca_reportado": F.col("irca").isNotNull().cast("int"),
            "cobertura_acueducto_pct": F.col("coverage"), "nivel_almacenamiento_pct": F.col("storage"),
            "precipitacion_mm": F.col("rain"), "consumo_m3s": F.col("water_use"),
        }

    @property
    def fact(self) -> DataFrame:
        return self.rows.select(*[c.alias(n) for n, c in self._fact().items()])

    def attributes(self, dimension: str) -> dict[str, Column]:
        """Columns of a dimension for the rows; ``orden`` carries the dimension's name."""
        known = lambda key, column: F.when(F.col(key) > 0, column).otherwise(UNKNOWN)
        if dimension == "time":
            return {n: F.coalesce(c, F.lit(_UNKNOWN_DAY[n])) for n, c in calendar_columns("fecha").items() if n != "fecha_key"}
        if dimension == "geography":
            return {"municipio": known("municipio_key", F.col("_name")), "departamento": known("municipio_key", F.col("departamento")),
                    "tipo_region": known("municipio_key", F.col("tipo_region"))}
        if dimension == "system":
            return {"sistema": known("sistema_key", F.col("system")), "cubierto": F.coalesce("cubierto", F.lit(0))}
        names, rows, key = (_RISK, list(RISK_DIMENSION), "riesgo_key") if dimension == "risk" else (_SERVICE, _service_rows(self.domain), "servicio_key")
        return {n if n != "orden" else f"orden_{dimension}": _member(rows, 0, F.col(key), i) for i, n in enumerate(names) if i}

    def join(self, *dimensions: str) -> DataFrame:
        """Fact with the attributes of the named dimensions only (all when none is named); a row stays one row."""
        columns = self._fact()
        for name in dimensions or ("time", "geography", "system", "risk", "service"):
            columns.update(self.attributes(name))
        return self.rows.select(*[c.alias(n) for n, c in columns.items()])


def build_star(df: DataFrame, domain: Domain, order: list[str], place: Column | None = None) -> Star:
    """The star of a frame of measurements; nothing runs until a part of it is asked for."""
    return Star(df, domain, order, place)


def cube_frame(star: Star, *dimensions: str) -> DataFrame:
    """Star rows under the names the cube operators use."""
    names = {
        "anio_trimestre": "periodo", "tipo_region": "region", "departamento": "department", "municipio": "place",
        "sistema": "system", "clasificacion": "risk_class", "grupo_riesgo": "risk_group", "nivel_servicio": "service",
        "cobertura_acueducto_pct": "coverage", "nivel_almacenamiento_pct": "storage",
        "precipitacion_mm": "rain", "consumo_m3s": "water_use",
    }
    return star.join(*dimensions).withColumnsRenamed(names)


# Checks. Each returns counts of violations, so a clean model still returns rows.

def repeated_keys(star: Star) -> DataFrame:
    checks = [(star.time, "dim_tiempo", "fecha_key"), (star.geography, "dim_geografia", "municipio"),
              (star.system, "dim_sistema", "sistema"), (star.risk, "dim_riesgo", "clasificacion"),
              (star.service, "dim_servicio", "nivel_servicio")]
    out = None
    for dim, name, key in checks:
        one = dim.groupBy(key).agg(F.count(F.lit(1)).alias("n")).agg(
            F.lit(name).alias("tabla"), F.count(F.lit(1)).alias("claves"), F.count_if(F.col("n") > 1).alias("repetidas"))
        out = one if out is None else out.unionByName(one)
    return out


def orphan_counts(star: Star) -> DataFrame:
    """Facts whose key has no dimension row, per dimension."""
    checks = {"sin_tiempo": (star.time, "fecha_key"), "sin_geografia": (star.geography, "municipio_key"),
              "sin_sistema": (star.system, "sistema_key"), "sin_riesgo": (star.risk, "riesgo_key"),
              "sin_servicio": (star.service, "servicio_key")}
    # Distinct keys first: the joins see a handful of keys instead of all facts.
    out = star.fact.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    for name, (dim, key) in checks.items():
        out = out.join(dim.select(F.col(key).alias("_k")).distinct(), F.col(key) == F.col("_k"), "left") \
            .withColumn(name, F.when(F.col("_k").isNull(), F.col("n")).otherwise(0)).drop("_k")
    return out.agg(*[F.sum(c).cast("bigint").alias(c) for c in checks])


def repeated_grain(fact: DataFrame, grain: list[str]) -> DataFrame:
    groups = fact.groupBy(*grain).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.sum("n").alias("hechos"), F.count(F.lit(1)).alias("grupos"), F.count_if(F.col("n") > 1).alias("grupos_repetidos"))


def unknown_counts(fact: DataFrame) -> DataFrame:
    return fact.agg(
        F.count_if(F.col("riesgo_key") == 6).alias("sin_dato_irca"),
        F.count_if(F.col("irca").isNull()).alias("irca_vacio"),
        F.count_if(F.col("irca_reportado") == 0).alias("irca_no_reportado"),
        F.count_if(F.array_contains(F.array(*[F.col(k) for k in KEYS]), 0)).alias("desconocidos"),
        F.count_if(F.col("precipitacion_mm").isNull()).alias("precipitacion_vacia"),
    )


def constraint_violations(star: Star) -> DataFrame:
    """Column rules a warehouse would enforce, as counts of violations."""
    fact = star.fact.agg(
        *[F.count_if(F.col(k).isNull()).alias(f"{k} nulo") for k in KEYS],
        F.count_if(~F.col("irca_reportado").isin(0, 1)).alias("irca_reportado fuera de 0/1"),
        F.count_if((F.col("irca_reportado") == 1) != F.col("irca").isNotNull()).alias("irca_reportado contradice irca"),
    )
    system = star.system.agg(F.count_if(~F.col("cubierto").isin(0, 1)).alias("cubierto fuera de 0/1"))
    service = star.service.agg(F.count_if(~F.col("es_continuo").isin(0, 1)).alias("es_continuo fuera de 0/1"))
    out = None
    for one in (fact, system, service):
        long = one.unpivot([], one.columns, "regla", "violaciones")
        out = long if out is None else out.unionByName(long)
    return out


def reconcile(source: DataFrame, model: DataFrame, checks: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Compare aggregates of source and model: name -> (aggregate over source, aggregate over model)."""
    left = source.agg(*[a.cast("double").alias(n) for n, (a, _) in checks.items()])
    right = model.agg(*[b.cast("double").alias(n) for n, (_, b) in checks.items()])
    a = left.unpivot([], list(checks), "comprobacion", "origen")
    b = right.unpivot([], list(checks), "comprobacion", "modelo")
    return a.join(b, "comprobacion").withColumn("igual", F.col("origen").eqNullSafe(F.col("modelo")))


def additivity(df: DataFrame, condition: Column, parts: str, row: str, column: str, values: tuple[str, ...]) -> DataFrame:
    """Direct count against the sum over groups and over matrix cells."""
    chosen = df.where(condition)
    direct = chosen.agg(F.count(F.lit(1)).alias("directo"))
    groups = chosen.groupBy(parts).agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("suma_grupos"))
    cells = chosen.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(f"c{i}") for i, v in enumerate(values)])
    cells = cells.agg(F.sum(sum((F.col(f"c{i}") for i in range(1, len(values))), F.col("c0"))).alias("suma_celdas"))
    return direct.join(F.broadcast(groups)).join(F.broadcast(cells)).withColumn(  # three one-row frames
        "cuadra", (F.col("directo") == F.col("suma_grupos")) & (F.col("directo") == F.col("suma_celdas")))

"""Temporal, territorial and multivariate indicators over measurement rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..domain import HIGH_GROUP, NO_DATA_GROUP, RISK_GROUPS, Domain
from ..functions import count_if, percentage, quadrant, risk_class
from .cube import COMPONENTS, base_cells, mean_of, merge_cells

MIN_UNITS = 3  # fewer units give no correlation


def _round(values: dict[str, Column], digits: int | None, keep: tuple[str, ...] = ()) -> list[Column]:
    return [(c if digits is None or n in keep else F.round(c, digits)).alias(n) for n, c in values.items()]


def summary_columns(prefix: str = "") -> dict[str, Column]:
    """The temporal summary from components: risk over rows with an index, the rest over all rows."""
    n, n_irca = F.col(prefix + "n"), F.col(prefix + "n_irca")
    return {
        "n": n,
        "n_con_irca": n_irca,
        "pct_continuo": percentage(F.col(prefix + "n_continuous"), n),
        "pct_racionamiento": percentage(F.col(prefix + "n_interrupted"), n),
        "pct_riesgo_alto": percentage(F.col(prefix + "n_high"), n_irca),
        "pct_sin_irca": percentage(n - n_irca, n),
        "irca_promedio": mean_of("irca", prefix),
        "almacenamiento_promedio": mean_of("storage", prefix),
        "precipitacion_promedio": mean_of("rain", prefix),
    }


def temporal_summary(df: DataFrame, domain: Domain, digits: int | None = None) -> DataFrame:
    """Total, year, quarter and year x region, from one pass over the facts.

    ``df`` carries the non-time filters only: the series does not follow the year filter.
    """
    cells = base_cells(df, ["anio", "periodo", "region"], domain)
    sets = [[], ["anio"], ["anio", "periodo"], ["anio", "region"]]
    grouped = cells.groupingSets(sets, "anio", "periodo", "region").agg(
        F.grouping_id().alias("_gid"), *[F.sum(c).alias(c) for c in COMPONENTS])
    level = F.when(F.col("_gid") == 7, "total").when(F.col("_gid") == 3, "anio").when(F.col("_gid") == 1, "periodo") \
        .otherwise("anio_region")
    return grouped.select(
        level.alias("nivel"), "anio", "periodo", "region", *_round(summary_columns(), digits, ("n", "n_con_irca")))


def change_by_year(df: DataFrame, domain: Domain, by: list[str] = (), digits: int | None = None) -> DataFrame:
    """Each year against the year before (a missing year gives null, so no lag)."""
    by = list(by)
    cells = base_cells(df, [*by, "anio"], domain)
    now = cells.select(*by, "anio", mean_of("irca").alias("actual"), percentage(F.col("n_continuous"), F.col("n")).alias("continuo"))
    before = now.select(*by, (F.col("anio") + 1).alias("anio"), F.col("actual").alias("anterior"), F.col("continuo").alias("continuo_anterior"))
    joined = now.join(before, [*by, "anio"], "left")
    return joined.select(*by, "anio", *_round({
        "actual": F.col("actual"), "anterior": F.col("anterior"),
        "variacion": F.col("actual") - F.col("anterior"),
        "variacion_continuo": F.col("continuo") - F.col("continuo_anterior")}, digits))


def change_by_quarter(df: DataFrame, domain: Domain, digits: int | None = None) -> DataFrame:
    """Each quarter against the same quarter one year before."""
    cells = base_cells(df, ["anio", "trimestre"], domain)
    now = cells.select("anio", "trimestre", mean_of("irca").alias("actual"))
    before = now.select((F.col("anio") + 1).alias("anio"), "trimestre", F.col("actual").alias("anterior"))
    return now.join(before, ["anio", "trimestre"], "left").select("anio", "trimestre", *_round({
        "actual": F.col("actual"), "anterior": F.col("anterior"), "variacion": F.col("actual") - F.col("anterior")}, digits))


def comparable_change(df: DataFrame, domain: Domain, year: int | None = None, period: str | None = None,
                      region: str | None = None, digits: int | None = None) -> DataFrame:
    """Index mean of the chosen time against the comparable one, other filters kept.

    A quarter compares with the same quarter one year before; a year with the year before; with
    neither, the last year with the one before it.
    """
    rows = df if region is None else df.where(F.col("region") == region)
    quarter = period[-2:] if period else None
    in_quarter = F.lit(True) if quarter is None else F.col("periodo").endswith(quarter)
    cells = base_cells(rows.where(in_quarter), ["anio"], domain).select("anio", "s_irca", "n_irca")
    current = int(period[:4]) if period else year
    last = cells.agg((F.max("anio") if current is None else F.lit(current)).alias("_current"))  # one row
    sums = cells.join(F.broadcast(last)).where(F.col("anio").isin(F.col("_current"), F.col("_current") - 1))
    now, before = F.col("anio") == F.col("_current"), F.col("anio") == F.col("_current") - 1
    mean = lambda side: F.sum(F.when(side, F.col("s_irca"))) / F.nullif(F.sum(F.when(side, F.col("n_irca"))).cast("double"), F.lit(0.0))
    both = sums.agg(F.max("_current").alias("c"), mean(now).alias("actual"), mean(before).alias("anterior"))
    suffix = F.lit(f"-{quarter}" if quarter else "")
    return both.select(
        F.concat((F.col("c") - 1).cast("string"), suffix).alias("referencia"),
        *_round({"actual": F.col("actual"), "anterior": F.col("anterior"), "variacion": F.col("actual") - F.col("anterior")}, digits))


def series_coverage(df: DataFrame) -> DataFrame:
    """Per year: rows, periods, months and places."""
    cells = df.groupBy("anio", "periodo", "mes", "place").agg(F.count(F.lit(1)).alias("n"))
    return cells.groupBy("anio").agg(
        F.sum("n").alias("registros"), F.count_distinct("periodo").alias("periodos"),
        F.count_distinct("mes").alias("meses"), F.count_distinct("place").alias("municipios"))


def first_occurrences(df: DataFrame, conditions: dict[str, Column], order: list[str], payload: list[str]) -> DataFrame:
    """First row in time per condition, ties broken by the total order; one scan."""
    key = F.struct("fecha", *order)
    firsts = df.agg(*[
        F.min_by(F.when(c, F.struct(*payload)), F.when(c, key)).alias(n) for n, c in conditions.items()])
    rows = F.array(*[F.struct(F.lit(n).alias("condicion"), F.col(n).alias("r")) for n in conditions])
    return firsts.select(F.inline(rows)).select("condicion", *[F.col(f"r.{c}").alias(c) for c in payload])


# Territory

def territory_means(df: DataFrame, domain: Domain, digits: int | None = None) -> DataFrame:
    """Mean index and its class per place."""
    cells = base_cells(df, ["place"], domain).select("place", mean_of("irca").alias("m"), "n")
    mean = F.col("m") if digits is None else F.round("m", digits)
    return cells.select("place", mean.alias("irca_promedio"), F.coalesce(risk_class("m"), F.lit("Sin dato")).alias("clasificacion"), "n")


def service_mix(df: DataFrame, unit: str, domain: Domain, digits: int | None = None, of: str = "known") -> DataFrame:
    """Per unit: count and percentage of each service level; ordered by size. ``of``: "known" takes the percentages of the rows
    with a service level, "all" of all rows."""
    counted = {"known": F.count("service"), "all": F.count(F.lit(1))}[of]
    counts = df.groupBy(unit).agg(
        counted.alias("total"), *[count_if(F.col("service") == s).alias(f"n{i}") for i, s in enumerate(domain.services)])
    percents = {f"pct{i}": percentage(F.col(f"n{i}"), F.col("total")) for i in range(len(domain.services))}
    return counts.select("*", *_round(percents, digits)).orderBy(F.desc("total"), unit)


def region_gap(df: DataFrame, first: str, second: str, domain: Domain, digits: int | None = None) -> DataFrame:
    """Two regions side by side with their gaps, one row."""
    cells = base_cells(df.where(F.col("region").isin(first, second)), ["region"], domain)
    values = {
        "n": F.col("n"), "irca": mean_of("irca"), "coverage": mean_of("coverage"),
        "continuous": percentage(F.col("n_continuous"), F.col("n"))}
    one = cells.select("region", *[v.alias(k) for k, v in values.items()]).agg(*[
        F.max(F.when(F.col("region") == r, F.col(k))).alias(f"{k}_{i}") for i, r in enumerate((first, second)) for k in values])
    return one.select("n_0", "n_1", *_round({
        "irca_0": F.col("irca_0"), "irca_1": F.col("irca_1"), "brecha_irca": F.col("irca_1") - F.col("irca_0"),
        "cobertura_0": F.col("coverage_0"), "cobertura_1": F.col("coverage_1"),
        "brecha_cobertura": F.col("coverage_0") - F.col("coverage_1"), "pct_continuo_0": F.col("continuous_0")}, digits))


def mean_band(df: DataFrame, by: str = "place", digits: int | None = None) -> DataFrame:
    """Grand mean of the unit means, plus and minus the pooled deviation inside units."""
    units = df.groupBy(by).agg(F.avg("irca").alias("m"), F.count("irca").alias("k"), F.var_samp("irca").alias("v"))
    pooled = units.agg(
        F.avg("m").alias("media"),
        F.sqrt(F.sum(F.col("v") * (F.col("k") - 1)) / F.nullif(F.sum(F.when(F.col("k") > 1, F.col("k") - 1)).cast("double"), F.lit(0.0))).alias("sd"))
    return pooled.select(*_round({
        "media": F.col("media"), "desviacion": F.col("sd"), "inferior": F.col("media") - F.col("sd"), "superior": F.col("media") + F.col("sd")}, digits))


# Multivariate

def _pearson(x: str, y: str) -> Column:
    """``corr`` divides by zero in ANSI mode when a column is constant."""
    return F.covar_pop(x, y) / F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))


def correlation_rows(df: DataFrame, x: str, y: str, digits: int | None = None) -> DataFrame:
    """Pearson over complete pairs; null without variance."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pairs.agg(F.count(F.lit(1)).alias("pares"), *_round({
        "media_x": F.avg(x), "media_y": F.avg(y), "correlacion": _pearson(x, y)}, digits))


def correlation_units(units: DataFrame, x: str, y: str, group: str, digits: int | None = None) -> DataFrame:
    """Pearson over aggregated units: overall and inside each group; null below three units."""
    pairs = units.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    enough = F.count(F.lit(1)) >= MIN_UNITS
    return pairs.rollup(group).agg(F.count(F.lit(1)).alias("unidades"), *_round({"correlacion": F.when(enough, _pearson(x, y))}, digits)) \
        .withColumn(group, F.coalesce(F.col(group), F.lit("global")))


def group_summary(df: DataFrame, keys: list[str], domain: Domain, digits: int | None = None) -> DataFrame:
    cells = base_cells(df, keys, domain)
    return cells.select(*keys, "n", *_round({"irca_promedio": mean_of("irca"), "cobertura_promedio": mean_of("coverage")}, digits))


# Priorities, gaps, recovery

def priorities(df: DataFrame, domain: Domain, digits: int | None = None) -> DataFrame:
    """Per department: risk over rows with an index, continuity over all rows, priority label."""
    cells = base_cells(df, ["department", "region"], domain).withColumns({
        "pct_alto": percentage(F.col("n_high"), F.col("n_irca")), "pct_continuo": percentage(F.col("n_continuous"), F.col("n"))})
    return cells.select(
        "department", "region", "n", F.col("n_irca").alias("validos"), F.col("n_high").alias("alto"), F.col("n_continuous").alias("continuo"),
        *_round({"pct_alto": F.col("pct_alto"), "pct_continuo": F.col("pct_continuo"), "cobertura": mean_of("coverage")}, digits),
        quadrant(F.col("pct_alto"), F.col("pct_continuo")).alias("prioridad"),
    ).orderBy(F.coalesce(F.col("pct_alto"), F.lit(0.0)).desc(), "department")


def risk_mix(df: DataFrame, unit: str, digits: int | None = None) -> DataFrame:
    """Risk groups per unit over the rows with an index."""
    known = F.col("risk_group") != NO_DATA_GROUP
    counts = df.groupBy(unit).agg(
        count_if(known).alias("validos"), *[count_if(F.col("risk_group") == g).alias(f"n{i}") for i, g in enumerate(RISK_GROUPS)])
    return counts.select("*", *_round({f"pct{i}": percentage(F.col(f"n{i}"), F.col("validos")) for i in range(len(RISK_GROUPS))}, digits))


def service_risk_matrix(df: DataFrame, unit: str, domain: Domain, digits: int | None = None) -> DataFrame:
    """Unit x service level: rows, rows with an index, % high over those; absent cells are null."""
    cells = base_cells(df, [unit, "service"], domain)
    picks = []
    for i, s in enumerate(domain.services):
        here = F.col("service") == s
        pct = percentage(F.col("n_high"), F.col("n_irca"))
        picks += [
            F.max(F.when(here, F.col("n"))).alias(f"n{i}"), F.max(F.when(here, F.col("n_irca"))).alias(f"validos{i}"),
            F.max(F.when(here, pct if digits is None else F.round(pct, digits))).alias(f"pct{i}")]
    return cells.groupBy(unit).agg(*picks)


def coverage_gap(df: DataFrame, domain: Domain, digits: int | None = None) -> DataFrame:
    """Per place: coverage, continuity and their difference; widest gap first, unknown gaps last."""
    cells = base_cells(df, ["place", "region"], domain)
    coverage, continuity = mean_of("coverage"), percentage(F.col("n_continuous"), F.col("n"))
    return cells.select("place", "region", "n", *_round({
        "cobertura": coverage, "continuidad": continuity, "brecha": coverage - continuity}, digits))


def widest_gaps(gaps: DataFrame, n: int = 15) -> DataFrame:
    return gaps.orderBy(F.col("brecha").desc_nulls_last(), "place").limit(n)


def misaligned(gaps: DataFrame, coverage: float = 90, continuity: float = 50) -> DataFrame:
    """Units with good coverage and poor continuity."""
    bad = (F.coalesce("cobertura", F.lit(0.0)) >= coverage) & (F.coalesce("continuidad", F.lit(0.0)) < continuity)
    return gaps.agg(F.count(F.lit(1)).alias("unidades"), count_if(bad).alias("desalineados"))


def recovery_series(df: DataFrame, keys: list[str], domain: Domain, digits: int | None = None) -> DataFrame:
    cells = base_cells(df, keys, domain)
    return cells.select(*keys, "n", *_round({
        "almacenamiento": mean_of("storage"), "consumo": mean_of("water_use"), "precipitacion": mean_of("rain"),
        "continuidad": percentage(F.col("n_continuous"), F.col("n"))}, digits))


def weighted_means(series: DataFrame, columns: list[str], digits: int | None = None) -> DataFrame:
    """Group means weighted by row counts."""
    total = F.nullif(F.sum("n").cast("double"), F.lit(0.0))
    return series.agg(F.sum("n").alias("n"), *_round({c: F.sum(F.col(c) * F.col("n")) / total for c in columns}, digits))


# What counts as a recovery.
USE_FACTOR = 1.03
STORAGE_POINTS = 3


def recovery_verdict(yearly: DataFrame, digits: int | None = None) -> DataFrame:
    """First against last year; null verdict with fewer than two years."""
    row = F.struct("anio", "consumo", "almacenamiento", "continuidad")
    ends = yearly.agg(F.min_by(row, "anio").alias("a"), F.max_by(row, "anio").alias("z"), F.count(F.lit(1)).alias("anios"))
    recovered = (
        (F.col("z.consumo") > F.col("a.consumo") * USE_FACTOR)
        & (F.col("z.almacenamiento") >= F.col("a.almacenamiento") + STORAGE_POINTS)
        & (F.col("z.continuidad") <= F.col("a.continuidad")))
    return ends.select(
        F.col("a.anio").alias("desde"), F.col("z.anio").alias("hasta"),
        *_round({f"{c}_{s}": F.col(f"{k}.{c}") for k, s in (("a", "inicial"), ("z", "final"))
                 for c in ("consumo", "almacenamiento", "continuidad")}, digits),
        F.when(F.col("anios") >= 2, recovered).alias("recuperacion_sin_servicio"))


def system_breaks(df: DataFrame, before: int, after: int, drop: float, domain: Domain) -> DataFrame:
    """Systems whose continuity fell by ``drop`` points or more between two years, of all that have both."""
    cells = base_cells(df.where(F.col("anio").isin(before, after)), ["system", "anio"], domain)
    at = lambda y: F.max(F.when(F.col("anio") == y, percentage(F.col("n_continuous"), F.col("n"))))
    both = cells.groupBy("system").agg(at(before).alias("a"), at(after).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    return both.agg(count_if(F.col("a") - F.col("b") >= drop).alias("caidas"), F.count(F.lit(1)).alias("sistemas"))


def continuity_by(df: DataFrame, keys: list[str], domain: Domain, digits: int | None = None) -> DataFrame:
    cells = base_cells(df, keys, domain)
    return cells.select(*keys, "n", *_round({"pct": percentage(F.col("n_continuous"), F.col("n"))}, digits))


def unit_system_matrix(df: DataFrame, unit: str, domain: Domain, digits: int | None = None) -> DataFrame:
    """Unit x system: rows and % continuous, with the unit's total."""
    cells = base_cells(df, [unit, "system"], domain)
    picks = []
    for i, s in enumerate(domain.systems):
        here = F.col("system") == s
        pct = percentage(F.col("n_continuous"), F.col("n"))
        picks += [F.max(F.when(here, F.col("n"))).alias(f"n{i}"),
                  F.max(F.when(here, pct if digits is None else F.round(pct, digits))).alias(f"pct{i}")]
    total = percentage(F.sum("n_continuous"), F.sum("n"))
    return cells.groupBy(unit).agg(
        F.sum("n").alias("total"), (total if digits is None else F.round(total, digits)).alias("pct_total"), *picks)

"""Profiling, six quality dimensions, treatment effects, problems and causes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..domain import MAX_LAG_DAYS, MISSING_MARKERS, QUALITY_THRESHOLDS, RECENCY_MONTHS, RISK_LABELS
from ..functions import is_missing, parse_date, percentage, safe_double, strip
from ..functions.dates import ISO_DATE
from ..functions.numbers import DECIMAL_PATTERN, INTEGER_PATTERN
from ..session import broadcast_if_small, store, work_folder, written
from .dedup import duplicate_profile
from .predicates import any_of, class_mismatch, class_orphan, date_parts_differ, misspelled_class, not_iso, outside, recent, untidy
from .quantiles import _match, exact_quantiles, tukey_fences

DAYS_PER_MONTH = 30.44


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


def _long(one_row: DataFrame, names: list[str], fields: list[str], label: str = "variable") -> DataFrame:
    """One row holding a struct per name -> one row per name."""
    lines = F.array(*[F.struct(F.lit(n).alias(label), *[F.col(f"`{n}`.{f}").alias(f) for f in fields]) for n in names])
    return one_row.select(F.inline(lines))


def _values(df: DataFrame, columns: list[str], ids: list[str] = ()) -> DataFrame:
    """Long form (variable, value), text stripped and markers dropped."""
    long = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(list(ids), columns, "variable", "value")
    return long.select(*ids, "variable", strip("value").alias("value")).where(~is_missing("value"))


# Completeness

def missing_by_column(df: DataFrame, columns: list[str], digits: int | None = None) -> DataFrame:
    counts = df.agg(*[
        F.struct(F.count_if(is_missing(c)).alias("missing"), F.count(F.lit(1)).alias("rows")).alias(c) for c in columns])
    return _long(counts, columns, ["missing", "rows"]).withColumn("pct", _round(percentage(F.col("missing"), F.col("rows")), digits))


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """Cells, missing cells and score, one row."""
    missing = sum((is_missing(c).cast("int") for c in columns[1:]), is_missing(columns[0]).cast("int"))
    one = df.agg((F.count(F.lit(1)) * len(columns)).alias("total"), F.coalesce(F.sum(missing), F.lit(0)).alias("bad"))
    return one.withColumn("score", percentage(F.col("total") - F.col("bad"), F.col("total")))


# Uniqueness

def uniqueness(df: DataFrame, columns: list[str]) -> DataFrame:
    return duplicate_profile(df, columns).select(
        F.col("rows").alias("total"), F.col("extra_rows").alias("bad"),
        percentage(F.col("rows") - F.col("extra_rows"), F.col("rows")).alias("score"))


def distinct_by_column(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct values per column. Values are merged by (column, value) first, so no column fills one task."""
    pairs = _values(df, columns).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    names = F.explode(F.array(*[F.lit(c) for c in columns])).alias("variable")
    found = pairs.groupBy("variable").agg(F.count(F.lit(1)).alias("unicos"))
    return df.sparkSession.range(1).select(names).join(found, "variable", "left").select(
        "variable", F.coalesce("unicos", F.lit(0)).cast("bigint").alias("unicos"))


def distinct_raw_and_normalised(df: DataFrame, column: str, normalised: Column) -> DataFrame:
    pairs = df.select(F.col(column).alias("a"), normalised.alias("b")).distinct()
    return pairs.agg(F.count_distinct("a").alias("crudos"), F.count_distinct("b").alias("normalizados"))


def infer_types(df: DataFrame, columns: list[str]) -> DataFrame:
    """Type each text column would have: nulls only, ISO date, mostly ISO date, integer, decimal, text."""
    parts = []
    for c in columns:
        value, present = strip(c), ~is_missing(c)
        test = lambda pattern: F.count_if(present & value.rlike(pattern))
        parts.append(F.struct(
            F.count_if(present).alias("n"), test(ISO_DATE).alias("iso"), test(INTEGER_PATTERN).alias("integers"),
            test(DECIMAL_PATTERN).alias("decimals")).alias(c))
    n, iso = F.col("n"), F.col("iso")
    kind = (
        F.when(n == 0, "solo nulos").when(iso == n, "fecha (ISO YYYY-MM-DD)")
        .when(iso >= n * 0.95, "fecha (ISO mayoritario; hay formatos mixtos)")
        .when(F.col("integers") == n, "entero").when(F.col("decimals") == n, "decimal").otherwise("texto (categorico)"))
    return _long(df.agg(*parts), columns, ["n", "iso", "integers", "decimals"]).select("variable", kind.alias("tipo"))


# Validity

def validity_by_variable(df: DataFrame, rules: dict[str, tuple[float, float]]) -> DataFrame:
    """Evaluated and out-of-domain values per variable; text that is no number is not evaluated."""
    counts = df.agg(*[
        F.struct(F.count(safe_double(c)).alias("evaluados"), F.count_if(outside(safe_double(c), lo, hi)).alias("fuera")).alias(c)
        for c, (lo, hi) in rules.items()])
    return _long(counts, list(rules), ["evaluados", "fuera"])


def validity(df: DataFrame, rules: dict[str, tuple[float, float]]) -> DataFrame:
    return validity_by_variable(df, rules).agg(F.sum("evaluados").alias("total"), F.sum("fuera").alias("bad")).withColumn(
        "score", percentage(F.col("total") - F.col("bad"), F.col("total")))


# Consistency

@dataclass(frozen=True)
class TextColumns:
    """Raw text columns the rules read."""

    date: str = "fecha_txt"
    year: str = "anio_txt"
    month: str = "mes_txt"
    place: str = "place_txt"
    value: str = "irca_txt"
    stored_class: str = "class_txt"
    scope: str = "scope"
    # Spelling the baseline expected of the top class.
    labels: tuple[str, ...] = RISK_LABELS


def consistency_rules(t: TextColumns) -> dict[str, Column]:
    return {
        "fecha": not_iso(t.date),
        "lugar": untidy(t.place),
        "incoherente": class_mismatch(t.value, t.stored_class, t.labels),
        "huerfano": class_orphan(t.value, t.stored_class),
    }


def consistency(df: DataFrame, t: TextColumns) -> DataFrame:
    """Rows that break at least one rule, and rows per rule."""
    rules = consistency_rules(t)
    one = df.agg(
        F.count(F.lit(1)).alias("total"), F.count_if(any_of(list(rules.values()))).alias("bad"),
        *[F.count_if(c).alias(f"n_{n}") for n, c in rules.items()])
    return one.withColumn("score", percentage(F.col("total") - F.col("bad"), F.col("total")))


# Accuracy

def _number(df: DataFrame, column: str) -> Column:
    """A column's values as doubles; text is parsed."""
    return safe_double(column) if df.schema[column].dataType.typeName() == "string" else F.col(column).cast("double")


def _numbers(df: DataFrame, columns: list[str], ids: list[str] = ()) -> DataFrame:
    return df.select(*ids, *[_number(df, c).alias(c) for c in columns]).unpivot(list(ids), columns, "variable", "value").where("value IS NOT NULL")


def fences(numbers: DataFrame, stored: bool = False, by: list[str] = ()) -> DataFrame:
    """Exact inclusive quartiles and Tukey limits per variable of (variable, value)."""
    return tukey_fences(exact_quantiles(numbers, "value", {"q1": 0.25, "q3": 0.75}, by=[*by, "variable"], stored=stored))


def fences_row(df: DataFrame, columns: list[str], stored: bool = False, by: list[str] = ()) -> DataFrame:
    """The limits of all variables side by side: one row, or one a group."""
    pick = lambda c, f: F.max(F.when(F.col("variable") == c, F.col(f)))
    return fences(_numbers(df, columns, by), stored, by).groupBy(*by).agg(*[F.struct(pick(c, "low").alias("low"), pick(c, "high").alias("high")).alias(f"_f_{c}") for c in columns])


def outlier(c: str) -> Column:
    """Whether a number lies beyond its limits; ``_f_<column>`` holds these."""
    value = F.col(c)
    return F.coalesce((value < F.col(f"_f_{c}.low")) | (value > F.col(f"_f_{c}.high")), F.lit(False))


LEAST_VALUES = 5  # fixed value: variables with fewer are not judged


def tukey_outliers(df: DataFrame, columns: list[str], digits: int | None = None) -> DataFrame:
    """Limits, outlier count and share, least and greatest value per variable with at least five values.

    The numbers are stored once; quartiles and counts read them from there.
    """
    with work_folder(df.sparkSession, "numbers") as folder:
        numbers = store(_numbers(df, columns), folder)
        limits = fences(numbers, stored=True).select("variable", "low", "high")
        value = F.col("value")
        counts = written(numbers.join(F.broadcast(limits), "variable").groupBy("variable").agg(  # a row per listed column
            F.count(value).alias("n"), F.max("low").alias("li"), F.max("high").alias("ls"),
            F.count_if((value < F.col("low")) | (value > F.col("high"))).alias("conteo"), F.min(value).alias("min"), F.max(value).alias("max")), "outliers")
    return counts.where(F.col("n") >= LEAST_VALUES).select(
        "variable", "n", _round(F.col("li"), digits).alias("li"), _round(F.col("ls"), digits).alias("ls"), "conteo",
        _round(percentage(F.col("conteo"), F.col("n")), digits).alias("porcentaje"), "min", "max")


def accuracy(df: DataFrame, columns: list[str], stored_class: str) -> DataFrame:
    """Rows with an outlier in any of the variables or a misspelled class."""
    with work_folder(df.sparkSession, "accuracy") as folder:
        rows = store(df.select(*[_number(df, c).alias(c) for c in columns], stored_class), folder)
        bad = any_of([*[outlier(c) for c in columns], misspelled_class(stored_class)])
        one = written(rows.join(F.broadcast(fences_row(rows, columns, stored=True))).agg(  # a global aggregate: one row
            F.count(F.lit(1)).alias("total"), F.count_if(bad).alias("bad")), "accuracy-count")
    return one.withColumn("score", percentage(F.col("total") - F.col("bad"), F.col("total")))


# Recency

def recency(df: DataFrame, day: Column, as_of: str, months: int = RECENCY_MONTHS, by: str | None = None) -> DataFrame:
    """Rows inside the window before ``as_of`` and the lag of the last observation."""
    at = F.lit(as_of).cast("date")
    keys = [by] if by else []
    one = df.withColumn("_day", day).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total"), F.count_if(recent(F.col("_day"), at, months)).alias("vigentes"), F.max("_day").alias("ultima"))
    lag = F.date_diff(at, F.col("ultima"))
    return one.select(
        *keys, "total", (F.col("total") - F.col("vigentes")).alias("bad"), percentage(F.col("vigentes"), F.col("total")).alias("score"),
        "ultima", lag.alias("desfase_dias"), (lag / DAYS_PER_MONTH).alias("desfase_meses"))


# Scorecards

@dataclass(frozen=True)
class Plan:
    """What to measure on one data set."""

    columns: tuple[str, ...]
    rules: dict[str, tuple[float, float]]
    accuracy_columns: tuple[str, ...]
    as_of: str
    text: TextColumns = TextColumns()
    # Columns that make a row a copy of another; all where none is named.
    key: tuple[str, ...] = ()

    @property
    def needed(self) -> list[str]:
        t = self.text
        return list(dict.fromkeys([*self.columns, *self.rules, *self.accuracy_columns, t.date, t.year, t.month, t.place, t.value, t.stored_class, t.scope, *self.key]))


def scores(df: DataFrame, plan: Plan, by: list[str] = ()) -> DataFrame:
    """Six dimensions in long form, for all rows or per group: ``by``, dimension, total, bad, desfase_dias, score.

    Every row is judged once and stored with its verdicts, its numbers and the columns that make it a copy. Five dimensions are
    one aggregate over that (beside the rounds for the quartiles), uniqueness is a second one. ``by`` ranges over a closed list.
    """
    by = list(by)
    at = F.lit(plan.as_of).cast("date")
    t = plan.text
    day = F.when(~not_iso(t.date), parse_date(t.date))
    numbers = {c: safe_double(F.col(c).cast("string")) for c in dict.fromkeys([*plan.rules, *plan.accuracy_columns])}
    key = list(plan.key or plan.columns)
    verdicts = {
        "_missing": sum((is_missing(c).cast("int") for c in plan.columns), F.lit(0)),
        "_judged": sum((numbers[c].isNotNull().cast("int") for c in plan.rules), F.lit(0)),
        "_wrong": sum((outside(numbers[c], lo, hi).cast("int") for c, (lo, hi) in plan.rules.items()), F.lit(0)),
        "_inconsistent": any_of(list(consistency_rules(t).values())),
        "_misspelled": misspelled_class(t.stored_class),
        "_day": day,
    }
    rows, no_lag = F.count(F.lit(1)), F.lit(None).cast("int")

    def line(total: Column, bad: Column, lag: Column = no_lag) -> Column:
        return F.struct(total.cast("bigint").alias("total"), F.coalesce(bad.cast("bigint"), F.lit(0)).alias("bad"), lag.alias("desfase_dias"))

    with work_folder(df.sparkSession, "quality") as folder:
        judged = df.select(*by, *key, *[c.alias(f"_n_{n}") for n, c in numbers.items()], *[c.alias(n) for n, c in verdicts.items()])
        base = store(judged, folder)
        measured = [f"_n_{c}" for c in plan.accuracy_columns]
        limits = fences_row(base, measured, stored=True, by=by)  # a global aggregate, or one row a group of a closed list
        if by:
            limited = base.join(F.broadcast(limits.withColumnsRenamed({c: f"_by_{c}" for c in by})), _match(by, [f"_by_{c}" for c in by]), "left")
        else:
            limited = base.join(F.broadcast(limits))
        inaccurate = any_of([*[outlier(c) for c in measured], F.col("_misspelled")])
        one = written(limited.groupBy(*by).agg(
            line(rows * len(plan.columns), F.sum("_missing")).alias("Completitud"),
            line(F.sum("_judged"), F.sum("_wrong")).alias("Validez"),
            line(rows, F.count_if("_inconsistent")).alias("Consistencia"),
            line(rows, F.count_if(inaccurate)).alias("Exactitud"),
            line(rows, F.count_if(~recent(F.col("_day"), at)), F.date_diff(at, F.max("_day"))).alias("Actualidad"),
        ), "scores")
        copies = written(base.groupBy(*by, *key).agg(F.count(F.lit(1)).alias("n")).groupBy(*by).agg(
            line(F.coalesce(F.sum("n"), F.lit(0)), F.sum(F.col("n") - 1)).alias("Unicidad")), "copies")
    out = None
    for part in (one, copies):
        names = [c for c in part.columns if c not in by]
        lines = F.array(*[F.struct(F.lit(n).alias("dimension"), f"{n}.total", f"{n}.bad", f"{n}.desfase_dias") for n in names])
        long = part.select(*by, F.inline(lines))
        out = long if out is None else out.unionByName(long)
    return out.withColumn("score", percentage(F.col("total") - F.col("bad"), F.col("total")))


def complies(dimension: Column, score: Column, lag_days: Column) -> Column:
    """Score against the requirement of its dimension; recency is judged by the lag."""
    limit = None
    for name, least in QUALITY_THRESHOLDS.items():
        limit = F.when(dimension == name, least) if limit is None else limit.when(dimension == name, least)
    return F.coalesce(F.when(dimension == "Actualidad", lag_days <= MAX_LAG_DAYS).otherwise(score >= limit), F.lit(False))


def scorecard(df: DataFrame, plan: Plan, digits: int | None = None) -> DataFrame:
    s = scores(df, plan)
    return s.select("dimension", "total", "bad", _round(F.col("score"), digits).alias("score"),
                    complies(F.col("dimension"), F.col("score"), F.col("desfase_dias")).alias("cumple"))


def compare_scores(before: DataFrame, after: DataFrame, digits: int | None = None) -> DataFrame:
    """Two score tables side by side with the difference in points."""
    a = before.select("dimension", F.col("score").alias("antes"))
    b = after.select("dimension", F.col("score").alias("despues"))
    return a.join(b, "dimension").select(
        "dimension", _round(F.col("antes"), digits).alias("antes"), _round(F.col("despues"), digits).alias("despues"),
        _round(F.col("despues") - F.col("antes"), digits).alias("delta"))


def scores_before_and_after(before: DataFrame, after: DataFrame, plan: Plan) -> tuple[DataFrame, DataFrame]:
    """The scores of two frames, counted together as two groups of one stored frame."""
    side = lambda df, name: df.select(F.lit(name).alias("_side"), *plan.needed)
    both = scores(side(before, "a").unionByName(side(after, "b")), plan, by=["_side"])
    return tuple(both.where(F.col("_side") == name).drop("_side") for name in "ab")


# Profiles

def numeric_profile(df: DataFrame, columns: list[str], digits: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, least, quartiles, greatest per variable."""
    with work_folder(df.sparkSession, "numbers") as folder:
        numbers = store(_numbers(df, columns), folder)
        q = exact_quantiles(numbers, "value", {"q1": 0.25, "mediana": 0.5, "q3": 0.75}, by=["variable"], stored=True).drop("n")
        s = written(numbers.groupBy("variable").agg(
            F.count("value").alias("n"), F.avg("value").alias("media"), F.stddev_samp("value").alias("desv"),
            F.min("value").alias("min"), F.max("value").alias("max")), "profile")
    return s.join(q, "variable").select("variable", "n", *[
        _round(F.col(c), digits).alias(c) for c in ("media", "desv", "min", "q1", "mediana", "q3", "max")])


def group_median(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    return exact_quantiles(df, column, {"mediana": 0.5}, by=by)


def impute_median(df: DataFrame, columns: list[str], by: list[str], stored: bool = False) -> DataFrame:
    """Fill nulls with the median of the row's group (0 for a group without values) and flag them. ``stored``: ``df`` is a stored frame."""
    long = df.select(*by, *columns).unpivot(by, columns, "variable", "value")
    medians = exact_quantiles(long, "value", {"m": 0.5}, by=[*by, "variable"], stored=stored)
    wide = written(medians.groupBy(*by).agg(*[F.max(F.when(F.col("variable") == c, F.col("m"))).alias(f"_m_{c}") for c in columns])
                   .withColumnsRenamed({c: f"_b_{c}" for c in by}), "medians")
    out = df.join(broadcast_if_small(wide), _match(by, [f"_b_{c}" for c in by]), "left")
    filled = {f"{c}_imputado": F.col(c).isNull() for c in columns}
    filled.update({c: F.coalesce(F.col(c), F.col(f"_m_{c}"), F.lit(0.0)) for c in columns})
    return out.withColumns(filled).drop(*[f"_b_{c}" for c in by], *[f"_m_{c}" for c in columns])


def calendar_gaps(df: DataFrame, day: str, by: list[str] = ()) -> DataFrame:
    """Days between first and last observation, days with data, days without."""
    days = df.select(*by, day).distinct()
    out = days.groupBy(*by).agg(F.min(day).alias("primera"), F.max(day).alias("ultima"), F.count(day).alias("dias_con_datos"))
    span = F.date_diff("ultima", "primera") + 1
    return out.withColumns({"dias_rango": span, "dias_sin_datos": span - F.col("dias_con_datos")})


def calendar_gap_days(df: DataFrame, day: str, by: list[str]) -> DataFrame:
    """The missing days themselves."""
    days = df.select(*by, day).distinct()
    every = days.groupBy(*by).agg(F.min(day).alias("a"), F.max(day).alias("z")).select(*by, F.explode(F.sequence("a", "z")).alias(day))
    return every.join(days, [*by, day], "left_anti")


@dataclass(frozen=True)
class ZeroCheck:
    """A check that should find nothing: rows that meet ``condition``, or what a whole-table ``count`` (one row, ``registros``) finds."""

    variable: str
    name: str
    dimension: str
    condition: Column | None = None
    count: Callable[[DataFrame], DataFrame] | None = None


def days_without_rows(day: Column) -> Callable[[DataFrame], DataFrame]:
    """Days between the first and the last readable date on which no row stands."""
    return lambda df: calendar_gaps(df.select(day.alias("_day")).where("_day IS NOT NULL"), "_day").select(F.coalesce("dias_sin_datos", F.lit(0)).cast("bigint").alias("registros"))


def zero_checks(df: DataFrame, checks: list[ZeroCheck]) -> DataFrame:
    """variable, prueba, registros, dimension of every check. Row conditions are one aggregate; the rows are stored once for all."""
    rows = [c for c in checks if c.condition is not None]
    with work_folder(df.sparkSession, "checks") as folder:
        base = store(df, folder)
        found = _counted(base, {f"c{i}": c.condition for i, c in enumerate(checks) if c in rows}, {f"c{i}": c.count for i, c in enumerate(checks) if c not in rows})
    about = F.create_map(*[x for i, c in enumerate(checks) for x in (F.lit(f"c{i}"), F.struct(
        F.lit(c.variable).alias("variable"), F.lit(c.name).alias("prueba"), F.lit(c.dimension).alias("dimension")))])
    return found.withColumn("_a", F.element_at(about, F.col("id"))).select("_a.variable", "_a.prueba", "registros", "_a.dimension")


def _counted(base: DataFrame, conditions: dict[str, Column], counts: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """id, registros, total: rows that meet each condition, from one aggregate, and what each count over all rows finds. Stored: a few rows."""
    one = base.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.coalesce(c, F.lit(False))).alias(i) for i, c in conditions.items()])
    out = one.select(F.inline(F.array(*[F.struct(F.lit(i).alias("id"), F.col(i).alias("registros"), "total") for i in conditions])))
    total = base.agg(F.count(F.lit(1)).alias("total"))
    for i, count in counts.items():
        out = out.unionByName(count(base).select(F.lit(i).alias("id"), F.coalesce("registros", F.lit(0)).cast("bigint").alias("registros")).join(F.broadcast(total)))  # two one-row aggregates
    return written(out, "counted")


# Problems and causes

@dataclass(frozen=True)
class Problem:
    """Rows that meet ``condition`` have it; a problem of the table as a whole has a ``count`` instead: rows -> one row with ``registros``."""

    id: str
    variable: str
    dimension: str
    impact: str
    condition: Column | None = None
    count: Callable[[DataFrame], DataFrame] | None = None


def extra_copies(columns: list[str]) -> Callable[[DataFrame], DataFrame]:
    """Rows beyond the first of equal ones."""
    return lambda df: duplicate_profile(df, columns).select(F.col("extra_rows").alias("registros"))


def lagging_part(part: Column, day: Column) -> Callable[[DataFrame], DataFrame]:
    """All rows of a part of the table whose last date lies before that of the whole; 0 if it keeps up."""
    inside = F.coalesce(part, F.lit(False))
    return lambda df: df.agg(F.count_if(inside).alias("n"), F.max(F.when(inside, day)).alias("a"), F.max(day).alias("z")).select(
        F.when((F.col("a") < F.col("z")) | (F.col("a").isNull() & F.col("z").isNotNull()), F.col("n")).otherwise(0).alias("registros"))


# Problem -> (root cause, secondary cause).
CAUSES = {
    "P01": ("Errores de captura", "Ausencia de validaciones"), "P02": ("Errores de captura", "Ausencia de validaciones"),
    "P03": ("Errores de captura", "Duplicidad de fuentes"), "P04": ("Ausencia de validaciones", "Formatos diferentes"),
    "P05": ("Formatos diferentes", "Ausencia de validaciones"), "P06": ("Duplicidad de fuentes", "Falta de actualizacion"),
    "P07": ("Duplicidad de fuentes", "Ausencia de validaciones"), "P08": ("Errores de captura", "Ausencia de validaciones"),
    "P09": ("Formatos diferentes", "Ausencia de validaciones"), "P10": ("Formatos diferentes", "Duplicidad de fuentes"),
    "P11": ("Ausencia de validaciones", "Errores de captura"), "P12": ("Ausencia de validaciones", "Errores de captura"),
    "P13": ("Formatos diferentes", "Ausencia de validaciones"), "P14": ("Formatos diferentes", "Ausencia de validaciones"),
    "P15": ("Formatos diferentes", "Duplicidad de fuentes"), "P16": ("Errores de captura", "Ausencia de validaciones"),
    "P17": ("Duplicidad de fuentes", "Errores de captura"), "P18": ("Duplicidad de fuentes", ""),
    "P19": ("Duplicidad de fuentes", ""), "P20": ("Falta de actualizacion", "Ausencia de validaciones"),
    "P21": ("Falta de actualizacion", "Duplicidad de fuentes"), "P22": ("Falta de actualizacion", "Ausencia de validaciones"),
}

# Order of the causes in reports.
CAUSE_ORDER = (
    "Errores de captura", "Formatos diferentes", "Ausencia de validaciones", "Duplicidad de fuentes", "Falta de actualizacion")

# Treated problem -> kind of treatment.
TREATMENTS = {
    "P01": "Tratamiento de valores nulos", "P02": "Tratamiento de valores nulos",
    "P03": "Tratamiento de valores nulos (por exclusion)", "P04": "Estandarizacion de textos / tratamiento de nulos",
    "P07": "Eliminacion de duplicados", "P08": "Validacion de rangos", "P09": "Estandarizacion de fechas",
    "P10": "Estandarizacion de textos / homologacion de categorias", "P11": "Correccion de tipos de datos / regla derivada",
    "P12": "Correccion de tipos de datos / regla derivada", "P16": "Homologacion de categorias",
}


def problem_inventory(df: DataFrame, problems: list[Problem], digits: int | None = None, fenced: list[str] = ()) -> DataFrame:
    """Affected rows of every problem. The rows are stored once: all conditions are one aggregate over them, each whole-table count another.

    ``fenced`` names columns whose Tukey limits conditions need: ``outlier(beyond(c))`` is then such a condition.
    """
    with work_folder(df.sparkSession, "problems") as folder:
        base = store(df.select("*", *[safe_double(F.col(c).cast("string")).alias(beyond(c)) for c in fenced]), folder)
        if fenced:
            base = base.join(F.broadcast(fences_row(base, [beyond(c) for c in fenced], stored=True)))  # a global aggregate: one row
        counts = _counted(base, {p.id: p.condition for p in problems if p.condition is not None}, {p.id: p.count for p in problems if p.condition is None})
    about = F.create_map(*[x for p in problems for x in (F.lit(p.id), F.struct(
        F.lit(p.variable).alias("variable"), F.lit(p.dimension).alias("dimension"), F.lit(p.impact).alias("impacto")))])
    return counts.withColumn("_a", F.element_at(about, F.col("id"))).select(
        "id", F.col("_a.variable").alias("variable"), "registros", _round(percentage(F.col("registros"), F.col("total")), digits).alias("porcentaje"),
        F.col("_a.dimension").alias("dimension"), F.col("_a.impacto").alias("impacto"))


def beyond(column: str) -> str:
    """Name of the parsed numbers of a fenced column."""
    return f"_n_{column}"


def cause_table(spark: SparkSession, causes: dict[str, tuple[str, str]] = CAUSES) -> DataFrame:
    return spark.createDataFrame([(i, a, b) for i, (a, b) in causes.items()], "id string, causa_raiz string, causa_secundaria string")


def treatment_table(spark: SparkSession, treatments: dict[str, str] = TREATMENTS) -> DataFrame:
    return spark.createDataFrame(list(treatments.items()), "id string, tipo_accion string")


def missing_causes(inventory: DataFrame, causes: DataFrame) -> DataFrame:
    """Problems of the inventory without a cause: must be empty."""
    return inventory.select("id").join(causes, "id", "left_anti")


def join_causes(inventory: DataFrame, causes: DataFrame) -> DataFrame:
    """Every problem with its causes; a problem without one raises when the rows are read."""
    joined = inventory.join(causes, "id", "left")
    guard = F.when(F.col("causa_raiz").isNotNull(), F.col("causa_raiz")).otherwise(
        F.raise_error(F.concat(F.lit("Hay problemas del inventario sin causa asignada: "), F.col("id"))).cast("string"))
    return joined.withColumn("causa_raiz", guard)


def problem_tally(inventory: DataFrame, by: str) -> DataFrame:
    return inventory.groupBy(by).agg(
        F.count(F.lit(1)).alias("problemas"), F.array_join(F.array_sort(F.collect_list("id")), ", ").alias("ids")).orderBy(F.desc("problemas"), by)


def cause_summary(with_causes: DataFrame) -> DataFrame:
    """Per cause: problems as root, as secondary, of high impact, their ids and dimensions."""
    roles = with_causes.select(
        "id", "dimension", "impacto",
        F.explode(F.array(F.struct(F.col("causa_raiz").alias("causa"), F.lit(True).alias("raiz")),
                          F.struct(F.col("causa_secundaria").alias("causa"), F.lit(False).alias("raiz")))).alias("r"),
    ).select("id", "dimension", "impacto", "r.causa", "r.raiz").where("causa <> ''")
    root = F.col("raiz")
    return roles.groupBy("causa").agg(
        F.count_if(root).alias("como_raiz"), F.count_if(~root).alias("como_secundaria"),
        F.count_if(root & (F.col("impacto") == "Alto")).alias("impacto_alto"),
        F.array_join(F.array_sort(F.collect_list(F.when(root, F.col("id")))), ", ").alias("ids"),
        F.array_join(F.array_sort(F.collect_set(F.when(root, F.col("dimension")))), ", ").alias("dimensiones"))


def rules_with_impact(treatments: DataFrame, inventory: DataFrame) -> DataFrame:
    """Treatments with the problem's impact and dimension; empty where the problem is not in the inventory."""
    known = inventory.select("id", "impacto", "dimension", F.col("porcentaje").cast("string").alias("porcentaje"))
    return treatments.join(known, "id", "left").na.fill("", ["impacto", "dimension", "porcentaje"])


def rules_applied(treatments: DataFrame, inventory: DataFrame) -> DataFrame:
    return treatments.join(inventory.select("id"), "id", "left_semi")



"""What a caller may filter on: one declaration per filter, and selections that turn into a column."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..domain import Domain

# What stands for "no filter", and the text of a selection without filters.
ALL = ("", "Todos")
NOTHING_SELECTED = "Sin filtros (todas las mediciones)"


@dataclass(frozen=True)
class Filter:
    """A name callers use, the column it restricts, the dimension that column belongs to, and how the filter is called."""

    name: str
    column: str
    dimension: str
    label: str
    integer: bool = False

    def read(self, given) -> tuple[str, ...]:
        """Values as text; blanks, nulls and the word for all of them are no values."""
        many = given if isinstance(given, (list, tuple)) else (given,)
        texts = (str(v).strip() for v in many if v is not None)
        return tuple(t for t in texts if t not in ALL)

    def holds(self, values: Iterable[str]) -> Column:
        return F.col(self.column).isin([int(v) for v in values] if self.integer else list(values))


FILTERS = {f.name: f for f in (
    Filter("region", "region", "Geografía", "Región"),
    Filter("departamento", "department", "Geografía", "Departamento"),
    Filter("anio", "anio", "Tiempo", "Año", integer=True),
    Filter("trimestre", "periodo", "Tiempo", "Trimestre"),
    Filter("sistema", "system", "Sistema de abastecimiento", "Sistema"),
    Filter("servicio", "service", "Servicio", "Nivel de servicio"),
    Filter("riesgo", "risk_group", "Riesgo", "Grupo de riesgo"),
)}


class Selection(dict):
    """Filter name -> values, for the known filters that restrict anything."""

    def __init__(self, given: dict | None = None):
        read = {name: FILTERS[name].read(values) for name, values in (given or {}).items() if name in FILTERS}
        super().__init__({name: list(values) for name, values in read.items() if values})

    @property
    def dimensions(self) -> list[str]:
        return sorted({FILTERS[name].dimension for name in self})

    def without(self, name: str) -> Selection:
        return Selection({n: v for n, v in self.items() if n != name})

    def condition(self) -> Column:
        return reduce(Column.__and__, (FILTERS[n].holds(v) for n, v in self.items()), F.lit(True))

    def __str__(self) -> str:
        return " | ".join(f"{FILTERS[n].label} = {', '.join(v)}" for n, v in self.items()) or NOTHING_SELECTED


def known(name: str, names: Iterable[str], kind: str) -> str:
    """``name`` if it is one of ``names``."""
    if name in names:
        return name
    raise ValueError(f"unknown {kind} {name!r}; known are {sorted(names)}")


def filter_in(df: DataFrame, filters: dict | None) -> DataFrame:
    selection = Selection(filters)
    return df.where(selection.condition()) if selection else df


def filter_optional(df: DataFrame, filters: dict | None, domain: Domain | None = None) -> DataFrame:
    """One optional value per filter. What is no value, an unknown name or a year that is no integer restricts nothing;
    ``periodo`` may name a period of the domain."""
    given = dict(filters or {})
    period = given.pop("periodo", None)
    selection = Selection({n: v for n, v in given.items() if not (n in FILTERS and FILTERS[n].integer) or _is_integer(v)})
    conditions = [selection.condition()] * bool(selection)
    if domain and period in domain.periods:
        conditions.append(named_period(domain, period))
    return reduce(DataFrame.where, conditions, df)


def _is_integer(value) -> bool:
    return str(value).strip().lstrip("+-").isdecimal()


def named_period(domain: Domain, label: str, year: str = "anio") -> Column:
    return F.col(year).between(*domain.periods[known(label, domain.periods, "period")])

"""Closed value lists of the measurement domain.

Frames use one set of column names throughout (``fecha, anio, mes, trimestre, periodo, region,
department, place, system, irca, coverage, storage, rain, water_use, service, decision``); a
``Domain`` holds the values that differ between data sets.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Risk index cuts (right-closed) and class labels.
RISK_CUTS = (5, 14, 28, 40)
RISK_LABELS = (
    "Sin riesgo (0-5)",
    "Bajo riesgo (5-14)",
    "Riesgo medio (14-28)",
    "Alto riesgo (28-40)",
    "Inviable sanitariamente (>40)",
)
RISK_TYPO = "Inviabile"
NO_VALUE_CLASS = "Sin dato de IRCA"
UNKNOWN = "Desconocido"

# Key, class, group, lower, upper, order.
RISK_DIMENSION = (
    (0, "Desconocido", "Desconocido", None, None, 0),
    (1, "Sin riesgo (0-5)", "Bajo o nulo", 0.0, 5.0, 1),
    (2, "Bajo riesgo (5-14)", "Bajo o nulo", 5.0, 14.0, 2),
    (3, "Riesgo medio (14-28)", "Medio", 14.0, 28.0, 3),
    (4, "Alto riesgo (28-40)", "Alto o inviable", 28.0, 40.0, 4),
    (5, "Inviable sanitariamente (>40)", "Alto o inviable", 40.0, 100.0, 5),
    (6, "Sin dato de IRCA", "Sin dato", None, None, 6),
)
RISK_GROUPS = ("Bajo o nulo", "Medio", "Alto o inviable")
HIGH_GROUP = "Alto o inviable"
NO_DATA_GROUP = "Sin dato"

# Month names of the time dimension.
MONTH_NAMES = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)

# Texts that stand for "no value" (compared trimmed and in lower case).
MISSING_MARKERS = ("", "n/a", "na", "null", "none", "-", "n/d")

# Least score per quality dimension; recency compares days of lag.
QUALITY_THRESHOLDS = {
    "Completitud": 92.0,
    "Unicidad": 95.0,
    "Validez": 95.0,
    "Consistencia": 92.0,
    "Exactitud": 92.0,
}
MAX_LAG_DAYS = 1825
RECENCY_MONTHS = 60

# Rule, field and reason of each reject route.
REJECT_REASONS = {
    "P05": ("tipo_region", "Registro de nivel global: vacios estructurales, fuera del alcance municipal"),
    "P09": ("fecha", "Fecha no convertible a ISO o inconsistente con la columna mes"),
    "P08": ("irca", "IRCA fuera del dominio 0-100 (Res. 2115/2007)"),
    "CONV": ("varios", "Error de conversion de tipo"),
    "P07": ("fecha+municipio+sistema", "Rechazado por la BD: llave fecha+municipio+sistema repetida"),
}
# Ours: the route of rows that a stream delivers too late.
LATE, LATE_REASON = "TARDE", ("fecha", "Llego cuando el plazo de su fecha ya habia cerrado")


@dataclass(frozen=True)
class Domain:
    services: tuple[str, ...]
    interrupted: tuple[str, ...]
    systems: tuple[str, ...]
    out_of_coverage: str
    regions: tuple[str, ...]
    global_scope: str
    no_restriction: str
    periods: dict[str, tuple[int, int]] = field(default_factory=dict)

    @property
    def continuous(self) -> str:
        return self.services[0]


# The published water data set.
WATER = Domain(
    services=("Continuo", "Intermitente", "Racionado", "Sin servicio"),
    interrupted=("Racionado", "Sin servicio"),
    systems=("Chingaza", "Sur", "Tibitoc", "Fuera de cobertura EAAB"),
    out_of_coverage="Fuera de cobertura EAAB",
    regions=("Regional", "Nacional"),
    global_scope="Global",
    no_restriction="Sin restriccion",
    periods={"2019-2023": (2019, 2023), "2024": (2024, 2024), "2025": (2025, 2025), "2024-2025": (2024, 2025)},
)

# The same domain over the order tables (see plans/views.py).
TRADE = Domain(
    services=("Continuous", "Intermittent", "Rationed", "No service"),
    interrupted=("Rationed", "No service"),
    systems=("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
    out_of_coverage="Out of coverage",
    regions=("EUROPE", "ASIA", "AMERICA", "MIDDLE EAST", "AFRICA"),
    global_scope="Global",
    no_restriction="No restriction",
    periods={"1995-1999": (1995, 1999), "2000": (2000, 2000), "2001": (2001, 2001), "2000-2001": (2000, 2001)},
)

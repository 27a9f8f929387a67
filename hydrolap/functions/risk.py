"""Risk classes, groups and priority labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..domain import NO_DATA_GROUP, RISK_CUTS, RISK_DIMENSION, RISK_LABELS, UNKNOWN
from .text import _col


def risk_class(c: Column | str, labels: tuple[str, ...] = RISK_LABELS) -> Column:
    """Right-closed buckets (5 belongs to the first class); null stays null."""
    value = _col(c)
    out = F.when(value.isNull(), F.lit(None))
    for cut, label in zip(RISK_CUTS, labels):
        out = out.when(value <= cut, F.lit(label))
    return out.otherwise(F.lit(labels[-1]))


def risk_group_of_class(c: Column | str) -> Column:
    """Class to group; an unlisted class is unknown, which is not the same as missing."""
    name = _col(c)
    out = None
    for _, label, group, *_ in RISK_DIMENSION:
        hit = name == label
        out = F.when(hit, F.lit(group)) if out is None else out.when(hit, F.lit(group))
    return out.otherwise(F.lit(UNKNOWN))


def risk_group(c: Column | str) -> Column:
    """Index value to group; a missing value has its own group."""
    value = _col(c)
    return F.when(value.isNull(), F.lit(NO_DATA_GROUP)).otherwise(risk_group_of_class(risk_class(value)))


# Priority thresholds and labels.
HIGH_RISK_PCT = 40
LOW_CONTINUITY_PCT = 50
PRIORITY_LABELS = ("Prioridad conjunta", "Prioridad de calidad", "Prioridad de servicio", "Seguimiento")


def quadrant(pct_high: Column, pct_continuous: Column) -> Column:
    """Two-threshold label; a missing percentage counts as 0."""
    risky = F.coalesce(pct_high, F.lit(0.0)) >= HIGH_RISK_PCT
    broken = F.coalesce(pct_continuous, F.lit(0.0)) < LOW_CONTINUITY_PCT
    both, quality, service, watch = PRIORITY_LABELS
    return (
        F.when(risky & broken, both).when(risky, quality).when(broken, service).otherwise(watch)
    )

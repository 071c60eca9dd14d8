"""Quality score of a lead as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _col, truthy

# --- fixed values: points per field, tracked fields, bands ---
WEIGHTS = {"email": 25, "telefono": 20, "sitio_web": 15, "partido": 10, "localidad": 10}
COORDINATES_WEIGHT = 10
VALIDATED_WEIGHT = 10
TRACKED_FIELDS = [
    "nombre", "email", "telefono", "sitio_web", "partido",
    "localidad", "provincia", "direccion", "latitud", "longitud",
]
HIGH_FROM, MEDIUM_FROM = 70, 40


def _has_coordinates() -> Column:
    return F.col("latitud").isNotNull() & F.col("longitud").isNotNull()


def _validated() -> Column:
    return F.coalesce(F.col("email_validado"), F.lit(False))


def quality_score() -> Column:
    """0..100 points of a lead row."""
    points = F.lit(0)
    for name, weight in WEIGHTS.items():
        points = points + F.when(truthy(name), weight).otherwise(0)
    points = points + F.when(_has_coordinates(), COORDINATES_WEIGHT).otherwise(0)
    points = points + F.when(_validated(), VALIDATED_WEIGHT).otherwise(0)
    return F.least(points, F.lit(100)).cast("double")


def missing_fields() -> Column:
    """Names of absent fields in a fixed order."""
    gaps = [F.when(~truthy(name), F.lit(name)) for name in WEIGHTS]
    gaps.append(F.when(~_has_coordinates(), F.lit("coordenadas")))
    return F.array_compact(F.array(*gaps))


def completeness(columns: list[str] | None = None) -> Column:
    """Percent of the ten tracked fields that are not NULL.

    ``columns`` are the columns the table has; a missing one counts as NULL.
    """
    present = [c for c in TRACKED_FIELDS if columns is None or c in columns]
    filled = F.lit(0)
    for name in present:
        filled = filled + F.col(name).isNotNull().cast("int")
    return (filled * 100 / len(TRACKED_FIELDS)).cast("double")


def has_critical_contact() -> Column:
    return truthy("email") | truthy("telefono") | truthy("sitio_web")


def is_enriched() -> Column:
    """E-mail, phone or a non-zero latitude present."""
    return truthy("email") | truthy("telefono") | (F.coalesce(F.col("latitud"), F.lit(0.0)) != 0.0)


def quality_band(score="score") -> Column:
    s = _col(score)
    return F.when(s >= HIGH_FROM, "alta").when(s >= MEDIUM_FROM, "media").otherwise("baja")


def percent_band(pct, warn: float = 40, ok: float = 70) -> Column:
    p = _col(pct)
    return F.when(p >= ok, "ok").when(p >= warn, "warn").otherwise("low")


def percent_flag(pct, ok: float = 50) -> Column:
    return _col(pct) >= ok

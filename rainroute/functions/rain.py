"""Rain-intensity bands."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Band labels and their closed limits in mm per hour. The limits
# touch at 5 (the first band wins) and leave (25, 25.1) uncovered on purpose.
DRY = "Sem Chuva"
CLOSED_BANDS = (
    ("Fraca", 0.1, 5.0),
    ("Moderada", 5.0, 25.0),
    ("Forte", 25.1, 50.0),
)
HEAVIEST, HEAVIEST_ABOVE = "Muito Forte", 50.0


def _chain(rules: list[tuple[Column, str]]) -> Column:
    (condition, label), *rest = rules
    expr = F.when(condition, label)
    for condition, label in rest:
        expr = expr.when(condition, label)
    return expr.otherwise(DRY)


def rain_band(mm: Column | str) -> Column:
    """Band of an hourly rainfall; first match wins, NULL and holes are dry."""
    mm = F.col(mm) if isinstance(mm, str) else mm
    rules = [(mm.between(low, high), label) for label, low, high in CLOSED_BANDS]
    return _chain([*rules, (mm > HEAVIEST_ABOVE, HEAVIEST)])


def rain_band_contiguous(mm: Column | str) -> Column:
    """Variant without the (25, 25.1) hole: each band reaches up to the next limit."""
    mm = F.col(mm) if isinstance(mm, str) else mm
    floor = CLOSED_BANDS[0][1]
    return _chain(
        [(mm > HEAVIEST_ABOVE, HEAVIEST)]
        + [
            (mm > below, label)
            for (label, _, _), (_, _, below) in zip(reversed(CLOSED_BANDS), reversed(CLOSED_BANDS[:-1]))
        ]
        + [(mm >= floor, CLOSED_BANDS[0][0])]
    )

"""Action, risk level and advice of a scored reading."""

from pyspark.sql import Column, functions as F

from frostline.functions.numeric import half_even
from frostline.schema import (
    ACTUAL, AMBIENT, CLASSES, EMERGENCY, SAFE, SEAL, SET_POINT, WARNING, probability,
)

# Allowed range of each reading (lowest, highest; None = open).
RANGES = {
    "Ambient_External_Temp_C": (-40.0, 70.0),
    "Internal_Set_Point_C": (-40.0, 20.0),
    "Actual_Internal_Temp_C": (-40.0, 70.0),
    "HVAC_Power_Consumption_Watts": (0.0, None),
    "Seal_Integrity_Index": (0.0, 1.0),
}

# Physical emergency limits.
EMERGENCY_DEVIATION = 6.0
EMERGENCY_SEAL = 0.60
EMERGENCY_AMBIENT = 38.0

# Risk level and advice of each action.
RISK_LEVELS = {SAFE: "LOW", WARNING: "MEDIUM", EMERGENCY: "HIGH"}
UNKNOWN_LEVEL = "UNKNOWN"
ADVICE = {
    SAFE: ["Continue shipment.", "Monitor temperature normally.", "No corrective action required."],
    WARNING: ["Request remote HVAC reset.", "Increase telemetry monitoring.", "Notify operations team."],
    EMERGENCY: ["Stop shipment immediately.", "Escalate to emergency response.",
                "Inspect refrigeration unit.", "Protect cargo from spoilage."],
}
DEFAULT_ADVICE = ["No recommendation available."]


def violation(name: str, lo: float | None, hi: float | None) -> Column:
    """The column name when its value is missing or out of range, else null."""
    value = F.col(name)
    bad = value.isNull() | F.isnan(value)
    if lo is not None:
        bad = bad | (value < F.lit(lo))
    if hi is not None:
        bad = bad | (value > F.lit(hi))
    return F.when(bad, F.lit(name))


def in_ranges(ranges: dict[str, tuple] = RANGES) -> Column:
    """True when no reading is missing or out of range; plain comparisons, so a parquet scan can skip by them."""
    allowed = F.lit(True)
    for name, (lo, hi) in ranges.items():
        value = F.col(name)
        if lo is not None:
            allowed = allowed & (value >= F.lit(lo))
        allowed = allowed & (value <= F.lit(hi) if hi is not None else ~F.isnan(value))
    return allowed


def is_emergency(deviation: float = EMERGENCY_DEVIATION, seal: float = EMERGENCY_SEAL,
                 ambient: float = EMERGENCY_AMBIENT) -> Column:
    """Physical emergency; a missing reading never triggers it."""
    condition = (
        ((F.col(ACTUAL) - F.col(SET_POINT)) >= F.lit(deviation))
        & (F.col(SEAL) < F.lit(seal))
        & (F.col(AMBIENT) >= F.lit(ambient))
    )
    return F.coalesce(condition, F.lit(False))


def class_probabilities(classes: list[str] = CLASSES, digits: int = 6) -> Column:
    """Map of class to probability."""
    return F.map_from_arrays(
        F.array(*[F.lit(c) for c in classes]),
        F.array(*[half_even(F.col(probability(c)), digits) for c in classes]),
    )


def confidence(classes: list[str] = CLASSES, digits: int = 6) -> Column:
    """Highest probability."""
    return half_even(F.greatest(*[F.col(probability(c)) for c in classes]), digits)


def warning_or_safe(threshold: float) -> Column:
    """WARNING when its probability reaches the threshold; the emergency probability is not used."""
    return F.when(F.col(probability(WARNING)) >= F.lit(float(threshold)), F.lit(WARNING)).otherwise(F.lit(SAFE))


def action(threshold: float) -> Column:
    """Thresholded action with the physical emergency override."""
    return F.when(is_emergency(), F.lit(EMERGENCY)).otherwise(warning_or_safe(threshold))


def risk_level(label: Column) -> Column:
    level = F
    for name, value in RISK_LEVELS.items():
        level = level.when(label == name, F.lit(value))
    return level.otherwise(F.lit(UNKNOWN_LEVEL))


def recommendations(label: Column) -> Column:
    texts = F
    for name, lines in ADVICE.items():
        texts = texts.when(label == name, F.array(*[F.lit(x) for x in lines]))
    return texts.otherwise(F.array(*[F.lit(x) for x in DEFAULT_ADVICE]))

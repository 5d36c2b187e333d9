"""Column names, labels and the fixed table schema."""

from pyspark.sql import types as T

ID = "Container_ID"
CARGO = "Cargo_Type"
AMBIENT = "Ambient_External_Temp_C"
SET_POINT = "Internal_Set_Point_C"
ACTUAL = "Actual_Internal_Temp_C"
WATTS = "HVAC_Power_Consumption_Watts"
SEAL = "Seal_Integrity_Index"
RISK = "Forecasted_4Hr_Spoilage_Risk_Pct"
ACTION = "Logistics_Action_Recommendation"
PREDICTED_RISK = "Predicted_Spoilage_Risk_Pct"
ORIGIN = "Data_Origin"

# The three action labels, in label-encoder (alphabetical) order.
EMERGENCY = "EMERGENCY"
SAFE = "SAFE_Maintain_Course"
WARNING = "WARNING_Request_HVAC_Remote_Reset"
CLASSES = [EMERGENCY, SAFE, WARNING]

SENSORS = [AMBIENT, SET_POINT, ACTUAL, WATTS, SEAL]
NUMERIC = [*SENSORS, RISK]
INPUTS = [CARGO, *SENSORS]
REQUIRED = [ID, *INPUTS, RISK, ACTION]

TELEMETRY = T.StructType(
    [T.StructField(ID, T.StringType()), T.StructField(CARGO, T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in NUMERIC]
    + [T.StructField(ACTION, T.StringType())]
)


def probability(label: str) -> str:
    """Name of the probability column of one class."""
    return f"Probability_{label}"


PROBABILITIES = [probability(c) for c in CLASSES]

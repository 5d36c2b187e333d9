"""Physical features of a reading, one expression each, and the four feature sets."""

from pyspark.sql import Column, DataFrame, functions as F

from frostline.functions.numeric import clip, ratio, ratio_or_zero
from frostline.schema import ACTUAL, AMBIENT, SEAL, SET_POINT, WATTS



def temperature_deviation() -> Column:
    return F.col(ACTUAL) - F.col(SET_POINT)


def positive_deviation() -> Column:
    return clip(temperature_deviation(), lo=0)


def ambient_load() -> Column:
    return F.col(AMBIENT) - F.col(SET_POINT)


def hvac_efficiency_guarded() -> Column:
    """Load per watt; zero power or a missing reading gives 0."""
    return ratio_or_zero(ambient_load(), F.col(WATTS))


def hvac_efficiency_plain() -> Column:
    """Load per watt; zero power gives null."""
    return ratio(ambient_load(), F.col(WATTS))


def hvac_efficiency_staged() -> Column:
    return temperature_deviation() / (F.col(WATTS) + 1.0)


def seal_loss() -> Column:
    return F.lit(1.0) - F.col(SEAL)


def hvac_stress_index() -> Column:
    return F.col(WATTS) * seal_loss()


def thermal_leak_load() -> Column:
    return clip(ambient_load(), lo=0) * seal_loss()


def hvac_load_per_degree() -> Column:
    return F.col(WATTS) / (F.abs(ambient_load()) + 1.0)


def cooling_efficiency() -> Column:
    return (F.col(AMBIENT) - F.col(ACTUAL)) / (F.col(WATTS) + 1.0)


def hvac_stress() -> Column:
    return F.col(WATTS) / (positive_deviation() + 1.0)


def ambient_stress() -> Column:
    return F.col(AMBIENT) * seal_loss()


def heat_ingress() -> Column:
    return (F.col(AMBIENT) - F.col(ACTUAL)) * seal_loss()


def cooling_stress() -> Column:
    return ambient_load() * F.col(WATTS)


def thermal_stress_index() -> Column:
    return temperature_deviation() * ambient_load()


def temperature_risk_index() -> Column:
    return F.abs(temperature_deviation()) * seal_loss()


def cooling_performance_score() -> Column:
    return F.col(WATTS) / (F.abs(temperature_deviation()) + 1.0)


def overall_risk_score() -> Column:
    return temperature_risk_index() + cooling_stress() + seal_loss()


REGRESSION = {
    "Temperature_Deviation_C": temperature_deviation,
    "Positive_Temperature_Deviation_C": positive_deviation,
    "Cooling_Load_C": ambient_load,
    "HVAC_Efficiency": hvac_efficiency_guarded,
    "Seal_Loss_Score": seal_loss,
    "HVAC_Stress_Index": hvac_stress_index,
    "Thermal_Leak_Load": thermal_leak_load,
    "HVAC_Load_Per_Degree": hvac_load_per_degree,
}

CLASSIFICATION = {
    "Temperature_Deviation": temperature_deviation,
    "Positive_Temperature_Deviation": positive_deviation,
    "Ambient_Load": ambient_load,
    "Seal_Loss": seal_loss,
    "Thermal_Leak_Load": thermal_leak_load,
    "HVAC_Load_Per_Degree": hvac_load_per_degree,
    "Cooling_Efficiency": cooling_efficiency,
    "HVAC_Stress": hvac_stress,
    "Ambient_Stress": ambient_stress,
    "Heat_Ingress": heat_ingress,
}

STAGED = {
    "Temperature_Deviation": temperature_deviation,
    "Ambient_Load": ambient_load,
    "HVAC_Efficiency": hvac_efficiency_staged,
    "Cooling_Stress": cooling_stress,
    "Seal_Loss": seal_loss,
    "Thermal_Stress_Index": thermal_stress_index,
    "HVAC_Load_Ratio": hvac_load_per_degree,
    "Temperature_Risk_Index": temperature_risk_index,
    "Cooling_Performance_Score": cooling_performance_score,
    "Overall_Risk_Score": overall_risk_score,
}

LEGACY = {
    "Temperature_Deviation_C": temperature_deviation,
    "Cooling_Load_C": ambient_load,
    "HVAC_Efficiency": hvac_efficiency_plain,
    "Seal_Loss_Score": seal_loss,
    "HVAC_Stress_Index": hvac_stress_index,
}


def _add(df: DataFrame, feature_set: dict) -> DataFrame:
    return df.withColumns({name: build() for name, build in feature_set.items()})


def features_regression(df: DataFrame) -> DataFrame:
    return _add(df, REGRESSION)


def features_classification(df: DataFrame) -> DataFrame:
    return _add(df, CLASSIFICATION)


def features_staged(df: DataFrame) -> DataFrame:
    return _add(df, STAGED)


def features_legacy(df: DataFrame) -> DataFrame:
    return _add(df, LEGACY)

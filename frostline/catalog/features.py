"""The four feature sets."""

from frostline.catalog.sql import ACTUAL, AMBIENT, ID, SEAL, SET_POINT, WATTS, views
from frostline.fixtures import telemetry
from frostline.functions import features as f

_AMB, _SP, _ACT, _W, _SEAL = AMBIENT, SET_POINT, ACTUAL, WATTS, SEAL
_DEV = f"({_ACT} - {_SP})"
_LOAD = f"({_AMB} - {_SP})"
_LOSS = f"(1e0 - {_SEAL})"


def _pos(x):
    return f"CASE WHEN {x} < 0e0 THEN 0e0 ELSE {x} END"


_REGRESSION = f"""{_DEV} AS Temperature_Deviation_C, {_pos(_DEV)} AS Positive_Temperature_Deviation_C,
    {_LOAD} AS Cooling_Load_C, coalesce({_LOAD} / nullif({_W}, 0e0), 0e0) AS HVAC_Efficiency, {_LOSS} AS Seal_Loss_Score,
    {_W} * {_LOSS} AS HVAC_Stress_Index, ({_pos(_LOAD)}) * {_LOSS} AS Thermal_Leak_Load,
    {_W} / (abs({_LOAD}) + 1e0) AS HVAC_Load_Per_Degree"""
_CLASSIFICATION = f"""{_DEV} AS Temperature_Deviation, {_pos(_DEV)} AS Positive_Temperature_Deviation, {_LOAD} AS Ambient_Load,
    {_LOSS} AS Seal_Loss, ({_pos(_LOAD)}) * {_LOSS} AS Thermal_Leak_Load, {_W} / (abs({_LOAD}) + 1e0) AS HVAC_Load_Per_Degree,
    ({_AMB} - {_ACT}) / ({_W} + 1e0) AS Cooling_Efficiency, {_W} / (({_pos(_DEV)}) + 1e0) AS HVAC_Stress,
    {_AMB} * {_LOSS} AS Ambient_Stress, ({_AMB} - {_ACT}) * {_LOSS} AS Heat_Ingress"""
_STAGED = f"""{_DEV} AS Temperature_Deviation, {_LOAD} AS Ambient_Load, {_DEV} / ({_W} + 1e0) AS HVAC_Efficiency,
    {_LOAD} * {_W} AS Cooling_Stress, {_LOSS} AS Seal_Loss, {_DEV} * {_LOAD} AS Thermal_Stress_Index,
    {_W} / (abs({_LOAD}) + 1e0) AS HVAC_Load_Ratio, abs({_DEV}) * {_LOSS} AS Temperature_Risk_Index,
    {_W} / (abs({_DEV}) + 1e0) AS Cooling_Performance_Score, abs({_DEV}) * {_LOSS} + {_LOAD} * {_W} + {_LOSS} AS Overall_Risk_Score"""
_LEGACY = f"""{_DEV} AS Temperature_Deviation_C, {_LOAD} AS Cooling_Load_C, {_LOAD} / nullif({_W}, 0e0) AS HVAC_Efficiency,
    {_LOSS} AS Seal_Loss_Score, {_W} * {_LOSS} AS HVAC_Stress_Index"""

STAGED_SQL = f"SELECT *, {_STAGED} FROM telemetry"


def _query(build, names):
    return lambda spark, sf_dir: build(telemetry(spark, sf_dir)).select(ID, *names)


QUERIES = {
    "features_regression": _query(f.features_regression, f.REGRESSION),
    "features_classification": _query(f.features_classification, f.CLASSIFICATION),
    "features_staged": _query(f.features_staged, f.STAGED),
    "features_legacy": _query(f.features_legacy, f.LEGACY),
}

CHECKS = {
    "features_regression": views() + f" SELECT {ID}, {_REGRESSION} FROM telemetry",
    "features_classification": views() + f" SELECT {ID}, {_CLASSIFICATION} FROM telemetry",
    "features_staged": views() + f" SELECT {ID}, {_STAGED} FROM telemetry",
    "features_legacy": views() + f" SELECT {ID}, {_LEGACY} FROM telemetry",
}

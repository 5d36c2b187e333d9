"""Encoding and scaling."""

from pyspark.sql import functions as F

from frostline.catalog.sql import ACTION, CARGO, ID, RISK, columns, r6, views
from frostline.fixtures import telemetry
from frostline.functions.numeric import rounded
from frostline.operators import encoding as ops
from frostline.schema import CLASSES, NUMERIC, SENSORS

# Cargo names of the fixture tables.
CARGOS = ["Dairy", "Frozen Food", "Produce"]


def _decode(spark, sf_dir):
    coded = ops.label_encode(telemetry(spark, sf_dir), ACTION, CLASSES).select(ID, "code")
    return ops.label_decode(coded, "code", CLASSES)


def _one_hot(spark, sf_dir):
    hot = ops.one_hot(telemetry(spark, sf_dir), CARGO, CARGOS[:2])
    return hot.select(ID, *[F.col(f"{CARGO}_{c}").alias(f"is_{c.split()[0].lower()}") for c in CARGOS[:2]])


def _preprocess(spark, sf_dir):
    x, y_risk, y_action = ops.preprocess(telemetry(spark, sf_dir).drop("Event_Time"))
    return x.select(ID, *[rounded(c).alias(c) for c in [CARGO, *SENSORS]]).join(y_risk, ID).join(y_action, ID)


QUERIES = {
    "label_encode": lambda s, d: ops.label_encode(telemetry(s, d), CARGO).select(ID, CARGO, "code"),
    "label_encode_many": lambda s, d: ops.label_encode(telemetry(s, d), ID).select(ID, "code"),
    "label_decode": _decode,
    "one_hot": _one_hot,
    "standard_scale": lambda s, d: ops.standard_scale(telemetry(s, d), NUMERIC).select(
        ID, *[rounded(c).alias(c) for c in NUMERIC]),
    "preprocess": _preprocess,
}

_CODES = f"codes AS (SELECT {{c}} AS v, dense_rank() OVER (ORDER BY {{c}}) - 1 AS code FROM (SELECT DISTINCT {{c}} FROM telemetry))"
_SCALED = "(({c}) - avg({c}) OVER ()) / stddev_pop({c}) OVER ()"

CHECKS = {
    "label_encode_many": views() + f" SELECT {ID}, dense_rank() OVER (ORDER BY {ID}) - 1 AS code FROM telemetry",
    "label_encode": views() + f", {_CODES.format(c=CARGO)} SELECT {ID}, {CARGO}, code FROM telemetry JOIN codes ON {CARGO} = v",
    "label_decode": views() + f", {_CODES.format(c=ACTION)} SELECT {ID}, code, {ACTION} AS label FROM telemetry JOIN codes ON {ACTION} = v",
    "one_hot": views() + f""" SELECT {ID}, CASE WHEN {CARGO} = 'Dairy' THEN 1 ELSE 0 END AS is_dairy,
        CASE WHEN {CARGO} = 'Frozen Food' THEN 1 ELSE 0 END AS is_frozen FROM telemetry""",
    "standard_scale": views() + f" SELECT {ID}, " + columns(NUMERIC, r6(_SCALED) + " AS {c}") + " FROM telemetry",
    "preprocess": views() + f""", coded AS (SELECT * REPLACE (dense_rank() OVER (ORDER BY {CARGO}) - 1 AS {CARGO},
        CASE {ACTION} WHEN 'EMERGENCY' THEN 0 WHEN 'SAFE_Maintain_Course' THEN 1 ELSE 2 END AS {ACTION}) FROM telemetry)
        SELECT {ID}, """ + columns([CARGO, *SENSORS], r6(_SCALED) + " AS {c}") + f", {RISK}, {ACTION} FROM coded",
}

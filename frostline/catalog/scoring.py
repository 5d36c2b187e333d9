"""Scoring, in batch and on a stream."""

import os

from pyspark.sql import functions as F

from frostline.catalog.evaluation import THRESHOLD, action_sql
from frostline.catalog.sql import AMBIENT, CARGO, ID, SEAL, WATTS, number, r6, views
from frostline.catalog.training import risk_rows
from frostline.fixtures import FAULTY_SQL, SCORED_SQL, events_to_telemetry, scored, telemetry
from frostline.functions.decisions import RISK_LEVELS
from frostline.functions.numeric import rounded
from frostline.operators import scoring as ops
from frostline.operators.training import fit_regressor, legacy_regressors
from frostline.operators.trees import INPUTS as NODE_INPUTS, NODES, forest_from_table, forest_of, raw_scores
from frostline.schema import CLASSES, EMERGENCY, INPUTS, PREDICTED_RISK, PROBABILITIES, RISK, SAFE, WARNING
from frostline.sources.models import load_forest, save_forest
from frostline.streaming.scoring import score_stream, score_stream_or_quarantine
from frostline.workspace import fresh_path

_NAMES = {EMERGENCY: "p_emergency", SAFE: "p_safe", WARNING: "p_warning"}


def _flat(df):
    """Maps and lists as plain columns."""
    return df.select(
        ID, "predicted_action", rounded(PREDICTED_RISK).alias(PREDICTED_RISK), rounded("confidence").alias("confidence"),
        *[rounded(F.col("probabilities")[c]).alias(n) for c, n in _NAMES.items()],
        "risk_level", F.array_join("recommendations", " ").alias("advice"), "warning_threshold")


def _predict_risk(spark, sf_dir):
    rows = telemetry(spark, sf_dir)
    model = fit_regressor(rows, legacy_regressors()["linear"])
    predicted = ops.predict_risk(rows.select(ID, *INPUTS), model).join(rows.select(ID, RISK), ID)
    return risk_rows(predicted)


def _probabilities(spark, sf_dir):
    made = ops.class_probabilities(scored(spark, sf_dir))
    return made.select(ID, *[rounded(F.col("probabilities")[c]).alias(n) for c, n in _NAMES.items()])


def _acted(spark, sf_dir):
    return ops.emergency_override(ops.apply_warning_threshold(scored(spark, sf_dir), THRESHOLD))


def _recommendations(spark, sf_dir):
    return ops.recommendations(_acted(spark, sf_dir)).select(ID, F.array_join("recommendations", " ").alias("advice"))


def _score_with_models(spark, sf_dir):
    """Both models fitted on the table, then every row scored by them."""
    from frostline.operators.training import add_predicted_risk, baseline_classifiers, fit_classifier, prepare_labels
    rows = telemetry(spark, sf_dir).drop("Event_Time")
    risk = fit_regressor(rows, legacy_regressors()["linear"])
    labelled = prepare_labels(add_predicted_risk(rows, risk))
    action = fit_classifier(labelled, baseline_classifiers()["decision_tree"])
    models = risk, forest_of(spark, action)  # a pipeline and a table of nodes
    scored = _flat(ops.score_shipments(rows.drop(RISK), THRESHOLD, *models))
    shares = [F.col(n) for n in _NAMES.values()]
    emergency, warned = F.col("predicted_action") == EMERGENCY, F.col("predicted_action") == WARNING
    levels = F.create_map(*[F.lit(x) for pair in RISK_LEVELS.items() for x in pair])
    return scored.select(
        ID, emergency.alias("emergency"), F.col(PREDICTED_RISK).between(0, 100).alias("bounded"),
        (F.abs(shares[0] + shares[1] + shares[2] - 1.0) < 1e-5).alias("shares"),
        (F.col("confidence") == F.greatest(*shares)).alias("confident"),
        (emergency | (warned == (F.col(_NAMES[WARNING]) >= THRESHOLD))).alias("thresholded"),
        (F.col("risk_level") == levels[F.col("predicted_action")]).alias("levelled"))


def _events_stream(spark, sf_dir):
    """The events as a file stream."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    one_file = os.path.isfile(path)
    stream = reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir) if one_file else reader.parquet(path)
    return events_to_telemetry(spark, stream)


def _faulty_scored(spark, readings):
    """Readings with gaps and values out of range, with predictions as far as they can be made."""
    return spark.sql(SCORED_SQL, telemetry=spark.sql(FAULTY_SQL, telemetry=readings))


def _decided_or_held(scored_rows, held):
    """Every row once: its action, or what is wrong with it."""
    decided = scored_rows.select(ID, "predicted_action", F.lit("").alias("violations"))
    return decided.unionByName(held.select(ID, F.lit(None).cast("string").alias("predicted_action"), F.array_join("violations", ",").alias("violations")))


def _score_or_quarantine(spark, sf_dir):
    return _decided_or_held(*ops.score_or_quarantine(_faulty_scored(spark, telemetry(spark, sf_dir)), THRESHOLD))


def _stream_or_quarantine(spark, sf_dir):
    """The same from a stream read once into two sinks, read back."""
    sinks = fresh_path(spark, "faulty_scored"), fresh_path(spark, "faulty_held")
    stream = _faulty_scored(spark, _events_stream(spark, sf_dir))
    score_stream_or_quarantine(stream, THRESHOLD, *sinks, fresh_path(spark, "progress")).awaitTermination()
    return _decided_or_held(*[spark.read.parquet(sink) for sink in sinks])


def _score_stream(spark, sf_dir):
    """The events as a file stream, scored into a table that is read back."""
    readings = spark.sql(SCORED_SQL, telemetry=_events_stream(spark, sf_dir))
    sink = fresh_path(spark, "scored_stream")
    score_stream(readings, THRESHOLD, sink, fresh_path(spark, "scored_stream_progress")).awaitTermination()
    return _flat(spark.read.parquet(sink))


def entry(spark, sf_dir):
    """Which cargo needs which action now, and at what risk."""
    rows = ops.score_shipments(scored(spark, sf_dir), THRESHOLD)
    return rows.groupBy(CARGO, "predicted_action", "risk_level").agg(
        F.count("*").alias("shipments"), rounded(F.avg(PREDICTED_RISK), 4).alias("avg_risk"),
        rounded(F.avg(SEAL), 4).alias("avg_seal"))


# A small model whose nodes SQL can walk too: three trees over five inputs.
_NODE_INPUTS = [(0, "Temperature_Deviation_C", None, 0.0, 1.0), (1, SEAL, None, 0.0, 1.0), (2, AMBIENT, None, 32.0, 0.125),
                (3, CARGO, "Dairy", 0.0, 1.0), (4, WATTS, None, 0.0, 0.001)]
_NODE_ROWS = [  # tree, node, input, threshold, left, right, value, weight
    (0, 0, 0, 2.0, 1, 2, 0.0, 1.0), (0, 1, 1, 0.8, 3, 4, 0.0, 1.0), (0, 2, 1, 0.6, 5, 6, 0.0, 1.0), (0, 3, -1, 0.0, 3, 3, 21.5, 1.0),
    (0, 4, -1, 0.0, 4, 4, 14.25, 1.0), (0, 5, -1, 0.0, 5, 5, 64.0, 1.0), (0, 6, 0, 6.0, 7, 8, 0.0, 1.0), (0, 7, -1, 0.0, 7, 7, 33.0, 1.0),
    (0, 8, -1, 0.0, 8, 8, 48.5, 1.0),
    (1, 0, 2, 0.75, 1, 2, 0.0, 0.5), (1, 1, 4, 1.9, 3, 4, 0.0, 0.5), (1, 2, -1, 0.0, 2, 2, 3.5, 0.5), (1, 3, -1, 0.0, 3, 3, -2.0, 0.5),
    (1, 4, -1, 0.0, 4, 4, 1.25, 0.5),
    (2, 0, 3, 0.5, 1, 2, 0.0, 0.25), (2, 1, -1, 0.0, 1, 1, 1.0, 0.25), (2, 2, 1, 0.9, 3, 4, 0.0, 0.25), (2, 3, -1, 0.0, 3, 3, 2.0, 0.25),
    (2, 4, -1, 0.0, 4, 4, -1.0, 0.25)]


def _node_scores(spark, sf_dir):
    """A stored node table scored in both ways: as generated code and by arrays."""
    nodes = spark.createDataFrame([(*r[:6], [r[6]], r[7]) for r in _NODE_ROWS], NODES)
    path = fresh_path(spark, "nodes")
    save_forest(spark, path, forest_from_table(nodes, spark.createDataFrame(_NODE_INPUTS, NODE_INPUTS), (0.5,), "identity", "regression"))
    forest = load_forest(spark, path)
    rows = raw_scores(raw_scores(telemetry(spark, sf_dir), forest, "coded"), forest, "walked", 0)
    return rows.select(ID, *[rounded(F.get(c, F.lit(0))).alias(c) for c in ("coded", "walked")])


QUERIES = {
    "node_scores": _node_scores,
    "predict_risk": _predict_risk,
    "class_probabilities": _probabilities,
    "confidence": lambda s, d: ops.confidence(scored(s, d)).select(ID, rounded("confidence").alias("confidence")),
    "apply_warning_threshold": lambda s, d: ops.apply_warning_threshold(scored(s, d), THRESHOLD).select(ID, "action"),
    "emergency_override": lambda s, d: _acted(s, d).select(ID, "action"),
    "risk_level": lambda s, d: ops.risk_level(_acted(s, d)).select(ID, "risk_level"),
    "recommendations": _recommendations,
    "score_shipments": lambda s, d: _flat(ops.score_shipments(scored(s, d), THRESHOLD)),
    "score_shipments_with_models": _score_with_models,
    "score_stream": _score_stream,
    "score_or_quarantine": _score_or_quarantine,
    "stream_or_quarantine": _stream_or_quarantine,
    "cargo_actions": entry,
}

_ACTION = action_sql(number(THRESHOLD))
_P = {c: r6(f"round_even(Probability_{c}, 6)") for c in CLASSES}
_CONFIDENCE = r6(f"round_even(greatest({', '.join(PROBABILITIES)}), 6)")
_LEVEL = f"CASE a WHEN '{SAFE}' THEN 'LOW' WHEN '{WARNING}' THEN 'MEDIUM' WHEN '{EMERGENCY}' THEN 'HIGH' ELSE 'UNKNOWN' END"
_ADVICE = f"""CASE a WHEN '{SAFE}' THEN 'Continue shipment. Monitor temperature normally. No corrective action required.'
    WHEN '{WARNING}' THEN 'Request remote HVAC reset. Increase telemetry monitoring. Notify operations team.'
    ELSE 'Stop shipment immediately. Escalate to emergency response. Inspect refrigeration unit. Protect cargo from spoilage.' END"""
_VALID = """valid AS (SELECT * FROM scored WHERE Ambient_External_Temp_C BETWEEN -40 AND 70 AND Internal_Set_Point_C BETWEEN -40 AND 20
    AND Actual_Internal_Temp_C BETWEEN -40 AND 70 AND HVAC_Power_Consumption_Watts >= 0 AND Seal_Integrity_Index BETWEEN 0 AND 1)"""
_ACTED = f"acted AS (SELECT *, {_ACTION} AS a FROM scored)"
_SCORE = views("scored") + f""", {_VALID}, acted AS (SELECT *, {_ACTION} AS a FROM valid)
    SELECT {ID}, a AS predicted_action, {r6(PREDICTED_RISK)} AS {PREDICTED_RISK}, {_CONFIDENCE} AS confidence,
    {', '.join(f'{_P[c]} AS {n}' for c, n in _NAMES.items())}, {_LEVEL} AS risk_level, {_ADVICE} AS advice,
    {number(THRESHOLD)} AS warning_threshold FROM acted"""

def _broken(c, lo, hi):
    test = f"{c} IS NULL OR {c} < {lo}" + (f" OR {c} > {hi}" if hi else "")
    return f"CASE WHEN {test} THEN '{c}' END"


_HELD = views("faulty") + f""", marked AS ({SCORED_SQL.format(telemetry="faulty")}), named AS (SELECT *, concat_ws(',',
    {_broken('Ambient_External_Temp_C', '-40', '70')}, {_broken('Internal_Set_Point_C', '-40', '20')}, {_broken('Actual_Internal_Temp_C', '-40', '70')},
    {_broken('HVAC_Power_Consumption_Watts', '0', None)}, {_broken('Seal_Integrity_Index', '0', '1')}) AS violations FROM marked)
    SELECT {ID}, CASE WHEN violations = '' THEN {_ACTION} END AS predicted_action, violations FROM named"""

_NODE_WALK = views().replace("WITH", "WITH RECURSIVE", 1) + f""", numbers AS (SELECT {ID}, [Actual_Internal_Temp_C - Internal_Set_Point_C, {SEAL},
        ({AMBIENT} - 32e0) * 125e-3, CASE WHEN {CARGO} = 'Dairy' THEN 1e0 ELSE 0e0 END, {WATTS} * 1e-3] AS x FROM telemetry),
    nodes(tree, node, input, threshold, lower, upper, value, weight) AS (VALUES {", ".join(f"({', '.join(map(str, r))})" for r in _NODE_ROWS)}),
    walk AS (SELECT {ID}, x, tree, 0 AS node FROM numbers, (SELECT DISTINCT tree FROM nodes)
        UNION ALL SELECT {ID}, x, w.tree, CASE WHEN x[input + 1] <= CAST(threshold AS DOUBLE) THEN lower ELSE upper END
        FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node WHERE input >= 0),
    sums AS (SELECT {ID}, sum(CAST(value AS DOUBLE) * weight) + 5e-1 AS s FROM walk w JOIN nodes n ON w.tree = n.tree AND w.node = n.node
        WHERE input < 0 GROUP BY {ID})
    SELECT {ID}, {r6('s')} AS coded, {r6('s')} AS walked FROM sums"""

CHECKS = {
    "predict_risk": views() + f" SELECT {ID}, true AS bounded, true AS beats_mean FROM telemetry",
    "score_shipments_with_models": views() + f", {_VALID.replace('FROM scored', 'FROM telemetry')}" + f""" SELECT {ID},
        Actual_Internal_Temp_C - Internal_Set_Point_C >= 6 AND {SEAL} < 6e-1 AND {AMBIENT} >= 38 AS emergency, true AS bounded, true AS shares,
        true AS confident, true AS thresholded, true AS levelled FROM valid""",
    "node_scores": _NODE_WALK,
    "score_or_quarantine": _HELD,
    "stream_or_quarantine": _HELD,
    "class_probabilities": views("scored") + f" SELECT {ID}, {', '.join(f'{_P[c]} AS {n}' for c, n in _NAMES.items())} FROM scored",
    "confidence": views("scored") + f" SELECT {ID}, {_CONFIDENCE} AS confidence FROM scored",
    "apply_warning_threshold": views("scored") + f" SELECT {ID}, CASE WHEN {PROBABILITIES[2]} >= {number(THRESHOLD)} THEN '{WARNING}' ELSE '{SAFE}' END AS action FROM scored",
    "emergency_override": views("scored") + f", {_ACTED} SELECT {ID}, a AS action FROM acted",
    "risk_level": views("scored") + f", {_ACTED} SELECT {ID}, {_LEVEL} AS risk_level FROM acted",
    "recommendations": views("scored") + f", {_ACTED} SELECT {ID}, {_ADVICE} AS advice FROM acted",
    "score_shipments": _SCORE,
    "score_stream": _SCORE,
    "cargo_actions": views("scored") + f""", {_VALID}, acted AS (SELECT *, {_ACTION} AS a FROM valid)
        SELECT {CARGO}, a AS predicted_action, {_LEVEL} AS risk_level, count(*) AS shipments, round(avg({PREDICTED_RISK}), 4) + 0e0 AS avg_risk,
        round(avg({SEAL}), 4) + 0e0 AS avg_seal FROM acted GROUP BY 1, 2, 3""",
}

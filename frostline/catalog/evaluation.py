"""Metrics, calibration, reports and model tables."""

from pyspark.sql import functions as F

from frostline.catalog.sql import ACTION, AMBIENT, CARGO, EMERGENCY, ID, RISK, SAFE, WARNING, by_feature, number, r6, views
from frostline.fixtures import scored
from frostline.functions import decisions
from frostline.functions.numeric import rounded
from frostline.operators import evaluation as ops
from frostline.schema import CLASSES, PREDICTED_RISK, PROBABILITIES
from frostline.sources.tables import write_table
from frostline.workspace import fresh_path

THRESHOLD = 0.35
_BASELINE = {"Loose": 0.20, "Early": 0.30}
_TUNED = {"Middle": 0.35, "Late": 0.45}


def predicted(spark, sf_dir):
    return scored(spark, sf_dir).withColumn("Predicted_Class", decisions.action(THRESHOLD))


def _cells(spark, sf_dir):
    return ops.confusion_counts(predicted(spark, sf_dir))


def _round(df, columns, keep=()):
    return df.select(*keep, *[rounded(c).alias(c) for c in columns])


def _interval(spark, sf_dir):
    rows = scored(spark, sf_dir)
    made = ops.interval_report(rows, ops.interval_half_width(rows), key=[ID])
    return _round(made, [c for c in made.columns if c != ID], [ID])


def _runs(df, thresholds):
    """Weighted metrics of several surrogate models in many experiments."""
    models = F.array(*[F.struct(F.lit(m).alias("Model"), F.lit(t).alias("t")) for m, t in thresholds.items()])
    experiment = F.concat_ws("/", CARGO, F.floor(F.col(AMBIENT) / 5.0).cast("string")).alias("Experiment")
    rows = df.select("*", experiment, F.explode(models).alias("m")).withColumn("Model", F.col("m.Model"))
    label = F.when(decisions.is_emergency(), F.lit(EMERGENCY)) \
        .when(F.col(PROBABILITIES[2]) >= F.col("m.t"), F.lit(WARNING)).otherwise(F.lit(SAFE))
    by = ["Experiment", "Model"]
    cells = ops.confusion_counts(rows.withColumn("Predicted_Class", label), by=by)
    return _round(ops.weighted_metrics(cells, by), ["Accuracy", "Precision", "Recall", "F1_Score"], by)


def _board(spark, sf_dir):
    rows = scored(spark, sf_dir)
    return ops.model_leaderboard(_runs(rows, _BASELINE), _runs(rows, _TUNED), by="Experiment")


def _save_predictions(spark, sf_dir):
    path = fresh_path(spark, "predictions")
    write_table(predicted(spark, sf_dir), path)
    return spark.read.parquet(path).select(ID, ACTION, "Predicted_Class")


QUERIES = {
    "balanced_weights": lambda s, d: _round(ops.balanced_weights(scored(s, d)), ["weight"], [ID]),
    "interval_half_width": lambda s, d: _round(ops.interval_half_width(scored(s, d)), ["half_width"]),
    "threshold_sweep": lambda s, d: _round(ops.threshold_sweep(scored(s, d)), ["threshold", "recall", "precision", "score"]),
    "calibrate_threshold": lambda s, d: _round(ops.calibrate_threshold(scored(s, d)), ["threshold", "score"]),
    "regression_metrics": lambda s, d: _round(ops.regression_metrics(scored(s, d)), ["MAE", "MSE", "RMSE", "R2"]),
    "metrics_by_risk_band": lambda s, d: _round(ops.metrics_by_risk_band(scored(s, d)), ["MAE", "RMSE"], ["Risk_Band", "Samples"]),
    "interval_report": _interval,
    "confusion_matrix": lambda s, d: ops.confusion_matrix(_cells(s, d)),
    "classification_report": lambda s, d: _round(
        ops.classification_report(_cells(s, d)), ["precision", "recall", "f1"], ["class", "support"]),
    "weighted_metrics": lambda s, d: _round(ops.weighted_metrics(_cells(s, d)), ["Accuracy", "Precision", "Recall", "F1_Score"]),
    "holdout_metrics": lambda s, d: _round(
        ops.holdout_metrics(_cells(s, d), THRESHOLD), ["macro_f1_observed_classes", "warning_recall", "warning_threshold"],
        ["split", "samples", "real_emergency_samples"]),
    "prediction_report": lambda s, d: _round(
        ops.prediction_report(predicted(s, d), key=[ID]), [PREDICTED_RISK, "Confidence", *PROBABILITIES],
        [ID, "Actual_Class", "Predicted_Class"]),
    "model_leaderboard": _board,
    "best_model": lambda s, d: ops.best_model(_board(s, d)),
    "comparison_summary": lambda s, d: ops.comparison_summary(_board(s, d), by="Experiment"),
    "save_predictions": _save_predictions,
}

# ---------------------------------------------------------------- checks

_PW = PROBABILITIES[2]
_IS_EMERGENCY = "(Actual_Internal_Temp_C - Internal_Set_Point_C >= 6e0 AND Seal_Integrity_Index < 6e-1 AND Ambient_External_Temp_C >= 38e0)"


def action_sql(threshold: str) -> str:
    return f"CASE WHEN {_IS_EMERGENCY} THEN '{EMERGENCY}' WHEN {_PW} >= {threshold} THEN '{WARNING}' ELSE '{SAFE}' END"


_PREDICTED = f"pred AS (SELECT *, {action_sql(number(THRESHOLD))} AS Predicted_Class FROM scored)"
_ERR = f"({RISK} - {PREDICTED_RISK})"


def per_class(table: str, keys: str = "") -> str:
    """Precision, recall, f1, support and correct rows of each class, per key."""
    group = f"{keys}, " if keys else ""
    parts = by_feature(table, CLASSES, f"""SELECT {group}'{{c}}' AS class,
        count(*) FILTER (WHERE {ACTION} = '{{c}}') AS support, count(*) FILTER (WHERE Predicted_Class = '{{c}}') AS claimed,
        count(*) FILTER (WHERE {ACTION} = '{{c}}' AND Predicted_Class = '{{c}}') AS correct FROM {{t}}""" + (f" GROUP BY {keys}" if keys else ""))
    return f"""SELECT *, CASE WHEN precision + recall > 0 THEN 2e0 * precision * recall / (precision + recall) ELSE 0e0 END AS f1 FROM (
        SELECT *, CASE WHEN claimed > 0 THEN correct / CAST(claimed AS DOUBLE) ELSE 0e0 END AS precision,
        CASE WHEN support > 0 THEN correct / CAST(support AS DOUBLE) ELSE 0e0 END AS recall FROM ({parts}))"""


def _weighted(m):
    return f"sum({m} * support) / CAST(sum(support) AS DOUBLE)"


_WEIGHTED = f"""{r6('sum(correct) / CAST(sum(support) AS DOUBLE)')} AS Accuracy, {r6(_weighted('precision'))} AS Precision,
    {r6(_weighted('recall'))} AS Recall, {r6(_weighted('f1'))} AS F1_Score"""
_SCORES = ", ".join(f"('{m}', {number(t)}, '{k}')" for k, ms in (("Baseline", _BASELINE), ("Tuned", _TUNED)) for m, t in ms.items())
_BOARD = f"""runs AS (SELECT scored.*, {CARGO} || '/' || CAST(CAST(floor({AMBIENT} / 5e0) AS BIGINT) AS VARCHAR) AS Experiment, Model, Category,
      {action_sql('t')} AS Predicted_Class FROM scored, (VALUES {_SCORES}) AS v(Model, t, Category)),
    pc AS ({per_class('runs', 'Experiment, Model, Category')}),
    metrics AS (SELECT Experiment, Model, {_WEIGHTED}, Category FROM pc GROUP BY Experiment, Model, Category),
    board AS (SELECT *, row_number() OVER (PARTITION BY Experiment ORDER BY F1_Score DESC, Category, Model) AS Rank FROM metrics)"""
_GRID = ", ".join(f"({number(t)})" for t in ops.threshold_grid())
_SWEEP = f"""sweep AS (SELECT t AS threshold, count(*) FILTER (WHERE {_PW} >= t AND {ACTION} = '{WARNING}') AS tp,
      count(*) FILTER (WHERE {_PW} >= t) AS flagged, count(*) FILTER (WHERE {ACTION} = '{WARNING}') AS pos
      FROM scored, (VALUES {_GRID}) AS g(t) GROUP BY t),
    rates AS (SELECT threshold, CASE WHEN pos > 0 THEN tp / CAST(pos AS DOUBLE) ELSE 0e0 END AS recall,
      CASE WHEN flagged > 0 THEN tp / CAST(flagged AS DOUBLE) ELSE 0e0 END AS precision FROM sweep),
    objective AS (SELECT *, 7e-1 * recall + 3e-1 * precision AS score FROM rates)"""
_BAND = f"CASE WHEN {RISK} <= 10 THEN '(-inf, 10]' " + " ".join(
    f"WHEN {RISK} <= {e + 10} THEN '({e}, {e + 10}]'" for e in range(10, 90, 10)) + " ELSE '(90, inf]' END"


def _held(x):
    return f"CASE WHEN {x} < 0e0 THEN 0e0 WHEN {x} > 100e0 THEN 100e0 ELSE {x} END"


CHECKS = {
    "balanced_weights": views("scored") + f""", n AS (SELECT {ACTION} AS c, count(*) AS nc, sum(count(*)) OVER () AS n, count(*) OVER () AS k FROM scored GROUP BY 1)
        SELECT {ID}, {r6('n / CAST(k * nc AS DOUBLE)')} AS weight FROM scored JOIN n ON {ACTION} = c""",
    "interval_half_width": views("scored") + f" SELECT {r6(f'quantile_cont(abs({_ERR}), 0.9)')} AS half_width FROM scored",
    "threshold_sweep": views("scored") + f", {_SWEEP} SELECT {r6('threshold')} AS threshold, {r6('recall')} AS recall, {r6('precision')} AS precision, {r6('score')} AS score FROM objective",
    "calibrate_threshold": views("scored") + f", {_SWEEP} SELECT {r6('threshold')} AS threshold, {r6('score')} AS score FROM (SELECT * FROM objective ORDER BY score DESC, threshold LIMIT 1)",
    "regression_metrics": views("scored") + f""" SELECT {r6(f'avg(abs({_ERR}))')} AS MAE, {r6(f'avg({_ERR} * {_ERR})')} AS MSE, {r6(f'sqrt(avg({_ERR} * {_ERR}))')} AS RMSE,
        {r6(f'1e0 - avg({_ERR} * {_ERR}) / var_pop({RISK})')} AS R2 FROM scored""",
    "metrics_by_risk_band": views("scored") + f""" SELECT {_BAND} AS Risk_Band, count(*) AS Samples, {r6(f'avg(abs({_ERR}))')} AS MAE,
        {r6(f'sqrt(avg({_ERR} * {_ERR}))')} AS RMSE FROM scored GROUP BY 1""",
    "interval_report": views("scored") + f""", h AS (SELECT quantile_cont(abs({_ERR}), 0.9) AS h FROM scored) SELECT {ID}, {r6(RISK)} AS Actual_Risk_Pct,
        {r6(PREDICTED_RISK)} AS Predicted_Risk_Pct, {r6(f'abs({_ERR})')} AS Absolute_Error, {r6(_held(f'({PREDICTED_RISK} - h)'))} AS Lower_90pct_Interval,
        {r6(_held(f'({PREDICTED_RISK} + h)'))} AS Upper_90pct_Interval FROM scored, h""",
    "confusion_matrix": views("scored") + f", {_PREDICTED} " + by_feature("pred", CLASSES, "SELECT '{c}' AS actual, " + ", ".join(
        f"count(*) FILTER (WHERE {ACTION} = '{{c}}' AND Predicted_Class = '{p}') AS {p}" for p in CLASSES) + " FROM {t}"),
    "classification_report": views("scored") + f""", {_PREDICTED}, pc AS (SELECT * FROM ({per_class('pred')}) WHERE support > 0)
        SELECT class, support, {r6('precision')} AS precision, {r6('recall')} AS recall, {r6('f1')} AS f1 FROM pc
        UNION ALL SELECT 'accuracy', CAST(sum(support) AS BIGINT), {", ".join([r6('sum(correct) / CAST(sum(support) AS DOUBLE)')] * 3)} FROM pc
        UNION ALL SELECT 'macro avg', CAST(sum(support) AS BIGINT), {r6('avg(precision)')}, {r6('avg(recall)')}, {r6('avg(f1)')} FROM pc
        UNION ALL SELECT 'weighted avg', CAST(sum(support) AS BIGINT), {r6(_weighted('precision'))}, {r6(_weighted('recall'))}, {r6(_weighted('f1'))} FROM pc""",
    "weighted_metrics": views("scored") + f", {_PREDICTED}, pc AS ({per_class('pred')}) SELECT {_WEIGHTED} FROM pc",
    "holdout_metrics": views("scored") + f""", {_PREDICTED}, pc AS ({per_class('pred')})
        SELECT 'test' AS split, CAST(sum(support) AS BIGINT) AS samples, max(support) FILTER (WHERE class = '{EMERGENCY}') AS real_emergency_samples,
        {r6('avg(f1) FILTER (WHERE support > 0)')} AS macro_f1_observed_classes, {r6(f"max(recall) FILTER (WHERE class = '{WARNING}')")} AS warning_recall,
        {r6(number(THRESHOLD))} AS warning_threshold FROM pc""",
    "prediction_report": views("scored") + f""", {_PREDICTED} SELECT {ID}, {ACTION} AS Actual_Class, Predicted_Class, {r6(f'round_even({PREDICTED_RISK}, 3)')} AS {PREDICTED_RISK},
        {r6('CASE ' + ' '.join(f"WHEN Predicted_Class = '{c}' THEN Probability_{c}" for c in CLASSES) + ' END')} AS Confidence,
        {', '.join(f'{r6(p)} AS {p}' for p in PROBABILITIES)} FROM pred""",
    "model_leaderboard": views("scored") + f", {_BOARD} SELECT * FROM board",
    "best_model": views("scored") + f", {_BOARD} SELECT *, 'Ranked first by weighted F1.' AS reason FROM board WHERE Rank = 1",
    "comparison_summary": views("scored") + f""", {_BOARD} SELECT Experiment, count(*) AS total_models, count(*) FILTER (WHERE Category = 'Baseline') AS baseline_models,
        count(*) FILTER (WHERE Category = 'Tuned') AS tuned_models, min_by(Model, Rank) AS best_model, min_by(F1_Score, Rank) AS best_f1_score FROM board GROUP BY 1""",
    "save_predictions": views("scored") + f", {_PREDICTED} SELECT {ID}, {ACTION}, Predicted_Class FROM pred",
}

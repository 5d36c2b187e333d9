"""Sources, sinks, contracts and filters."""

from pyspark.sql import functions as F

from frostline.catalog.sql import views
from frostline.fixtures import faulty, scored, telemetry
from frostline.functions.decisions import is_emergency
from frostline.functions.features import STAGED, features_staged
from frostline.functions.numeric import clip, rounded
from frostline.operators import contracts as ops
from frostline.operators.evaluation import regression_metrics, upsert_leaderboard
from frostline.operators.sampling import split_report, stratified_split
from frostline.operators.scoring import predict_risk
from frostline.operators.selection import correlation_filter, selection_report
from frostline.operators.training import fit_regressor, legacy_regressors
from frostline.plans.classification import SHARES
from frostline.schema import (
    ACTION, ACTUAL, AMBIENT, CARGO, ID, INPUTS, NUMERIC, PREDICTED_RISK, REQUIRED, RISK, SEAL, SENSORS, SET_POINT, WARNING, WATTS,
)
from frostline.sources.models import load_model, save_model
from frostline.sources.tables import load_feature_list, read_telemetry, write_report, write_table
from frostline.sources.versions import read_version, upsert_version, versions
from frostline.workspace import fresh_path
from frostline.catalog.features import STAGED_SQL
from frostline.catalog import sql

_COLUMNS = ", ".join(REQUIRED)


def _read_telemetry(spark, sf_dir):
    path = fresh_path(spark, "telemetry_csv")
    write_table(telemetry(spark, sf_dir).select(REQUIRED), path, fmt="csv")
    return read_telemetry(spark, path, "csv")


def _require_columns(spark, sf_dir):
    return ops.require_columns(telemetry(spark, sf_dir), REQUIRED).groupBy(CARGO).agg(F.count("*").alias("readings"))


def _require_not_null(spark, sf_dir):
    return ops.null_counts(faulty(spark, sf_dir), NUMERIC)


def _write_table(spark, sf_dir):
    path = fresh_path(spark, "split_table")
    write_table(stratified_split(telemetry(spark, sf_dir).select(REQUIRED), ACTION, SHARES), path, ["split"])
    return spark.read.parquet(path)


def _write_report(spark, sf_dir):
    path = fresh_path(spark, "split_report")
    report = split_report(stratified_split(telemetry(spark, sf_dir), ACTION, SHARES))
    nested = report.groupBy("split").agg(
        F.max("total").alias("rows"),
        F.sort_array(F.collect_list(F.struct("class", "count", "percentage"))).alias("distribution"))
    write_report(nested, path)
    schema = "split string, rows bigint, distribution array<struct<class: string, count: bigint, percentage: double>>"
    return spark.read.schema(schema).json(path).select("split", "rows", F.inline("distribution"))


_OFFSETS = {"Surrogate": 0.0, "Shifted": 1.5, "Damped": -2.5}


def _regression_runs(df, models, part):
    """Metrics of shifted surrogate models on one half of the cargo types."""
    shifts = F.array(*[F.struct(F.lit(m).alias("Model"), F.lit(_OFFSETS[m]).alias("shift")) for m in models])
    rows = df.where(part).select(RISK, PREDICTED_RISK, F.explode(shifts).alias("m"))
    rows = rows.select("m.Model", RISK, (F.col(PREDICTED_RISK) + F.col("m.shift")).alias(PREDICTED_RISK))
    return regression_metrics(rows, by=["Model"]).select("Model", *[rounded(c).alias(c) for c in ("MAE", "MSE", "RMSE", "R2")])


def _boards(spark, sf_dir):
    df = scored(spark, sf_dir)
    return (_regression_runs(df, ["Surrogate", "Shifted"], F.col(CARGO) == "Frozen Food"),
            _regression_runs(df, ["Shifted", "Damped"], F.col(CARGO) != "Frozen Food"))


def _upsert_leaderboard(spark, sf_dir):
    return upsert_leaderboard(*_boards(spark, sf_dir))


def _runs_sql(models, part):
    values = ", ".join(f"('{m}', {sql.number(_OFFSETS[m])})" for m in models)
    error = f"({RISK} - ({PREDICTED_RISK} + shift))"
    return f"""SELECT Model, {sql.r6(f'avg(abs({error}))')} AS MAE, {sql.r6(f'avg({error} * {error})')} AS MSE,
        {sql.r6(f'sqrt(avg({error} * {error}))')} AS RMSE, {sql.r6(f'1e0 - avg({error} * {error}) / var_pop({RISK})')} AS R2
        FROM scored, (VALUES {values}) AS v(Model, shift) WHERE {part} GROUP BY Model"""


def _save_load_model(spark, sf_dir):
    path = fresh_path(spark, "model")
    rows = telemetry(spark, sf_dir)
    model = fit_regressor(rows, legacy_regressors()["linear"])
    save_model(spark, path, {"model": "linear", "inputs": INPUTS}, risk=model)
    models, metadata = load_model(spark, path)
    again = predict_risk(rows.select(metadata["inputs"] + [ID]), models["risk"]).withColumnRenamed(PREDICTED_RISK, "_again")
    both = again.join(predict_risk(rows, model).select(ID, PREDICTED_RISK), ID)
    return both.select(ID, F.col("_again").eqNullSafe(F.col(PREDICTED_RISK)).alias("same"), F.lit(metadata["model"]).alias("model"))


def _leaderboard_versions(spark, sf_dir):
    """The leaderboard upserted onto itself, twice; a write without its commit in between stays unseen."""
    path = fresh_path(spark, "versions")
    old, new = _boards(spark, sf_dir)
    upsert_version(old, path)
    new.write.parquet(f"{path}/data/broken")
    return read_version(spark, path, upsert_version(new, path)).withColumn("version", F.lit(len(versions(spark, path))))


_CANDIDATES = [*NUMERIC[:-1], *STAGED]


def _load_feature_list(spark, sf_dir):
    path = fresh_path(spark, "features")
    rows = features_staged(telemetry(spark, sf_dir))
    names = spark.createDataFrame([(c,) for c in _CANDIDATES], "feature string")
    kept = names.join(correlation_filter(rows, _CANDIDATES), "feature", "left_anti")
    write_report(selection_report(kept), path)
    return load_feature_list(spark, path)


def dropped_sql(table: str, names: list[str], threshold: float = 0.90) -> str:
    """Names dropped by the correlation filter."""
    pairs = [(a, b) for j, b in enumerate(names) for a in names[:j]]
    wide = ", ".join(f"abs(corr({a}, {b})) > {sql.number(threshold)} AS p{i}" for i, (a, b) in enumerate(pairs))
    tests = " UNION ALL ".join(f"SELECT '{b}' AS feature, p{i} AS hit FROM wide" for i, (_, b) in enumerate(pairs))
    return f"WITH wide AS (SELECT {wide} FROM {table}) SELECT DISTINCT feature FROM ({tests}) WHERE hit"


def _split_features_targets(spark, sf_dir):
    x, y_risk, y_action = ops.split_features_targets(telemetry(spark, sf_dir).select(REQUIRED))
    return x.join(y_risk, ID).join(y_action, ID)


def _validate_ranges(spark, sf_dir):
    return ops.validate_ranges(faulty(spark, sf_dir)).select(ID, F.array_join("violations", ",").alias("violations"))


QUERIES = {
    "read_telemetry": _read_telemetry,
    "require_columns": _require_columns,
    "missing_columns": lambda s, d: ops.column_report(faulty(s, d).drop(SEAL), [*REQUIRED, "Door_Open"]),
    "require_not_null": _require_not_null,
    "write_table": _write_table,
    "write_report": _write_report,
    "upsert_leaderboard": _upsert_leaderboard,
    "leaderboard_versions": _leaderboard_versions,
    "save_load_model": _save_load_model,
    "load_feature_list": _load_feature_list,
    "drop_identifier": lambda s, d: ops.drop_identifier(telemetry(s, d).select(REQUIRED)),
    "split_features_targets": _split_features_targets,
    "validate_ranges": _validate_ranges,
    "is_emergency": lambda s, d: telemetry(s, d).select(ID, is_emergency().alias("emergency")),
    "filter_class": lambda s, d: ops.filter_class(telemetry(s, d).select(REQUIRED), WARNING),
    "check_finite": lambda s, d: ops.check_finite(faulty(s, d), NUMERIC),
    "clip": lambda s, d: telemetry(s, d).select(ID, clip(F.col(RISK) * 3.0 - 40.0, 0, 100).alias("clipped")),
    "apply_feature_selection": lambda s, d: ops.apply_feature_selection(telemetry(s, d), [ID, *SENSORS]),
    "head_tail": lambda s, d: ops.head_tail(telemetry(s, d).select(REQUIRED)),
}

_COUNT_NULLS = sql.by_feature("faulty", NUMERIC, "SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {t}")
_SPLIT = sql.split_of("telemetry", "parts", ACTION, SHARES)
_EMERGENCY = f"({ACTUAL} - {SET_POINT} >= 6e0 AND {SEAL} < 6e-1 AND {AMBIENT} >= 38e0)"


_UPSERTED = views("scored") + f""", new AS ({_runs_sql(["Shifted", "Damped"], f"{CARGO} <> 'Frozen Food'")}),
    old AS ({_runs_sql(["Surrogate", "Shifted"], f"{CARGO} = 'Frozen Food'")}) """


def _bad(c, lo, hi):
    test = f"{c} IS NULL OR {c} < {lo}" + (f" OR {c} > {hi}" if hi else "")
    return f"CASE WHEN {test} THEN '{c}' END"


CHECKS = {
    "save_load_model": sql.views() + f" SELECT {ID}, true AS same, 'linear' AS model FROM telemetry",
    "read_telemetry": views() + f" SELECT {_COLUMNS} FROM telemetry",
    "require_columns": views() + f" SELECT {CARGO}, count(*) AS readings FROM telemetry GROUP BY {CARGO}",
    "missing_columns": views("faulty") + " " + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c not in (SEAL, 'Door_Open')} AS present, "
        f"{'count(' + c + ')' if c not in (SEAL, 'Door_Open') else 'CAST(0 * count(*) AS BIGINT)'} AS filled FROM faulty" for c in [*REQUIRED, "Door_Open"]),
    "require_not_null": views("faulty") + " " + _COUNT_NULLS,
    "write_table": views() + f", {_SPLIT} SELECT {_COLUMNS}, split FROM parts",
    "write_report": views() + f""", {_SPLIT},
        n AS (SELECT split, {ACTION} AS class, count(*) AS count FROM parts GROUP BY ALL
              UNION ALL SELECT 'original', {ACTION}, count(*) FROM parts GROUP BY ALL)
        SELECT split, CAST(sum(count) OVER (PARTITION BY split) AS BIGINT) AS rows, class, count,
               round_even(count / CAST(sum(count) OVER (PARTITION BY split) AS DOUBLE) * 100e0, 2) AS percentage FROM n""",
    "upsert_leaderboard": _UPSERTED + "SELECT * FROM old WHERE Model NOT IN (SELECT Model FROM new) UNION ALL SELECT * FROM new",
    "leaderboard_versions": _UPSERTED + """SELECT *, 2 AS version FROM old WHERE Model NOT IN (SELECT Model FROM new)
        UNION ALL SELECT *, 2 FROM new""",
    "load_feature_list": views() + f""", staged AS ({STAGED_SQL}), dropped AS ({dropped_sql('staged', _CANDIDATES)})
        SELECT feature FROM (VALUES {", ".join(f"('{c}')" for c in _CANDIDATES)}) AS v(feature)
        WHERE feature NOT IN (SELECT feature FROM dropped)""",
    "drop_identifier": views() + f" SELECT {', '.join(REQUIRED[1:])} FROM telemetry",
    "split_features_targets": views() + f" SELECT {_COLUMNS} FROM telemetry",
    "validate_ranges": views("faulty") + f""" SELECT {ID}, concat_ws(',', {_bad(AMBIENT, '-40', '70')}, {_bad(SET_POINT, '-40', '20')},
        {_bad(ACTUAL, '-40', '70')}, {_bad(WATTS, '0', None)}, {_bad(SEAL, '0', '1')}) AS violations FROM faulty""",
    "is_emergency": views() + f" SELECT {ID}, {_EMERGENCY} AS emergency FROM telemetry",
    "filter_class": views() + f" SELECT {_COLUMNS} FROM telemetry WHERE {ACTION} = '{WARNING}'",
    "check_finite": views("faulty") + " " + sql.by_feature("faulty", NUMERIC, """SELECT '{c}' AS feature,
        count(*) FILTER (WHERE {c} IS NULL OR isnan({c})) AS missing, count(*) FILTER (WHERE isinf({c})) AS infinite FROM {t}"""),
    "clip": views() + f" SELECT {ID}, {sql.bound(f'({RISK} * 3e0 - 40e0)', '0e0', '100e0')} AS clipped FROM telemetry",
    "apply_feature_selection": views() + f" SELECT {ID}, {', '.join(SENSORS)}, {ACTION} FROM telemetry",
    "head_tail": views() + f""" SELECT * FROM (SELECT {_COLUMNS}, 'first' AS position FROM telemetry ORDER BY {ID} LIMIT 5)
        UNION ALL SELECT * FROM (SELECT {_COLUMNS}, 'last' AS position FROM telemetry ORDER BY {ID} DESC LIMIT 5)""",
}

"""From readings to a versioned risk regressor."""

from pyspark.sql import DataFrame, functions as F

from frostline.operators.contracts import filter_class, require_columns, require_not_null
from frostline.operators.evaluation import interval_report, metrics_by_risk_band, regression_metrics
from frostline.operators.sampling import regression_split, sample_with_replacement
from frostline.operators.scoring import predict_risk
from frostline.operators.synthesis import scenario_bands
from frostline.operators.training import fit_regressor, half_width_of, refit_production, regressors, select_best_regressor
from frostline.schema import ACTION, ID, INPUTS, RISK, WARNING
from frostline.sources.models import save_model
from frostline.sources.tables import write_report, write_table


def augment_training_rows(train: DataFrame, warning: int = 5000, emergency: int = 5000, seed: int = 42) -> DataFrame:
    """Training rows plus banded warning rows up to a target and banded emergency rows."""
    seeds = filter_class(train, WARNING)
    real = seeds.count()
    if real == 0:
        raise ValueError("There is no WARNING row to draw synthetic rows from.")
    made = train
    for kind, n in (("warning", max(0, warning - real)), ("emergency", emergency)):
        if n:
            drawn = sample_with_replacement(seeds, n, seed, stream=f"pick_{kind}")
            drawn = drawn.withColumn(ID, F.format_string(f"SYN_{kind.upper()}_%06d", "draw_id"))
            made = made.unionByName(scenario_bands(drawn, kind, seed=seed).select(train.columns))
    return made


def run_regression(df: DataFrame, out: str, seed: int = 42, augment: bool = False, share: float = 1.0,
                   warning: int = 5000, emergency: int = 5000) -> DataFrame:
    """Split, fit the candidates, choose, refit, test and store; returns the model table with its test row.

    The split is written once and read back, so fits neither repeat it nor depend on cached blocks.
    """
    spark = df.sparkSession
    require_not_null(require_columns(df, [ID, *INPUTS, RISK]), RISK)
    write_table(regression_split(df.select(ID, *INPUTS, RISK, ACTION), RISK, seed=seed), f"{out}/split", ["split"])
    stored = spark.read.parquet(f"{out}/split")
    train, validation, test = (stored.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test"))
    if augment:
        train = augment_training_rows(train, warning, emergency, seed)
    train, validation = train.persist(), validation.persist()
    try:
        candidates = regressors(seed, share)
        fitted = {name: fit_regressor(train, estimator) for name, estimator in candidates.items()}
        best, board = select_best_regressor(fitted, validation)
        half_width = half_width_of(fitted[best], validation)
        model = refit_production(candidates[best], train, validation)
    finally:
        train.unpersist()
        validation.unpersist()
    predicted = predict_risk(test, model)
    width = spark.range(1).select(F.lit(half_width).alias("half_width"))
    write_table(interval_report(predicted, width, key=[ID]), f"{out}/test_predictions")
    write_report(metrics_by_risk_band(predicted), f"{out}/test_metrics_by_risk_band")
    final = regression_metrics(predicted).first().asDict()
    save_model(spark, f"{out}/model", {"model": best, "half_width": half_width, "test_metrics": final,
                                       "augmented": augment, "validation": board}, risk=model)
    rows = [("validation", r["Model"], r["MAE"], r["RMSE"], r["R2"], r["Model"] == best, half_width) for r in board]
    rows.append(("test", best, final["MAE"], final["RMSE"], final["R2"], True, half_width))
    report = spark.createDataFrame(
        rows, "split string, Model string, MAE double, RMSE double, R2 double, chosen boolean, half_width double")
    write_report(report, f"{out}/metrics")
    return report


"""Metrics and reports of scored tables."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from frostline.functions.numeric import clip, edges_below, half_even
from frostline.operators.quantiles import quantiles
from frostline.operators.small import with_totals
from frostline.schema import ACTION, CLASSES, EMERGENCY, PREDICTED_RISK, RISK, WARNING, probability

# Upper edges of the risk bands and the calibration objective.
RISK_EDGES = [10, 20, 30, 40, 50, 60, 70, 80, 90]
RECALL_WEIGHT, PRECISION_WEIGHT = 0.70, 0.30
THRESHOLD_START, THRESHOLD_STEP, THRESHOLD_COUNT = 0.05, 0.01, 56


def threshold_grid() -> list[float]:
    """The 56 thresholds 0.05, 0.06, ... 0.60, with the step as the difference of the first two."""
    step = (THRESHOLD_START + THRESHOLD_STEP) - THRESHOLD_START
    return [THRESHOLD_START + i * step for i in range(THRESHOLD_COUNT)]


def _quotient(numerator: Column, denominator: Column) -> Column:
    """0 when the denominator is 0."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


# ---------------------------------------------------------------- class balance

def class_weight_row(df: DataFrame, classes: list[str], column: str = ACTION) -> DataFrame:
    """Balanced weight n / (k * n_class) of each listed class that occurs, one row."""
    counts = df.agg(*[F.count_if(F.col(column) == c).alias(c) for c in classes])
    present = sum((F.when(F.col(c) > 0, 1).otherwise(0) for c in classes), F.lit(0))
    total = sum((F.col(c) for c in classes), F.lit(0))
    return counts.select(*[F.try_divide(total.cast("double"), present * F.col(c)).alias(c) for c in classes])


def balanced_weights(df: DataFrame, column: str = ACTION, classes: list[str] = CLASSES, output: str = "weight") -> DataFrame:
    """Add the balanced class weight to every row, without a shuffle."""
    weights = class_weight_row(df, classes, column).select(*[F.col(c).alias(f"_w|{c}") for c in classes])
    value = F
    for c in classes:
        value = value.when(F.col(column) == c, F.col(f"`_w|{c}`"))
    return with_totals(df, weights).withColumn(output, value).drop(*weights.columns)


# ---------------------------------------------------------------- regression

def regression_metrics(df: DataFrame, actual: str = RISK, predicted: str = PREDICTED_RISK,
                       by: list[str] | None = None) -> DataFrame:
    """MAE, MSE, RMSE and R2 in one aggregate."""
    error = F.col(actual) - F.col(predicted)
    grouped = df.groupBy(*by) if by else df.groupBy()
    sums = grouped.agg(
        F.avg(F.abs(error)).alias("MAE"), F.avg(error * error).alias("MSE"), F.var_pop(actual).alias("_spread"))
    return sums.select(
        *(by or []), "MAE", "MSE", F.sqrt("MSE").alias("RMSE"),
        (F.lit(1.0) - F.try_divide(F.col("MSE"), F.col("_spread"))).alias("R2"))


def risk_band(value: Column) -> Column:
    """Right-closed band, open at both ends."""
    edges = RISK_EDGES
    band = F.when(value <= F.lit(float(edges[0])), F.lit(f"(-inf, {edges[0]}]"))
    for lo, hi in zip(edges, edges[1:]):
        band = band.when(value <= F.lit(float(hi)), F.lit(f"({lo}, {hi}]"))
    return band.when(value > F.lit(float(edges[-1])), F.lit(f"({edges[-1]}, inf]"))


def metrics_by_risk_band(df: DataFrame, actual: str = RISK, predicted: str = PREDICTED_RISK) -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return (
        df.groupBy(risk_band(F.col(actual)).alias("Risk_Band"))
        .agg(F.count("*").alias("Samples"), F.avg(F.abs(error)).alias("MAE"), F.sqrt(F.avg(error * error)).alias("RMSE"))
    )


def interval_half_width(df: DataFrame, actual: str = RISK, predicted: str = PREDICTED_RISK, q: float = 0.90) -> DataFrame:
    """Quantile of the absolute error, one row."""
    errors = df.select(F.abs(F.col(actual) - F.col(predicted)).alias("error"))
    return quantiles(errors, ["error"], [q]).select(F.col("q0").alias("half_width"))


def interval_report(df: DataFrame, half_width: DataFrame, actual: str = RISK, predicted: str = PREDICTED_RISK,
                    key: list[str] | None = None) -> DataFrame:
    """Actual, predicted, absolute error and the bounds of the prediction interval."""
    rows = with_totals(df.select(*(key or []), actual, predicted), half_width)
    return rows.select(
        *(key or []),
        F.col(actual).alias("Actual_Risk_Pct"), F.col(predicted).alias("Predicted_Risk_Pct"),
        F.abs(F.col(actual) - F.col(predicted)).alias("Absolute_Error"),
        clip(F.col(predicted) - F.col("half_width"), 0, 100).alias("Lower_90pct_Interval"),
        clip(F.col(predicted) + F.col("half_width"), 0, 100).alias("Upper_90pct_Interval"))


# ---------------------------------------------------------------- calibration

def threshold_sweep(df: DataFrame, label: str = ACTION, score: str = probability(WARNING), positive: str = WARNING,
                    grid: list[float] | None = None, recall_weight: float = RECALL_WEIGHT,
                    precision_weight: float = PRECISION_WEIGHT) -> DataFrame:
    """Recall, precision and objective at every threshold, from one histogram of the score.

    A score is put in the bucket "number of thresholds not above it", compared with the very
    threshold literals, so edges fall as in a direct pass. The window runs over 57 rows.
    """
    grid = grid or threshold_grid()
    spark = df.sparkSession
    passed = edges_below(F.col(score), grid, inclusive=True)
    counted = df.groupBy(passed.alias("bucket")).agg(
        F.count_if(F.col(label) == positive).alias("hits"), F.count("*").alias("rows"))
    steps = spark.createDataFrame([(0, None), *((i + 1, t) for i, t in enumerate(grid))], "bucket int, threshold double")
    filled = steps.join(counted, "bucket", "left").na.fill(0, ["hits", "rows"])
    above = Window.orderBy("bucket").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    swept = filled.withColumns({
        "true_positive": F.sum("hits").over(above), "flagged": F.sum("rows").over(above),
        "positives": F.sum("hits").over(everything)}).where(F.col("bucket") > 0)
    scored = swept.withColumns({
        "recall": _quotient(F.col("true_positive"), F.col("positives")),
        "precision": _quotient(F.col("true_positive"), F.col("flagged"))})
    return scored.select(
        "threshold", "recall", "precision",
        (F.lit(recall_weight) * F.col("recall") + F.lit(precision_weight) * F.col("precision")).alias("score"))


def calibrate_threshold(df: DataFrame, **options) -> DataFrame:
    """The first threshold with the best objective, one row."""
    return threshold_sweep(df, **options).orderBy(F.desc("score"), "threshold").limit(1)


# ---------------------------------------------------------------- classification

def confusion_counts(df: DataFrame, actual: str = ACTION, predicted: str = "Predicted_Class",
                     classes: list[str] = CLASSES, by: list[str] | None = None) -> DataFrame:
    """Rows per (actual, predicted) over all known classes, zeros kept; k * k cells per group."""
    cells = [(a, p) for a in classes for p in classes]
    grouped = df.groupBy(*by) if by else df.groupBy()
    wide = grouped.agg(*[
        F.count_if((F.col(actual) == a) & (F.col(predicted) == p)).alias(f"{i}|n") for i, (a, p) in enumerate(cells)])
    entries = F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(f"`{i}|n`").alias("n"))
        for i, (a, p) in enumerate(cells)])
    return wide.select(*(by or []), F.inline(entries))


def confusion_matrix(cells: DataFrame, classes: list[str] = CLASSES) -> DataFrame:
    """One row per actual class, one column per predicted class."""
    return cells.groupBy("actual").pivot("predicted", classes).agg(F.sum("n"))


def _per_class(cells: DataFrame, by: list[str]) -> DataFrame:
    """Precision, recall, f1, support and predicted rows of each class."""
    both = cells.select(*by, F.col("n"), (F.col("actual") == F.col("predicted")).alias("hit"),
                        F.explode(F.array(F.struct(F.col("actual").alias("class"), F.lit(True).alias("is_actual")),
                                          F.struct(F.col("predicted").alias("class"), F.lit(False).alias("is_actual")))).alias("side"))
    sums = both.groupBy(*by, F.col("side.class").alias("class")).agg(
        F.sum(F.when(F.col("side.is_actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("side.is_actual"), F.col("n")).otherwise(0)).alias("claimed"),
        F.sum(F.when(F.col("side.is_actual") & F.col("hit"), F.col("n")).otherwise(0)).alias("correct"))
    scored = sums.withColumns({
        "precision": _quotient(F.col("correct"), F.col("claimed")), "recall": _quotient(F.col("correct"), F.col("support"))})
    return scored.withColumn(
        "f1", _quotient(F.lit(2.0) * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def weighted_metrics(cells: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1."""
    by = by or []
    total = F.sum("support")

    def weighted(name: str) -> Column:
        return _quotient(F.sum(F.col(name) * F.col("support")), total)

    scored = _per_class(cells, by)
    grouped = scored.groupBy(*by) if by else scored.groupBy()
    return grouped.agg(
        _quotient(F.sum("correct"), total).alias("Accuracy"), weighted("precision").alias("Precision"),
        weighted("recall").alias("Recall"), weighted("f1").alias("F1_Score"))


def classification_report(cells: DataFrame, observed_only: bool = True) -> DataFrame:
    """Precision, recall, f1 and support per class, accuracy, macro and weighted averages."""
    scored = _per_class(cells, [])
    if observed_only:
        scored = scored.where(F.col("support") > 0)
    rows = scored.select("class", "precision", "recall", "f1", "support")
    total = F.sum("support")
    macro = scored.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), total.alias("support"))
    weighted = scored.agg(*[
        _quotient(F.sum(F.col(m) * F.col("support")), total).alias(m) for m in ("precision", "recall", "f1")], total.alias("support"))
    accuracy = cells.agg(
        _quotient(F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)), F.sum("n")).alias("precision"),
        F.sum("n").alias("support"))
    accuracy = accuracy.select("precision", F.col("precision").alias("recall"), F.col("precision").alias("f1"), "support")
    parts = [("accuracy", accuracy), ("macro avg", macro), ("weighted avg", weighted)]
    for name, part in parts:
        rows = rows.unionByName(part.withColumn("class", F.lit(name)))
    return rows


def holdout_metrics(cells: DataFrame, threshold: float, positive: str = WARNING, split: str = "test") -> DataFrame:
    """Macro F1 over the classes that occur in the truth, recall of one class, and row counts."""
    scored = _per_class(cells, [])
    return scored.agg(
        F.avg(F.when(F.col("support") > 0, F.col("f1"))).alias("macro_f1_observed_classes"),
        F.max(F.when(F.col("class") == positive, F.col("recall"))).alias("warning_recall"),
        F.sum("support").alias("samples"),
        F.max(F.when(F.col("class") == EMERGENCY, F.col("support"))).alias("real_emergency_samples"),
    ).select(F.lit(split).alias("split"), "macro_f1_observed_classes", "warning_recall", "samples",
             F.lit(float(threshold)).alias("warning_threshold"), "real_emergency_samples")


def prediction_report(df: DataFrame, classes: list[str] = CLASSES, key: list[str] | None = None,
                      predicted: str = "Predicted_Class") -> DataFrame:
    """Actual and predicted class, risk, probability of the predicted class, and all probabilities."""
    own = F
    for c in classes:
        own = own.when(F.col(predicted) == c, F.col(probability(c)))
    return df.select(
        *(key or []), F.col(ACTION).alias("Actual_Class"), F.col(predicted).alias("Predicted_Class"),
        half_even(F.col(PREDICTED_RISK), 3).alias(PREDICTED_RISK), own.alias("Confidence"),
        *[probability(c) for c in classes])


# ---------------------------------------------------------------- model tables

def upsert_leaderboard(old: DataFrame, new: DataFrame, key: str = "Model", order: str = "R2") -> DataFrame:
    """Replace the rows of the models in `new`, best first."""
    kept = old.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new).orderBy(F.desc(order), key)


def model_leaderboard(baseline: DataFrame, tuned: DataFrame, by: str | None = None, score: str = "F1_Score") -> DataFrame:
    """Baseline and tuned runs ranked by score (per experiment); baseline first and name order on ties."""
    runs = (
        baseline.withColumn("Category", F.lit("Baseline"))
        .unionByName(tuned.withColumn("Category", F.lit("Tuned")), allowMissingColumns=True)
    )
    experiment = Window.partitionBy(by) if by else Window.partitionBy()
    return runs.withColumn("Rank", F.row_number().over(experiment.orderBy(F.desc(score), "Category", "Model")))


def best_model(board: DataFrame) -> DataFrame:
    """First row of each experiment with the reason."""
    return board.where(F.col("Rank") == 1).withColumn("reason", F.lit("Ranked first by weighted F1."))


def comparison_summary(board: DataFrame, by: str | None = None, score: str = "F1_Score") -> DataFrame:
    grouped = board.groupBy(by) if by else board.groupBy()
    return grouped.agg(
        F.count("*").alias("total_models"),
        F.count_if(F.col("Category") == "Baseline").alias("baseline_models"),
        F.count_if(F.col("Category") == "Tuned").alias("tuned_models"),
        F.min_by("Model", "Rank").alias("best_model"), F.min_by(score, "Rank").alias("best_f1_score"))

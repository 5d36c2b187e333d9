"""Turning model output into actions, for whole tables."""

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from frostline.functions import decisions
from frostline.functions.numeric import clip
from frostline.operators.contracts import quarantined_rows, validate_ranges
from frostline.operators.trees import Forest, linked, raw_scores
from frostline.schema import CLASSES, PREDICTED_RISK, PROBABILITIES, probability

MODEL_NAME = "model"


def predict_risk(df: DataFrame, model: PipelineModel | Forest, output: str = PREDICTED_RISK) -> DataFrame:
    """Regression prediction held in 0..100; the model's working columns are dropped."""
    if isinstance(model, Forest):
        predicted = raw_scores(df, model, "prediction").withColumn("prediction", F.get("prediction", F.lit(0)))
    else:
        predicted = model.transform(df)
    return predicted.select(*df.columns, clip("prediction", 0, 100).alias(output))


def add_probabilities(df: DataFrame, model: PipelineModel | Forest, classes: list[str] = CLASSES) -> DataFrame:
    """One probability column per class of a fitted classifier."""
    if isinstance(model, Forest):
        scored = raw_scores(df, model, "_s").withColumn("_p", linked(F.col("_s"), model.link))
    else:
        scored = model.transform(df).withColumn("_p", vector_to_array("probability"))
    return scored.select(*df.columns, *[F.col("_p")[i].alias(probability(c)) for i, c in enumerate(classes)])


def class_probabilities(df: DataFrame, classes: list[str] = CLASSES, digits: int = 6) -> DataFrame:
    return df.withColumn("probabilities", decisions.class_probabilities(classes, digits))


def confidence(df: DataFrame, classes: list[str] = CLASSES, digits: int = 6) -> DataFrame:
    return df.withColumn("confidence", decisions.confidence(classes, digits))


def apply_warning_threshold(df: DataFrame, threshold: float, output: str = "action") -> DataFrame:
    return df.withColumn(output, decisions.warning_or_safe(threshold))


def emergency_override(df: DataFrame, column: str = "action") -> DataFrame:
    return df.withColumn(
        column, F.when(decisions.is_emergency(), F.lit(decisions.EMERGENCY)).otherwise(F.col(column)))


def risk_level(df: DataFrame, column: str = "action") -> DataFrame:
    return df.withColumn("risk_level", decisions.risk_level(F.col(column)))


def recommendations(df: DataFrame, column: str = "action") -> DataFrame:
    return df.withColumn("recommendations", decisions.recommendations(F.col(column)))


def decide(df: DataFrame, threshold: float, classes: list[str] = CLASSES, model_name: str = MODEL_NAME) -> DataFrame:
    """Action, confidence, probabilities, level and advice from the probability columns."""
    acted = df.withColumn("predicted_action", decisions.action(threshold))
    return acted.withColumns({
        "confidence": decisions.confidence(classes),
        "probabilities": decisions.class_probabilities(classes),
        "risk_level": decisions.risk_level(F.col("predicted_action")),
        "recommendations": decisions.recommendations(F.col("predicted_action")),
        "warning_threshold": F.lit(float(threshold)),
        "model_name": F.lit(model_name),
    }).drop(*[probability(c) for c in classes])


def score_shipments(df: DataFrame, threshold: float, risk_model: PipelineModel | Forest | None = None,
                    classifier: PipelineModel | Forest | None = None, classes: list[str] = CLASSES,
                    model_name: str = MODEL_NAME) -> DataFrame:
    """Validate, predict risk, predict probabilities and decide: one stage without a shuffle.

    Models are fitted pipelines or node tables. Without them the risk and probability columns must already be
    there. Rows outside the allowed ranges are left out; `score_or_quarantine` gives them back as well.
    """
    rows = df.where(decisions.in_ranges())
    if risk_model is not None:
        rows = predict_risk(rows.drop(PREDICTED_RISK), risk_model)
    if classifier is not None:
        rows = add_probabilities(rows.drop(*PROBABILITIES), classifier, classes)
    return decide(rows, threshold, classes, model_name)


def score_or_quarantine(df: DataFrame, threshold: float, risk_model: PipelineModel | Forest | None = None,
                        classifier: PipelineModel | Forest | None = None, classes: list[str] = CLASSES,
                        model_name: str = MODEL_NAME) -> tuple[DataFrame, DataFrame]:
    """Decided rows, and the rows that can't be scored with the names of the offending columns: every row is in one of them."""
    scored = score_shipments(df, threshold, risk_model, classifier, classes, model_name)
    return scored, quarantined_rows(validate_ranges(df))

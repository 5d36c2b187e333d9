"""Tree models as tables of nodes, and scoring by walking them.

A model is one row for each node (input, threshold, children, values of a leaf) and one for each input (a column or one
of its categories, shifted and scaled as the fitted model does). Small models become comparisons inside generated code;
large ones are walked by arrays, all trees of a batch of rows at once. Neither assembles vectors nor calls a model for a
row, both work on streams, and both give what the fitted model gives.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, GBTClassificationModel, RandomForestClassificationModel
from pyspark.ml.feature import StandardScalerModel, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from frostline.functions import features
from frostline.workspace import fresh_path, remove

NODES = "tree int, node int, input int, threshold double, left int, right int, value array<double>, weight double"
INPUTS = "input int, column string, category string, shift double, factor double"
#: Nodes up to which a model becomes generated code.
CODE_NODES = 1_500
#: Rows times trees that are walked together.
_WALKED = 1_000_000


@dataclass(frozen=True)
class Input:
    """A number that nodes compare: a column, or whether it has a category, less `shift`, times `factor`."""
    column: str
    category: str | None = None
    shift: float = 0.0
    factor: float = 1.0


@dataclass(frozen=True)
class Forest:
    """Trees whose leaf values, weighted and added to `base`, are the scores; a leaf is its own child.

    `link` says what scores mean: "identity", "votes" (shares of the sum), "logistic" (a vote of each booster) or "softmax".
    """
    inputs: list[Input]
    first: np.ndarray  # where each tree's nodes begin, and the number of all
    input: np.ndarray  # -1 for leaves
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # one row for each node, one column for each score
    weight: np.ndarray  # of each tree
    base: tuple[float, ...] = (0.0,)
    link: str = "identity"
    feature_set: str = ""

    @property
    def trees(self) -> int:
        return len(self.first) - 1

    def walk(self, numbers: np.ndarray) -> np.ndarray:
        """Scores of rows of input numbers; a missing number goes right."""
        step = max(1, _WALKED // max(self.trees, 1))
        parts = [self._walk(numbers[i:i + step]) for i in range(0, len(numbers), step)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.base)))

    def _walk(self, numbers: np.ndarray) -> np.ndarray:
        node = np.tile(self.first[:-1], (len(numbers), 1))
        row = np.arange(len(numbers))[:, None]
        while True:
            asked = self.input[node]
            if not (asked >= 0).any():
                break
            lower = numbers[row, np.maximum(asked, 0)] <= self.threshold[node]
            node = np.where(lower, self.left[node], self.right[node])
        return np.einsum("rtk,t->rk", self.value[node], self.weight) + np.array(self.base)

    def numbers(self) -> list[Column]:
        """The input numbers as expressions over readings; derived features are computed as in fitting."""
        derived = getattr(features, self.feature_set.upper()) if self.feature_set else {}
        out = []
        for i in self.inputs:
            value = derived[i.column]() if i.column in derived else F.col(f"`{i.column}`")
            if i.category is not None:
                value = F.when(value == F.lit(i.category), F.lit(1.0)).otherwise(F.lit(0.0))
            value = value.cast("double")
            out.append(value if (i.shift, i.factor) == (0.0, 1.0) else (value - F.lit(i.shift)) * F.lit(i.factor))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Every row with `prediction` and, where scores are of classes, `probability`, as fitted pipelines add them."""
        scored = raw_scores(df, self, "_scores")
        if self.link == "identity":
            return scored.withColumn("prediction", F.get("_scores", F.lit(0))).drop("_scores")
        best = (F.array_position("_scores", F.array_max("_scores")) - 1).cast("double")
        return scored.withColumns({"probability": array_to_vector(linked(F.col("_scores"), self.link)), "prediction": best}).drop("_scores")

    def _leaf(self, node: int, name: str) -> str:
        """The leaf that a row reaches below a node, counted over all trees, as SQL."""
        if self.input[node] < 0:
            return str(node)
        left, right = self._leaf(self.left[node], name), self._leaf(self.right[node], name)
        return f"CASE WHEN {name}{self.input[node]} <= {float(self.threshold[node])!r}D THEN {left} ELSE {right} END"

    def table(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """Nodes and inputs as tables."""
        tree = np.repeat(np.arange(self.trees), np.diff(self.first))
        local = self.first[tree]
        columns = [pa.array(tree, pa.int32()), pa.array(np.arange(len(tree)) - local, pa.int32()), pa.array(self.input, pa.int32()),
                   pa.array(self.threshold), pa.array(self.left - local, pa.int32()), pa.array(self.right - local, pa.int32()),
                   pa.array(self.value.tolist(), pa.list_(pa.float64())), pa.array(self.weight[tree])]
        nodes = spark.createDataFrame(pa.Table.from_arrays(columns, [c.split()[0] for c in NODES.split(", ")]), NODES)
        rows = [(n, i.column, i.category, i.shift, i.factor) for n, i in enumerate(self.inputs)]
        return nodes, spark.createDataFrame(rows, INPUTS)


def forest_from_table(nodes: DataFrame, inputs: DataFrame, base: tuple[float, ...] = (0.0,), link: str = "identity", feature_set: str = "") -> Forest:
    """A model from its tables; the driver holds its nodes, as it holds any fitted model."""
    held = nodes.select(*[c.split()[0] for c in NODES.split(", ")]).toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
    column = {c: held.column(c).to_numpy() for c in ("tree", "node", "input", "threshold", "left", "right", "weight")}
    number, first = np.unique(column["tree"], return_index=True)
    first = np.append(first, held.num_rows)
    shift = np.repeat(first[:-1], np.diff(first))
    if (column["node"] != np.arange(held.num_rows) - shift).any():
        raise ValueError("A tree's nodes must be numbered from 0 without gaps.")
    leaf = column["input"] < 0
    own = np.arange(held.num_rows)
    known = [Input(r["column"], r["category"], r["shift"], r["factor"]) for r in inputs.orderBy("input").collect()]
    value = np.array(held.column("value").to_pylist(), np.float64).reshape(held.num_rows, len(base))
    return Forest(
        known, first, np.where(leaf, -1, column["input"]), np.where(leaf, 0.0, column["threshold"]),
        np.where(leaf, own, column["left"] + shift), np.where(leaf, own, column["right"] + shift), value,
        column["weight"][first[:-1]] if len(number) else np.zeros(0), tuple(base), link, feature_set)


def raw_scores(df: DataFrame, forest: Forest, output: str = "scores", code_nodes: int = CODE_NODES) -> DataFrame:
    """Every row with its scores, an array of doubles, in column `output`."""
    if len(forest.input) > code_nodes:
        def walk(*columns: pa.Array) -> pa.Array:
            numbers = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in columns])
            found = forest.walk(numbers)
            at = pa.array(np.arange(0, found.size + 1, found.shape[1], dtype=np.int32))
            return pa.ListArray.from_arrays(at, pa.array(found.ravel()))

        return df.withColumn(output, F.arrow_udf(walk, ArrayType(DoubleType()))(*forest.numbers()))
    name = "__number_"
    numbered = df.withColumns({f"{name}{i}": c for i, c in enumerate(forest.numbers())})
    leaves = {f"__leaf_{t}": F.expr(forest._leaf(int(forest.first[t]), name)) for t in range(forest.trees)}
    placed = numbered.withColumns(leaves) if leaves else numbered
    scores = []
    for k, base in enumerate(forest.base):
        values = F.expr(f"array({', '.join(f'{float(v)!r}D' for v in forest.value[:, k])})")
        parts = [F.get(values, F.col(leaf)) * F.lit(float(w)) for leaf, w in zip(leaves, forest.weight)]
        scores.append(sum(parts, F.lit(0.0)) + F.lit(float(base)))
    return placed.withColumn(output, F.array(*scores)).drop(*leaves, *[f"{name}{i}" for i in range(len(forest.inputs))])


def linked(scores: Column, link: str) -> Column:
    """Class probabilities from scores."""
    if link == "softmax":
        scores = F.transform(scores, lambda s: F.exp(s - F.array_max(scores)))
    elif link == "logistic":
        scores = F.transform(scores, lambda s: F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-2.0) * s)))
    elif link != "votes":
        raise ValueError(f"Scores of link {link} are no probabilities.")
    total = F.aggregate(scores, F.lit(0.0), lambda a, s: a + s)
    return F.transform(scores, lambda s: s / total)


# ---------------------------------------------------------------- from fitted models

def _learner_nodes(spark: SparkSession, learner, score: int, scores: int) -> DataFrame:
    """The nodes of a fitted learner, read from the files in which it saves itself; `score` is the one it adds to."""
    path = fresh_path(spark, "learner")
    learner.write().save(path)
    rows = spark.read.parquet(f"{path}/data")
    several = "treeID" in rows.columns
    rows = rows.select("treeID", "nodeData.*") if several else rows.withColumn("treeID", F.lit(0))
    votes = isinstance(learner, (DecisionTreeClassificationModel, RandomForestClassificationModel))
    if votes:
        total = F.aggregate("impurityStats", F.lit(0.0), lambda a, x: a + x)
        value = F.transform("impurityStats", lambda x: x / total)
    else:
        value = F.array(*[F.col("prediction") if k == score else F.lit(0.0) for k in range(scores)])
    weights = [1.0]
    if isinstance(learner, (GBTRegressionModel, GBTClassificationModel)):
        weights = [float(w) for w in learner.treeWeights]
    elif several:
        weights = [1.0 if votes else 1.0 / learner.getNumTrees] * learner.getNumTrees
    # Two categories are told apart as numbers 0 and 1: those that hold 0 go where numbers up to a half go.
    two = F.col("split.numCategories") >= 0
    swapped = two & ~F.array_contains("split.leftCategoriesOrThreshold", F.lit(0.0))
    threshold = F.when(two, F.lit(0.5)).otherwise(F.get("split.leftCategoriesOrThreshold", F.lit(0)))
    nodes = rows.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.col("split.featureIndex").alias("input"), threshold.alias("threshold"),
        F.when(swapped, F.col("rightChild")).otherwise(F.col("leftChild")).alias("left"),
        F.when(swapped, F.col("leftChild")).otherwise(F.col("rightChild")).alias("right"), value.alias("value"),
        F.get(F.expr(f"array({', '.join(f'{w!r}D' for w in weights)})"), F.col("treeID")).alias("weight"))
    held = spark.createDataFrame(nodes.toArrow(), NODES)
    remove(spark, path)
    return held


def _link(learner) -> str:
    if isinstance(learner, (DecisionTreeClassificationModel, RandomForestClassificationModel)):
        return "votes"
    if isinstance(learner, (DecisionTreeRegressionModel, GBTRegressionModel, RandomForestRegressionModel)):
        return "identity"
    raise ValueError(f"{type(learner).__name__} has no trees.")


def forest_of(spark: SparkSession, model: PipelineModel | Forest) -> Forest:
    """The nodes of a fitted pipeline of this library: its features, its scaling and its trees."""
    if isinstance(model, Forest):
        return model
    stages = model.stages
    feature_set = stages[0].getOrDefault(stages[0].featureSet) if stages[0].hasParam("featureSet") else ""
    columns = next(s for s in stages if isinstance(s, VectorAssembler)).getInputCols()
    scaler = next(s for s in stages if isinstance(s, StandardScalerModel))
    cargo = next(s for s in stages if isinstance(s, StringIndexerModel))
    inputs = [Input(c, None, float(m), 1.0 / float(s) if s else 0.0) for c, m, s in zip(columns, scaler.mean, scaler.std)]
    inputs += [Input(cargo.getInputCol(), label) for label in cargo.labels]
    learner = stages[-1]
    if isinstance(learner, PipelineModel):  # a booster for each class
        boosters = [s for s in learner.stages if isinstance(s, GBTClassificationModel)]
        parts, begun = [], 0
        for k, booster in enumerate(boosters):
            part = _learner_nodes(spark, booster, k, len(boosters))
            parts.append(part.withColumn("tree", F.col("tree") + F.lit(begun)))
            begun += booster.getNumTrees
        nodes, link, scores = parts[0], "logistic", len(boosters)
        for part in parts[1:]:
            nodes = nodes.unionByName(part)
    else:
        link = _link(learner)
        scores = learner.numClasses if link == "votes" else 1
        nodes = _learner_nodes(spark, learner, 0, scores)
    rows = [(n, i.column, i.category, i.shift, i.factor) for n, i in enumerate(inputs)]
    return forest_from_table(nodes, spark.createDataFrame(rows, INPUTS), (0.0,) * scores, link, feature_set)

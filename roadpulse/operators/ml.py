"""Severity classifiers on Spark ML: training, search, scoring, selection, neighbours."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler, VectorSlicer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import LABEL, MODEL_FEATURES, NON_FEATURES
from ..session import staged
from . import neighbours
from .evaluate import class_factors, full_metrics, leaderboard
from .serving import union_all

CLASSES = (1, 2, 3, 4)
PROBABILITIES = {c: f"p{c}" for c in CLASSES}
SEED = 42
IMPORTANCE = 0.03
#: Models that are fitted side by side.
AT_ONCE = 4


def feature_columns(df: DataFrame, label: str = LABEL) -> list[str]:
    """Columns of a frame that may serve as model input."""
    return [c for c in df.columns if c not in NON_FEATURES and c != label]


def training_frame(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows with a label, their features, and ``label`` as class index (severity - 1)."""
    names = feature_columns(df, label)
    if not names:
        raise ValueError("no feature columns after exclusions")
    rows = df.dropna(subset=[label])
    return rows.withColumn("label", (F.col(label).cast("int") - 1).cast("double"))


def one_hot_stages(df: DataFrame, columns: list[str]) -> tuple[list, list[str]]:
    """Stages that turn text columns into indicator vectors, and the vectors' names."""
    types = dict(df.dtypes)
    texts = [c for c in columns if types[c] == "string"]
    if not texts:
        return [], []
    indexer = StringIndexer(inputCols=texts, outputCols=[f"{c}_index" for c in texts], handleInvalid="keep")
    encoder = OneHotEncoder(
        inputCols=[f"{c}_index" for c in texts], outputCols=[f"{c}_vector" for c in texts], dropLast=False
    )
    return [indexer, encoder], [f"{c}_vector" for c in texts]


def feature_stages(df: DataFrame, columns: list[str] | None = None) -> list:
    """Stages from columns to the vector ``features``; rows with gaps are skipped."""
    names = columns or [c for c in MODEL_FEATURES if c in df.columns]
    stages, vectors = one_hot_stages(df, names)
    numeric = [c for c in names if dict(df.dtypes)[c] != "string"]
    return [*stages, VectorAssembler(inputCols=numeric + vectors, outputCol="features", handleInvalid="skip")]


def with_class_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows with ``weight``, the bounded sampling factor of their class (one number per class)."""
    factors = {r["class_label"]: r["factor"] for r in class_factors(df, label).collect()}
    weight = F.lit(1.0)
    for value, factor in factors.items():
        weight = F.when(F.col(label) == value, F.lit(float(factor))).otherwise(weight)
    return df.withColumn("weight", weight)


def forest(trees: int, depth: int, **params) -> RandomForestClassifier:
    """A forest whose rows keep the node they have reached in every tree, so that no level walks them down from the roots again."""
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=SEED, cacheNodeIds=True, **params)


def estimators(trees: int = 100, iterations: int = 1000) -> dict[str, object]:
    """The comparison's classifiers by name."""
    return {
        "Decision Tree (entropy)": DecisionTreeClassifier(maxDepth=8, impurity="entropy", seed=SEED),
        "Decision Tree (gini)": DecisionTreeClassifier(maxDepth=8, impurity="gini", seed=SEED),
        "Random Forest": forest(trees, 10),
        "Logistic Regression": LogisticRegression(family="multinomial", maxIter=iterations),
    }


def search_grid(
    trees: tuple[int, ...] = (20, 50), depths: tuple[int, ...] = (8, 12), boosts: int = 20
) -> dict[str, object]:
    """Class-weighted candidates of several families for the model search."""
    grid: dict[str, object] = {}
    for depth in depths:
        grid[f"tree d{depth}"] = DecisionTreeClassifier(maxDepth=depth, seed=SEED, weightCol="weight")
        for n in trees:
            grid[f"forest t{n} d{depth}"] = forest(n, depth, weightCol="weight")
    for strength in (0.0, 0.01):
        grid[f"logistic r{strength}"] = LogisticRegression(
            family="multinomial", maxIter=100, regParam=strength, weightCol="weight"
        )
    boosted = GBTClassifier(maxIter=boosts, maxDepth=5, seed=SEED)
    grid["boosted"] = OneVsRest(classifier=boosted, weightCol="weight", parallelism=AT_ONCE)
    return grid


def train(df: DataFrame, estimator, columns: list[str] | None = None) -> PipelineModel:
    """Fitted pipeline from feature columns to prediction."""
    rows = training_frame(df)
    return Pipeline(stages=[*feature_stages(rows, columns), estimator]).fit(rows)


def score(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Rows with ``predicted_severity`` and class probabilities p1..p4, aligned by class.

    Every row stays. One that lacks a model feature gets nulls. A model without probabilities leaves
    them null.
    """
    names = [c for c in MODEL_FEATURES if c in df.columns]
    complete = ~F.exists(F.array(*[F.col(c).cast("double").isNull() for c in names]), lambda x: x)
    # The row passes by as one value. With its own columns filled and blanked again, the constraints that the optimizer
    # derives of the conditions double with every column, and planning takes all of the driver's memory.
    held = df.select(F.struct(*df.columns).alias("_row"), complete.alias("_complete"), *names).fillna(0, subset=names)
    out = model.transform(held)
    if "probability" in out.columns:
        vector = vector_to_array("probability")
        shares = {name: F.when(F.col("_complete"), F.get(vector, c - 1)) for c, name in PROBABILITIES.items()}
    else:
        shares = {name: F.lit(None).cast("double") for name in PROBABILITIES.values()}
    predicted = F.when(F.col("_complete"), (F.col("prediction") + 1).cast("int"))
    filled = {c: F.nanvl(F.col(f"_row.{c}"), F.lit(0).cast(t)) if t in ("double", "float") else F.col(f"_row.{c}") for c, t in df.dtypes if c in names}
    columns = [F.when(F.col("_complete"), filled[c]).alias(c) if c in filled else F.col(f"_row.{c}") for c in df.columns]
    return out.select(*columns, predicted.alias("predicted_severity"), *[s.alias(n) for n, s in shares.items()])


def evaluate(model: PipelineModel, test: DataFrame, name: str, label: str = LABEL) -> DataFrame:
    """One row of metrics of a model on a test set.

    The rows are scored once: what the metrics need of them is written, and read from there.
    """
    scored = score(test.drop("predicted_severity"), model).where(F.col("predicted_severity").isNotNull())
    shares = PROBABILITIES if model.stages[-1].hasParam("probabilityCol") else None
    with staged(scored.select(label, "predicted_severity", *PROBABILITIES.values()), "scored") as rows:
        metrics = full_metrics(rows, label, "predicted_severity", shares)
    if shares is None:
        metrics = metrics.withColumn("logloss", F.lit(None).cast("double"))
    return metrics.select(F.lit(name).alias("model"), F.lit("ok").alias("status"), "*")


def model_search(train_df: DataFrame, test_df: DataFrame, grid: dict[str, object] | None = None, limit: int = 10):
    """Fits every candidate, class-weighted, and ranks them on the test rows.

    Returns (leaderboard frame, fitted models by name). Training rows are cached while the
    candidates are fitted, some at a time: the many small jobs of one leave tasks free for the others.
    """
    candidates = grid or search_grid()
    weighted = with_class_weight(train_df).cache()
    weighted.count()  # else each of the first candidates would fill the cache

    def tried(name: str) -> tuple[PipelineModel, DataFrame]:
        model = train(weighted, candidates[name])
        return model, evaluate(model, test_df, name)

    try:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            found = list(pool.map(inheritable_thread_target(train_df.sparkSession)(tried), candidates))
    finally:
        weighted.unpersist()
    models, rows = {name: m for name, (m, _) in zip(candidates, found)}, [row for _, row in found]
    common = [c for c in rows[0].columns if all(c in r.columns for r in rows)]
    return leaderboard(union_all([r.select(*common) for r in rows]), limit), models


def importances(model: PipelineModel) -> list[tuple[str, float]]:
    """Features of a tree model with their importance, largest first."""
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(assembler.getInputCols(), map(float, values)), key=lambda p: (-p[1], p[0]))


def select_features(df: DataFrame, model: PipelineModel, estimator, threshold: float = IMPORTANCE):
    """Retrains on the features at or above an importance; returns (model, names), or (None, [])."""
    chosen = {name for name, value in importances(model) if value >= threshold}
    if not chosen:
        return None, []
    assembler = next(s for s in model.stages if isinstance(s, VectorAssembler))
    order = assembler.getInputCols()
    names = [c for c in order if c in chosen]
    slicer = VectorSlicer(inputCol="features", outputCol="selected", indices=[order.index(c) for c in names])
    rows = training_frame(df)
    pipeline = Pipeline(stages=[assembler, slicer, estimator.copy({estimator.featuresCol: "selected"})])
    return pipeline.fit(rows), names


def knn(
    train_df: DataFrame, test_df: DataFrame, key: str, label: str = LABEL, columns: list[str] | None = None, k: int = 6,
) -> DataFrame:
    """Label of each test row by its k nearest training rows, among all that have a label and all features.

    A test row that lacks a feature gets null. Ties in distance go to the smaller key, ties of votes to the smaller
    label. Without any labelled row there is no result. See ``neighbours`` for the search.
    """
    names = columns or [c for c in MODEL_FEATURES if c in train_df.columns]
    own = [f"f{i}" for i in range(len(names))]
    numbers = [F.col(c).cast("double").alias(f) for c, f in zip(names, own)]
    labelled = train_df.where(F.col(label).isNotNull())
    fitted = labelled.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"), *numbers)
    rows = test_df.select(F.col(key).alias("key"), *numbers).withColumn("row", F.monotonically_increasing_id())
    if labelled.isEmpty():
        return rows.select(F.col("key").alias(key), F.lit(None).cast("int").alias("predicted_severity")).limit(0)
    rows = neighbours.stored(rows, "test-rows")
    near = neighbours.nearest_rows(fitted, rows.select("row", *own), own, k)
    labels = F.transform("near", lambda x: x["label"])
    votes = F.transform(F.array_distinct(labels), lambda x: F.struct(F.size(F.filter(labels, lambda y: y == x)).alias("n"), (-x).alias("less")))
    predicted = near.select("row", (-F.array_max(votes)["less"]).alias("predicted_severity"))
    return rows.join(predicted, "row", "left").select(F.col("key").alias(key), "predicted_severity")

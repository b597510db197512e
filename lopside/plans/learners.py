"""The learners with the settings used throughout, and how they are fitted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import GBTClassifier, LinearSVC, LogisticRegression
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lopside.operators.lookups import small_rows
from lopside.operators.splits import class_weights, hash_key, with_class_weight
from lopside.plans.forest import BootstrapForest
from lopside.plans.stages import TabularEncoder

SEED = 42
TASK_ROWS = 10_000
MANY_TASKS = 48  # from here on tasks grow instead, up to MOST_ROWS
MOST_ROWS = 1_000_000


def label_weights(df: DataFrame, label: str) -> dict:
    """Balanced weight of each class (as many entries as classes)."""
    return {r[label]: float(r["weight"]) for r in small_rows(class_weights(df, label))}


def weight_column(weights: dict, label: str) -> Column:
    out = F.lit(1.0)
    for value, weight in weights.items():
        out = F.when(F.col(label) == F.lit(value), F.lit(weight)).otherwise(out)
    return out


def ridge(n: float, c: float = 1.0) -> float:
    """Spark averages the losses where the penalty C multiplies their sum."""
    return 1.0 / (c * max(1.0, n))


def logistic(n: float, max_iter: int = 1000, **kw) -> LogisticRegression:
    return LogisticRegression(labelCol="_y", weightCol="_w", regParam=ridge(n), elasticNetParam=0.0,
                              standardization=False, maxIter=max_iter, **kw)


def linear_svc(n: float, max_iter: int = 100, **kw) -> LinearSVC:
    return LinearSVC(labelCol="_y", weightCol="_w", regParam=ridge(n), standardization=False,
                     maxIter=max_iter, **kw)


def forest(n: float, trees: int = 150, leaf: int = 5, **kw) -> BootstrapForest:
    return BootstrapForest(trees, leaf, seed=SEED, **kw)


def boosting(n: float, rounds: int = 100, depth: int = 3, **kw) -> GBTClassifier:
    return GBTClassifier(labelCol="_y", weightCol="_w", maxIter=rounds, maxDepth=depth, maxBins=256,
                         stepSize=0.1, seed=SEED, **kw)


def histogram_boosting(n: float, rounds: int = 300, **kw) -> GBTClassifier:
    """Boosting on 256 bins that stops early on a tenth of the rows."""
    return GBTClassifier(labelCol="_y", weightCol="_w", maxIter=rounds, maxDepth=5, maxBins=256,
                         stepSize=0.1, seed=SEED, validationIndicatorCol="_check", **kw)


def positive_probability(probability: str = "probability") -> Column:
    return vector_to_array(F.col(probability))[1]


def parts_of(n: int) -> int:
    """How many partitions ``n`` training rows are dealt to.

    Boosting runs hundreds of small jobs over all partitions and every task reports to the driver, so their
    number must not grow with the rows: from ``MANY_TASKS`` on a task takes more rows.
    """
    return max(1, min(-(-n // TASK_ROWS), MANY_TASKS), -(-n // MOST_ROWS))


def placed(rows: DataFrame, n: int) -> DataFrame:
    """Deal the training rows out by a hash of each row, in its order.

    Spark's boosting sums floating-point numbers partition by partition, so the same rows must meet in the
    same partitions: they do, whatever files, cores or partitions the table came in.
    """
    return rows.repartition(parts_of(n), "_key").sortWithinPartitions("_key")


def fit_tabular(train: DataFrame, label: str, categorical: list[str], numeric: list[str],
                learner: Callable[[float], Estimator] = forest, balanced: bool = False,
                row_id: str | None = None, sample_weight: Column | None = None) -> PipelineModel:
    """Encoder and learner, fitted on the training rows only.

    ``learner`` is given the rows' total weight, by which a penalty is scaled, so a row of
    weight 2 counts as two rows in the losses and in the penalty. A forest balances the classes
    in each of its bootstraps instead, and takes no sample weights.
    """
    encoder = TabularEncoder(categorical, numeric).fit(train)
    draws = isinstance(learner(1.0), BootstrapForest)
    if draws and sample_weight is not None:
        raise ValueError("a forest draws whole rows; it takes no sample weights")
    weight = F.lit(1.0) if sample_weight is None else sample_weight
    if balanced and not draws:
        train = with_class_weight(train, label, "_balance")
        weight = weight * F.col("_balance")
    key = F.col(row_id) if row_id else F.struct(*categorical, *numeric, label)
    check = (hash_key(F.col(row_id), "check") < F.lit("1999")) if row_id else F.lit(False)
    rows = encoder.transform(train).select(
        "features", F.col(label).cast("double").alias("_y"), weight.alias("_w"),
        check.alias("_check"), hash_key(F.to_json(F.struct(key.alias("k"))), "place").alias("_key"))
    if not draws:  # a forest reads its rows once and keeps them in a shorter form
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sums = rows.agg(F.count("*").alias("n"), F.sum("_w").alias("w")).first()
        estimator = learner(sums["w"] or 0.0)
        if draws:
            estimator.balanced = balanced
            model = estimator.fit(rows)
        else:
            model = estimator.fit(placed(rows, sums["n"]).drop("_key"))
    finally:
        if not draws:
            rows.unpersist()
    return PipelineModel([encoder, model])


def score_tabular(model: PipelineModel, df: DataFrame, out: str = "p") -> DataFrame:
    """The input rows plus the positive-class probability."""
    return model.transform(df).withColumn(out, positive_probability()).drop(
        "features", "rawPrediction", "probability", "prediction")


def spread(df: DataFrame) -> DataFrame:
    """The rows in parts of even size, several a core: a filter may leave all of them in a few files, and scoring costs far more than dealing."""
    return df.repartition(max(df.rdd.getNumPartitions(), 4 * df.sparkSession.sparkContext.defaultParallelism))


def impurity_importance(model: PipelineModel, spark) -> DataFrame:
    """Importance of each encoded feature, by name."""
    names = model.stages[0].feature_names
    values = model.stages[-1].featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, values)],
                                 "feature string, importance double")

"""Boosted-tree classifiers, cross-validation and their measures, on Spark ML."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.util import inheritable_thread_target

from hustings.operators.ordering import running_totals
from hustings.session import fixed_rows, fresh_path, shared_folder

# The three published parameter sets.  ``maxBins`` is ours: codes of hundreds of constituencies need
# more thresholds than the library's 32.
PRESETS: dict[str, dict[str, object]] = {
    "history": {"maxBins": 256, "maxIter": 200, "stepSize": 0.05, "maxDepth": 6, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"},
    "web": {"maxBins": 256, "maxIter": 150, "stepSize": 0.08, "maxDepth": 5, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.8"},
    "template": {"maxBins": 256, "maxIter": 150, "stepSize": 0.08, "maxDepth": 5, "subsamplingRate": 0.8, "featureSubsetStrategy": "all"},
}
SEED = 42


def boosted_trees(preset: str = "history", label: str = "label", **changes: object) -> GBTClassifier:
    settings = {**PRESETS[preset], "seed": SEED, "checkpointInterval": 10, **changes}
    return GBTClassifier(labelCol=label, featuresCol="features", **settings)


def assemble(df: DataFrame, features: list[str]) -> DataFrame:
    """Add ``features``; codes go in as plain numbers, without category metadata."""
    plain = df.select("*", *[F.col(c).cast("double").alias(f"_f_{c}") for c in features])
    assembler = VectorAssembler(inputCols=[f"_f_{c}" for c in features], outputCol="features")
    return assembler.transform(plain).drop(*[f"_f_{c}" for c in features])


def training_rows(df: DataFrame, features: list[str], label: str, row_id: list[str], partitions: int | None = None):
    """Assembled training rows in a layout fixed by ``row_id`` and their number: fits are then repeatable.

    Tree building reads the rows once per level and round, so they are written, cut loose from what produced them.  Tasks take a
    bounded number of rows each, however many there are.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return fixed_rows(assemble(df.where(F.col(label).isNotNull()), features), row_id, n)


def fit(df: DataFrame, estimator: Estimator) -> Model:
    shared_folder(df.sparkSession)
    return estimator.fit(df)


def score(model: Model, df: DataFrame) -> DataFrame:
    """Add ``prediction`` and ``p_win``, the probability of class 1."""
    scored = model.transform(df)
    return scored.withColumn("p_win", vector_to_array("probability")[1])


def outcome_label(prediction: str = "prediction") -> Column:
    return F.when(F.col(prediction) == 1, F.lit("WIN")).otherwise(F.lit("LOSS"))


def cross_validate(
    rows: DataFrame, make: Callable[[], Estimator], folds: int = 5, parallelism: int = 1
) -> DataFrame:
    """Held-out rows of every fold, scored by a model fitted on the other folds; needs ``fold`` and ``features``.

    ``parallelism`` folds are fitted at a time, each keeping its training rows in memory, as in Spark's own
    cross-validator.
    """

    def held_out(k: int) -> DataFrame:
        model = fit(rows.where(F.col("fold") != k), make())
        return score(model, rows.where(F.col("fold") == k))

    shared_folder(rows.sparkSession)
    with ThreadPool(parallelism) as pool:
        parts = pool.map(inheritable_thread_target(rows.sparkSession)(held_out), range(folds))
    return reduce(lambda a, b: a.unionByName(b), parts)


def fold_accuracy(scored: DataFrame, label: str = "label") -> DataFrame:
    """Per fold: ``n_rows`` and ``accuracy``."""
    hit = (F.col(label) == F.col("prediction")).cast("int")
    return scored.groupBy("fold").agg(F.count(F.lit(1)).alias("n_rows"), F.avg(hit).alias("accuracy"))


def mean_accuracy(per_fold: DataFrame) -> DataFrame:
    """Unweighted mean of the fold accuracies."""
    return per_fold.agg(F.avg("accuracy").alias("mean_accuracy"), F.count(F.lit(1)).alias("n_folds"))


def split_counts(model: Model, spark, features: list[str]) -> DataFrame:
    """How often each feature splits a node, over all trees: ``feature, n_splits``; unused features have 0."""
    path = fresh_path(spark, "trees")
    model.save(path)
    splits = (
        spark.read.parquet(f"{path}/data")
        .where(F.col("nodeData.leftChild") >= 0)
        .groupBy(F.col("nodeData.split.featureIndex").alias("i"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = spark.range(1).select(F.posexplode(F.array(*[F.lit(f) for f in features])).alias("i", "feature"))
    return names.join(splits, "i", "left").select("feature", F.coalesce("n", F.lit(0)).alias("n_splits"))


def rival_models(
    label: str = "label", trees: int = 100, logistic_steps: int = 100, **tree_changes: object
) -> dict[str, Callable[[], Estimator]]:
    """The compared classifiers; logistic regression sees scaled features.  ``trees`` is the size of the forest,
    ``logistic_steps`` the most iterations of the regression."""

    def logistic() -> Estimator:
        scaler = StandardScaler(inputCol="features", outputCol="scaled")
        return Pipeline(stages=[scaler, LogisticRegression(featuresCol="scaled", labelCol=label, maxIter=logistic_steps)])

    return {
        "boosted trees": lambda: boosted_trees("history", label, **tree_changes),
        "random forest": lambda: RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=5, seed=SEED),
        "logistic regression": logistic,
    }


def compare_models(
    rows: DataFrame, rivals: dict[str, Callable[[], Estimator]], label: str, folds: int = 5, parallelism: int = 1
) -> DataFrame:
    """Mean held-out accuracy per classifier on the same folds."""
    keep = ["fold", label, "prediction"]
    parts = [
        cross_validate(rows, make, folds, parallelism).select(F.lit(name).alias("model"), *keep)
        for name, make in rivals.items()
    ]
    hit = (F.col(label) == F.col("prediction")).cast("int")
    per_fold = (
        reduce(lambda a, b: a.unionByName(b), parts).groupBy("model", "fold").agg(F.avg(hit).alias("accuracy"))
    )
    return per_fold.groupBy("model").agg(F.avg("accuracy").alias("mean_accuracy"))


def tune(
    rows: DataFrame,
    grid: list[dict[str, object]],
    label: str,
    preset: str = "history",
    folds: int = 5,
    parallelism: int = 1,
) -> DataFrame:
    """Mean held-out accuracy per parameter combination; ``rows`` is usually one state."""
    rivals = {
        ", ".join(f"{k}={v}" for k, v in changes.items()): (lambda c=changes: boosted_trees(preset, label, **c))
        for changes in grid
    }
    return compare_models(rows, rivals, label, folds, parallelism).withColumnRenamed("model", "settings")


def select_model(
    rows: DataFrame,
    estimator: Estimator,
    grid: list[dict[str, object]],
    label: str,
    folds: int = 5,
    parallelism: int = 1,
) -> tuple[Model, DataFrame]:
    """The best setting fitted on all of ``rows`` (usually one state), and what every setting achieved.

    The table has ``settings, mean_accuracy, deviation`` (of the folds, as of a whole population) and ``chosen``: the highest
    mean, the first in the grid on a tie.  ``rows`` needs ``features`` and ``fold``.  Settings are parameter names of
    ``estimator`` with values.
    """
    shared_folder(rows.sparkSession)
    maps = [{estimator.getParam(k): v for k, v in changes.items()} for changes in grid]
    judge = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    search = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=maps,
        evaluator=judge,
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
    )
    found = search.fit(rows.withColumn(label, F.col(label).cast("double")))
    named = [", ".join(f"{k}={v}" for k, v in changes.items()) for changes in grid]
    best = max(range(len(grid)), key=lambda i: (found.avgMetrics[i], -i))
    table = [(n, float(m), float(d), i == best) for i, (n, m, d) in enumerate(zip(named, found.avgMetrics, found.stdMetrics))]
    ddl = "settings string, mean_accuracy double, deviation double, chosen boolean"
    return found.bestModel, rows.sparkSession.createDataFrame(table, ddl)


def parameter_grid(**values: list[object]) -> list[dict[str, object]]:
    """Every combination of the listed values, the last name changing fastest."""
    return [dict(zip(values, chosen)) for chosen in product(*values.values())]


def precision_recall_points(scored: DataFrame, by: list[str], label: str = "label", score: str = "p_win") -> DataFrame:
    """Per group and distinct score: ``threshold, n, hits`` and exact ``precision`` and ``recall`` when all rows that score at
    least as much are taken.

    Rows without a score or a label are left out; recall is null where a group has no positive row.  A group of any size is
    summed up in ranges of its scores.
    """
    known = scored.where(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(label).isNotNull())
    value = F.col(score).cast("double")
    # Null groups are groups too; 0.0 and -0.0 are one score.
    points = known.groupBy(*by, (value + F.lit(0.0)).alias("threshold")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("hits")
    )
    summed = running_totals(points, by, [-F.col("threshold")], ["n", "hits"])
    taken, right = F.col("n") + F.col("before_n"), F.col("hits") + F.col("before_hits")
    return summed.select(
        *by,
        "threshold",
        "n",
        "hits",
        (right / taken).alias("precision"),
        F.try_divide(right.cast("double"), F.col("all_hits").cast("double")).alias("recall"),
        "all_hits",
    )


def precision_recall_area(scored: DataFrame, by: list[str], label: str = "label", score: str = "p_win") -> DataFrame:
    """Per group ``n_rows, n_hits`` and ``area``, the exact average precision over all distinct scores; null without hits."""
    points = precision_recall_points(scored, by, label, score)
    share = F.try_divide(F.col("hits").cast("double"), F.col("all_hits").cast("double"))
    return points.groupBy(*by).agg(
        F.sum("n").alias("n_rows"), F.sum("hits").alias("n_hits"), F.sum(F.col("precision") * share).alias("area")
    )


def precision_recall(scored: DataFrame, by: list[str], label: str = "label", steps: int = 20) -> DataFrame:
    """Precision and recall per group at score thresholds 0, 1/steps, …; counts per step are summed from the top."""
    step = F.least(F.floor(F.col("p_win") * steps), F.lit(steps - 1)).cast("int")
    binned = scored.groupBy(*by, step.alias("step")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label).cast("bigint")).alias("hits")
    )
    # At most ``steps`` rows per group from here on.
    above = W.partitionBy(*by).orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(*by)
    return binned.select(
        *by,
        (F.col("step") / F.lit(steps)).alias("threshold"),
        (F.sum("hits").over(above) / F.sum("n").over(above)).alias("precision"),
        F.try_divide(F.sum("hits").over(above).cast("double"), F.sum("hits").over(whole).cast("double")).alias("recall"),
    )

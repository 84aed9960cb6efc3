"""Cleaning, flags, labels and outcomes as pipeline stages with parameters, so that a whole workflow is one saved model."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.pipeline import Pipeline
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hustings.functions.numbers import uniform
from hustings.operators.cleaning import clean_candidates, tidy_keys
from hustings.operators.encoding import SafeEncoder
from hustings.operators.features import NOISE_SEED, PROXY_THRESHOLD, PROXY_WEIGHTS, add_major_flag
from hustings.operators.ordering import exact_median
from hustings.operators.winners import pick_winners
from hustings.session import fixed_rows, materialise

# Where the trees stand in a prediction pipeline, from its end.
TREES = -2


def text_list(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, TypeConverters.toListString)


class Stage(DefaultParamsReadable, DefaultParamsWritable):
    """A stage that is its parameters and nothing else."""

    def __getitem__(self, name: str):
        return self.getOrDefault(name)


class CleanCandidates(Transformer, Stage):
    """Web candidates with numeric features and without missing categories."""

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return clean_candidates(dataset)


class TidyKeys(Transformer, Stage):
    """Key columns of two sources in one form."""

    columns = text_list("columns", "key columns")

    @keyword_only
    def __init__(self, *, columns: list[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return tidy_keys(dataset, self["columns"])


class MajorFlag(Transformer, Stage):
    """``is_major_party``: whether the party's text holds one of ``names``."""

    names = text_list("names", "party names")
    anyCase = Param(Params._dummy(), "anyCase", "whether case is ignored", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, names: list[str] | None = None, anyCase: bool = True):
        super().__init__()
        self._setDefault(anyCase=True)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return add_major_flag(dataset, self["names"], self["anyCase"])


class StandInLabel(Estimator, Stage):
    """Learns the exact median of the assets; its model adds ``proxy``, the stand-in label, and asks nothing of new rows."""

    rowId = text_list("rowId", "columns that tell the rows apart")
    assets = Param(Params._dummy(), "assets", "column of the assets", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, rowId: list[str] | None = None, assets: str = "assets_numeric"):
        super().__init__()
        self._setDefault(assets="assets_numeric")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> StandInLabelModel:
        median = exact_median(dataset, self["assets"]).first()["median"]
        model = self._copyValues(StandInLabelModel())
        return model if median is None else model._set(median=median)


class StandInLabelModel(Model, Stage):
    rowId = text_list("rowId", "columns that tell the rows apart")
    assets = Param(Params._dummy(), "assets", "column of the assets", TypeConverters.toString)
    median = Param(Params._dummy(), "median", "median of the assets; absent if there were none", TypeConverters.toFloat)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(assets="assets_numeric")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        major, wealth, noise = PROXY_WEIGHTS
        median = F.lit(self["median"] if self.isDefined("median") else None).cast("double")
        score = (
            F.col("is_major_party") * F.lit(major)
            + (F.col(self["assets"]) > median).cast("int") * F.lit(wealth)
            + uniform(F.concat_ws("|", *self["rowId"]), NOISE_SEED) * F.lit(noise)
        )
        return dataset.withColumn("proxy", (score > F.lit(PROXY_THRESHOLD)).cast("int"))


class FixedRows(Transformer, Stage):
    """The rows written once, in a layout that depends on ``rowId`` and their number: fits on them are repeatable, and trees read
    them once a level without computing them again."""

    rowId = text_list("rowId", "columns that tell the rows apart")
    partitions = Param(Params._dummy(), "partitions", "number of partitions, 0 for the session's", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, rowId: list[str] | None = None, partitions: int = 0):
        super().__init__()
        self._setDefault(partitions=0)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        n = self["partitions"] or int(dataset.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return fixed_rows(dataset, self["rowId"], n)


class Outcomes(Transformer, Stage):
    """``p_win`` and ``outcome``: by predicted class, or, if ``contest`` is given, ``win`` for the best row of each contest."""

    contest = text_list("contest", "columns of a contest; none for the predicted class")
    rowId = text_list("rowId", "columns that order the rows of a contest")
    win = Param(Params._dummy(), "win", "what a winner gets", TypeConverters.toString)
    lose = Param(Params._dummy(), "lose", "what the others get", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, contest: list[str] | None = None, rowId: list[str] | None = None, win: str = "WIN", lose: str = "LOSS"):
        super().__init__()
        self._setDefault(contest=[], rowId=[], win="WIN", lose="LOSS")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = dataset.withColumn("p_win", vector_to_array("probability")[1])
        if self["contest"]:
            return pick_winners(materialise(scored), self["contest"], "p_win", self["rowId"], win=self["win"], lose=self["lose"])
        named = F.when(F.col("prediction") == 1, F.lit(self["win"])).otherwise(F.lit(self["lose"]))
        return scored.withColumn("outcome", named)


def prediction_pipeline(
    prepare: list,
    encoder: SafeEncoder,
    features: list[str],
    trees: GBTClassifier,
    row_id: list[str],
    outcomes: Outcomes,
    partitions: int | None = None,
) -> Pipeline:
    """Preparing stages, codes, features, trees and outcomes in one pipeline; rows are written once before the trees."""
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    return Pipeline(stages=[*prepare, encoder, assembler, FixedRows(rowId=row_id, partitions=partitions or 0), trees, outcomes])

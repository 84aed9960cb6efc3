"""Categories as ordinal codes: sorted vocabularies, lookups with and without an unknown bucket."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hustings.operators.keeping import TableReader, TableWriter
from hustings.operators.ordering import positions
from hustings.operators.skew import BROADCAST_ROWS, spread_join
from hustings.session import materialise

UNKNOWN = "UNKNOWN"


def field_values(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Distinct known values per field as ``field, value``; ``fields`` maps field names to columns."""
    pairs = [F.struct(F.lit(f).alias("field"), F.col(c).cast("string").alias("value")) for f, c in fields.items()]
    return (
        df.select(F.explode(F.array(*pairs)).alias("pair"))
        .select("pair.*")
        .where(F.col("value").isNotNull())
        .distinct()
    )


def with_sentinel(values: DataFrame, fields: list[str], sentinel: str = UNKNOWN) -> DataFrame:
    extra = values.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(f) for f in fields])).alias("field"), F.lit(sentinel).alias("value")
    )
    return values.unionByName(extra).distinct()


def sorted_codes(values: DataFrame) -> DataFrame:
    """Add ``code``: 0, 1, … in sorted order of ``value`` within each ``field``, for distinct ``field, value``."""
    placed = positions(values.withColumn("_pair", F.struct("field", "value")), "_pair")
    # One row per field, and the fields are named in the program.
    starts = placed.groupBy("field").agg(F.min("before").alias("_start"))
    return placed.join(F.broadcast(starts), "field").select(
        "field", "value", (F.col("before") - F.col("_start")).cast("int").alias("code")
    )


class EncoderParams(HasInputCols, HasOutputCols):
    """What a fitted and an unfitted encoder have in common.

    ``missing`` is the category of null values.  With ``sentinel`` it belongs to every vocabulary and unseen values get its
    code; without, it is a category like any other and unseen values get the number of known ones.  Vocabularies of more than
    ``broadcastRows`` values are joined by spread keys, for which ``rowId`` tells the rows apart.
    """

    missing = Param(Params._dummy(), "missing", "category of null values", TypeConverters.toString)
    sentinel = Param(Params._dummy(), "sentinel", "whether unseen values are taken as missing", TypeConverters.toBoolean)
    rowId = Param(Params._dummy(), "rowId", "columns that tell the rows apart", TypeConverters.toListString)
    broadcastRows = Param(Params._dummy(), "broadcastRows", "largest vocabulary to broadcast", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(missing=UNKNOWN, sentinel=True, rowId=[], broadcastRows=BROADCAST_ROWS)

    @property
    def row_id(self) -> list[str]:
        return self.getOrDefault("rowId")

    @row_id.setter
    def row_id(self, columns: list[str]) -> None:
        self._set(rowId=columns)

    @property
    def broadcast_rows(self) -> int:
        return self.getOrDefault("broadcastRows")

    @broadcast_rows.setter
    def broadcast_rows(self, rows: int) -> None:
        self._set(broadcastRows=rows)

    def category(self, column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(self.getOrDefault("missing")))


class SafeEncoder(Estimator, EncoderParams, MLReadable, MLWritable):
    """Learns one sorted vocabulary per input column; unseen and missing values get the code of ``UNKNOWN``.

    ``template`` adds the values of a second dataset (columns of the same names) to the vocabularies; a saved encoder keeps
    them as a table.
    """

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: list[str] | None = None,
        outputCols: list[str] | None = None,
        template: DataFrame | None = None,
        missing: str = UNKNOWN,
        sentinel: bool = True,
        rowId: list[str] | None = None,
        broadcastRows: int = BROADCAST_ROWS,
    ):
        super().__init__()
        given = dict(self._input_kwargs)
        self.template = given.pop("template", None)
        self._set(**given)

    def _fit(self, dataset: DataFrame) -> SafeEncoderModel:
        columns = self.getInputCols()
        fields = {c: f"_cat_{c}" for c in columns}
        values = field_values(dataset.select(*[self.category(c).alias(f"_cat_{c}") for c in columns]), fields)
        if self.template is not None:
            values = values.unionByName(field_values(self.template, {c: c for c in columns}))
        values = with_sentinel(values, columns, self.getOrDefault("missing")) if self.getOrDefault("sentinel") else values.distinct()
        model = SafeEncoderModel(materialise(sorted_codes(values)))
        return self._copyValues(model)

    def write(self) -> MLWriter:
        return TableWriter(self, self.template.select(*self.getInputCols()).distinct() if self.template is not None else None)

    @classmethod
    def read(cls) -> MLReader:
        return TableReader(cls, lambda table: cls(template=table))


class SafeEncoderModel(Model, EncoderParams, MLReadable, MLWritable):
    """Vocabulary table ``field, value, code`` and its lookup; saved and loaded with the table."""

    def __init__(self, vocabulary: DataFrame):
        super().__init__()
        self.vocabulary = vocabulary
        self._sizes: dict[str, int] | None = None

    @property
    def sizes(self) -> dict[str, int]:
        if self._sizes is None:
            # One row per encoded column.
            rows = self.vocabulary.groupBy("field").agg(F.count(F.lit(1)).alias("size")).collect()
            self._sizes = {r["field"]: r["size"] for r in rows}
        return self._sizes

    def unseen(self) -> dict[str, int]:
        """The code of unseen values per column."""
        if not self.getOrDefault("sentinel"):
            return self.sizes
        missing = F.col("value") == self.getOrDefault("missing")
        return {r["field"]: r["code"] for r in self.vocabulary.where(missing).collect()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, unseen = dataset, self.unseen()
        for field, target in zip(self.getInputCols(), self.getOutputCols()):
            codes = self.vocabulary.where(F.col("field") == field).select(
                F.col("value").alias("_value"), F.col("code").alias(target)
            )
            keyed = out.withColumn("_value", self.category(field))
            if self.sizes.get(field, 0) <= self.broadcast_rows:
                joined = keyed.join(F.broadcast(codes), "_value", "left")
            else:
                joined = spread_join(keyed, codes, ["_value"], self.row_id or dataset.columns)
            out = joined.drop("_value").withColumn(target, F.coalesce(target, F.lit(unseen.get(field, 0))))
        return out

    def write(self) -> MLWriter:
        return TableWriter(self, self.vocabulary)

    @classmethod
    def read(cls) -> MLReader:
        return TableReader(cls, cls)


def closed_encoder(columns: dict[str, str], row_id: list[str]) -> SafeEncoder:
    """An encoder over the values of the training rows themselves, null being the category ``nan``."""
    return SafeEncoder(inputCols=list(columns), outputCols=list(columns.values()), missing="nan", sentinel=False, rowId=row_id)


def encode_closed(df: DataFrame, columns: dict[str, str], row_id: list[str]) -> DataFrame:
    """Codes over the values of ``df`` itself, null being the category ``nan``; ``columns`` maps input to output."""
    return closed_encoder(columns, row_id).fit(df).transform(df)

"""Saving and loading of pipeline stages that hold a table besides their parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame


class TableWriter(MLWriter):
    """Parameters as metadata, the table as Parquet in ``data``; without a table there is no such folder."""

    def __init__(self, instance, table: DataFrame | None):
        super().__init__()
        self.instance = instance
        self.table = table

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"table": self.table is not None})
        if self.table is not None:
            self.table.write.parquet(f"{path}/data")


class TableReader(MLReader):
    """``make`` builds the stage from its table, or from None; parameters and identity follow from the metadata."""

    def __init__(self, kind: type, make: Callable[[DataFrame | None], object]):
        super().__init__()
        self.kind = kind
        self.make = make

    def load(self, path: str):
        named = f"{self.kind.__module__}.{self.kind.__name__}"
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession, named)
        stage = self.make(self.sparkSession.read.parquet(f"{path}/data") if metadata["table"] else None)
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        return stage

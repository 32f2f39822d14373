"""Models with a table beside their parameters, for what a driver should not hold."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


class _Writer(DefaultParamsWriter):
    def save(self, path: str) -> None:
        if self.instance.stored_at().startswith(path.rstrip("/") + "/"):
            raise ValueError("a model cannot replace the folder that its table is read from")
        super().save(path)

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        if self.instance.stored_at():
            self.instance.stored(self.sparkSession).write.parquet(f"{path}/table")


class _Reader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        return model._set(storedAt=f"{path}/table") if model.stored_at() else model


class StoredModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A model whose table, if it has one, is in a folder; saving copies it beside the parameters."""

    storedAt = Param(Params._dummy(), "storedAt", "folder of the table, or nothing", TypeConverters.toString)

    def __init__(self, table: DataFrame | None = None, label: str = "model"):
        super().__init__()
        self._setDefault(storedAt="")
        if table is not None:
            path = scratch_path(table.sparkSession, label)
            table.write.parquet(path)
            self._set(storedAt=path)

    def stored_at(self) -> str:
        return self.getOrDefault(self.storedAt)

    def stored(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.stored_at())

    def write(self):
        return _Writer(self)

    @classmethod
    def read(cls):
        return _Reader(cls)

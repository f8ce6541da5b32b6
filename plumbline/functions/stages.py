"""Pipeline stages whose fitted state is a distributed table, not labels on the driver."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.functions.encoding import CategoryIndex, fit_index


class _IndexerParams(HasInputCols, HasOutputCols):
    invalid: Param[str] = Param(Params._dummy(), "invalid", "null or unknown values: error, skip the row, or keep as one further index", typeConverter=TypeConverters.toString)

    def getInvalid(self) -> str:
        return self.getOrDefault(self.invalid)


class CategoryIndexer(Estimator, _IndexerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Category indexes as a pipeline stage, for any number of values: most frequent is 0, ties by text.

    The counterpart of Spark's ``StringIndexer``, whose labels all visit the driver
    and lie inside the model.  Here the model is a table of ranks: it is joined where
    rows are indexed, and saved and loaded as Parquet.
    """

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None, invalid: str = "error"):
        super().__init__()
        self._setDefault(invalid="error")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CategoryIndexerModel:
        if len(self.getInputCols()) != len(self.getOutputCols()):
            raise ValueError("inputCols and outputCols differ in length")
        return self._copyValues(CategoryIndexerModel(fit_index(dataset, self.getInputCols())))


class CategoryIndexerModel(Model, _IndexerParams, MLReadable, MLWritable):
    """Ranks of the categories of some columns.

    A freshly fitted model reads the table its fit pinned; ``save`` writes a copy of
    its own, and a loaded model reads that.
    """

    def __init__(self, index: CategoryIndex | None = None):
        super().__init__()
        self._setDefault(invalid="error")
        self.index = index

    @property
    def sizes(self) -> dict[str, int]:
        """Number of values of each column."""
        return dict(self.index.sizes)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.index.transform(dataset, self.getInputCols(), self.getOutputCols(), self.getInvalid())

    def write(self) -> MLWriter:
        return _IndexerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _IndexerReader()


class _IndexerWriter(MLWriter):
    def __init__(self, model: CategoryIndexerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model = self.model
        cols = model.getInputCols()
        DefaultParamsWriter.saveMetadata(model, path, self.sparkSession, extraMetadata={"sizes": [model.index.sizes[c] for c in cols]})
        tables = [model.index.tables[c].select(F.lit(k).alias("at"), "value", "index") for k, c in enumerate(cols)]
        reduce(DataFrame.unionByName, tables).write.parquet(f"{path}/data")


class _IndexerReader(MLReader):
    def load(self, path: str) -> CategoryIndexerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = CategoryIndexerModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        table = self.sparkSession.read.schema("at int, value string, index double").parquet(f"{path}/data")
        cols = model.getInputCols()
        tables = {c: table.where(F.col("at") == k).select("value", "index") for k, c in enumerate(cols)}
        model.index = CategoryIndex(tables, dict(zip(cols, metadata["sizes"])))
        return model

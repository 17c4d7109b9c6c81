"""Imputer and category encoder as pipeline stages that can be saved.

A fitted stage is a ``Transformer`` with a writer and a reader, so that one saved ``PipelineModel`` holds imputation, codes, indicators,
scaling and the learner, and serves batches and streams alike. The category table of the encoder is a table, in memory and
on disk: a join gives the codes, whatever its length.

Cases: a column without any value has no fill and stays null; a null or unknown category gets the code after the last one, which
``OneHotEncoder(dropLast=True)`` turns into zeros; an empty training frame gives an empty table.
"""

from __future__ import annotations

import json
import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularis.operators import encoders as E


class _Columns(Params):
    medians = Param(Params._dummy(), "medians", "columns filled with their median", typeConverter=TypeConverters.toListString)
    modes = Param(Params._dummy(), "modes", "columns filled with their most frequent value", typeConverter=TypeConverters.toListString)


class FillEstimator(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the median of some columns and the most frequent value of others."""

    @keyword_only
    def __init__(self, *, medians=None, modes=None):
        super().__init__()
        self._setDefault(medians=[], modes=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FillModel:
        medians, modes = self.getOrDefault(self.medians), self.getOrDefault(self.modes)
        fills = {**E.fit_medians(dataset, medians), **E.fit_modes(dataset, modes)} if medians or modes else {}
        row = dataset.sparkSession.range(1).select(*[c.alias(n) for n, c in fills.items()]).first() if fills else None
        return FillModel(fills=json.dumps({n: row[n] for n in fills}))


class FillModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    fills = Param(Params._dummy(), "fills", "value for each column, as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, fills="{}"):
        super().__init__()
        self._set(fills=fills)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fills = {n: F.lit(v) for n, v in json.loads(self.getOrDefault(self.fills)).items() if v is not None}
        return E.impute(dataset, fills)


class _InOut(Params):
    inputCol = Param(Params._dummy(), "inputCol", "category column", typeConverter=TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "code column", typeConverter=TypeConverters.toString)


class CodeEstimator(Estimator, _InOut, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the table of a column's categories, coded from 0 in sorted order."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CodeModel:
        c = self.getOrDefault(self.inputCol)
        model = CodeModel(inputCol=c, outputCol=self.getOrDefault(self.outputCol))
        return model.with_table(E.fit_ordinal(dataset, c))


class CodeModel(Model, _InOut, MLWritable, MLReadable):
    """Codes by a join with the category table."""

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.table: DataFrame | None = None

    def with_table(self, table: DataFrame) -> CodeModel:
        self.table, self.unknown = table, table.count()
        return self

    def copy(self, extra=None):
        return super().copy(extra).with_table(self.table)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        coded = E.ordinal(dataset, self.getOrDefault(self.inputCol), self.table, self.unknown, self.getOrDefault(self.outputCol))
        return coded.withColumn(self.getOrDefault(self.outputCol), F.col(self.getOrDefault(self.outputCol)).cast("double"))

    def write(self) -> MLWriter:
        return _CodeWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _CodeReader(cls)


class _CodeWriter(MLWriter):
    def __init__(self, instance: CodeModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(os.path.join(path, "table"))


class _CodeReader(MLReader):
    def __init__(self, cls: type[CodeModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> CodeModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model.with_table(self.sparkSession.read.parquet(os.path.join(path, "table")))

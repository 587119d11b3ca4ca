"""Preprocessing, features and scaling as Spark ML stages, so that a saved pipeline starts from observations."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame

from ..operators.features import feature_matrix
from ..operators.split_scale import apply_scaler, fit_scaler
from ..session import durable
from .preparation import preprocess


class SeriesFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Cleans the measure columns of daily series and derives the features of one of them."""

    key = Param(Params._dummy(), "key", "series column", TypeConverters.toString)
    day = Param(Params._dummy(), "day", "date column", TypeConverters.toString)
    columns = Param(Params._dummy(), "columns", "measures to clean", TypeConverters.toListString)
    value = Param(Params._dummy(), "value", "measure the features come from", TypeConverters.toString)
    horizon = Param(Params._dummy(), "horizon", "days ahead of the labels", TypeConverters.toInt)
    targets = Param(Params._dummy(), "targets", "measures to predict", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, key="series_key", day="day", columns=None, value=None, horizon=0, targets=None):
        super().__init__()
        self._setDefault(key="series_key", day="day", columns=[], value="", horizon=0, targets=[])
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        settings = {p.name: self.getOrDefault(p) for p in self.params}
        place = {"key": settings["key"], "day": settings["day"]}
        clean = preprocess(dataset, columns=settings["columns"], **place)
        return feature_matrix(
            clean, value=settings["value"], horizon=settings["horizon"], targets=settings["targets"], **place
        )


class _ScalerParams(Params):
    key = Param(Params._dummy(), "key", "series column", TypeConverters.toString)
    features = Param(Params._dummy(), "features", "columns to standardise", TypeConverters.toListString)
    targets = Param(Params._dummy(), "targets", "columns that the features shall predict", TypeConverters.toListString)


class SeriesScaler(Estimator, _ScalerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns mean and deviation of every feature per series; fit it on the training rows only."""

    @keyword_only
    def __init__(self, *, key="series_key", features=None, targets=None):
        super().__init__()
        self._setDefault(key="series_key", features=[], targets=[])
        self._set(**{n: v for n, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SeriesScalerModel:
        table = fit_scaler(dataset, key=self.getOrDefault(self.key), features=self.getOrDefault(self.features))
        return self._copyValues(SeriesScalerModel(durable(table)))


class SeriesScalerModel(Model, _ScalerParams, MLWritable, MLReadable):
    """A fitted scaler: a table of one row per series, and the lists of features and targets it goes with.

    Rows of a series that was not fitted are left out, as by ``apply_scaler``.
    """

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self._setDefault(key="series_key", features=[], targets=[])
        self.table = table

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return apply_scaler(dataset, self.table, key=self.getOrDefault(self.key), features=self.getOrDefault(self.features))

    def write(self) -> MLWriter:
        return _ScalerWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ScalerReader()


class _ScalerWriter(MLWriter):
    def __init__(self, model: SeriesScalerModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.table.write.parquet(f"{path}/table")


class _ScalerReader(MLReader):
    def load(self, path: str) -> SeriesScalerModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = SeriesScalerModel(self.sparkSession.read.parquet(f"{path}/table"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model

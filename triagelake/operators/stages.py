"""The claim preprocessing as an ML Pipeline stage.

``ClaimEncoder`` learns fill value, category codes and scaling from the rows it is fitted on;
``ClaimEncoderModel`` applies them to tables and streams and adds the feature vector. Both are
saved and loaded with the ML readers and writers, alone or inside a ``PipelineModel``.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasOutputCol
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.ml.functions import array_to_vector

from ..schema import CATEGORICAL_FEATURES, FEATURES
from ..sources.tables import load_preprocessor, save_preprocessor
from .encode import Preprocessor, fit_preprocessor


class _EncoderParams(HasOutputCol):
    """Params of the estimator and its model."""

    features = Param(Params._dummy(), "features", "feature columns in order", TypeConverters.toListString)
    categorical = Param(Params._dummy(), "categorical", "which of them are categories", TypeConverters.toListString)
    repair = Param(Params._dummy(), "repair", "apply the claim cleaning rules", TypeConverters.toBoolean)
    inlineValues = Param(Params._dummy(), "inlineValues", "longest category list kept inside the plan", TypeConverters.toInt)

    def __init__(self):
        super().__init__()
        self._setDefault(features=FEATURES, categorical=CATEGORICAL_FEATURES, repair=True, inlineValues=512, outputCol="features")


class ClaimEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the preprocessing on the rows it is given."""

    @keyword_only
    def __init__(self, *, features=None, categorical=None, repair=True, inlineValues=512, outputCol="features"):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> ClaimEncoderModel:
        get = self.getOrDefault
        fitted = fit_preprocessor(dataset, get("features"), get("categorical"), get("repair"), get("inlineValues"))
        return self._copyValues(ClaimEncoderModel(fitted))


class ClaimEncoderModel(Model, _EncoderParams, MLReadable, MLWritable):
    """Fitted preprocessing: feature columns become scaled numbers, the vector is added, other columns pass."""

    def __init__(self, fitted: Preprocessor | None = None):
        super().__init__()
        self.fitted = fitted

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out = self.fitted.transform(dataset)
        # After scaling the training mean is 0: it takes the place of a missing number.
        numbers = F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in self.fitted.features])
        return out.withColumn(self.getOutputCol(), array_to_vector(numbers))

    def write(self) -> MLWriter:
        return _ModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ModelReader()


class _ModelWriter(MLWriter):
    def __init__(self, model: ClaimEncoderModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = SparkSession.getActiveSession()
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        save_preprocessor(spark, self.model.fitted, f"{path}/preprocessor")


class _ModelReader(MLReader):
    def load(self, path: str) -> ClaimEncoderModel:
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = ClaimEncoderModel(load_preprocessor(spark, f"{path}/preprocessor"))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model

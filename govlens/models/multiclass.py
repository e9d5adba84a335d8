"""Boosted trees for three or more classes: one-against-rest models that answer together."""

from __future__ import annotations

import os
from functools import reduce

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, functions as F


class BoostedClasses(Estimator):
    """Fits MLlib's ``OneVsRest`` over a boosted classifier of two classes and combines its parts."""

    @keyword_only
    def __init__(self, *, classifier: GBTClassifier, parallelism: int = 1):
        super().__init__()
        self.classifier, self.parallelism = classifier, parallelism

    def _fit(self, dataset: DataFrame) -> BoostedClassesModel:
        parts = OneVsRest(classifier=self.classifier, featuresCol="features", labelCol="label", parallelism=self.parallelism).fit(dataset)
        return BoostedClassesModel(list(parts.models))


class BoostedClassesModel(Model, MLWritable, MLReadable):
    """Class i's probability is its own model's over the sum of all (equal shares if all are 0); the first largest is predicted."""

    def __init__(self, models: list[Model] | None = None):
        super().__init__()
        self.models = models or []

    @property
    def numClasses(self) -> int:
        return len(self.models)

    @property
    def featureImportances(self) -> DenseVector:
        """The mean of the parts' importances, summing to one (to zero if no part has a split)."""
        mean = np.mean([m.featureImportances.toArray() for m in self.models], axis=0)
        return DenseVector(mean / mean.sum() if mean.sum() else mean)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        out, own = dataset, []
        for i, m in enumerate(self.models):
            part = m.copy()
            for param, name in ((part.rawPredictionCol, "raw"), (part.probabilityCol, "p"), (part.predictionCol, "class")):
                part.set(param, f"_rest_{name}{i}")
            out = part.transform(out)
            own.append(vector_to_array(F.col(f"_rest_p{i}"))[1])
        total = reduce(lambda a, b: a + b, own)
        k = len(own)
        shares = F.array(*[F.when(total > 0, p / total).otherwise(F.lit(1.0 / k)) for p in own])
        out = out.withColumn("_rest_shares", shares) \
            .withColumn("probability", array_to_vector("_rest_shares")) \
            .withColumn("prediction", (F.array_position("_rest_shares", F.array_max("_rest_shares")) - 1).cast("double"))
        return out.drop("_rest_shares", *[f"_rest_{n}{i}" for i in range(k) for n in ("raw", "p", "class")])

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: BoostedClassesModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"parts": len(self.model.models)})
        for i, m in enumerate(self.model.models):
            m.write().save(os.path.join(path, "parts", str(i)))


class _Reader(MLReader):
    def load(self, path: str) -> BoostedClassesModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = BoostedClassesModel([DefaultParamsReader.loadParamsInstance(os.path.join(path, "parts", str(i)), self.sparkSession) for i in range(meta["parts"])])
        model._resetUid(meta["uid"])
        return model

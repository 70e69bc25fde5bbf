"""The extractor and the softmax classifier as Spark ML stages, for ``Pipeline`` and ``PipelineModel.load``."""

from __future__ import annotations

from typing import Any

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textspark.plans.classifier import SoftmaxModel, fit_softmax
from textspark.plans.extractor import FeatureExtractor
from textspark.sources.artefacts import load_json, load_table, save_json, save_table


def _param(name: str, doc: str, kind) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=kind)


class _Writer(MLWriter):
    """Parameters as Spark's own stages store them, and what ``_save`` adds."""

    def __init__(self, stage) -> None:
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage._save(path)


class _Reader(MLReader):
    def __init__(self, kind) -> None:
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage._load(self.sparkSession, path)
        return stage


class _Stored(MLWritable, MLReadable):
    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)

    def _save(self, path: str) -> None:
        """Nothing beside the parameters."""

    def _load(self, spark, path: str) -> None:
        """Nothing beside the parameters."""


class _FeatureParams(Params):
    method = _param("method", "bow, ngram, tfidf, char_tfidf or char_wb_tfidf", TypeConverters.toString)
    maxFeatures = _param("maxFeatures", "most frequent terms kept", TypeConverters.toInt)
    ngramRange = _param("ngramRange", "shortest and longest n-gram", TypeConverters.toListInt)
    minDF = _param("minDF", "documents a term must be in", TypeConverters.toInt)
    maxDF = _param("maxDF", "share of documents a term may be in", TypeConverters.toFloat)
    sublinearTF = _param("sublinearTF", "1 + ln(tf) in place of tf", TypeConverters.toBoolean)
    hanMode = _param("hanMode", "char or bigram", TypeConverters.toString)
    nullToken = _param("nullToken", "what a missing text reads as", TypeConverters.toString)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(method="bow", maxFeatures=5000, ngramRange=[1, 1], minDF=1, maxDF=1.0, sublinearTF=False, hanMode="char", nullToken="")


class TextFeatures(Estimator, _FeatureParams, _Stored):
    """Fits a vocabulary on ``doc_id, sentence_sep``; the model adds vectors ``features``."""

    @keyword_only
    def __init__(self, **params: Any) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "TextFeaturesModel":
        get = self.getOrDefault
        extractor = FeatureExtractor(
            get("method"), get("maxFeatures"), tuple(get("ngramRange")), get("minDF"), get("maxDF"), get("sublinearTF"), get("hanMode"), get("nullToken")
        )
        return self._copyValues(TextFeaturesModel(extractor.fit(dataset)))


class TextFeaturesModel(Model, _FeatureParams, _Stored):
    """Replaces ``sentence_sep`` by ``features``, as a written table: training reads vectors again and again."""

    def __init__(self, extractor: FeatureExtractor | None = None) -> None:
        super().__init__()
        self.extractor = extractor

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.extractor.transform(dataset)

    def _save(self, path: str) -> None:
        self.extractor.save(f"{path}/extractor")

    def _load(self, spark, path: str) -> None:
        self.extractor = FeatureExtractor.load(spark, f"{path}/extractor")


class _SoftmaxParams(Params):
    labelCol = _param("labelCol", "column of class numbers", TypeConverters.toString)
    solver = _param("solver", "lbfgs, sgd or adam", TypeConverters.toString)
    l2 = _param("l2", "weight of the squared weights", TypeConverters.toFloat)
    maxIter = _param("maxIter", "iterations of lbfgs", TypeConverters.toInt)
    lr = _param("lr", "step size of sgd and adam", TypeConverters.toFloat)
    batchSize = _param("batchSize", "documents of a mini-batch", TypeConverters.toInt)
    epochs = _param("epochs", "epochs of sgd and adam", TypeConverters.toInt)
    seed = _param("seed", "of start values and orders", TypeConverters.toInt)

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(labelCol="y", solver="lbfgs", l2=1e-4, maxIter=100, lr=0.03, batchSize=16, epochs=120, seed=42)


class SoftmaxRegression(Estimator, _SoftmaxParams, _Stored):
    """Fits a softmax classifier on ``doc_id, features`` and class numbers from 0."""

    @keyword_only
    def __init__(self, **params: Any) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "SoftmaxRegressionModel":
        get = self.getOrDefault
        train = dataset.withColumn("y", dataset[get("labelCol")].cast("int"))
        shape = train.select(F.max(F.unwrap_udt("features")["size"]).alias("size"), (F.max("y") + 1).alias("classes")).first()
        model = fit_softmax(
            train, None, shape["size"], shape["classes"], get("solver"), get("l2"), get("maxIter"),
            lr=get("lr"), batch_size=get("batchSize"), epochs=get("epochs"), seed=get("seed"),
        )
        return self._copyValues(SoftmaxRegressionModel(model))


class SoftmaxRegressionModel(Model, _SoftmaxParams, _Stored):
    """Adds ``logits`` and the class ``pred`` to ``doc_id, features``."""

    def __init__(self, model: SoftmaxModel | None = None) -> None:
        super().__init__()
        self.model = model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.join(self.model.score(dataset.select("doc_id", "features")), "doc_id")

    def _save(self, path: str) -> None:
        save_table(self.model.weights, f"{path}/weights")
        save_json(self.model.weights.sparkSession, f"{path}/bias", {"bias": self.model.bias})

    def _load(self, spark, path: str) -> None:
        self.model = SoftmaxModel(load_table(spark, f"{path}/weights"), load_json(spark, f"{path}/bias")["bias"])

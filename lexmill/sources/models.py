"""Saving and loading a two-view model."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegressionModel, MultilayerPerceptronClassificationModel
from pyspark.sql import DataFrame, SparkSession

from lexmill.operators.classify import VIEWS
from lexmill.operators.models import TwoViewModel

_CLASSES = {"logistic": LogisticRegressionModel, "perceptron": MultilayerPerceptronClassificationModel}


def save_model(model: TwoViewModel, vocab: DataFrame, root: str) -> None:
    """Both views' classifiers, and the vocabulary they were built from."""
    for view in VIEWS:
        model.classifiers[view].write().overwrite().save(f"{root}/{view}/{model.kind}")
    vocab.write.mode("overwrite").parquet(f"{root}/vocab")
    # Written last: a folder without it is not a complete model.
    spark = vocab.sparkSession
    spark.createDataFrame([(model.kind,)], "kind string").coalesce(1).write.mode("overwrite").json(f"{root}/kind")


def load_model(spark: SparkSession, root: str) -> tuple[TwoViewModel, DataFrame]:
    """The model and its vocabulary; fails if either view is missing."""
    try:
        kind = spark.read.schema("kind string").json(f"{root}/kind").first().kind
        vocab = spark.read.parquet(f"{root}/vocab")
        classifiers = {v: _CLASSES[kind].load(f"{root}/{v}/{kind}") for v in VIEWS}
    except Exception as error:
        if isinstance(error, AnalysisException) or "does not exist" in str(error):
            raise FileNotFoundError(f"no complete model in {root}: train one first") from error
        raise
    return TwoViewModel(vocab, classifiers, kind), vocab

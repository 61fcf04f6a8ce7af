"""A Spark ML baseline classifier that remembers how its texts were cleaned."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import SENTIMENTS
from ..functions.text import profile as known_profile
from .scoring import Model


@dataclass(frozen=True)
class Fitted:
    """A fitted model, the profile its texts were cleaned under, and its class names."""

    model: PipelineModel
    profile: str
    names: tuple[str, ...]
    text_col: str = "clean_text"
    lemmas: Mapping[str, str] | None = None

    def as_model(self) -> Model:
        """The model as jobs take it; they clean texts as its training did."""
        return Model(lambda df: self.predict(df, self.profile), self.profile, self.lemmas, self.names)

    def predict(self, df: DataFrame, profile: str) -> DataFrame:
        """Add ``logits``; refuses texts cleaned under another profile."""
        if profile != self.profile:
            raise ValueError(f"model was trained on {self.profile!r} texts, not {profile!r}")
        scored = self.model.transform(df).withColumn("_z", vector_to_array("rawPrediction"))
        # a class that no training row had gets a logit no other falls below
        absent = F.array_repeat(F.lit(-1e30), F.lit(len(self.names)) - F.size("_z"))
        return scored.select(*df.columns, F.concat("_z", absent).alias("logits"))

    def save(self, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        facts = {"profile": self.profile, "names": list(self.names), "text_col": self.text_col, "lemmas": self.lemmas}
        spark = SparkSession.active()
        spark.createDataFrame([(json.dumps(facts),)], "value string").write.mode(
            "overwrite").text(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Fitted:
        facts = json.loads(spark.read.text(f"{path}/facts").first().value)
        model = PipelineModel.load(f"{path}/model")
        return Fitted(model, facts["profile"], tuple(facts["names"]), facts["text_col"], facts.get("lemmas"))


def baseline(text_col: str, features: int = 1 << 14, max_iter: int = 20) -> Pipeline:
    """Hashed tf-idf and multinomial logistic regression."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text_col, outputCol="_words", pattern=r"\s+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_tfidf"),
        LogisticRegression(featuresCol="_tfidf", labelCol="_y", family="multinomial",
                           maxIter=max_iter, regParam=0.01),
    ])


def fit(
    df: DataFrame, profile: str, text_col: str = "clean_text", label_col: str = "label",
    names: Sequence[str] = SENTIMENTS, estimator: Estimator | None = None,
    lemmas: Mapping[str, str] | None = None,
) -> Fitted:
    """Fit on rows with a text and a label; ``estimator`` may be any Spark ML estimator or grid
    search that reads ``text_col`` and ``_y`` and writes ``rawPrediction``."""
    known_profile(profile)
    rows = df.select(F.col(text_col), F.col(label_col).cast("double").alias("_y")).dropna()
    model = (estimator or baseline(text_col)).fit(rows)
    return Fitted(getattr(model, "bestModel", model), profile, tuple(names), text_col, lemmas)

"""Feature and classifier pipelines on pyspark.ml."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, Normalizer, RegexTokenizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import kept
from .density import density_clusters
from .nearest import nearest
from .svd import SvdEncoder


def text_stages(features: int = 1 << 12) -> list:
    return [
        RegexTokenizer(inputCol="text", outputCol="_words", pattern=r"\W+"),
        HashingTF(inputCol="_words", outputCol="_tf", numFeatures=features),
        IDF(inputCol="_tf", outputCol="_idf"),
        Normalizer(inputCol="_idf", outputCol="features"),
    ]


def fit_encoder(df: DataFrame, size: int = 64, features: int = 1 << 12, seed: int = 13) -> SvdEncoder:
    """Vectors of ``size`` learned from the texts of ``df``."""
    rows = df.filter(F.col("text").isNotNull())
    return SvdEncoder.fit(Pipeline(stages=text_stages(features)).fit(rows), rows, size, seed=seed)


def add_embeddings(df: DataFrame, encoder: SvdEncoder | None = None, name: str | None = None, size: int = 64) -> DataFrame:
    """``embedding`` (array of doubles of length one) and ``embedding_model``; a fitted encoder can be given, else one is fitted on ``df``."""
    rows = df.filter(F.col("text").isNotNull())
    if encoder is None:
        rows = kept(rows)  # a join or an explosion before it is not run again for each step of the fit
    model = encoder or fit_encoder(rows, size)
    return model.transform(rows).select(*df.columns, "embedding", F.lit(name or model.name).alias("embedding_model"))


def predict(df: DataFrame, model, name: str) -> DataFrame:
    """``predictions`` of a fitted model on ``embedding`` and ``prediction_model``."""
    out = model.transform(df.withColumn("features", array_to_vector("embedding")))
    return out.withColumn("predictions", F.col("prediction").cast("int")).withColumn("prediction_model", F.lit(name)).drop("features", "rawPrediction", "prediction")


def fit_logistic(df: DataFrame, reg: float = 0.01):
    return LogisticRegression(labelCol="relevant", maxIter=20, regParam=reg).fit(df.withColumn("features", array_to_vector("embedding")))


def topics(sentences: DataFrame, encoder: SvdEncoder | None = None, size: int = 32, k: int = 10, least: int = 10, levels: int = 8) -> DataFrame:
    """Topic and membership probability of each sentence (id long unique, text): density clusters of learned vectors.

    A topic is named by the smallest id in it, -1 are outliers; sentences without text are left out.
    """
    points = add_embeddings(sentences.select("id", "text"), encoder, size=size).select("id", F.col("embedding").alias("v"))
    return density_clusters(kept(points), k, least, levels)


def knn_classify(train: DataFrame, rows: DataFrame, k: int = 5) -> DataFrame:
    """Majority label among the ``k`` nearest training vectors (ties: the smaller label, then the smaller id), by exact search with pivots."""
    near = nearest(rows.select("id", F.col("embedding").cast("array<double>").alias("v")), train.select("id", F.col("embedding").cast("array<double>").alias("v")), k)
    votes = near.join(train.select(F.col("id").alias("n_id"), "label"), "n_id").groupBy("id", "label").agg(F.count(F.lit(1)).alias("v"))
    return votes.groupBy("id").agg(F.max_by("label", F.struct("v", -F.col("label"))).alias("pred"))

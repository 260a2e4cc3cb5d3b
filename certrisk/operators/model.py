"""Text-and-numbers classifier as an MLlib pipeline."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer,
    VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from certrisk import constants as k
from certrisk.config import DEFAULT, RiskConfig
from certrisk.functions.text import strip_accents
from certrisk.operators.ensemble import ML_TYPE
from certrisk.operators.logistic import class_weights, fit_logistic
from certrisk.operators.vocabulary import gram_vocabulary
from certrisk.session import staged

NUMERIC = tuple(f"x_{name}" for name in k.MODEL_COLUMNS)
MODEL_TYPES = ("logistic", "xgboost", "numbers")


def model_input(df: DataFrame, *keep: str) -> DataFrame:
    """Prepared text and the 38 numbers (NULL counts as 0) of rows with ``features``."""
    return df.select(
        *keep,
        strip_accents(F.lower(F.coalesce("raw_text", F.lit("")))).alias("x_text"),
        *[F.coalesce(F.col(f"features.{n}"), F.lit(0)).cast("double").alias(x)
          for n, x in zip(k.MODEL_COLUMNS, NUMERIC)])


def term_stages() -> list:
    """Words of two or more characters and their 1- to 3-grams."""
    return [
        RegexTokenizer(inputCol="x_text", outputCol="x_words", pattern=r"[\p{L}\p{N}_]{2,}", gaps=False,
                       toLowercase=False),
        NGram(n=2, inputCol="x_words", outputCol="x_pairs"),
        NGram(n=3, inputCol="x_words", outputCol="x_triples"),
        SQLTransformer(statement="SELECT *, concat(x_words, x_pairs, x_triples) AS x_terms FROM __THIS__"),
    ]


def with_words(df: DataFrame) -> DataFrame:
    """Add the words alone, ``x_words``."""
    return term_stages()[0].transform(df)


def with_terms(df: DataFrame) -> DataFrame:
    for stage in term_stages():
        df = stage.transform(df)
    return df


def numeric_scaling(df: DataFrame, columns: tuple[str, ...] = NUMERIC) -> SQLTransformer:
    """Centre by the mean, divide by the population deviation; constants are only centred."""
    sums = []
    for x in columns:
        sums += [F.avg(x).alias(f"m_{x}"), F.stddev_pop(x).alias(f"s_{x}")]
    row = df.agg(*sums).first()
    parts = [
        f"({x} - {row[f'm_{x}']!r}D) / {(row[f's_{x}'] or 1.0)!r}D AS z_{x}" for x in columns]
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


@dataclass
class CertificateModel:
    """A fitted pipeline, its type, and the issuer table its features were made with."""

    pipeline: PipelineModel
    model_type: str
    vocabulary: list[str]
    frequencies: DataFrame | None = None

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` as an array ``[benign, phishing]``."""
        keep = df.columns
        scored = self.pipeline.transform(model_input(df, F.struct(*keep).alias("x_row")))
        p = F.col("probability") if self.model_type == "numbers" else vector_to_array("probability")
        return scored.select("x_row.*", p.alias("probability"))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add ``ml_label`` (1 when the phishing probability exceeds one half) and ``ml``."""
        p = F.col("probability")[1]
        return self.predict_proba(df).withColumns({
            "ml_label": (p > 0.5).cast("int"),
            "ml": F.struct(p.alias("score"), F.lit(self.model_type).alias("model")).cast(ML_TYPE),
        }).drop("probability")

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        if self.frequencies is not None:
            self.frequencies.write.mode("overwrite").parquet(f"{path}/issuers")
        meta = {"model_type": self.model_type, "feature_columns": list(k.MODEL_COLUMNS),
                "vocabulary": self.vocabulary, "has_issuers": self.frequencies is not None}
        spark.createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode(
            "overwrite").text(f"{path}/metadata")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CertificateModel:
        meta = json.loads(spark.read.text(f"{path}/metadata").first()[0])
        issuers = spark.read.parquet(f"{path}/issuers") if meta["has_issuers"] else None
        return cls(PipelineModel.load(f"{path}/pipeline"), meta["model_type"],
                   meta["vocabulary"], issuers)


def _train_numbers(rows: DataFrame, frequencies: DataFrame | None, config: RiskConfig) -> CertificateModel:
    """A logistic model on the scaled numbers alone, solved to the optimum; the text is never read."""
    scaling = numeric_scaling(rows)
    scaled = [f"z_{x}" for x in NUMERIC]
    table = staged(scaling.transform(rows).select("y_true", *scaled), "training-numbers")
    found = fit_logistic(table, scaled, "y_true", 1.0, config.max_iter)
    score = " + ".join([f"{found.intercept!r}D", *[f"{z} * {w!r}D" for z, w in zip(scaled, found.coefficients)]])
    scored = SQLTransformer(statement="SELECT *, array(1 - _p, _p) AS probability FROM "
                                      f"(SELECT *, 1 / (1 + exp(-({score}))) AS _p FROM __THIS__)")
    return CertificateModel(PipelineModel([scaling, scored]), config.model_type, [], frequencies)


def train(
    df: DataFrame, frequencies: DataFrame | None = None, config: RiskConfig = DEFAULT,
) -> CertificateModel:
    """Fit on rows with ``raw_text``, ``features`` and ``y_true`` (rows without a label are left out).

    Text: term counts of the most frequent 1- to 3-grams (ties by term), scaled by smoothed
    inverse document frequency plus one, to unit length. Numbers: standardised.
    Both stay one sparse vector. The text is tokenised once for each length of terms, and once for the vectors.
    The model type "numbers" leaves the text out.
    """
    if config.model_type not in MODEL_TYPES:
        raise ValueError(f"unknown model type: {config.model_type}")
    rows = model_input(df.filter("y_true IS NOT NULL"), "y_true")
    weights = class_weights(rows, "y_true")
    if config.model_type == "numbers":
        return _train_numbers(rows, frequencies, config)
    n = rows.count()
    words = gram_vocabulary(with_words(rows), "x_words", n, config.tfidf_terms, config.tfidf_min_df, config.tfidf_max_df)
    # At most ``tfidf_terms`` rows.
    chosen = words.select("term", "idf").orderBy("position").collect()
    if not chosen:
        raise ValueError("no term is frequent enough and none too frequent")
    counts = CountVectorizerModel.from_vocabulary(
        [r["term"] for r in chosen], inputCol="x_terms", outputCol="x_counts")
    scaling = numeric_scaling(rows)
    stages = term_stages() + [
        counts,
        ElementwiseProduct(inputCol="x_counts", outputCol="x_weighted",
                           scalingVec=Vectors.dense([r["idf"] for r in chosen])),
        Normalizer(inputCol="x_weighted", outputCol="x_tfidf", p=2.0),
        scaling,
        VectorAssembler(inputCols=[f"z_{x}" for x in NUMERIC] + ["x_tfidf"], outputCol="features_vector"),
    ]
    prepared = PipelineModel(stages).transform(rows)
    weight = F.when(F.col("y_true") == 1, weights[1]).otherwise(weights[0])
    # The solver reads the vectors many times; a staged table spares it the text.
    vectors = staged(prepared.select(
        F.col("y_true").cast("double").alias("y_true"), weight.alias("class_weight"),
        "features_vector"), "training-vectors")
    if config.model_type == "logistic":
        # Equal to a penalty of C = 1 on the sum of weighted losses; weights add up to n.
        estimator = LogisticRegression(
            featuresCol="features_vector", labelCol="y_true", weightCol="class_weight",
            maxIter=config.max_iter, regParam=1.0 / n, elasticNetParam=0.0, standardization=False)
    else:
        estimator = GBTClassifier(
            featuresCol="features_vector", labelCol="y_true", maxIter=config.boost_rounds,
            maxDepth=config.boost_depth, seed=config.seed)
    fitted = estimator.fit(vectors)
    return CertificateModel(
        PipelineModel([*stages, fitted]), config.model_type, [r["term"] for r in chosen], frequencies)

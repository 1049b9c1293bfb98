"""Classifiers on text and on vectors, with Spark's own learners."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier
from pyspark.ml.feature import IDF, HashingTF, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import collapse, fold
from ..functions.text import words

#: Dimensions of the hashed n-grams.
SPACE = 1 << 18


def model_text(title: Column, description: Column) -> Column:
    """Title and description as one text, the title's end marked."""
    return collapse(F.concat_ws(". ", F.nullif(F.trim(title), F.lit("")), F.nullif(F.trim(description), F.lit(""))))


def with_grams(df: DataFrame, text: str) -> DataFrame:
    """Adds grams: the text's 1- to 3-character and 1- to 2-word n-grams; null and empty texts have none."""
    t = fold(F.coalesce(F.col(text), F.lit("")))
    df = df.withColumn("_t", t).withColumn("_w", words(F.col("_t")))

    def chars(n: int) -> Column:
        return F.when(F.length("_t") >= n, F.transform(F.sequence(F.lit(1), F.greatest(F.length("_t") - n + 1, F.lit(1))), lambda i: F.concat(F.lit(f"{n}:"), F.substring(F.col("_t"), i, F.lit(n))))).otherwise(F.array().cast("array<string>"))

    two = F.when(F.size("_w") > 1, F.transform(F.sequence(F.lit(1), F.greatest(F.size("_w") - 1, F.lit(1))), lambda i: F.concat(F.lit("w:"), F.array_join(F.slice(F.col("_w"), i, F.lit(2)), " ")))).otherwise(F.array().cast("array<string>"))
    return df.withColumn("grams", F.concat(chars(1), chars(2), chars(3), F.transform("_w", lambda w: F.concat(F.lit("w:"), w)), two)).drop("_t", "_w")


def balanced(df: DataFrame, label: str = "label") -> DataFrame:
    """Adds weight, so that both classes weigh the same."""
    n = F.broadcast(df.agg(F.avg(label).alias("_share")))
    return df.join(n, F.lit(True)).withColumn("weight", F.when(F.col(label) == 1, 0.5 / F.col("_share")).otherwise(0.5 / (1 - F.col("_share")))).drop("_share")


def fit_text(train: DataFrame, text: str = "text", label: str = "label", regularised: float = 1e-3) -> PipelineModel:
    """TF-IDF of hashed n-grams and a logistic regression, fitted on all rows of ``train``; one pass for the document counts, then the learner's passes over sparse vectors."""
    steps = [HashingTF(inputCol="grams", outputCol="tf", numFeatures=SPACE), IDF(inputCol="tf", outputCol="features", minDocFreq=2), LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight", regParam=regularised, maxIter=40)]
    return Pipeline(stages=steps).fit(balanced(with_grams(train, text), label))


def text_scores(model: PipelineModel, df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with score, the probability of class 1."""
    out = model.transform(with_grams(df, text).withColumn("weight", F.lit(1.0)))
    return out.withColumn("score", vector_to_array("probability")[1]).select(*df.columns, "score")


def with_vector(df: DataFrame, array: str, *more: str) -> DataFrame:
    """Adds raw: an array column and further numbers as one vector; rows with a null in them are left out."""
    df = df.filter(F.col(array).isNotNull()).withColumn("_v", array_to_vector(F.transform(array, lambda x: x.cast("double"))))
    return VectorAssembler(inputCols=["_v", *more], outputCol="raw", handleInvalid="skip").transform(df).drop("_v")


def fit_vectors(train: DataFrame, kind: str = "logistic", label: str = "label", classes: int = 2, seed: int = 1) -> PipelineModel:
    """Vectors scaled by the training rows' mean and deviation, then ``logistic``, ``mlp`` or ``trees`` (two classes)."""
    size = len(train.select("raw").first()["raw"])
    learner = {
        "logistic": lambda: LogisticRegression(featuresCol="features", labelCol=label, maxIter=60, regParam=1e-3),
        "mlp": lambda: MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=[size, 32, classes], seed=seed, maxIter=60),
        "trees": lambda: GBTClassifier(featuresCol="features", labelCol=label, maxIter=15, maxDepth=3, seed=seed),
    }[kind]()
    return Pipeline(stages=[StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True), learner]).fit(train)


def few_shot(df: DataFrame, key: str, label: str, each: int, seed: str = "1") -> DataFrame:
    """``each`` rows of every class, in a seeded order."""
    from .evaluation import draw

    return draw(df, [label], key, each, seed).drop("weight")


def combined(change: Column, local: Column, excluded: Column) -> Column:
    """Struct of the ways three probabilities make one."""
    return F.struct(change.alias("change"), (change * local).alias("local"), (change * local * (1 - excluded)).alias("local_kept"), (change * (1 - excluded)).alias("kept"))

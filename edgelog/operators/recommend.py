"""Models trained on tables."""

from __future__ import annotations

from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ratings_text(df: DataFrame, value: str = "value") -> DataFrame:
    """``user item rate`` lines as ratings."""
    p = F.split(value, " ")
    at = lambda i, kind: F.try_element_at(p, F.lit(i)).try_cast(kind)
    return df.select(at(1, "int").alias("user"), at(2, "int").alias("item"), at(3, "double").alias("rating"))


def labeled_points(df: DataFrame, value: str = "value", sep: str = ",") -> DataFrame:
    """``label<sep>f f f`` lines as label and feature vector; the separator is literal.

    Lines that cannot be read are left to :func:`unreadable_points`.
    """
    p = F.split(value, f"\\Q{sep}\\E")
    numbers = F.transform(F.split(F.try_element_at(p, F.lit(2)), " "), lambda x: x.try_cast("double"))
    label = F.try_element_at(p, F.lit(1)).try_cast("double")
    read = df.select(label.alias("label"), numbers.alias("_f"))
    usable = read.where("label IS NOT NULL AND _f IS NOT NULL AND NOT exists(_f, x -> x IS NULL)")
    return usable.select("label", array_to_vector("_f").alias("features"))


def unreadable_points(df: DataFrame, value: str = "value", sep: str = ",") -> DataFrame:
    """The lines :func:`labeled_points` leaves out, with the reason."""
    p = F.split(value, f"\\Q{sep}\\E")
    numbers = F.transform(F.split(F.try_element_at(p, F.lit(2)), " "), lambda x: x.try_cast("double"))
    reason = (
        F.when(F.try_element_at(p, F.lit(1)).try_cast("double").isNull(), F.lit("bad label"))
        .when(numbers.isNull() | F.exists(numbers, lambda x: x.isNull()), F.lit("bad feature"))
    )
    return df.select(F.col(value).alias("raw"), reason.alias("reason")).where("reason IS NOT NULL")


def libsvm(spark: SparkSession, path: str, num_features: int | None = None) -> DataFrame:
    reader = spark.read.format("libsvm")
    if num_features:
        reader = reader.option("numFeatures", str(num_features))
    return reader.load(path)


def als_model(ratings: DataFrame, rank: int = 2, iterations: int = 2, reg: float = 0.02, seed: int = 7):
    """A factor model of ``user, item, rating`` rows; ratings of one pair should be one row."""
    return ALS(
        rank=rank, maxIter=iterations, regParam=reg, seed=seed, userCol="user", itemCol="item",
        ratingCol="rating", coldStartStrategy="drop",
    ).fit(ratings)


def als_items(model, users: DataFrame, n: int = 1) -> DataFrame:
    """The ``n`` items ``model`` ranks first for each of ``users``; users it does not know have none."""
    top = model.recommendForUserSubset(users, n)
    return top.select("user", F.explode("recommendations").alias("r")).select(
        "user", F.col("r.item").alias("item"), F.col("r.rating").cast("double").alias("score")
    )


def als_top(
    ratings: DataFrame, users: DataFrame, n: int = 1, rank: int = 2, iterations: int = 2, reg: float = 0.02,
    seed: int = 7,
) -> DataFrame:
    """:func:`als_items` of a model made from ``ratings``."""
    return als_items(als_model(ratings, rank, iterations, reg, seed), users, n)


def als_error(model, ratings: DataFrame) -> DataFrame:
    """Ratings the model predicts, its mean squared error and that of the mean rating."""
    scored = model.transform(ratings).select(F.col("rating").cast("double").alias("rating"), F.col("prediction").cast("double").alias("prediction"))
    gap = F.col("rating") - F.col("prediction")
    return scored.agg(F.count(F.lit(1)).alias("n"), F.avg(gap * gap).alias("model_error"), F.var_pop("rating").alias("mean_error"))


def cosine_users(ratings: DataFrame, user, digits: int = 6) -> DataFrame:
    """Cosine similarity of one user's ratings with every user's, missing ones being 0.

    Only the asked user is compared, by an equi-join on the item: their side has one row
    per item, so the join emits no more rows than there are ratings.
    """
    known = ratings.groupBy("user", "item").agg(F.avg("rating").alias("rating"))
    own = known.where(F.col("user") == F.lit(user)).select("item", F.col("rating").alias("_own"))
    joined = known.join(own, "item", "left")
    sums = joined.groupBy("user").agg(
        F.sum(F.col("rating") * F.coalesce("_own", F.lit(0.0))).alias("_dot"),
        F.sum(F.col("rating") * F.col("rating")).alias("_norm"),
    )
    own_norm = own.agg(F.sqrt(F.sum(F.col("_own") * F.col("_own")))).scalar()
    score = F.try_divide(F.col("_dot"), F.sqrt(F.col("_norm")) * own_norm)
    return sums.select("user", F.round(score, digits).alias("similarity"))


def naive_bayes(points: DataFrame, smoothing: float = 1.0):
    return NaiveBayes(smoothing=smoothing).fit(points)


def linear_regression(points: DataFrame, iterations: int = 100):
    return LinearRegression(maxIter=iterations).fit(points)


def logistic_regression(points: DataFrame, iterations: int = 50, tol: float = 1e-6):
    return LogisticRegression(maxIter=iterations, tol=tol).fit(points)


def linear_svc(points: DataFrame, iterations: int = 10, reg: float = 0.0, weight: str | None = None):
    """``weight`` names a column of how many points a row stands for.

    With ``reg`` such weights change the scale of features a little, by which the penalty is measured.
    """
    model = LinearSVC(maxIter=iterations, regParam=reg)
    return (model.setWeightCol(weight) if weight else model).fit(points)


def distinct_points(points: DataFrame) -> DataFrame:
    """``label, features, weight``: equal points as one row and their number, for features that take few values."""
    return points.groupBy("label", "features").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def split_points(points: DataFrame, weights=(0.6, 0.4), seed: int = 11) -> list[DataFrame]:
    return points.randomSplit(list(weights), seed)


def accuracy(predictions: DataFrame, prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Share of rows whose prediction is their label."""
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return predictions.agg(F.avg(hit).alias("accuracy"))

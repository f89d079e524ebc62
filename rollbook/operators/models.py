"""Training, scoring and saving classifiers with pyspark.ml.

Text goes through hashed term features of a fixed width, so no vocabulary is gathered on
the driver. Class weights, decision rule and features are passed in.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, NaiveBayes, RandomForestClassifier
from pyspark.ml.feature import HashingTF, RegexTokenizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.functions.vectors import argmax

# Class weights of the two text classifiers.
SEARCH_WEIGHTS = {0: 1.0, 1: 13.0, 2: 25.0}
ARTICLE_WEIGHTS = {0: 1.0, 1: 2.0}


def with_vector(df: DataFrame, values: str, out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(values)))


def decide(scored: DataFrame, decider: Callable[[Column], Column] = argmax) -> DataFrame:
    """Add `scores` (array) and `predicted` by a replaceable rule over the scores."""
    out = scored.withColumn("scores", vector_to_array("probability"))
    return out.withColumn("predicted", decider(F.col("scores")))


def random_forest(
    train: DataFrame, label: str = "label", features: str = "features", trees: int = 20, seed: int = 41
):
    return RandomForestClassifier(
        labelCol=label, featuresCol=features, numTrees=trees, seed=seed
    ).fit(train)


def gaussian_nb(train: DataFrame, label: str = "label", features: str = "features"):
    return NaiveBayes(modelType="gaussian", labelCol=label, featuresCol=features).fit(train)


def class_moments(df: DataFrame, label: str, values: str) -> DataFrame:
    """(label, dim, n, total, squares) of an array column: partial sums that can be added up.

    Rows without a label and values that are null or no number are left out.
    """
    each = df.where(F.col(label).isNotNull()).select(
        F.col(label).alias("label"), F.posexplode(values).alias("dim", "x")
    )
    x = F.col("x").cast("double")
    each = each.where(x.isNotNull() & ~F.isnan(x))
    return each.groupBy("label", "dim").agg(
        F.count("*").alias("n"), F.sum(x).alias("total"), F.sum(x * x).alias("squares")
    )


def merge_moments(*parts: DataFrame) -> DataFrame:
    """The moments of all batches from those of each."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("label", "dim").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])


def moments_model(moments: DataFrame) -> DataFrame:
    """One row: classes, an array of (label, prior, means, variances), labels in order.

    Variances get a billionth of the largest one over all rows, so none is zero. The row grows with
    classes and dimensions only.
    """
    variance = F.greatest(F.col("squares") / F.col("n") - F.pow(F.col("total") / F.col("n"), F.lit(2.0)), F.lit(0.0))
    over_all = moments.groupBy("dim").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")])
    floor = over_all.agg((F.max(variance) * 1e-9).alias("floor"))
    sizes = moments.groupBy("label").agg(F.max("n").alias("rows"))
    total = sizes.agg(F.sum("rows").alias("all"))
    cells = moments.crossJoin(F.broadcast(floor))  # one row
    cells = cells.select("label", "dim", (F.col("total") / F.col("n")).alias("mean"), (variance + F.col("floor")).alias("variance"))
    lists = F.array_sort(F.collect_list(F.struct("dim", "mean", "variance")))
    per_label = cells.groupBy("label").agg(lists.alias("cells")).join(sizes, "label")
    per_label = per_label.crossJoin(F.broadcast(total))  # one row
    parts = F.struct(
        "label",
        F.log(F.col("rows") / F.col("all")).alias("prior"),
        F.col("cells.mean").alias("means"),
        F.col("cells.variance").alias("variances"),
    )
    return per_label.agg(F.array_sort(F.collect_list(parts)).alias("classes"))


def score_moments(df: DataFrame, model: DataFrame, values: str) -> DataFrame:
    """Add `scores`, the log-likelihood of every class with its prior, and `predicted`, the label of
    the largest, of equal ones the least label."""

    def likelihood(c: Column) -> Column:
        cells = F.arrays_zip(F.col(values).alias("x"), c["means"].alias("mean"), c["variances"].alias("variance"))
        term = lambda z: -0.5 * F.log(2.0 * math.pi * z["variance"]) - F.pow(
            z["x"].cast("double") - z["mean"], F.lit(2.0)
        ) / (2.0 * z["variance"])
        return F.aggregate(cells, c["prior"], lambda acc, z: acc + F.coalesce(term(z), F.lit(0.0)))

    scored = df.crossJoin(F.broadcast(model))  # one row
    scored = scored.withColumn("scores", F.transform("classes", likelihood))
    place = F.array_position("scores", F.array_max("scores"))
    return scored.withColumn("predicted", F.get(F.col("classes.label"), (place - 1).cast("int"))).drop("classes")


def one_vs_rest(
    train: DataFrame, labels: Sequence[int], label: str = "label", trees: int = 20, seed: int = 41
) -> dict[int, object]:
    """One binary forest per label; unlike a wrapped estimator they keep their scores."""
    return {
        v: random_forest(
            train.withColumn("_is", (F.col(label) == v).cast("double")), "_is", trees=trees, seed=seed
        )
        for v in labels
    }


def score_one_vs_rest(models: Mapping[int, object], df: DataFrame) -> DataFrame:
    """Add `score_<label>` for every label."""
    for v, model in models.items():
        scored = model.transform(df)
        df = scored.withColumn(f"score_{v}", vector_to_array("probability")[1]).drop(
            "rawPrediction", "probability", "prediction"
        )
    return df


def fit_features(
    train: DataFrame,
    fit: Callable[[DataFrame], object],
    extract_features: Callable[[DataFrame], DataFrame] | None = None,
    balance: Callable[[DataFrame], DataFrame] | None = None,
    label: str = "label",
):
    """`fit` on rows with features and label, after two replaceable steps.

    `extract_features` makes the feature columns of any table, also of those scored later;
    `balance` changes the rows of the training table only, e.g. `weigh_classes`.
    """
    made = extract_features(train) if extract_features else train
    known = made.filter(F.col(label).isNotNull())
    return fit(balance(known) if balance else known)


def weigh_classes(train: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Add weights that give every class the same sum; no row is dropped or repeated."""
    sizes = train.groupBy(label).agg(F.count("*").alias("_n"))
    totals = sizes.agg(F.sum("_n").alias("_all"), F.count("*").alias("_classes"))
    shares = sizes.crossJoin(totals)  # one row of totals
    weight = (F.col("_all") / (F.col("_n") * F.col("_classes"))).alias(out)
    return train.join(shares.select(label, weight), label)


# Words of a text as lower-case runs of letters, digits and '_'.
WORD_PATTERN = r"[^\p{L}\p{N}_]+"


def weighted_text_classifier(
    train: DataFrame,
    text: str,
    label: str,
    weights: Mapping[int, float],
    width: int = 1 << 14,
    iterations: int = 20,
    text_of: Callable[[DataFrame], Column] | None = None,
    params: Mapping[str, object] | None = None,
) -> PipelineModel:
    """Class-weighted logistic regression on hashed terms.

    `text_of` gives the text to tokenize from the other columns; it is written to `text`, so apply
    it to tables that are scored as well. `params` are further settings of the regression.
    """
    if text_of is not None:
        train = train.withColumn(text, text_of(train))
    w = F.lit(1.0)
    for k, v in weights.items():
        w = F.when(F.col(label) == k, F.lit(float(v))).otherwise(w)
    settings = {"maxIter": iterations, "regParam": 0.01, **(params or {})}
    stages = [
        RegexTokenizer(inputCol=text, outputCol="_words", pattern=WORD_PATTERN),
        HashingTF(inputCol="_words", outputCol="features", numFeatures=width),
        LogisticRegression(labelCol=label, weightCol="_weight", **settings),
    ]
    return Pipeline(stages=stages).fit(train.withColumn("_weight", w))


def save_model(model, path: str) -> None:
    """Model and its feature stages in one place."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def batch_infer(df: DataFrame, model: PipelineModel) -> DataFrame:
    """Score a whole table with a loaded model."""
    return decide(model.transform(df))

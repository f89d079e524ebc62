"""Classifier evaluation from label pairs and scores.

Label pairs are folded to the confusion cells first, so everything after one aggregation
works on labels x labels rows. Curves are folded to one row per distinct score and summed
in two levels (`ordered.running_totals`).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollbook.operators.ordered import quantile_buckets, running_totals


def label_counts(df: DataFrame, label: str, split: str) -> DataFrame:
    """Rows per label for all rows and per split."""
    per = df.groupBy(split, label).agg(F.count("*").alias("n"))
    both = F.explode(F.array(F.lit("all"), F.col(split)))
    return (
        per.withColumn("part", both).groupBy("part", label).agg(F.sum("n").alias("n"))
    )


def confusion_cells(df: DataFrame, y: str, p: str) -> DataFrame:
    return df.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count("*").alias("n"))


def confusion_matrix(df: DataFrame, y: str, p: str, labels: Sequence[Any]) -> DataFrame:
    """One row per true label, one column `pred_<label>` per label; empty cells are 0."""
    spark = df.sparkSession
    kind = dict(df.dtypes)[y]
    rows = spark.range(1).select(
        F.explode(F.array(*[F.lit(v).cast(kind) for v in labels])).alias("y")
    )
    cells = confusion_cells(df, y, p)
    wide = cells.groupBy("y").agg(
        *[F.sum(F.when(F.col("p") == F.lit(v), F.col("n"))).alias(f"pred_{v}") for v in labels]
    )
    names = [f"pred_{v}" for v in labels]
    return rows.join(wide, "y", "left").select(
        "y", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in names]
    )


def _per_label(df: DataFrame, y: str, p: str) -> DataFrame:
    """(label, tp, predicted, support) from the confusion cells."""
    cells = confusion_cells(df, y, p)
    sides = F.array(
        F.struct(
            F.col("y").alias("label"),
            F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("tp"),
            F.lit(0).cast("bigint").alias("predicted"),
            F.col("n").alias("support"),
        ),
        F.struct(
            F.col("p").alias("label"),
            F.lit(0).cast("bigint").alias("tp"),
            F.col("n").alias("predicted"),
            F.lit(0).cast("bigint").alias("support"),
        ),
    )
    return cells.select(F.inline(sides)).groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"), F.sum("support").alias("support")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def class_report(df: DataFrame, y: str, p: str) -> DataFrame:
    """Precision, recall, F1 and support per label, plus 'macro avg' and 'weighted avg'."""
    per = _per_label(df, y, p)
    precision = _ratio(F.col("tp"), F.col("predicted"))
    recall = _ratio(F.col("tp"), F.col("support"))
    scored = per.select(
        F.col("label").cast("string").alias("label"),
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )
    measures = ("precision", "recall", "f1")
    macro = scored.agg(
        F.lit("macro avg").alias("label"),
        *[F.avg(m).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    weighted = scored.agg(
        F.lit("weighted avg").alias("label"),
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    return scored.unionByName(macro).unionByName(weighted)


def accuracy_f1(df: DataFrame, y: str, p: str) -> DataFrame:
    """Accuracy and support-weighted F1 in one row."""
    per = _per_label(df, y, p)
    f1 = _ratio(2 * F.col("tp"), F.col("predicted") + F.col("support"))
    return per.agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        (F.sum(f1 * F.col("support")) / F.sum("support")).alias("f1"),
    )


def misclassified(df: DataFrame, position: str, kinds: Mapping[str, Column]) -> DataFrame:
    """(kind, position) of each error, as rows; one row can be of several kinds."""
    tags = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in kinds.items()]))
    return df.select(F.explode(tags).alias("kind"), position)


def search_errors(y: str, p: str) -> dict[str, Column]:
    """Three-label errors: relevant taken for irrelevant; wrongly taken for relevant."""
    t, q = F.col(y), F.col(p)
    return {"missed_relevant": (t == 2) & (q == 0), "false_relevant": (q == 2) & (t != q)}


def article_errors(y: str, p: str) -> dict[str, Column]:
    """Two-label errors."""
    t, q = F.col(y), F.col(p)
    return {"missed_relevant": (t == 1) & (t != q), "false_relevant": (t == 0) & (t != q)}


def _by_score(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """One row per distinct score with its positives and negatives, in score buckets."""
    hit = F.when(positive, 1).otherwise(0).cast("bigint")
    folded = df.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(hit).alias("pos"), F.sum(1 - hit).alias("neg")
    )
    return quantile_buckets(folded, "threshold")


def _curve(df: DataFrame, score: str, positive: Column) -> DataFrame:
    return running_totals(
        _by_score(df, score, positive),
        [F.col("threshold").desc()],
        {"tp": F.col("pos"), "fp": F.col("neg")},
        descending=True,
    )


def roc_curve(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """(threshold, fpr, tpr, gap) for every distinct score, gap = |fpr + tpr - 1|."""
    fpr, tpr = _ratio(F.col("fp"), F.col("fp_total")), _ratio(F.col("tp"), F.col("tp_total"))
    return _curve(df, score, positive).select(
        "threshold", fpr.alias("fpr"), tpr.alias("tpr"), F.abs(fpr + tpr - 1).alias("gap")
    )


def roc_auc(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule, in one row."""
    c = _curve(df, score, positive)
    # the step of one score: its negatives wide, from tp - pos up to tp high
    strip = F.col("neg") * (F.col("tp") - F.col("pos") / 2.0)
    area = c.agg(
        F.sum(strip).alias("_area"), F.max("tp_total").alias("_p"), F.max("fp_total").alias("_n")
    )
    return area.select(_ratio(F.col("_area"), F.col("_p") * F.col("_n")).alias("auc"))


def pr_curve(df: DataFrame, score: str, positive: Column) -> DataFrame:
    """(threshold, precision, recall) for every distinct score."""
    return _curve(df, score, positive).select(
        "threshold",
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp_total")).alias("recall"),
    )


def text_length_box(df: DataFrame, text: str, label: str) -> DataFrame:
    """Words per text as box-plot numbers by label (exact quartiles).

    Texts are folded to (label, words, count) first; the percentile weighs by count.
    """
    n = F.size(F.filter(F.split(text, r"\s+"), lambda w: w != ""))
    sizes = df.select(label, n.alias("words")).groupBy(label, "words").agg(F.count("*").alias("n"))
    q = [F.percentile("words", p, F.col("n")).alias(f"q{int(p * 100)}") for p in (0.25, 0.5, 0.75)]
    return sizes.groupBy(label).agg(
        F.sum("n").alias("texts"), F.min("words").alias("low"), *q, F.max("words").alias("high")
    )



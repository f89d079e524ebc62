"""Naive Bayes from class moments against the library's model, batch by batch."""

import random

from rollbook.operators import models


def test_agrees_with_the_library_and_merges(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(i % 3, 1 + i % 2) for _ in range(6)] + [1.0], i % 3) for i in range(600)]
    df = spark.createDataFrame(rows, "i int, v array<double>, label int")
    parts = [models.class_moments(df.where(f"i % 4 = {k}"), "label", "v") for k in range(4)]
    model = models.moments_model(models.merge_moments(*parts))
    got = {r.i: (r.predicted, r.scores) for r in models.score_moments(df, model, "v").collect()}
    fitted = models.gaussian_nb(models.with_vector(df, "v"))
    want = {r.i: r.prediction for r in fitted.transform(models.with_vector(df, "v")).collect()}
    assert sum(got[i][0] == want[i] for i in want) == len(want)
    whole = models.moments_model(models.class_moments(df, "label", "v"))
    again = {r.i: r.scores for r in models.score_moments(df, whole, "v").collect()}
    assert all(abs(a - b) < 1e-6 for i in again for a, b in zip(again[i], got[i][1]))


def test_nulls_and_ties(spark):
    rows = [([1.0, None], 0), ([None, 2.0], 1), ([1.0, 2.0], 1), (None, 0), ([float("nan"), 2.0], 0), ([1.0, 2.0], None)]
    df = spark.createDataFrame(rows, "v array<double>, label int")
    moments = models.class_moments(df, "label", "v")
    assert {(r.label, r.dim): r.n for r in moments.collect()} == {(0, 0): 1, (0, 1): 1, (1, 0): 1, (1, 1): 2}
    scored = models.score_moments(df, models.moments_model(moments), "v").collect()
    assert len(scored) == 6
    assert models.moments_model(moments.limit(0)).collect()[0].classes == []

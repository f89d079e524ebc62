"""Small numeric vector functions on array Columns."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def label_binarize(label: Column, labels: Sequence[Any]) -> Column:
    """Label -> array of 0/1, one place per known label."""
    return F.array(*[(label == F.lit(v)).cast("int") for v in labels])


def dict_vector(m: Column, vocabulary: Sequence[str], absent: Any = 0) -> Column:
    """Map -> values over the sorted key vocabulary; absent keys get `absent`."""
    keys = F.array(*[F.lit(k) for k in sorted(set(vocabulary))])
    return F.transform(keys, lambda k: F.coalesce(F.try_element_at(m, k), F.lit(absent)))


def softmax(logits: Column) -> Column:
    """Logits -> probabilities, shifted by the largest logit."""
    top = F.array_max(logits)
    e = F.transform(logits, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / total)


def argmax(values: Column) -> Column:
    """0-based place of the first largest value."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")

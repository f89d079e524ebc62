"""Row filters as Column predicates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def present(c: Column) -> Column:
    """Not null and not empty."""
    return c.isNotNull() & (c != "")


def due_days(key: Column, days_min: int, days_max: int, seed: int = 0) -> Column:
    """Waiting days of one row, spread over [min, max] by a repeatable hash of its key."""
    if days_min == days_max:
        return F.lit(days_min)
    width = days_max - days_min + 1
    return (F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(width)) + days_min).cast("int")


def stale(
    last_check: Column,
    key: Column,
    as_of: dt.datetime,
    days_min: int,
    days_max: int,
    seed: int = 0,
) -> Column:
    """Never checked, or checked longer ago than the row's waiting days."""
    days = due_days(key, days_min, days_max, seed)
    limit = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(days)
    return last_check.isNull() | (last_check.cast("timestamp_ntz") < limit)


def needs_refresh(
    linked: Column,
    last_search: Column,
    last_update: Column,
    key: Column,
    as_of: dt.datetime,
    days_min: int,
    days_max: int,
    literal: bool = False,
) -> Column:
    """Due by the time of the last search, and not a linked row whose update is still fresh.

    `literal` skips linked rows whose update is due instead, which is what the rule says word by
    word in older code and keeps fresh rows busy.
    """
    searched = stale(last_search, key, as_of, days_min, days_max)
    updated = stale(last_update, key, as_of, days_min, days_max)
    skipped = F.coalesce(linked, F.lit(False)) & (updated if literal else ~updated)
    return searched & ~skipped


def affiliated(
    affiliation: Column,
    email_domain: Column,
    names: Sequence[str],
    excluded: Sequence[str],
    domains: Sequence[str],
) -> Column:
    """Affiliation names the institution and not a namesake, or the mail domain does."""

    def any_of(c: Column, terms: Sequence[str]) -> Column:
        out = F.lit(False)
        for t in terms:
            out = out | F.lower(c).contains(t.lower())
        return F.coalesce(out, F.lit(False))

    return (any_of(affiliation, names) & ~any_of(affiliation, excluded)) | any_of(
        email_domain, domains
    )


def likely_candidates(
    candidates: DataFrame,
    linked: DataFrame,
    name: str = "name",
    min_overlap: int = 2,
    min_similarity: float = 0.95,
) -> DataFrame:
    """Candidates with enough shared stems and a near-equal name, not linked already."""
    likely = candidates.filter(
        (F.size("overlap") >= min_overlap) & (F.col("name_similarity") > min_similarity)
    )
    return likely.join(linked.select(name).distinct(), name, "left_anti")


def non_empty_map(c: Column) -> Column:
    return F.size(c) > 0

"""Joins of a large table with a keyed lookup table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Largest number of lookup rows that go to every task.
MOST_FREQUENT = 200_000


def lookup_join(facts: DataFrame, lookup: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Join ``facts`` with ``lookup`` (unique ``key``).

    A settled lookup table has an exact size, by which Spark broadcasts it or shuffles both
    sides; adaptive execution then splits the tasks of a hot key. Callers count equal facts
    first, so that a hot key has a row per document at most.
    """
    return facts.join(lookup, key, how)


def frequent_from(lookup: DataFrame, weight: str, most: int) -> float:
    """The least ``weight`` that about ``most`` keys have; more than that share it only by ties and estimation."""
    weighed = lookup.where(F.col(weight).isNotNull())
    keys = weighed.count()
    if keys <= most:
        return float("-inf")
    # Errs by one in 10,000 keys; ties at the cut are left out.
    return weighed.agg(F.percentile_approx(weight, 1.0 - most / keys, F.lit(10_000))).first()[0]


def weighted_join(facts: DataFrame, lookup: DataFrame, key: str, weight: str, most: int = MOST_FREQUENT) -> DataFrame:
    """Inner join of ``facts`` with ``lookup`` (unique ``key``), whose ``weight`` says how often a key occurs.

    About ``most`` keys, the most frequent ones, go to every task; only facts of rarer keys are
    shuffled. ``facts`` are read twice if there are any, and ``lookup`` should be stored.
    """
    above = frequent_from(lookup, weight, most)
    if above == float("-inf"):
        return facts.join(F.broadcast(lookup.drop(weight)), key)
    frequent = F.coalesce(F.col(weight) > above, F.lit(False))
    often, seldom = F.broadcast(lookup.where(frequent).drop(weight)), lookup.where(~frequent).drop(weight)
    rest = facts.join(often.select(key), key, "left_anti")
    return facts.join(often, key).unionByName(rest.join(seldom, key))

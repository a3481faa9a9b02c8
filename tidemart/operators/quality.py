"""Reject splits, cleaning rules and key checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.functions.scalars import mixed_date
from tidemart.schemas import (
    COMMERCE_ALSO_REQUIRED, COMMERCE_DATES, COMMERCE_KEYS, COMMERCE_LOWERED, COMMERCE_NOT_BELOW_ZERO,
)


class Split(NamedTuple):
    kept: DataFrame
    rejected: DataFrame


def split_on_key(df: DataFrame, key: str) -> Split:
    """Rows with the key, and rows without it."""
    has_key = F.col(key).isNotNull()
    return Split(df.filter(has_key), df.filter(~has_key))


@dataclass(frozen=True)
class Rule:
    """What cleaning does to a table, beyond dropping exact copies."""

    dates: Sequence[str] = ()
    lowered: Sequence[str] = ()
    required: Sequence[str] = ()
    flag_below_zero: str | None = None


RULES: Mapping[str, Rule] = {
    name: Rule(
        COMMERCE_DATES.get(name, ()),
        COMMERCE_LOWERED.get(name, ()),
        (key, *COMMERCE_ALSO_REQUIRED.get(name, ())),
        COMMERCE_NOT_BELOW_ZERO.get(name),
    )
    for name, key in COMMERCE_KEYS.items()
}


def clean(df: DataFrame, rule: Rule) -> DataFrame:
    """Drop exact copies, then normalise, require and flag.

    Copies are compared before normalising, so rows that only become equal by
    it both stay. A missing amount is not flagged.
    """
    rows = df.dropDuplicates()
    changed = {c: mixed_date(c) for c in rule.dates} | {c: F.lower(c) for c in rule.lowered}
    if rule.flag_below_zero:
        changed["negative_amount_flag"] = F.coalesce(F.col(rule.flag_below_zero) < 0, F.lit(False))
    if rule.required:
        rows = rows.dropna(subset=list(rule.required))
    return rows.withColumns(changed) if changed else rows


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Key values that are missing in part or occur more than once."""
    missing = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in key))
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(missing | (F.col("copies") > 1))


def reference_violations(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose reference is set but has no parent."""
    parents = parent.select(F.col(parent_key).alias(column))
    return child.filter(F.col(column).isNotNull()).join(parents, column, "left_anti")


def orphans(child: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    """Child rows without a parent; a missing reference counts as one."""
    return child.join(parent.select(key), key, "left_anti").select(*child.columns)


def too_long(df: DataFrame, limits: Mapping[str, int]) -> DataFrame:
    """How many values of each column exceed its declared length."""
    counts = df.agg(*(F.count_if(F.length(c) > n).alias(c) for c, n in limits.items()))
    return counts.unpivot([], list(limits), "column_name", "too_long")


def reject_measures(key: str) -> tuple[Column, Column]:
    """How many rows there are, and how many of them lack the key."""
    return F.count(F.lit(1)).alias("row_count"), F.count_if(F.col(key).isNull()).alias("rejected_count")


def reject_counts(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Rows and rejected rows per table, one pass over each."""
    parts = [df.agg(F.lit(name).alias("table_name"), *reject_measures(key)) for name, (df, key) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def lower_names(df: DataFrame) -> DataFrame:
    """Column names in lower case; two names that become equal are an error."""
    names = [c.lower() for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"column names collide in lower case: {sorted(df.columns)}")
    return df.toDF(*names)

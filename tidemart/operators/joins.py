"""Joins whose null rules or skew need a word."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.session import pin


def not_in(left: DataFrame, key: str, right: DataFrame, right_key: str | None = None) -> DataFrame:
    """Rows of ``left`` with ``key NOT IN (SELECT right_key FROM right)``.

    SQL's rule: one null on the right empties the answer, and a null key is
    kept only when the right side is empty. The right side is evaluated once,
    down to its distinct keys, so a key held by most of it is collapsed before
    the shuffle; null tests and a plain anti join read that table.
    """
    known = pin(right.select(F.col(right_key or key).alias(key)).distinct(), "keys")
    has_null = known.filter(F.col(key).isNull()).limit(1).exists()
    is_empty = ~known.limit(1).exists()
    return left.filter(~has_null).filter(F.col(key).isNotNull() | is_empty).join(known, key, "left_anti")


def exists_in(left: DataFrame, key: str, right: DataFrame) -> DataFrame:
    """Rows of ``left`` whose key occurs on the right (``IN``), without copies."""
    return left.join(right.select(key).distinct(), key, "left_semi")

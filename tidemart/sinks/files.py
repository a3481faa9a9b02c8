"""Parquet and CSV outputs. Every write replaces what was there, unless told to append."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_partitioned(df: DataFrame, path: str, *by: str, mode: str = "overwrite", codec: str | None = None) -> None:
    """Parquet folders by the given columns; with mode ``append`` beside what is there.

    Rows are first brought together by folder, so a folder gets few files; the
    rebalance hint lets Spark split a folder that holds much of the table over
    several tasks.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path, compression=codec)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", codec: str | None = None) -> None:
    df.write.mode(mode).parquet(path, compression=codec)


def write_csv(df: DataFrame, path: str, single_file: bool = False, codec: str | None = None) -> None:
    """CSV with a header; ``single_file`` only for results of a known small size."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").csv(path, header=True, compression=codec)


def write_summaries(tables: Mapping[str, DataFrame], folder: str, small: frozenset[str] = frozenset()) -> None:
    """Each table under ``summary_<name>``; those named in ``small`` as one file."""
    for name, df in tables.items():
        write_csv(df, f"{folder}/summary_{name}", single_file=name in small)


def write_rejects(tables: Mapping[str, DataFrame], folder: str) -> None:
    """Rejected rows per table; the caller names only tables that have some."""
    for name, df in tables.items():
        write_csv(df, f"{folder}/rejected/{name}")

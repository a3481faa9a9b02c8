"""Retail tables as literal rows, views, or JDBC tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.plans.retail import Retail
from tidemart.schemas import RETAIL


def literal_table(spark: SparkSession, name: str, rows: Sequence[tuple]) -> DataFrame:
    """A retail table from rows in the program, for fixtures and small lookups."""
    return spark.createDataFrame(list(rows), RETAIL[name])


def register(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Make tables known to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")


def retail_from_parquet(spark: SparkSession, folder: str) -> Retail:
    """Retail tables stored one Parquet folder each."""
    return Retail(**{n: spark.read.schema(s).parquet(f"{folder}/{n}") for n, s in RETAIL.items()})


def jdbc_table(spark: SparkSession, options: Mapping[str, str], table: str, *, key: str | None = None,
               bounds: tuple[int, int] | None = None, partitions: int | None = None) -> DataFrame:
    """A database table, read in parallel ranges of ``key`` when bounds are given.

    Filters on the result are pushed to the database.
    """
    reader = spark.read.format("jdbc").options(**options).option("dbtable", table)
    if key and bounds and partitions:
        reader = reader.options(
            partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(partitions)
        )
    return reader.load()


def after_mark(df: DataFrame, key: str, mark: int, limit: int = 100) -> DataFrame:
    """The next ``limit`` rows in key order behind the mark.

    The mark is a filter on the key, which Parquet and JDBC scans push down, so
    a poll never pages through what was read before.
    """
    return df.filter(F.col(key) > mark).orderBy(key).limit(limit)


class KeysetReader:
    """Polls a table in key order and remembers how far it got.

    The mark lives in a small table in a shared folder. ``commit`` is called
    after the rows are safely passed on, so a failure in between repeats rows
    and loses none.
    """

    def __init__(self, table: DataFrame, key: str, state: str) -> None:
        self.table, self.key, self.state = table, key, state

    def mark(self) -> int:
        try:
            marks = self.table.sparkSession.read.schema("mark BIGINT").parquet(self.state)
        except AnalysisException:
            return 0  # nothing committed yet
        return marks.agg(F.coalesce(F.max("mark"), F.lit(0))).first()[0]

    def poll(self, limit: int = 100) -> DataFrame:
        return after_mark(self.table, self.key, self.mark(), limit)

    def commit(self, rows: DataFrame) -> bool:
        """Advance past ``rows``; false when there were none."""
        reached = rows.agg(F.max(self.key).cast("bigint").alias("mark"))
        if reached.first()[0] is None:
            return False
        reached.write.mode("append").parquet(self.state)
        return True


def replay(reader: KeysetReader, publish: Callable[[DataFrame], None], limit: int = 100) -> int:
    """Publish what is new, poll by poll, until a poll comes back empty."""
    polls = 0
    while True:
        rows = reader.poll(limit).persist()
        publish(rows)
        more = reader.commit(rows)
        rows.unpersist()
        if not more:
            return polls
        polls += 1

"""Commerce CSV files, read by header name and cast to their schema."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemart.operators.quality import Split, reject_measures, split_on_key
from tidemart.schemas import COMMERCE, COMMERCE_KEYS, REJECT_COUNTS
from tidemart.session import SMALLEST, pin, unpin


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV file with a header, in the schema's columns and order.

    Everything is read as text and matched by name, so the file's column order
    is free; text that does not fit a type becomes null. ``path`` may be a
    folder whose files have their columns in different orders: files are
    grouped by their header line, and each group is read with its own.
    """
    groups = _by_header(spark, path)
    parts = [_read_group(spark, files, schema) for files in groups]
    text = parts[0]
    for part in parts[1:]:
        text = text.unionByName(part)
    return text


def _by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """Files below ``path`` grouped by their first line.

    What comes to the driver is a list of file names, as in any listing of a
    folder. A single file needs no look at its header.
    """
    every = spark.read.text(path)
    if len(every.inputFiles()) < 2:
        return [[path]]
    lines = every.where("_metadata.file_block_start = 0")
    firsts = lines.select(F.col("_metadata.file_path").alias("file"), "value").groupBy("file").agg(
        F.first("value").alias("header")
    )
    groups = firsts.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [g.files for g in groups] or [[path]]


def _read_group(spark: SparkSession, files: list[str], schema: StructType) -> DataFrame:
    text = spark.read.csv(files, header=True, mode="PERMISSIVE")
    return text.select(*(F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema))


def read_commerce_table(spark: SparkSession, path: str, name: str) -> Split:
    """One commerce table, split on its key."""
    return split_on_key(read_csv(spark, path, COMMERCE[name]), COMMERCE_KEYS[name])


@dataclass(frozen=True)
class Landed:
    """A table after its one parse: rows by whether they have their key, and how many there are."""

    kept: DataFrame
    rejected: DataFrame
    row_count: int
    rejected_count: int
    stored: DataFrame

    def drop(self) -> None:
        """Delete the files, once no output needs them."""
        unpin(self.stored)


def land(df: DataFrame, key: str, label: str) -> Landed:
    """Write ``df`` once to the shared folder, counting rows and rejected rows on the way.

    The counts are observed in the tasks that write, which no shuffle precedes:
    a task that is run again counts once. Whatever comes later reads the
    Parquet files, where a filter on the key skips row groups without (or with
    only) nulls, so text is split and cast one time however many outputs use it.
    """
    counts = Observation()
    stored = pin(df.observe(counts, *reject_measures(key)), label, SMALLEST)
    split = split_on_key(stored, key)
    seen = counts.get
    return Landed(split.kept, split.rejected, seen["row_count"], seen["rejected_count"], stored)


@dataclass(frozen=True)
class Intake:
    """The commerce tables, each parsed once."""

    spark: SparkSession
    tables: dict[str, Landed]

    @property
    def kept(self) -> dict[str, DataFrame]:
        return {name: table.kept for name, table in self.tables.items()}

    @property
    def rejected(self) -> dict[str, DataFrame]:
        """Rejected rows of the tables that have any."""
        return {name: table.rejected for name, table in self.tables.items() if table.rejected_count}

    def rejects(self) -> DataFrame:
        """Rows and rejected rows per table, from the counts of the pass that wrote them."""
        counts = [(name, table.row_count, table.rejected_count) for name, table in self.tables.items()]
        return self.spark.createDataFrame(counts, REJECT_COUNTS)


def land_commerce_table(spark: SparkSession, path: str, name: str) -> Landed:
    return land(read_csv(spark, path, COMMERCE[name]), COMMERCE_KEYS[name], f"csv-{name}")


def read_commerce_folder(spark: SparkSession, folder: str) -> Intake:
    return Intake(spark, {name: land_commerce_table(spark, f"{folder}/{name}.csv", name) for name in COMMERCE})

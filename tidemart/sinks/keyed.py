"""Keyed tables: a later write of a key replaces the earlier one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StringType, StructField, StructType

from tidemart.schemas import Contract
from tidemart.session import children, delete, exists

_BATCHES = "batches"
#: So many neighbouring folders of like size become one.
FAN = 8


class KeyedTable:
    """A Parquet table with a key, written batch by batch.

    Each batch is its own folder ``batches=n-n``, replaced as a whole when the
    batch is replayed after a failure, so a replay changes nothing. Reading
    takes, per key, the row of the latest batch; the aggregation combines
    before it shuffles, so a key written again and again costs one row.

    An upsert merges ``FAN`` neighbouring folders of one size class into one
    folder ``batches=first-last`` with a row per key, so there are as many
    folders as the logarithm of the batches, and each row is rewritten as
    often. Only batches before the one being written are merged: these are
    committed and never replayed. A merged folder counts once it is complete,
    and hides the folders it covers; these are deleted one upsert later, when
    readers that had listed them are done. A failure in between leaves either
    the old folders or both.
    """

    def __init__(self, spark: SparkSession, path: str, contract: Contract) -> None:
        self.spark, self.path, self.contract = spark, path, contract

    def _folder(self, first: int, last: int) -> str:
        return f"{self.path}/{_BATCHES}={first}-{last}"

    def _complete(self) -> list[tuple[int, int]]:
        ranges = [c.split("=")[1].split("-") for c in children(self.spark, self.path) if c.startswith(f"{_BATCHES}=")]
        return sorted((int(a), int(b)) for a, b in ranges if exists(self.spark, f"{self._folder(int(a), int(b))}/_SUCCESS"))

    def folders(self) -> list[tuple[int, int]]:
        """First and last batch of each folder that counts."""
        every = self._complete()
        return [r for r in every if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in every)]

    def upsert(self, rows: DataFrame, batch_id: int) -> None:
        if any(a <= batch_id <= b and a < b for a, b in self.folders()):
            raise ValueError(f"batch {batch_id} has been merged with others already")
        columns = (F.col(f.name).cast(f.dataType).alias(f.name) for f in self.contract.schema)
        rows.select(*columns).write.mode("overwrite").parquet(self._folder(batch_id, batch_id))
        self._merge(batch_id)

    def _merge(self, before: int) -> None:
        counted = self.folders()
        for covered in set(self._complete()) - set(counted):
            delete(self.spark, self._folder(*covered))
        older = [r for r in counted if r[1] < before]
        while len(last := older[-FAN:]) == FAN and len({_size_class(a, b) for a, b in last}) == 1:
            whole = (last[0][0], last[-1][1])
            self._read(last).write.mode("overwrite").parquet(self._folder(*whole))
            older = [*older[:-FAN], whole]

    def _read(self, folders: list[tuple[int, int]]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.contract.schema)
        stored = StructType([*self.contract.schema.fields, StructField(_BATCHES, StringType())])
        rows = self.spark.read.schema(stored).option("basePath", self.path).parquet(*(self._folder(a, b) for a, b in folders))
        last = F.split_part(_BATCHES, F.lit("-"), F.lit(2)).cast("long")
        return latest_per_key(rows.withColumn(_BATCHES, last), self.contract, _BATCHES)

    def read(self) -> DataFrame:
        return self._read(self.folders())

    def rewritten(self, path: str, batch_id: int) -> KeyedTable:
        """The current rows as one batch of a new table, say to move it.

        Later batches go on from ``batch_id`` there; this table stays as it is.
        """
        fresh = KeyedTable(self.spark, path, self.contract)
        fresh.upsert(self.read(), batch_id)
        return fresh

    def stored_batch(self, batch_id: int) -> DataFrame:
        """What one batch wrote, until it is merged."""
        return self.spark.read.schema(self.contract.schema).parquet(self._folder(batch_id, batch_id))

    def sink(self, rows: DataFrame, checkpoint: str, mode: str = "append") -> DataStreamWriter:
        """A stream writer that upserts each micro-batch; the caller starts it."""
        return (
            rows.writeStream.outputMode(mode)
            .option("checkpointLocation", checkpoint)
            .foreachBatch(lambda batch, batch_id: self.upsert(batch, batch_id))
        )


def _size_class(first: int, last: int) -> int:
    """How many times ``FAN`` goes into the number of batches."""
    batches, level = last - first + 1, 0
    while batches >= FAN:
        batches, level = batches // FAN, level + 1
    return level


def latest_per_key(rows: DataFrame, contract: Contract, version: str) -> DataFrame:
    """One row per key: the one of the highest version, then of the highest values."""
    others = [c for c in contract.schema.names if c not in contract.key]
    best = F.max(F.struct(version, *others)).alias("_row")
    picked = rows.groupBy(*contract.key).agg(best)
    return picked.select(*(F.col(c) if c in contract.key else F.col(f"_row.{c}") for c in contract.schema.names))


def recent(table: DataFrame, contract: Contract, limit: int, symbol: str | None = None) -> DataFrame:
    """The first ``limit`` rows of one symbol, or of all, in the table's own order."""
    rows = table if symbol is None else table.filter(F.col("symbol") == symbol)
    if contract.order is None:
        return rows.orderBy(*contract.key).limit(limit)
    order = F.desc(contract.order) if contract.newest_first else F.asc(contract.order)
    lead = ["symbol"] if symbol is None else []
    return rows.orderBy(*lead, order).limit(limit)


def of_symbols(table: DataFrame, symbols: Sequence[str] | None = None) -> DataFrame:
    """All rows, or those of the named symbols."""
    return table if not symbols else table.filter(F.col("symbol").isin(*symbols))

"""A Parquet table as a stream in ranges of a growing key.

The offset is the largest key read so far, and Spark keeps it in the query's own
checkpoint: there is no table of marks beside it. A micro-batch is the range of
keys behind the offset, cut by the row groups whose statistics meet it, so its
rows are read by many tasks and none pass through the driver. A batch that fails
is read again as the same range.

Keys are whole numbers, unique, and only grow: a row that is added later with a
key below the offset is not read, nor are rows without a key. A table whose
largest key has fallen behind the offset is refused, as it would be read twice.

Python opens the files, so the path is a local or mounted folder, or a URI of a
store that pyarrow knows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import IntegerType, LongType, StructType

#: Before any key.
BEFORE = -(2 ** 63)
#: Rows of a table that one task reads, in whole row groups.
ROWS_PER_TASK = 1_000_000


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if ":/" in path else (pafs.LocalFileSystem(), path)


def _key_ranges(file: pq.ParquetFile, key: str) -> list[tuple[int, int, int, int]]:
    """(row group, rows, least key, largest key) of the row groups that hold a key."""
    about = file.metadata
    at = next(i for i in range(len(about.schema)) if about.schema.column(i).path == key)
    found = []
    for group in range(about.num_row_groups):
        known = about.row_group(group).column(at).statistics
        if known is not None and known.has_min_max:
            low, high = known.min, known.max
        else:
            ends = pc.min_max(file.read_row_group(group, [key]).column(0))
            low, high = ends["min"].as_py(), ends["max"].as_py()
        if low is not None:
            found.append((group, about.row_group(group).num_rows, low, high))
    return found


class KeyRange(InputPartition):
    """Row groups by file, and the keys wanted of them: behind ``start``, up to ``end``."""

    def __init__(self, pieces: Sequence[tuple[str, list[int]]], start: int, end: int) -> None:
        self.pieces, self.start, self.end = pieces, start, end


class KeysetStreamReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, path: str, key: str, after: int, rows_per_task: int) -> None:
        self.path, self.key, self.after, self.rows_per_task = path, key, after, rows_per_task
        self.arrow = to_arrow_schema(schema)
        #: Row groups by file; a file of the table never changes.
        self.known: dict[str, list[tuple[int, int, int, int]]] = {}

    def _groups(self) -> dict[str, list[tuple[int, int, int, int]]]:
        files, folder = _place(self.path)
        listed = files.get_file_info(pafs.FileSelector(folder, allow_not_found=True, recursive=True))
        for info in listed:
            inside = info.path[len(folder):].strip("/")
            hidden = any(part.startswith(("_", ".")) for part in inside.split("/"))
            if info.is_file and not hidden and info.path not in self.known:
                with files.open_input_file(info.path) as source:
                    self.known[info.path] = _key_ranges(pq.ParquetFile(source), self.key)
        return self.known

    def initialOffset(self) -> dict:  # noqa: N802
        return {"key": self.after}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"key": max((high for groups in self._groups().values() for *_, high in groups), default=self.after)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        low, high = start["key"], end["key"]
        if high < low:
            raise ValueError(f"the largest key of {self.path} was {low} and is {high} now; its rows would be read again")
        parts, pieces, rows = [], [], 0
        for file, groups in sorted(self._groups().items()):
            for group, held, least, largest in groups:
                if largest <= low or least > high:
                    continue
                if pieces and rows + held > self.rows_per_task:
                    parts.append(KeyRange(pieces, low, high))
                    pieces, rows = [], 0
                if pieces and pieces[-1][0] == file:
                    pieces[-1][1].append(group)
                else:
                    pieces.append((file, [group]))
                rows += held
        return [*parts, KeyRange(pieces, low, high)] if pieces else parts

    def read(self, partition: KeyRange) -> Iterator[pa.RecordBatch]:
        files, _ = _place(self.path)
        for path, groups in partition.pieces:
            with files.open_input_file(path) as source:
                for batch in pq.ParquetFile(source).iter_batches(row_groups=groups, columns=list({*self.arrow.names, self.key})):
                    keys = batch.column(self.key)
                    wanted = batch.filter(pc.and_(pc.greater(keys, partition.start), pc.less_equal(keys, partition.end)))
                    yield wanted.select(self.arrow.names).cast(self.arrow)


class KeysetSource(DataSource):
    """Options: ``path``, ``key``, and if wanted ``after`` (the first key to leave behind) and ``rows_per_task``."""

    @classmethod
    def name(cls) -> str:
        return "keyset"

    def schema(self) -> StructType:
        raise ValueError("name the table's schema: readStream.schema(...)")

    def streamReader(self, schema: StructType) -> KeysetStreamReader:  # noqa: N802
        key = self.options["key"]
        if key in schema.names and not isinstance(schema[key].dataType, (LongType, IntegerType)):
            raise ValueError(f"the key {key} must be a whole number")
        return KeysetStreamReader(schema, self.options["path"], key, int(self.options.get("after", BEFORE)),
                                  int(self.options.get("rows_per_task", ROWS_PER_TASK)))


def keyset_stream(spark: SparkSession, path: str, schema: StructType, key: str, **options: object) -> DataFrame:
    """The Parquet table at ``path`` as a stream that reads what lies behind the last key."""
    spark.dataSource.register(KeysetSource)
    return spark.readStream.format("keyset").schema(schema).options(path=path, key=key, **options).load()

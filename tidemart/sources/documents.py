"""Landed API documents, one JSON object per record."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemart.operators.quality import Split

_BROKEN = "_corrupt_record"


def _with_broken(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(_BROKEN, StringType())])


def parse_documents(df: DataFrame, schema: StructType, column: str = "value") -> Split:
    """JSON text parsed to ``schema``; records that fail are set aside as text.

    One broken record costs that record only.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    parsed = df.withColumn("_doc", F.from_json(F.col(column), _with_broken(schema), options))
    broken = F.col("_doc").isNull() | F.col(f"_doc.{_BROKEN}").isNotNull()
    others = [c for c in df.columns if c != column]
    return Split(
        parsed.filter(~broken).select(*others, *(F.col(f"_doc.{f}").alias(f) for f in schema.names)),
        parsed.filter(broken).select(*df.columns),
    )


def read_documents(spark: SparkSession, path: str, schema: StructType) -> Split:
    """JSON files (one object per line) in a folder."""
    return parse_documents(spark.read.text(path), schema)

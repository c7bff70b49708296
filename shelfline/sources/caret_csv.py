"""The ``^``-delimited files the shop imports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# NULL is written as nothing, empty text as "", quotes are doubled, blanks kept.
FORMAT = {
    "sep": "^",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "encoding": "UTF-8",
}


# Part files are read whole when records may span lines, so none gets larger than this.
ROWS_PER_FILE = 1_000_000

# Stands for NULL while reading, where empty text must stay empty; cannot occur in the data.
NO_VALUE = "\u0000"


def write_caret_csv(
    df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite"
) -> None:
    """Write part files with a header each."""
    writer = df.write.mode(mode).options(**FORMAT).option("maxRecordsPerFile", ROWS_PER_FILE)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def read_caret_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read the files back: empty text is ``""``, nothing is NULL, records may span lines."""
    options = FORMAT | {"nullValue": NO_VALUE, "emptyValue": "", "multiLine": "true"}
    return spark.read.schema(schema).options(**options).csv(path)

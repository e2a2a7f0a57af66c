"""Plain file sources and sinks beside the extracts."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A CSV file as a peer table; the schema is given, so no pass over the data infers it."""
    return spark.read.csv(path, header=True, schema=schema)


def table_bytes(df: DataFrame) -> int:
    """Bytes of the files a DataFrame reads, as their listing has them; nothing is read."""
    files = df.inputFiles()
    if not files:
        return 0
    paths = [re.sub(r"[][*?{}\\]", r"\\\g<0>", unquote(f)) for f in files]
    return df.sparkSession.read.format("binaryFile").load(paths).agg({"length": "sum"}).first()[0]


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), format: str = "parquet") -> DataFrame:
    """Materialise a read and continue from the written files."""
    writer = df.write.format(format).mode("errorifexists")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return df.sparkSession.read.format(format).schema(df.schema).load(path)

"""Event sources and sinks (JSON envelope)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EVENT


def read_events(spark: SparkSession, path: str, partitions: int | None = None) -> DataFrame:
    """Bulk read of JSON-lines event files (gzip read natively).

    The envelope schema is fixed, so no inference pass over the data.
    A gzip file is one task; pass ``partitions`` to spread the rows out
    after the read when the input is a few large ``.gz`` files.
    """
    df = spark.read.schema(EVENT).json(path)
    if partitions:
        df = df.repartition(partitions)
    return df


def read_events_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Incremental file source: each new JSON file in ``path`` is read once."""
    reader = spark.readStream.schema(EVENT)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.json(path)


def write_events(df: DataFrame, path: str, mode: str = "append",
                 compression: str | None = None) -> None:
    """Write events as JSON lines in envelope form (the landing-folder format)."""
    out = df.select(*[F.col(f.name).cast(f.dataType) for f in EVENT.fields])
    writer = out.write.mode(mode)
    if compression:
        writer = writer.option("compression", compression)
    writer.json(path)


def read_lines_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Lines of event files as text (column ``value``), nothing parsed yet."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    return reader.text(path)

"""Small files on shared storage, through Hadoop's FileSystem API."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a file, None where there is none."""
    fs, p = _open(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that appears whole or not at all (rename)."""
    fs, p = _open(spark, path)
    temp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.writing")
    stream = fs.create(temp, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(temp, p):
        raise OSError(f"cannot rename to {path}")


def names(spark: SparkSession, path: str) -> list[str]:
    """Names inside a folder (none where there is no folder)."""
    fs, p = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _open(spark, path)
    fs.delete(p, True)

"""Small files and folders on any Hadoop filesystem, through the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, p = _fs(spark, path)
        fs.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no folder."""
    fs, p = _fs(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(p)) if fs.exists(p) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """The file appears whole, under its name, or not at all; an older one is replaced."""
    fs, p = _fs(spark, path)
    _, temp = _fs(spark, f"{path}.tmp")
    out = fs.create(temp, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(p, False)
    if not fs.rename(temp, p):
        raise OSError(f"{path} could not be written")


def read_text(spark: SparkSession, path: str) -> str | None:
    """The file's text; None if there is no file."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()

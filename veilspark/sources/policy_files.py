"""Policy file reading through Spark (any Hadoop filesystem)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def read_policy_text(spark: SparkSession, path: str) -> str:
    """The whole text of one policy file.

    A policy is a small configuration document (a rule per field), so its one
    row is brought to the driver, where it is compiled into expressions.
    Raises ``FileNotFoundError`` when the path does not exist.
    """
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        exists = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)
    except Exception:  # no JVM handle (remote session): the read below reports a missing path
        exists = True
    if not exists:
        raise FileNotFoundError(path)
    rows = spark.read.text(path, wholetext=True).take(1)
    if not rows:
        raise ValueError(f"empty policy file: {path}")
    return rows[0][0]

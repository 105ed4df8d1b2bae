"""File-system calls through Hadoop, so that any store Spark can read works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _resolve(spark, path)
    return fs.exists(jpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = _resolve(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def remove(spark: SparkSession, path: str) -> None:
    fs, jpath = _resolve(spark, path)
    fs.delete(jpath, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, source = _resolve(spark, path)
    if not fs.rename(source, _resolve(spark, to)[1]):
        raise OSError(f"cannot rename {path} to {to}")


def make_passing_dir(spark: SparkSession, path: str) -> None:
    """Make a folder that the file system removes when the driver ends."""
    fs, jpath = _resolve(spark, path)
    if not fs.exists(jpath):
        fs.mkdirs(jpath)
        fs.deleteOnExit(jpath)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, jpath = _resolve(spark, path)
    fs.mkdirs(jpath)


def glob(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in the form that the pattern has."""
    fs, jpath = _resolve(spark, pattern)
    found = fs.globStatus(jpath) or []
    base = pattern.split("*", 1)[0].rsplit("/", 1)[0]
    whole = fs.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(base)).toString()
    return sorted(base + str(s.getPath().toString()).removeprefix(whole) for s in found)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, jpath = _resolve(spark, path)
    return int(fs.getContentSummary(jpath).getLength())

"""Small file operations through Hadoop, so any shared file system works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    system, target = _open(spark, path)
    return system.getFileStatus(target).isDirectory()


def make_folder(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.mkdirs(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible entries of a folder; none if it does not exist."""
    system, target = _open(spark, path)
    if not system.exists(target):
        return []
    names = [status.getPath().getName() for status in system.listStatus(target)]
    return sorted(name for name in names if not name.startswith(("_", ".")))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    system, target = _open(spark, path)
    return system.getContentSummary(target).getLength()


def publish(spark: SparkSession, staged: str, final: str) -> bool:
    """Rename a finished folder or file to its final name; false if that name is taken."""
    system, source = _open(spark, staged)
    target = spark._jvm.org.apache.hadoop.fs.Path(final)
    if system.exists(target):
        return False
    system.mkdirs(target.getParent())
    if not system.rename(source, target):
        raise OSError(f"cannot rename {staged} to {final}")
    return True


def remove(spark: SparkSession, path: str) -> None:
    system, target = _open(spark, path)
    system.delete(target, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, target = _open(spark, path)
    stream = system.create(target, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    system, target = _open(spark, path)
    stream = system.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()

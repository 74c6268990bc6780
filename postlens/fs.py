"""Small file-system questions (does it exist, what is in it), answered by Hadoop's FileSystem, so
that any store Spark reads will do."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _at(spark, path)
    return bool(fs.exists(target))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, target = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, target = _at(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _at(spark, path)
    stream = fs.open(target)
    try:
        return str(stream.readUTF())
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a short text as a new file; fails if there is one."""
    fs, target = _at(spark, path)
    stream = fs.create(target, False)
    try:
        stream.writeUTF(text)
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a short text as a new file; False if there is one (also if another writer was faster)."""
    fs, target = _at(spark, path)
    if fs.exists(target):
        return False
    try:
        write_text(spark, path, text)
    except Py4JJavaError as e:
        if fs.exists(target):
            return False
        raise e
    return True

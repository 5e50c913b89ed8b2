"""Folder questions that work on any file system Spark can read (local, HDFS, object store)."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _located(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there."""
    files, location = _located(spark, path)
    return files.exists(location)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob; empty if there are none."""
    files, location = _located(spark, pattern)
    return [str(status.getPath().toString()) for status in files.globStatus(location) or []]


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder with its contents."""
    files, location = _located(spark, path)
    files.delete(location, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another, which is removed if it is there."""
    files, location = _located(spark, target)
    files.delete(location, True)
    files.mkdirs(location.getParent())
    if not files.rename(_located(spark, source)[1], location):
        raise OSError(f"{source} could not be moved to {target}")


def add(spark: SparkSession, source: str, target: str) -> None:
    """Put the files of a folder beside those of another; their names must differ."""
    files, location = _located(spark, target)
    files.mkdirs(location)
    for status in files.listStatus(_located(spark, source)[1]):
        path = status.getPath()
        if not files.rename(path, location.suffix(f"/{path.getName()}")):
            raise OSError(f"{path} could not be moved to {target}")


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless there is one of that name; says whether it was written. Only one of several callers succeeds."""
    files, location = _located(spark, path)
    try:
        stream = files.create(location, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName() or files.exists(location):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def content(spark: SparkSession, path: str) -> str:
    """Text of a small file; empty if it is gone or not written to its end."""
    files, location = _located(spark, path)
    try:
        stream = files.open(location)
    except Py4JJavaError:
        if files.exists(location):
            raise
        return ""
    text = bytes(stream.readAllBytes()).decode()
    stream.close()
    return text


def listed_files(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The files below some folders: path, length, modificationTime; their content is not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folders)
    return found.select("path", "length", "modificationTime")


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder all executors can reach, below ``spark.checkpoint.dir``; whoever owns that folder clears it.

    Only where the session names none and its master is local, a folder of this machine is taken.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/eventmart-{purpose}-{uuid.uuid4().hex}"

"""Small file operations over Hadoop's file system, so that any shared store will do."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def located(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system of a path, and the path in it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = located(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    fs, place = located(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; a missing one is no error."""
    fs, place = located(spark, path)
    fs.delete(place, True)


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file; False, and nothing is written, if it is there already.

    Of several writers one creates the file. A last line break marks that all
    was written.
    """
    fs, place = located(spark, path)
    try:
        out = fs.create(place, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(place):
            return False
        raise
    out.write(bytearray((text + "\n").encode()))
    out.close()
    return True


def text_of(spark: SparkSession, path: str) -> str | None:
    """What ``create`` wrote; None if the file is missing or its writer died midway."""
    fs, place = located(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text[:-1] if text.endswith("\n") else None

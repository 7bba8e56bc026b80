"""Small files through Hadoop's file systems, so that any path that Spark can write serves."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Taken(Exception):
    """The file is there already."""


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file."""
    system, place = _path(spark, path)
    out = system.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _path(spark, path)
    stream = system.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a small file that was not there, whole or not at all: it is written beside and renamed. ``Taken`` if it is there.

    On local disks the new name is a link, elsewhere a rename that refuses a name that is taken, which is one step on HDFS.
    """
    jvm = spark._jvm
    aside = f"{path}.{jvm.java.util.UUID.randomUUID().toString()}.tmp"
    write_text(spark, aside, text)
    system, source = _path(spark, aside)
    _, target = _path(spark, path)
    try:
        if system.getUri().getScheme() == "file":
            local = lambda p: jvm.java.io.File(p.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(target), local(source))
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration()).rename(source, target, none)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise Taken(path) from None
        raise
    finally:
        system.delete(source, False)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if it is not there."""
    system, place = _path(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    system, place = _path(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    system, place = _path(spark, path)
    if not system.rename(place, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be renamed to {to}")

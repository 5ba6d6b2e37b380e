"""Small files and folders on whatever file system a name belongs to, through Hadoop's interface."""

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    """The file system of ``path`` and the path as it knows it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return system, system.makeQualified(place)


def _names(spark: SparkSession, path: str, folders: bool) -> list[str]:
    system, place = _system(spark, path)
    if not system.exists(place):
        return []
    return [entry.getPath().getName() for entry in system.listStatus(place) if entry.isDirectory() == folders]


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """The sub-folders of ``path``; none if it is not there."""
    return _names(spark, path, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """The files in ``path``; none if it is not there."""
    return _names(spark, path, False)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if it is not there."""
    system, place = _system(spark, path)
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with ``text``, whole or not at all; False if the name is taken.

    The text is written under another name and renamed to its own, which fails if that exists. So
    of many that try, one succeeds, and nobody reads half a file.
    """
    system, place = _system(spark, path)
    if system.exists(place):
        return False
    jvm = spark._jvm
    draft = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), system.getConf())
    keep = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(draft, place, keep)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def deliver(spark: SparkSession, folder: str, target: str) -> None:
    """Move a finished folder to where a stream looks for it, all its files at once."""
    system, place = _system(spark, folder)
    _, to = _system(spark, target)
    system.mkdirs(to.getParent())
    if system.exists(to) or not system.rename(place, to):
        raise ValueError(f"{folder} could not be moved to {target}")


def copy(spark: SparkSession, folder: str, target: str) -> None:
    """Copy a folder byte by byte, through the driver; for small folders."""
    system, place = _system(spark, folder)
    other, to = _system(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(system, place, other, to, False, system.getConf())


def drop(spark: SparkSession, folder: str) -> None:
    """Delete a folder and what is in it; nothing if it is not there."""
    system, place = _system(spark, folder)
    system.delete(place, True)

"""Folders of Parquet and text tables, through the file system that Spark uses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder, by one listing; none if it is missing."""
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(target))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if it is missing."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def read_file(spark: SparkSession, path: str) -> str:
    """The whole content of a small file."""
    files, target = _file_system(spark, path)
    stream = files.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, content: str) -> bool:
    """Create a file with its whole content unless there is one; whether it was created.

    The content is written aside and renamed without overwriting, so nobody sees a
    part of it, and of several writers one succeeds. That is as strict as the file
    system's rename: HDFS refuses an existing target; an object store must do so too.
    """
    jvm = spark._jvm
    files, target = _file_system(spark, path)
    aside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}")
    files.mkdirs(target.getParent())
    out = files.create(aside, False)
    out.write(bytearray(content.encode()))
    out.close()
    modes = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    mode = spark.sparkContext._gateway.new_array(modes, 1)
    mode[0] = modes.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.getUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(files.makeQualified(aside), files.makeQualified(target), mode)
        return True
    except Py4JJavaError as failed:
        if "FileAlreadyExistsException" not in failed.java_exception.getClass().getName():
            raise
        return False
    finally:
        files.delete(aside, False)
